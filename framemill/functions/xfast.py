"""x-fast tries over many small groups at once, vectorised.

A trie holds the sorted distinct keys ("leaves") of each group. For every prefix length there is one hash table whose
entries are (group, prefix) and carry the first and last leaf below that prefix. A query finds its longest stored
prefix by binary search over the lengths; the child that is missing there gives the predecessor or the successor at
once, and the leaves' order gives the other one.
"""

from __future__ import annotations

import numpy as np

_EMPTY = np.int64(-1)


def _mix(group: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """64-bit mix of a group number and a prefix."""
    h = group.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ (prefix.astype(np.uint64) + np.uint64(0x7F4A7C15)) * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class PrefixTable:
    """Open-addressing hash table from (group, prefix) to the leaf range [first, last]."""

    def __init__(self, group: np.ndarray, prefix: np.ndarray, first: np.ndarray, last: np.ndarray):
        size = 1 << max(3, int(2 * len(group)).bit_length())
        self.mask = np.int64(size - 1)
        self.slot = np.full(size, _EMPTY)
        self.group, self.prefix, self.first, self.last = group, prefix, first, last
        at = (_mix(group, prefix) & np.uint64(size - 1)).astype(np.int64)
        rest = np.arange(len(group))
        while len(rest):
            free = self.slot[at] == _EMPTY
            self.slot[at[free]] = rest[free]  # of several that want one slot, one stays
            lost = self.slot[at] != rest
            rest, at = rest[lost], (at[lost] + 1) & self.mask

    def find(self, group: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        """Entry number of each (group, prefix), or -1."""
        out = np.full(len(group), _EMPTY)
        at = (_mix(group, prefix) & np.uint64(self.mask)).astype(np.int64)
        rest = np.arange(len(group))
        while len(rest):
            entry = self.slot[at]
            here = entry != _EMPTY
            rest, at, entry = rest[here], at[here], entry[here]
            hit = (self.group[entry] == group[rest]) & (self.prefix[entry] == prefix[rest])
            out[rest[hit]] = entry[hit]
            rest, at = rest[~hit], (at[~hit] + 1) & self.mask
        return out


class XFastTries:
    """Tries of ``bits``-bit keys, one per group number; leaves must be sorted by (group, key) and distinct."""

    def __init__(self, group: np.ndarray, key: np.ndarray, bits: int):
        self.group, self.key, self.bits = group, key, bits
        self.levels: list[PrefixTable] = []
        count = len(group)
        for length in range(bits + 1):
            prefix = key >> np.int64(bits - length)
            start = np.ones(count, bool)
            if count:
                start[1:] = (group[1:] != group[:-1]) | (prefix[1:] != prefix[:-1])
            first = np.flatnonzero(start)
            last = np.append(first[1:], count)[: len(first)] - 1
            self.levels.append(PrefixTable(group[first], prefix[first], first, last))

    def neighbours(self, group: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaf numbers of the last key <= and the first key >= each query, -1 where there is none."""
        n = len(group)
        low, high = np.zeros(n, np.int64), np.full(n, self.bits, np.int64)
        entry = self.levels[0].find(group, np.zeros(n, np.int64))
        known = entry != _EMPTY
        while True:  # invariant: the prefix of length low is stored, that of high + 1 is not
            open_ = known & (low < high)
            if not open_.any():
                break
            middle = (low + high + 1) // 2
            for length in np.unique(middle[open_]):
                rows = np.flatnonzero(open_ & (middle == length))
                found = self.levels[length].find(group[rows], key[rows] >> np.int64(self.bits - length))
                hit = found != _EMPTY
                low[rows[hit]], entry[rows[hit]] = length, found[hit]
                high[rows[~hit]] = length - 1
        before, after = np.full(n, _EMPTY), np.full(n, _EMPTY)
        for length in np.unique(low[known]):
            rows = np.flatnonzero(known & (low == length))
            table = self.levels[length]
            first, last = table.first[entry[rows]], table.last[entry[rows]]
            if length == self.bits:
                before[rows] = after[rows] = first
                continue
            ones = (key[rows] >> np.int64(self.bits - length - 1)) & 1
            # The missing child is the 1: all leaves below are smaller, the last one is the predecessor; else the first is the successor.
            before[rows] = np.where(ones == 1, last, first - 1)
            after[rows] = np.where(ones == 1, last + 1, first)
        for side in (before, after):
            bad = (side < 0) | (side >= len(self.group))
            side[bad] = _EMPTY
            ok = np.flatnonzero(~bad)
            side[ok[self.group[side[ok]] != group[ok]]] = _EMPTY
        return before, after
