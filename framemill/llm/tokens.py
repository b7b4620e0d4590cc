"""Encoding of a corpus with a public byte-level BPE vocabulary, by forced boundaries.

A byte pair that occurs inside no vocabulary entry can't be inside a token, so a text may be cut there and the fragments
encoded apart. Almost every such cut is a word's edge; fragments therefore repeat a great deal, and each distinct one
is encoded once and looked up after that. Cuts where the pre-tokenizer would see something else at a fragment's edge than
in the whole text (after white space, before an apostrophe, inside a character) aren't taken.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framemill.session import spread

# Fixed value: how this vocabulary's texts are pre-tokenized.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Where the vocabulary files of public tokenizers lie.
TOKENIZERS = os.environ.get("FRAMEMILL_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
#: A vocabulary file above this size isn't broadcast.
MAX_VOCABULARY_BYTES = 16 << 20
#: Distinct fragments that a worker remembers before it starts afresh.
REMEMBERED = 200_000
#: Slots of the table of remembered fragments: it stays sparse, as a block adds at most its own fragments.
SLOTS = 1 << 20
#: Fragments taken at once.
BLOCK = 100_000

_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class FragmentEncoder:
    """Ids of texts under the ranks of a vocabulary file (base64 token and rank a line)."""

    def __init__(self, ranks_file: bytes):
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in ranks_file.splitlines() if line)}
        self.encoding = tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        inside = np.zeros(1 << 16, bool)
        joined = np.frombuffer(b"".join(ranks), np.uint8).astype(np.int64)
        ends = np.cumsum([len(t) for t in ranks]) - 1
        pair = joined[:-1] * 256 + joined[1:]
        same = np.ones(len(pair), bool)
        same[ends[:-1]] = False
        inside[pair[same]] = True
        self.certain = ~inside
        self.certain &= ~np.isin(np.arange(1 << 16) & 255, [0x27, *range(0x80, 0xC0)])  # before an apostrophe, inside a character
        self.certain &= ~np.isin(np.arange(1 << 16) >> 8, [*range(0x09, 0x0E), *range(0x1C, 0x21)])  # after white space
        # Last bytes of white space outside ASCII, when the byte before is one of those that such characters have there.
        self.space_end = np.isin(np.arange(256), [*range(0x80, 0x8B), 0x85, 0xA0, 0xA8, 0xA9, 0xAF, 0x9F])
        self.space_middle = np.isin(np.arange(256), [0xC2, 0x9A, 0x80, 0x81])
        self._forget()

    def _forget(self) -> None:
        self.long: dict[bytes, int] = {}  # fragments of more than 16 bytes
        self.table = _ShortFragments(SLOTS)
        self.ids, self.n_ids = np.zeros(1 << 16, np.int32), 0
        self.start, self.size, self.n = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), 0

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Positions in ``data`` (bytes) at which it may be cut."""
        if len(data) < 2:
            return np.zeros(0, np.int64)
        at = np.flatnonzero(self.certain[data[:-1].astype(np.int32) * 256 + data[1:]]) + 1
        before = np.where(at >= 2, data[np.maximum(at - 2, 0)], 0)
        return at[~(self.space_end[data[at - 1]] & self.space_middle[before])]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, offsets by text). Bytes that aren't UTF-8 count as U+FFFD."""
        whole = b"".join(texts)
        try:
            whole.decode()
        except UnicodeDecodeError:
            texts = [t.decode(errors="replace").encode() for t in texts]
            whole = b"".join(texts)
        ends = np.cumsum([0, *map(len, texts)])
        edge = np.zeros(len(whole) + 1, bool)
        edge[ends] = True
        edge[self.cuts(np.frombuffer(whole, np.uint8))] = True
        edges = np.flatnonzero(edge)
        parts, sizes = [], [np.zeros(1, np.int64)]
        padded = np.frombuffer(whole + bytes(8), np.uint8)
        for start in range(0, len(edges) - 1, BLOCK):
            ids, lengths = self._fragments(whole, padded, edges[start : start + BLOCK + 1])
            parts.append(ids)
            sizes.append(lengths)
        ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        until = np.cumsum(np.concatenate(sizes))
        return ids, until[np.searchsorted(edges, ends)]

    def _fragments(self, whole: bytes, padded: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.n > REMEMBERED:
            self._forget()
        begin, length = edges[:-1], np.diff(edges)
        words = np.ndarray((len(padded) - 7,), np.uint64, padded, 0, (1,))  # the 8 bytes from each position on
        head = words[begin] & _MASK[np.minimum(length, 8)]
        tail = words[np.maximum(begin + length - 8, begin)] & _MASK[np.minimum(length, 8)]
        short = length <= 16
        code = np.full(len(begin), -1)
        if short.all():
            code = self.table.find(head, tail, length)
        else:
            code[short] = self.table.find(head[short], tail[short], length[short])
            for i in np.flatnonzero(~short):
                code[i] = self.long.get(whole[begin[i] : begin[i] + length[i]], -1)
        missing = np.flatnonzero(code < 0)
        if len(missing):
            fragments = [whole[i:j] for i, j in zip(begin[missing].tolist(), (begin + length)[missing].tolist(), strict=True)]
            new: dict[bytes, int] = {}
            for f in fragments:
                new.setdefault(f, self.n + len(new))
            encoded = self.encoding.encode_ordinary_batch([f.decode() for f in new], num_threads=1)
            self._add([np.array(e, np.int32) for e in encoded])
            code[missing] = [new[f] for f in fragments]
            self.long.update((f, c) for f, c in new.items() if len(f) > 16)
            _, one = np.unique(code[missing], return_index=True)
            one = missing[one]
            one = one[short[one]]
            self.table.add(head[one], tail[one], length[one], code[one])
        n_ids = self.size[code]
        shift = np.repeat(self.start[code] - (np.cumsum(n_ids) - n_ids), n_ids)
        return self.ids[shift + np.arange(len(shift))], n_ids

    def _add(self, lists: list[np.ndarray]) -> None:
        size = np.array([len(x) for x in lists])
        flat = np.concatenate(lists)
        while self.n + len(size) > len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        while self.n_ids + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.start[self.n : self.n + len(size)] = self.n_ids + np.cumsum(size) - size
        self.size[self.n : self.n + len(size)] = size
        self.ids[self.n_ids : self.n_ids + len(flat)] = flat
        self.n, self.n_ids = self.n + len(size), self.n_ids + len(flat)


class _ShortFragments:
    """Hash table from fragments of up to 16 bytes, as (first 8, last 8, length), to their code."""

    def __init__(self, slots: int):
        self.mask = np.uint64(slots - 1)
        self.head, self.tail = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64)
        self.length, self.code = np.zeros(slots, np.int8), np.full(slots, -1, np.int32)

    def _slot(self, head: np.ndarray, tail: np.ndarray, length: np.ndarray) -> np.ndarray:
        h = head * np.uint64(0x9E3779B97F4A7C15) ^ (tail + length.astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(31)
        return (h * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(20)) & self.mask

    def find(self, head: np.ndarray, tail: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Codes, -1 for what isn't there."""
        at = self._slot(head, tail, length)
        out = self.code[at].astype(np.int64)
        rest = np.flatnonzero((out >= 0) & ((self.head[at] != head) | (self.tail[at] != tail) | (self.length[at] != length)))
        at = at[rest]
        while len(rest):
            at = (at + np.uint64(1)) & self.mask
            found = self.code[at]
            out[rest] = found
            on = (found >= 0) & ((self.head[at] != head[rest]) | (self.tail[at] != tail[rest]) | (self.length[at] != length[rest]))
            rest, at = rest[on], at[on]
        return out

    def add(self, head: np.ndarray, tail: np.ndarray, length: np.ndarray, code: np.ndarray) -> None:
        """Fragments that aren't there yet, each once."""
        at, rest = self._slot(head, tail, length), np.arange(len(code))
        while len(rest):
            free = self.code[at] < 0
            self.code[at[free]] = code[rest[free]]
            own = self.code[at] == code[rest]
            slot, mine = at[own], rest[own]
            self.head[slot], self.tail[slot], self.length[slot] = head[mine], tail[mine], length[mine]
            rest, at = rest[~own], (at[~own] + np.uint64(1)) & self.mask


@lru_cache(maxsize=2)
def _encoder(ranks_file: bytes) -> FragmentEncoder:
    return FragmentEncoder(ranks_file)


def vocabulary_file(folder: str = TOKENIZERS, name: str = VOCABULARY) -> bytes:
    """The vocabulary's file, read on the driver; its size is checked as it is sent to every executor."""
    path = os.path.join(folder, name)
    if os.path.getsize(path) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is too large for a vocabulary")
    with open(path, "rb") as f:
        return f.read()


def slices(texts: list[bytes | None], most: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """(start, texts) of about ``most`` bytes; null counts as empty."""
    start, held, size = 0, [], 0
    for i, t in enumerate(texts):
        held.append(t or b"")
        size += len(held[-1])
        if size >= most:
            yield start, held
            start, held, size = i + 1, [], 0
    if held:
        yield start, held


def token_ids(documents: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """``<id_column>, ids ARRAY<INT>``: each text's token ids, without special tokens.

    Null and empty texts have the empty list. One row comes out for each row that goes in, whatever its id (null and
    repeated ids too). Strings of special tokens are ordinary text. Other columns aren't read.
    """
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary_file(folder, vocabulary))
    kind = dict(documents.dtypes)[id_column]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            for start, texts in slices(batch.column(1).to_pylist()):
                ids, offsets = encoder.encode(texts)
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.record_batch([batch.column(0).slice(start, len(texts)), lists], names=[id_column, "ids"])

    rows = documents.select(F.col(f"`{id_column}`"), F.col(f"`{text_column}`").cast("binary").alias("text_bytes"))
    return spread(rows).mapInArrow(encode, f"`{id_column}` {kind}, ids array<int>")
