"""Class-conditional character models with Kneser-Ney smoothing, as one table of log-likelihood ratios.

Two classes, toxic and ordinary, have their own n-gram counts for the higher orders; the lower orders are continuation
counts over both classes together, so that rare expressions fall back on shared ground. What scoring needs is only the
difference of the two log-likelihoods of each character, and that is a back-off model again: a difference for each
n-gram seen and, for a context whose continuation is new, the difference of the two classes' back-off weights.
"""

from __future__ import annotations

import io
import re
import unicodedata

import numpy as np

#: Longest n-gram, in characters, and the longest one whose counts the classes share.
ORDER, SHARED = 6, 2

# Look-alike letters, and digits and signs in the place of letters.
_LOOKALIKES = str.maketrans("авсԁеёһіїјкӏмнорԛѕтυνѵԝхуαβγεικορτχ", "abcdeehiijklmhopqstuvvwxyabyeikoptx")
_SPELLED = str.maketrans("0134578@$!|", "oieastbasii")
_NUMBER = re.compile(r"\d+")
_HIDDEN = re.compile("[\u00ad\u200b-\u200f\u2060-\u2064\ufeff\u0300-\u036f\ufe00-\ufe0f]")
_SPACED = re.compile(r"(?<![^\W\d_])(?:[^\W\d_][ .\-_*]){2,}[^\W\d_](?![^\W\d_])")
_TWICE = re.compile(r"([^\W\d_])\1+")
_HEX = re.compile(r"\b(?=[a-f]*\d)[\da-f]{6,}\b")
_LEET = re.compile(r"[a-z0-9@$!|]*[0134578@$!|][a-z][a-z0-9@$!|]*")


_LONE = re.compile(r"[ .\-_*][^\W\d_][ .\-_*][^\W\d_](?![^\W\d_])")
_HANGUL = re.compile("[가-힣]")
#: Words whose plain form a worker remembers before it starts afresh; longer ones than the second number aren't kept.
REMEMBERED_WORDS, LONGEST_WORD = 200_000, 40
_words: tuple[dict[str, str], dict[str, str]] = ({}, {})


def plain(text: str) -> str:
    """Text as the models see it: case, look-alikes, digits for letters, hidden marks, spaced and repeated letters undone.

    Only hidden marks and spaced letters reach over white space; all else is done by word, and words repeat.
    """
    text = unicodedata.normalize("NFKC", text).casefold()
    hangul = False
    if not text.isascii():
        text = _HIDDEN.sub("", text)
        hangul = _HANGUL.search(text) is not None
    if _LONE.search(text):
        text = _SPACED.sub(lambda m: re.sub(r"[ .\-_*]", "", m[0]), text)
    known = _words[hangul]
    return " ".join(filter(None, [known.get(w) or _word(w, hangul) for w in text.split()]))


def _word(word: str, hangul: bool) -> str:
    out = word
    if not out.isascii():
        # Hangul would fall apart into its letters.
        out = _HIDDEN.sub("", out if hangul else unicodedata.normalize("NFD", out)).translate(_LOOKALIKES)
    out = _LEET.sub(lambda m: m[0].translate(_SPELLED), _HEX.sub("#", out))
    out = " ".join(_TWICE.sub(r"\1", _NUMBER.sub("0", out)).replace("_", " ").split())
    if len(word) <= LONGEST_WORD:
        if len(_words[hangul]) >= REMEMBERED_WORDS:
            _words[hangul].clear()
        _words[hangul][word] = out
    return out


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points with ORDER - 1 separators before each text, start of each text, its length)."""
    pad = "\n" * (ORDER - 1)
    lengths = np.array([len(t) for t in texts], np.int64)
    flat = np.frombuffer((pad + pad.join(texts)).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    starts = np.cumsum(lengths + ORDER - 1) - lengths
    return flat, starts, lengths


def _hashes(flat: np.ndarray, order: int) -> list[np.ndarray]:
    """Hashes of the last 0, 1, ..., ``order`` characters up to each position."""
    out = [np.full(len(flat), np.uint64(0x9E3779B97F4A7C15))]
    for back in range(order):
        c = flat if not back else np.concatenate([np.full(back, 10, np.uint64), flat[:-back]])[: len(flat)]
        h = (out[-1] ^ c) * np.uint64(0xC2B2AE3D27D4EB4F)
        out.append((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9))
    return out


class RatioModel:
    """Table from n-gram hash to (difference of log-likelihoods, difference of back-off weights)."""

    def __init__(self, key: np.ndarray, ratio: np.ndarray, backoff: np.ndarray):
        bits = max(4, int(2 * len(key)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.key, self.ratio, self.backoff = key, ratio.astype(np.float32), backoff.astype(np.float32)
        self.slot = np.full(1 << bits, -1, np.int32)
        at, rest = (key >> self.shift).astype(np.int64), np.arange(len(key))
        while len(rest):
            free = self.slot[at] < 0
            self.slot[at[free]] = rest[free]
            lost = self.slot[at] != rest
            rest, at = rest[lost], (at[lost] + 1) & self.mask

    def find(self, key: np.ndarray) -> np.ndarray:
        """Entry of each hash, -1 where there is none."""
        if not len(self.key):
            return np.full(len(key), -1)
        at = (key >> self.shift).astype(np.int64)
        out = self.slot[at].astype(np.int64)
        rest = np.flatnonzero((out >= 0) & (self.key[out] != key))
        at = at[rest]
        while len(rest):
            at = (at + 1) & self.mask
            out[rest] = self.slot[at]
            on = (out[rest] >= 0) & (self.key[out[rest]] != key[rest])
            rest, at = rest[on], at[on]
        return out

    def per_character(self, flat: np.ndarray) -> np.ndarray:
        """Difference of the classes' log-likelihoods of each character, given those before it."""
        total = np.zeros(len(flat), np.float32)
        hashes = _hashes(flat, ORDER)
        open_ = np.arange(len(flat))
        for order in range(ORDER, 0, -1):
            here = self.find(hashes[order][open_])
            seen = here >= 0
            total[open_[seen]] += self.ratio[here[seen]]
            open_ = open_[~seen]
            if not len(open_):
                break
            if order > 1:
                context = self.find(hashes[order - 1][open_ - 1])
                known = context >= 0
                total[open_[known]] += self.backoff[context[known]]
        return total

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, key=self.key, ratio=self.ratio, backoff=self.backoff)
        return out.getvalue()

    @staticmethod
    def from_bytes(data: bytes) -> RatioModel:
        x = np.load(io.BytesIO(data))
        return RatioModel(x["key"], x["ratio"], x["backoff"])


#: Characters counted at once.
CHUNK = 1 << 20


class GramCounts:
    """Distinct n-grams of one class for each order: hash, count, hash of the context and of the n-gram without its first character."""

    def __init__(self, texts: list[str]):
        none = np.zeros(0, np.uint64)
        self.orders = [(none, np.zeros(0, np.int64), none, none)] * ORDER
        held: list[str] = []
        size = 0
        for text in texts:
            held.append(text)
            size += len(text) + ORDER
            if size >= CHUNK:
                self._count(held)
                held, size = [], 0
        if held:
            self._count(held)

    def _count(self, texts: list[str]) -> None:
        codes, starts, lengths = _codes(texts)
        at = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        hashes = _hashes(codes, ORDER)
        for k in range(1, ORDER + 1):
            key, first, count = np.unique(hashes[k][at], return_index=True, return_counts=True)
            self._merge(k, key, count, hashes[k - 1][at[first] - 1], hashes[k - 1][at[first]])

    def _merge(self, k: int, key: np.ndarray, count: np.ndarray, context: np.ndarray, shorter: np.ndarray) -> None:
        old = self.orders[k - 1]
        both = [np.concatenate([a, b]) for a, b in zip(old, (key, count, context, shorter), strict=True)]
        merged, first, inverse = np.unique(both[0], return_index=True, return_inverse=True)
        self.orders[k - 1] = (merged, np.bincount(inverse, both[1], minlength=len(merged)).astype(np.int64), both[2][first], both[3][first])

    def __add__(self, other: GramCounts) -> GramCounts:
        out = GramCounts([])
        out.orders = list(self.orders)
        for k, o in enumerate(other.orders, 1):
            out._merge(k, *o)
        return out


#: Occurrences in ordinary texts that wrong labels explain, for each one in toxic texts; they are taken off the ordinary counts.
MISLABELLED = 0.2


def fit(toxic: GramCounts, ordinary: GramCounts, shared: int = SHARED, mislabelled: float = MISLABELLED) -> RatioModel:
    """The model of two classes' counts.

    A toxic expression that wrong labels put among the ordinary texts just once would be as certain there, once begun, as
    in the toxic class. So the ordinary counts are lowered by what ``mislabelled`` expects; common expressions, which toxic
    texts hold no more often than their share, hardly change.
    """
    grams = []
    for k in range(1, ORDER + 1):
        t, o = toxic.orders[k - 1], ordinary.orders[k - 1]
        key, first = np.unique(np.concatenate([t[0], o[0]]), return_index=True)
        counts = []
        for side in (t, o):
            n = np.zeros(len(key))
            n[np.searchsorted(key, side[0])] = side[1]
            counts.append(n)
        counts[1] = np.floor(np.maximum(counts[1] - mislabelled * counts[0], 0))
        grams.append((key, counts, np.concatenate([t[2], o[2]])[first], np.concatenate([t[3], o[3]])[first]))

    keys, ratios, backoffs = [], [], []
    lower: list[np.ndarray] = []
    lower_key = np.zeros(0, np.uint64)
    letters = len(grams[0][0]) + 1
    for k in range(1, ORDER + 1):
        key, by_class, context, shorter = grams[k - 1]
        if k < ORDER:  # continuation counts: how many different characters precede
            longer = grams[k]
            into = np.searchsorted(key, longer[3])
            by_class = [np.bincount(into, longer[1][c] > 0, minlength=len(key)) for c in (0, 1)]
            if k <= shared:
                by_class = [np.bincount(into, minlength=len(key)).astype(np.float64)] * 2
        context_key, context_of = np.unique(context, return_inverse=True)
        here, weights = [], []
        for c in (0, 1):
            n = by_class[c]
            once, twice = (n == 1).sum(), (n == 2).sum()
            discount = min(max(once / max(once + 2 * twice, 1), 0.1), 0.95)
            total = np.bincount(context_of, n, minlength=len(context_key))
            kinds = np.bincount(context_of, n > 0, minlength=len(context_key))
            weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
            below = np.full(len(key), 1.0 / letters) if k == 1 else lower[c][np.searchsorted(lower_key, shorter)]
            here.append(np.where(total[context_of] > 0, np.maximum(n - discount, 0) / np.maximum(total[context_of], 1), 0) + weight[context_of] * below)
            weights.append(weight)
        keys.append(key)
        ratios.append(np.log(here[0]) - np.log(here[1]))
        backoffs.append(np.zeros(len(key)))
        if k > 1 and len(keys[k - 2]):
            place = np.minimum(np.searchsorted(keys[k - 2], context_key), len(keys[k - 2]) - 1)
            ok = keys[k - 2][place] == context_key
            backoffs[k - 2][place[ok]] = (np.log(weights[0]) - np.log(weights[1]))[ok]
        lower, lower_key = here, key
    return RatioModel(np.concatenate(keys), np.concatenate(ratios), np.concatenate(backoffs))


#: Window widths, in characters, and what is added to a width before a window's sum is divided by it: short windows need more per character.
WIDTHS, STEADY = (12, 24, 48), 20


def scores(model: RatioModel, texts: list[str]) -> np.ndarray:
    """For each text the largest length-normalised difference of the classes' log-likelihoods over its windows; 0 without characters."""
    flat, starts, lengths = _codes(texts)
    total = np.concatenate([[0.0], np.cumsum(model.per_character(flat), dtype=np.float64)])
    best = np.full(len(texts), -np.inf)
    for width in WIDTHS:
        take = np.maximum(lengths - width, 0) + 1
        begin = np.repeat(starts - (np.cumsum(take) - take), take) + np.arange(take.sum())
        window = total[np.minimum(begin + width, np.repeat(starts + lengths, take))] - total[begin]
        best = np.maximum(best, np.maximum.reduceat(window / (width + STEADY), np.cumsum(take) - take))
    return np.where(lengths > 0, best, 0.0)


def toxic_parts(model: RatioModel, texts: list[str], width: int = 40, least: float = 0.3) -> list[str]:
    """The stretches of texts that windows above ``least`` per character cover."""
    flat, starts, lengths = _codes(texts)
    total = np.concatenate([[0.0], np.cumsum(model.per_character(flat), dtype=np.float64)])
    out = []
    for text, s, n in zip(texts, starts.tolist(), lengths.tolist(), strict=True):
        w = min(width, n)
        above = np.flatnonzero((total[s + w : s + n + 1] - total[s : s + n - w + 1]) / width > least) if n else []
        covered = np.zeros(n + 2, np.int8)
        for i in above:
            covered[i + 1 : i + w + 1] = 1
        edge = np.flatnonzero(np.diff(covered))
        out += [text[a:b] for a, b in zip(edge[::2], edge[1::2], strict=True)]
    return out
