"""Set reconciliation by characteristic polynomials over GF(2**61 - 1), for many small buckets at once.

A set S of field elements has the polynomial prod(z - x). Its values at d agreed points are the sketch of S. The ratio
of two sketches is a rational function whose reduced numerator and denominator have just the elements of A - B and
B - A as roots. With as many points as there are differences, plus a few for verification, both come out of a linear
system; each side then tells by evaluation which of its own elements are roots.
"""

from __future__ import annotations

import numpy as np

P = np.uint64((1 << 61) - 1)
_ONE, _S61, _S31, _S30 = np.uint64(1), np.uint64(61), np.uint64(31), np.uint64(30)
_LOW31, _LOW30 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
#: Elements lie below 2**60 and evaluation points above, so no sketch value is 0.
ELEMENT_BITS = 60
#: Evaluation points that only verify.
VERIFY = 2


def mul(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b mod P of reduced uint64 arrays."""
    ah, al, bh, bl = a >> _S31, a & _LOW31, b >> _S31, b & _LOW31
    mid = ah * bl + al * bh
    s = ((ah * bh) << _ONE) + (mid >> _S30) + ((mid & _LOW30) << _S31) + al * bl
    s = (s & P) + (s >> _S61)
    return np.where(s >= P, s - P, s)


def sub(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a - b mod P."""
    return np.where(a >= b, a - b, a + (P - b))


def power(a: np.ndarray, e: int) -> np.ndarray:
    """a ** e mod P."""
    out = np.ones_like(a)
    while e:
        if e & 1:
            out = mul(out, a)
        e >>= 1
        if e:
            a = mul(a, a)
    return out


def inverse(a: np.ndarray) -> np.ndarray:
    """1 / a mod P of nonzero elements."""
    return power(a, int(P) - 2)


def points(count: int) -> np.ndarray:
    """The agreed evaluation points: fixed, distinct, all from 2**60 on."""
    step = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7)
    return (np.uint64(1) << np.uint64(ELEMENT_BITS)) + step % np.uint64((1 << ELEMENT_BITS) - 2)


def sketch(element: np.ndarray, bucket: np.ndarray, buckets: int, z: np.ndarray, taken: np.ndarray | None = None) -> np.ndarray:
    """Values (buckets, len(z)) of each bucket's characteristic polynomial; ``bucket`` is sorted. ``taken`` picks elements."""
    if taken is not None:
        element, bucket = element[taken], bucket[taken]
    out = np.ones((buckets, len(z)), np.uint64)
    if not len(element):
        return out
    size = np.bincount(bucket, minlength=buckets)
    place = np.arange(len(bucket)) - np.repeat(np.cumsum(size) - size, size)
    factors = sub(np.broadcast_to(z, (len(element), len(z))), element[:, None])
    longest = int(size.max())
    while longest > 1:  # fold the upper half of each bucket onto its lower half
        half = (longest + 1) // 2
        upper = np.flatnonzero(place >= half)
        factors[upper - half] = mul(factors[upper - half], factors[upper])
        keep = place < half
        factors, bucket, place = factors[keep], bucket[keep], place[keep]
        longest = half
    out[bucket] = factors
    return out


def solve(ratio: np.ndarray, z: np.ndarray, up: int, down: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Monic numerators (n, up + 1) and denominators (n, down + 1), lowest power first, whose quotient takes the values
    ``ratio`` (n, up + down) at ``z``; and which of the n systems have a solution. Free unknowns become 0, which
    multiplies both polynomials by a common factor."""
    n, m = len(ratio), up + down
    powers = np.ones((m, max(up, down) + 1), np.uint64)
    for i in range(1, powers.shape[1]):
        powers[:, i] = mul(powers[:, i - 1], z[:m])
    a = np.zeros((n, m, m + 1), np.uint64)
    a[:, :, :up] = powers[:, :up]
    a[:, :, up:m] = sub(np.zeros((n, m, down), np.uint64), mul(np.broadcast_to(ratio[:, :, None], (n, m, down)), np.broadcast_to(powers[:, :down], (n, m, down))))
    a[:, :, m] = sub(mul(ratio, np.broadcast_to(powers[:, down], (n, m))), np.broadcast_to(powers[:, up], (n, m)))
    rank, owner, every, row = np.zeros(n, np.int64), np.full((n, m), -1), np.arange(n), np.arange(m)
    for c in range(m):
        usable = (a[:, :, c] != 0) & (row >= rank[:, None])
        pivot = usable.argmax(axis=1)
        has = np.flatnonzero(usable[every, pivot])
        if not len(has):
            continue
        r, p = rank[has], pivot[has]
        line = a[has, p].copy()
        a[has, p] = a[has, r]
        head = line[:, c]
        block = a[has]
        block = sub(mul(block, np.broadcast_to(head[:, None, None], block.shape)), mul(np.broadcast_to(block[:, :, c][:, :, None], block.shape), np.broadcast_to(line[:, None, :], block.shape)))
        block[np.arange(len(has)), r] = line
        a[has] = block
        owner[has, r] = c
        rank[has] += 1
    solvable = ((a[:, :, m] == 0) | (row < rank[:, None])).all(axis=1)
    unknown = np.zeros((n, m), np.uint64)
    which, r = np.nonzero(owner >= 0)
    unknown[which, owner[which, r]] = mul(a[which, r, m], inverse(a[which, r, owner[which, r]]))
    one = np.ones((n, 1), np.uint64)
    return np.hstack([unknown[:, :up], one]), np.hstack([unknown[:, up:], one]), solvable


def roots(coefficients: np.ndarray, element: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Which elements are roots of their bucket's polynomial (Horner)."""
    value = np.zeros(len(element), np.uint64)
    for i in range(coefficients.shape[1] - 1, -1, -1):
        value = mul(value, element) + coefficients[bucket, i]
        value = np.where(value >= P, value - P, value)
    return value == 0


def reconcile(a: np.ndarray, a_bucket: np.ndarray, b: np.ndarray, b_bucket: np.ndarray, buckets: int, degree: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Masks over ``a`` and ``b`` of the elements that the other set of the same bucket lacks.

    Elements are distinct within a bucket and the buckets sorted. The degree bound starts at ``degree`` and doubles for
    the buckets whose result the verification points refuse. Where the bound reaches the number of elements, a sketch
    would be as large as the sets: such buckets are compared element by element.
    """
    a_out, b_out = np.zeros(len(a), bool), np.zeros(len(b), bool)
    a_size, b_size = np.bincount(a_bucket, minlength=buckets), np.bincount(b_bucket, minlength=buckets)
    open_ = np.ones(buckets, bool)
    while open_.any():
        whole = open_ & (degree >= a_size + b_size)
        if whole.any():
            _by_element(a, a_bucket, b, b_bucket, whole, a_out, b_out)
            open_ &= ~whole
        if not open_.any():
            break
        number = np.cumsum(open_) - 1
        ids = np.flatnonzero(open_)
        a_at, b_at = np.flatnonzero(open_[a_bucket]), np.flatnonzero(open_[b_bucket])
        z = points(degree + VERIFY)
        a_in, b_in = number[a_bucket[a_at]], number[b_bucket[b_at]]
        fa, fb = sketch(a[a_at], a_in, len(ids), z), sketch(b[b_at], b_in, len(ids), z)
        same = (fa == fb).all(axis=1) & (a_size[ids] == b_size[ids])
        done = same.copy()
        ratio = mul(fa, inverse(fb)) if (~same).any() else fa
        gap = a_size[ids] - b_size[ids]
        for g in np.unique(gap[~same]):
            if abs(g) > degree:
                continue
            own = np.flatnonzero(~same & (gap == g))
            up, down = (degree + int(g)) // 2, (degree - int(g)) // 2
            top, bottom, ok = solve(ratio[own][:, : up + down], z, up, down)
            place = np.full(len(ids), -1)
            place[own[ok]] = np.flatnonzero(ok)
            a_mine, b_mine = np.flatnonzero(place[a_in] >= 0), np.flatnonzero(place[b_in] >= 0)
            a_hit = a_mine[roots(top, a[a_at[a_mine]], place[a_in[a_mine]])]
            b_hit = b_mine[roots(bottom, b[b_at[b_mine]], place[b_in[b_mine]])]
            # Verified if the roots found explain the sketches at every point, those for verification included.
            ra = sketch(a[a_at[a_hit]], a_in[a_hit], len(ids), z)[own]
            rb = sketch(b[b_at[b_hit]], b_in[b_hit], len(ids), z)[own]
            right = ok & (mul(fa[own], rb) == mul(fb[own], ra)).all(axis=1)
            right &= (np.bincount(a_in[a_hit], minlength=len(ids)) - np.bincount(b_in[b_hit], minlength=len(ids)))[own] == g
            done[own[right]] = True
            a_out[a_at[a_hit[done[a_in[a_hit]]]]] = True
            b_out[b_at[b_hit[done[b_in[b_hit]]]]] = True
        open_[ids[done]] = False
        degree *= 2
    return a_out, b_out


def _by_element(a: np.ndarray, a_bucket: np.ndarray, b: np.ndarray, b_bucket: np.ndarray, which: np.ndarray, a_out: np.ndarray, b_out: np.ndarray) -> None:
    a_at, b_at = np.flatnonzero(which[a_bucket]), np.flatnonzero(which[b_bucket])
    pair = np.dtype([("bucket", np.int64), ("element", np.uint64)])
    left, right = np.zeros(len(a_at), pair), np.zeros(len(b_at), pair)
    left["bucket"], left["element"] = a_bucket[a_at], a[a_at]
    right["bucket"], right["element"] = b_bucket[b_at], b[b_at]
    a_out[a_at] = ~np.isin(left, right)
    b_out[b_at] = ~np.isin(right, left)
