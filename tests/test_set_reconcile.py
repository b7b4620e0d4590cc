"""Set reconciliation: the field, the polynomials, and whole tables."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from framemill.functions import charpoly
from framemill.operators import set_reconcile
from framemill.operators.set_reconcile import table_differences


def test_field_arithmetic():
    rng = random.Random(1)
    p = int(charpoly.P)
    a = [rng.randrange(p) for _ in range(500)] + [0, 1, p - 1]
    b = [rng.randrange(p) for _ in range(500)] + [p - 1, p - 1, p - 1]
    x, y = np.array(a, np.uint64), np.array(b, np.uint64)
    assert charpoly.mul(x, y).tolist() == [i * j % p for i, j in zip(a, b, strict=True)]
    assert charpoly.sub(x, y).tolist() == [(i - j) % p for i, j in zip(a, b, strict=True)]
    keep = x != 0
    assert (charpoly.mul(x[keep], charpoly.inverse(x[keep])) == 1).all()


def test_points_are_distinct_and_no_elements():
    z = charpoly.points(300)
    assert len(set(z.tolist())) == 300
    assert z.min() >= 1 << charpoly.ELEMENT_BITS and z.max() < int(charpoly.P)


@pytest.mark.parametrize(("share", "degree"), [(0.0, 8), (0.03, 8), (0.2, 8), (0.2, 2), (0.9, 4), (1.0, 8)])
def test_reconcile_finds_the_differences(share, degree):
    rng = random.Random(7)
    sides = [[], []]
    for bucket in range(60):
        for _ in range(rng.randrange(0, 40)):
            x = rng.randrange(1 << charpoly.ELEMENT_BITS)
            roll = rng.random()
            if roll < share / 2:
                sides[0].append((bucket, x))
            elif roll < share:
                sides[1].append((bucket, x))
            else:
                sides[0].append((bucket, x))
                sides[1].append((bucket, x))
    a, b = (sorted(s) for s in sides)
    split = lambda s: (np.array([x for _, x in s], np.uint64), np.array([k for k, _ in s], np.int64))
    mine, theirs = charpoly.reconcile(*split(a), *split(b), 60, degree)
    assert [r for r, m in zip(a, mine, strict=True) if m] == sorted(set(a) - set(b))
    assert [r for r, m in zip(b, theirs, strict=True) if m] == sorted(set(b) - set(a))


SCHEMA = "k1 bigint, k2 string, v bigint, x double, vec array<float>, t string"
FIELDS = ["x", "vec", "t"]


def run(spark, a, b, **options):
    out = table_differences(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA), ["k1", "k2"], FIELDS, version="v", **options)
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_exact_comparison(spark):
    nan = float("nan")
    a = [(1, "a", 0, 0.0, [1.0, nan], "é"), (2, "a", 0, nan, [], None), (3, "a", 0, 1.0, None, "x"), (4, "a", 0, 1.0, [1.0, None], "x"), (5, "a", 0, 1.0, [1.0], ""), (6, None, 0, 1.0, [1.0], "x")]
    same = [(1, "a", 1, -0.0, [1.0, nan], "é"), (2, "a", 1, nan, [], None)]
    b = [*same, (3, "a", 0, 1.0, [], "x"), (4, "a", 0, 1.0, [None, 1.0], "x"), (5, "a", 0, 1.0, [1.0, 1.0], None), (None, "a", 0, 1.0, [1.0], "x")]
    assert run(spark, a, b) == sorted([(3, "a", "vec"), (4, "a", "vec"), (5, "a", "vec"), (5, "a", "t"), (6, None, "only_left"), (None, "a", "only_right")], key=repr)


def test_composed_and_decomposed_letters_differ(spark):
    assert run(spark, [(1, "a", 0, 1.0, [], "é")], [(1, "a", 0, 1.0, [], "é")]) == [(1, "a", "t")]


def test_the_newest_version_stands_and_repeats_do_not_matter(spark):
    a = [(1, "a", 1, 5.0, [], "old"), (1, "a", 2, 6.0, [], "new"), (1, "a", 2, 6.0, [], "new")]
    b = [(1, "a", None, 9.0, [], "x"), (1, "a", 7, 6.0, [], "new")]
    assert run(spark, a, b) == []
    assert run(spark, a, [(1, "a", 7, 6.0, [], "old")]) == [(1, "a", "t")]


def test_empty_copies(spark):
    row = (1, "a", 0, 1.0, [1.0], "x")
    assert run(spark, [], []) == []
    assert run(spark, [row], []) == [(1, "a", "only_left")]
    assert run(spark, [], [row]) == [(1, "a", "only_right")]


@pytest.mark.parametrize("broadcast_rows", [400_000, 20])  # the second is over, so rows are fetched by a shuffle
def test_many_rows_in_small_chunks_against_brute_force(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(set_reconcile, "CHUNK_ROWS", 100)
    rng = random.Random(3)
    a = [(i, "k", 0, float(rng.randrange(3)), [float(rng.randrange(2))], "t" * rng.randrange(2)) for i in range(1500) if rng.random() < 0.95]
    b = [(i, "k", 0, float(rng.randrange(3)) if rng.random() < 0.1 else x, v, t) for i, _, _, x, v, t in a if rng.random() < 0.95]
    left, right = {r[0]: r for r in a}, {r[0]: r for r in b}
    want = [(i, "k", "only_left") for i in left if i not in right] + [(i, "k", "x") for i in left if i in right and left[i][3] != right[i][3]]
    assert run(spark, a, b, bucket_rows=16, broadcast_rows=broadcast_rows) == sorted(want, key=repr)


def test_long_text_and_clashing_names(spark):
    schema = "bucket bigint, element string, side double, f0 string"
    a = spark.createDataFrame([(1, "x" * 300_000, 1.0, "a")], schema)
    b = spark.createDataFrame([(1, "x" * 299_999 + "y", 1.0, "a")], schema)
    out = table_differences(a, b, ["bucket"], ["element", "side", "f0"])
    assert [tuple(r) for r in out.collect()] == [(1, "element")]


@pytest.mark.parametrize("cut", [1, 7, 1000])
def test_sketches_of_parts_multiply_to_those_of_buckets(cut):
    """Wherever batches cut the buckets, just those that differ come out."""
    rng = random.Random(5)
    rows = [[(b, rng.randrange(1 << 60)) for b in range(40) for _ in range(rng.randrange(9))] for _ in range(1)][0]
    other = [r for r in rows if r[0] % 5 or rng.random() < 0.7] + [(50, 3)]
    want = {b for b in range(51) if sorted(x for k, x in rows if k == b) != sorted(x for k, x in other if k == b)}
    parts = []
    for side, side_rows in enumerate((rows, other)):
        batches = [pa.record_batch([pa.array([side] * len(p), pa.int8()), pa.array([k for k, _ in p]), pa.array([x for _, x in p])], names=["side", "bucket", "element"]) for p in (side_rows[i : i + cut] for i in range(0, len(side_rows), cut))]
        parts += list(set_reconcile._sketch_batches(iter(batches), set_reconcile.DEGREE))
    met = pa.Table.from_batches(parts).sort_by([("bucket", "ascending"), ("side", "ascending")])
    found = [b for batch in set_reconcile._differing_buckets(iter(met.to_batches(max_chunksize=cut + 2))) for b in batch.column(0).to_pylist()]
    assert sorted(found) == sorted(want) and len(want) > 4
