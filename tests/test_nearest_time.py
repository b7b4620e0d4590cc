"""Nearest-time pairing against brute force, and its edges."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest

from framemill.functions.xfast import XFastTries
from framemill.operators import nearest_time
from framemill.operators.nearest_time import nearest_within

BASE = dt.datetime(2024, 1, 1)
POINTS = "e bigint, t timestamp_ntz, r bigint, p bigint"
QUERIES = "e bigint, t timestamp_ntz, q bigint"


def at(us):
    return None if us is None else BASE + dt.timedelta(microseconds=us)


def run(spark, points, queries, tolerance=25_000, **options):
    p = spark.createDataFrame([(e, at(t), r, i) for e, t, r, i in points], POINTS)
    q = spark.createDataFrame([(e, at(t), i) for e, t, i in queries], QUERIES)
    out = nearest_within(p, q, entity=("e", "e"), time=("t", "t"), rank="r", point_id="p", query_id="q", tolerance_us=tolerance, **options)
    return sorted((r["p"], r["q"], r["distance_us"]) for r in out.collect())


def brute(points, queries, tolerance=25_000):
    out = set()
    for e, t, q in queries:
        if e is None or t is None:
            continue
        near = [(abs(pt - t), -(r if r is not None else -(2**62)), -p) for pe, pt, r, p in points if pe == e and pt is not None and p is not None and abs(pt - t) <= tolerance]
        if near:
            d, _, p = min(near)
            out.add((-p, q, d))
    return sorted(out)


def test_tries_find_neighbours():
    rng = np.random.default_rng(1)
    group = np.sort(rng.integers(0, 20, 500))
    key = rng.integers(0, 1 << 12, 500)
    order = np.lexsort((key, group))
    pairs = np.unique(np.stack([group[order], key[order]]), axis=1)
    group, key = pairs
    tries = XFastTries(group, key, 12)
    qg, qk = rng.integers(0, 22, 2000), rng.integers(0, 1 << 12, 2000)
    before, after = tries.neighbours(qg, qk)
    for g, k, b, a in zip(qg, qk, before, after, strict=True):
        mine = np.flatnonzero(group == g)
        below, above = mine[key[mine] <= k], mine[key[mine] >= k]
        assert b == (below[-1] if len(below) else -1)
        assert a == (above[0] if len(above) else -1)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    points = [(rng.choice([1, 2, 3, None]), rng.choice([None, *range(0, 4_000_000, 9_973)]), rng.choice([None, 1, 2, 3]), i) for i in range(400)]
    queries = [(rng.choice([1, 2, 4, None]), rng.choice([None, rng.randrange(4_000_000)]), i) for i in range(300)]
    queries += queries[:20]
    assert run(spark, points, queries) == brute(points, queries)


def test_hot_blocks_and_small_chunks(spark, monkeypatch):
    rng = random.Random(5)
    points = [(1, rng.randrange(0, 3_000_000), rng.randrange(5), i) for i in range(500)]
    queries = [(1, rng.randrange(0, 3_000_000), i) for i in range(500)]
    monkeypatch.setattr(nearest_time, "CHUNK_ROWS", 50)
    assert run(spark, points, queries, hot_block=40) == brute(points, queries)


def test_ties_take_the_larger_rank_then_the_larger_id(spark):
    points = [(1, 0, 1, 10), (1, 200, 2, 11), (1, 1000, 7, 20), (1, 1000, 7, 21), (1, 5000, None, 30), (1, 5200, 3, 31), (1, 9000, 4, 41), (1, 9200, 4, 40)]
    assert run(spark, points, [(1, 100, 1), (1, 1000, 2), (1, 5100, 3), (1, 9100, 4)]) == [(11, 1, 100), (21, 2, 0), (31, 3, 100), (41, 4, 100)]


def test_tolerance_is_inclusive_and_blocks_have_no_edges(spark):
    edge = 1 << 20
    base = int((BASE - dt.datetime(1970, 1, 1)).total_seconds() * 1e6)
    first = edge - base % edge
    points = [(1, first - 1, 0, 1), (1, first + 100_000, 0, 2)]
    assert run(spark, points, [(1, first + 24_999, 1), (1, first + 25_000, 2), (1, first + 75_000, 3)]) == [(1, 1, 25_000), (2, 3, 25_000)]


def test_empty_sides(spark):
    assert run(spark, [], [(1, 0, 1)]) == []
    assert run(spark, [(1, 0, 0, 1)], []) == []
    assert run(spark, [], []) == []


def test_one_query_with_several_times(spark):
    assert run(spark, [(1, 0, 0, 1), (1, 900_000, 0, 2)], [(1, 10, 5), (1, 900_010, 5), (1, 10, 5)]) == [(1, 5, 10), (2, 5, 10)]


def test_wide_tolerance(spark):
    assert run(spark, [(1, 0, 0, 1)], [(1, 9_000_000, 5)], tolerance=10_000_000) == [(1, 5, 9_000_000)]


def test_clashing_names(spark):
    p = spark.createDataFrame([(1, at(0), 1, 7, "x")], "b bigint, x timestamp_ntz, kind bigint, s bigint, q string")
    q = spark.createDataFrame([("1", at(5), 1)], "kind string, t timestamp_ntz, b bigint")
    out = nearest_within(p, q, entity=("b", "b"), time=("x", "t"), rank="kind", point_id="s", query_id="kind", tolerance_us=10)
    assert [tuple(r) for r in out.collect()] == [(7, "1", 5)]


@pytest.mark.parametrize("tolerance", [3_000, 40_000, 10**12])
def test_tolerances_wider_than_blocks(spark, monkeypatch, tolerance):
    """Blocks of about a millisecond, points hours apart, and blocks that hold queries only."""
    monkeypatch.setattr(nearest_time, "CHUNK_ROWS", 50)
    rng = random.Random(tolerance)
    moments = [rng.choice([rng.randrange(30_000), rng.randrange(10**10), -rng.randrange(10**7)]) for _ in range(150)]
    points = [(rng.randrange(3), m, rng.randrange(5), i) for i, m in enumerate(moments)] + [(None, 5, 1, 900), (1, None, 1, 901), (1, 7, None, 902)]
    queries = [(rng.choice([0, 1, 2, 7, None]), rng.choice(moments) + rng.choice([0, rng.randrange(-5000, 5000), rng.randrange(-(10**9), 10**9)]), i) for i in range(300)]
    assert run(spark, points, queries, tolerance=tolerance, block_bits=10) == brute(points, queries, tolerance)
    assert run(spark, points, queries, tolerance=tolerance, block_bits=10, hot_block=2) == brute(points, queries, tolerance)


def test_tolerance_beyond_all(spark):
    with pytest.raises(ValueError, match="tolerance"):
        run(spark, [], [], tolerance=1 << 51)
