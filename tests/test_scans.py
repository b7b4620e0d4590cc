"""Ordered scans with blocks of a few rows against plain loops, so that every carry across blocks is exercised."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from framemill.operators import bins, clocks, metadata, pairing, scans, statistics

BLOCKS = [3, 7, 1 << 16]


def episodes(seed, values, episodes=6):
    rng = random.Random(seed)
    out = []
    for e in range(episodes):
        at = sorted(rng.sample(range(60), rng.randrange(1, 30)))
        out += [(e, i, rng.choice(values)) for i in at]
    return out


def frame(spark, rows, kind="double"):
    shuffled = rows[:]
    random.Random(0).shuffle(shuffled)
    return spark.createDataFrame(shuffled, f"episode_index bigint, frame_index bigint, a {kind}")


def by_episode(rows):
    out = {}
    for e, i, a in sorted(rows, key=lambda r: r[:2]):
        out.setdefault(e, []).append((i, a))
    return out


@pytest.mark.parametrize("block", BLOCKS)
def test_relative_to_absolute(spark, block):
    rows = episodes(1, [0.0, 0.05, 0.5, -0.5, None, float("nan"), 0.1, -0.1])
    want = {}
    for e, items in by_episode(rows).items():
        switch = [1 if a is not None and a < -0.1 else -1 if a is not None and a > 0.1 else 0 for _, a in items]
        first = next((s for s in switch if s), 0)
        now = -first or 1
        for (i, _), s in zip(items, switch, strict=True):
            now = s or now
            want[e, i] = now / 2 + 0.5
    out = scans.relative_to_absolute(frame(spark, rows), "a", block=block).collect()
    assert {(r["episode_index"], r["frame_index"]): r["gripper_abs"] for r in out} == want


@pytest.mark.parametrize("block", BLOCKS)
def test_binarize(spark, block):
    rows = episodes(2, [0.0, 0.5, 0.7, 1.0, 0.95, 0.05])
    want = {}
    for e, items in by_episode(rows).items():
        carry = items[-1][1]
        for i, a in reversed(items):
            carry = 1.0 if a > 0.95 else 0.0 if a < 0.05 else carry
            want[e, i] = carry
    out = scans.binarize(frame(spark, rows), "a", block=block).collect()
    assert {(r["episode_index"], r["frame_index"]): r["gripper_bin"] for r in out} == want


@pytest.mark.parametrize("block", BLOCKS)
def test_drop_noops(spark, block):
    rng = random.Random(3)
    rows = [(e, i, (rng.choice([True, True, False]), rng.choice([0.0, 1.0]))) for e, i, _ in episodes(3, [0])]
    want = set()
    for e, items in by_episode(rows).items():
        held, seen = None, False
        for i, (still, g) in items:
            if still and (not seen or g == held):
                continue
            want.add((e, i))
            held, seen = g, True
    df = spark.createDataFrame([(e, i, s, g) for e, i, (s, g) in rows], "episode_index bigint, frame_index bigint, still boolean, g double")
    assert {(r["episode_index"], r["frame_index"]) for r in scans.drop_noops(df, F.col("still"), "g", block=block).collect()} == want


@pytest.mark.parametrize("block", BLOCKS)
def test_positions_and_relabelling(spark, block):
    rows = episodes(4, [1.0, 2.0, 4.0])
    df = frame(spark, rows).withColumn("s", F.array(F.col("a"), F.lit(1.0)))
    want = {(e, i): k for e, items in by_episode(rows).items() for k, (i, _) in enumerate(items)}
    assert {(r["episode_index"], r["frame_index"]): r["position"] for r in scans.positions(df, block=block).collect()} == want
    moved = {(e, i): [b[1] - a, 0.0, a] for e, items in by_episode(rows).items() for (i, a), b in zip(items, items[1:], strict=False)}
    out = scans.relabel_actions(df, "s", "a", out="act", width=2, block=block).collect()
    assert {(r["episode_index"], r["frame_index"]): list(r["act"]) for r in out} == moved


def test_empty_frames(spark):
    empty = frame(spark, [])
    for df in (scans.relative_to_absolute(empty, "a"), scans.binarize(empty, "a"), scans.positions(empty), scans.drop_first(empty), scans.step_flags(empty), scans.global_index(empty)):
        assert df.count() == 0


@pytest.mark.parametrize("block", [3, 1 << 26])
@pytest.mark.parametrize("seed", [1, 2])
def test_nearest_claimed(spark, block, seed):
    rng = random.Random(seed)
    samples = [(e, rng.randrange(200)) for e in range(4) for _ in range(rng.randrange(1, 25))]
    refs = [(e, s, i, rng.randrange(220)) for e in range(5) for s in "xy" for i in range(rng.randrange(0, 25))]
    want = set()
    for e in range(4):
        times = sorted(t for x, t in samples if x == e)
        for s in "xy":
            taken = set()
            for t, i in sorted((t, i) for x, y, i, t in refs if (x, y) == (e, s)):
                k = next((j for j, u in enumerate(times) if u >= t), len(times))
                if k > 0 and (k == len(times) or abs(t - times[k - 1]) < abs(t - times[k])):
                    k -= 1
                k = k if k not in taken else k + 1 if k + 1 not in taken and k + 1 < len(times) else None
                if k is not None:
                    taken.add(k)
                    want.add((e, s, i, k))
    a = spark.createDataFrame(samples, "episode_index bigint, t bigint")
    b = spark.createDataFrame(refs, "episode_index bigint, stream string, reference_id bigint, t bigint")
    out = clocks.nearest_claimed(a, b, time_block=block, block=min(block, 4)).collect()
    assert {(r["episode_index"], r["stream"], r["reference_id"], r["sample"]) for r in out} == want


@pytest.mark.parametrize(("sizes", "want"), [([10, 10, 10], [0, 0, 0]), ([40, 40, 40, 40], [0, 0, 1, 1]), ([500, 10], [0, 1]), ([], [])])
def test_destinations(spark, sizes, want):
    df = spark.createDataFrame([("g", i, float(s)) for i, s in enumerate(sizes)], "g string, i bigint, s double")
    assert [r["bin"] for r in bins.destinations(df, ["g"], ["i"], "s", 100.0).orderBy("i").collect()] == want


@pytest.mark.parametrize(("episodes_", "most", "target", "want"), [([300, 300, 300], 8, 768, [0, 0, 0]), ([50] * 4, 2, 10000, [0, 0, 1, 1]), ([100, 5000, 100], 3, 768, [0, 1, 2])])
def test_batches(spark, episodes_, most, target, want):
    df = spark.createDataFrame([(i, e) for i, e in enumerate(episodes_)], "i bigint, e bigint")
    assert [r["bin"] for r in bins.batches(df, [], ["i"], "e", most, target).orderBy("i").collect()] == want


def test_batches_refuse_nonsense(spark):
    df = spark.createDataFrame([(1, -1)], "i bigint, e bigint")
    with pytest.raises(ValueError, match="room"):
        bins.batches(df, [], ["i"], "e", 0, 1)
    with pytest.raises(Exception, match="negative"):
        bins.batches(df, [], ["i"], "e", 1, 1).collect()


def test_pooled_statistics(spark):
    schema = "f string, n bigint, min double, max double, mean double, std double, q50 double"
    one = spark.createDataFrame([("x", 1, 1.0, 1.0, 1.0, 0.0, 1.0), ("x", 3, 3.0, 4.0, 3.0, 0.0, 3.0), ("x", 0, None, None, None, None, None)], schema)
    r = statistics.pooled(one, ["f"], ["q50"]).first()
    assert (r["n"], r["min"], r["max"], r["mean"], r["q50"]) == (4, 1.0, 4.0, 2.5, 2.5)
    assert r["std"] == pytest.approx(0.75**0.5)
    partial = spark.createDataFrame([("x", 1, 1.0, 1.0, 1.0, 0.0, 1.0), ("x", 3, 3.0, 4.0, 3.0, 0.0, None)], schema)
    assert statistics.pooled(partial, ["f"], ["q50"]).first()["q50"] is None
    assert statistics.pooled(partial.limit(0), ["f"], ["q50"]).count() == 0


def test_exact_quantiles_against_numpy(spark):
    import numpy as np

    rng = random.Random(9)
    rows = [(rng.choice("aab"), float(rng.choice([rng.randrange(10), rng.random()]))) for _ in range(3000)]
    out = statistics.exact_quantiles(spark.createDataFrame([*rows, ("a", None)], "g string, v double"), ["g"], "v", {"q1": 0.01, "q5": 0.5, "q9": 0.9})
    for r in out.collect():
        mine = [v for g, v in rows if g == r["g"]]
        assert [r["q1"], r["q5"], r["q9"]] == pytest.approx(np.quantile(mine, [0.01, 0.5, 0.9]).tolist())


def test_pairs_need_equal_multiplicity(spark):
    schema = "episode_index bigint, n_rows bigint, whole string, prefix string"
    a = spark.createDataFrame([(1, 9, "x", "p"), (2, 9, "x", "p"), (3, 9, "y", "q"), (4, 7, "z", "r")], schema)
    b = spark.createDataFrame([(11, 9, "x", "p"), (13, 9, "y", "q"), (14, 9, "w", "r")], schema)
    out = {(r["one"], r["other"], r["basis"], r["row_delta"]) for r in pairing.pair_episodes(a, b).collect()}
    assert out == {(1, None, "one_only", None), (2, None, "one_only", None), (3, 13, "exact", 0), (4, 14, "prefix", -2), (None, 11, "other_only", None)}


def test_split_ranges(spark):
    ranges = spark.createDataFrame([(0, 0, 5000), (1, 5000, 5001), (2, 5001, 9000), (3, 9000, 9000)], "episode_index bigint, dataset_from_index bigint, dataset_to_index bigint")
    out = metadata.split_ranges(spark.range(9500).withColumnRenamed("id", "index"), ranges).groupBy("episode_index").count().collect()
    assert {tuple(r) for r in out} == {(0, 5000), (1, 1), (2, 3999)}


@pytest.mark.parametrize("block", [2, 1 << 16])
def test_rows_without_episode_or_frame_stay(spark, block):
    """A null episode is an episode like any other, beside episode 0; a null frame_index comes first."""
    rows = [(0, 0, 1.0), (0, 1, 0.0), (0, 5, -1.0), (None, 0, -1.0), (None, 3, 0.0), (None, 4, 1.0), (2, None, 0.0), (2, 7, 1.0), (None, None, 0.0), (-3, -9, 0.0), (-3, -1, 1.0)]
    df = frame(spark, rows)
    got = {(r["episode_index"], r["frame_index"]): r["gripper_abs"] for r in scans.relative_to_absolute(df, "a", block=block).collect()}
    assert got == {(0, 0): 0.0, (0, 1): 0.0, (0, 5): 1.0, (None, None): 0.0, (None, 0): 1.0, (None, 3): 1.0, (None, 4): 0.0, (2, None): 1.0, (2, 7): 0.0, (-3, -9): 1.0, (-3, -1): 0.0}
    keys = lambda d: sorted(((r["episode_index"], r["frame_index"]) for r in d.collect()), key=repr)
    every = sorted([r[:2] for r in rows], key=repr)
    assert keys(scans.binarize(df, "a", block=block)) == keys(scans.step_flags(df, block=block)) == keys(scans.positions(df, block=block)) == every
    assert keys(scans.drop_first(df, block=block)) == sorted([(0, 1), (0, 5), (None, 3), (None, 4), (2, None), (None, None), (-3, -1)], key=repr)
    assert keys(scans.drop_last(df, block=block)) == sorted([(0, 0), (0, 1), (None, 0), (None, 3), (2, None), (None, None), (-3, -9)], key=repr)
    index = {(r["episode_index"], r["frame_index"]): r["index"] for r in scans.global_index(df).collect()}
    assert index == {k: i for i, k in enumerate([(None, None), (None, 0), (None, 3), (None, 4), (-3, -9), (-3, -1), (0, 0), (0, 1), (0, 5), (2, None), (2, 7)])}
    assert sorted(scans.positions(df, block=block).columns) == sorted([*df.columns, "position"])
