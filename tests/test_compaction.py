"""Path resolution, components, the journal, and real files merged by it."""

from __future__ import annotations

import random
import shutil

import pytest
from pyspark.sql import functions as F

from framemill.functions.paths import resolved
from framemill.operators.compaction import Sizes, compaction_journal, final_outputs
from framemill.operators.components import component_labels, links_from_keys
from framemill.queries.compaction import audit, table_files, video_files
from framemill.sources import compact

SIZES = {"data": Sizes(small=16.0, good=64.0, unit=0.25), "video": Sizes(small=20.0, good=100.0, unit=1.0)}
FILES = "kind string, grp string, file_key bigint, size double"


@pytest.mark.parametrize(
    ("path", "want"),
    [("/a/b", "/a/b"), ("/a//b/", "/a/b"), ("/a/./b/../c", "/a/c"), ("/../a", "/a"), ("/a/../../b", "/b"), ("a/../../b", "../b"), ("", ""), ("/", "/"), ("/A/b", "/A/b"), ("/a/..b/.c", "/a/..b/.c"), (None, None), ("/a/b/.", "/a/b"), ("/a/b/..", "/a")],
)
def test_resolved(spark, path, want):
    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(resolved(F.col("p"))).first()[0] == want


def components(spark, links):
    df = spark.createDataFrame(links, "u bigint, v bigint")
    return {r["id"]: r["label"] for r in component_labels(df).collect()}


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(1000, j) for j in range(1001, 1030)] + [(5, 5), (2001, 2000)] * 2
    out = components(spark, links)
    assert out == {i: 1 for i in range(2, 61)} | {j: 1000 for j in range(1001, 1030)} | {2001: 2000}


def test_random_components_against_union_find(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    parent = list(range(300))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in links:
        a, b = sorted((root(u), root(v)))
        parent[b] = a
    assert components(spark, links) == {i: root(i) for i in range(300) if root(i) != i}


def test_no_links(spark):
    assert components(spark, []) == {}
    assert links_from_keys(spark.createDataFrame([(1, None), (None, "a")], "id bigint, key string")).count() == 0


def journal(spark, files, **options):
    return compaction_journal(spark.createDataFrame(files, FILES), SIZES, **options)


def check_journal(rows, files):
    """Every small original once; outputs are used at most once, and only if small; sizes add up."""
    small = {(k, f) for k, _, f, s in files if s is None or s != s or s < SIZES[k].small}
    assert sorted((r["kind"], r["file_key"]) for r in rows if r["file_key"] is not None) == sorted(small)
    inputs = [r["input"] for r in rows]
    assert len(inputs) == len(set(inputs))
    made = {}
    for r in rows:
        made.setdefault(r["output"], []).append(r)
    for output, parts in made.items():
        assert len({(p["kind"], p["grp"], p["level"]) for p in parts}) == 1
        total = sum(p["size"] for p in parts)
        again = [r for r in rows if r["input"] == output]
        for r in again:
            assert r["size"] == pytest.approx(total) and r["level"] > parts[0]["level"]
        assert total <= SIZES[parts[0]["kind"]].good + SIZES[parts[0]["kind"]].small


def test_journal(spark):
    rng = random.Random(2)
    files = [(rng.choice(["data", "video"]), rng.choice(["a", "b", None]), i, rng.choice([None, float("nan"), -1.0, 0.0, 200.0, rng.random(), rng.random() * 18])) for i in range(800)]
    rows = journal(spark, files).collect()
    check_journal(rows, files)
    assert all(r["once"] and r["linked"] and r["within"] for r in audit(journal(spark, files), SIZES).collect())
    ends = {r["output"] for r in final_outputs(journal(spark, files)).collect()}
    assert len(ends) < len({r["input"] for r in rows}) / 4


def test_journal_is_the_same_again_and_with_shards(spark):
    files = [("data", "a", i, 0.3 + (i % 50) / 10) for i in range(500)]
    one, two = ({tuple(r) for r in journal(spark, list(f)).collect()} for f in (files, reversed(files)))
    assert one == two
    check_journal(journal(spark, files, shard_files=40).collect(), files)


def test_lonely_and_no_files(spark):
    rows = journal(spark, [("data", "a", 1, 3.0), ("data", "b", 2, 99.0)]).collect()
    assert [(r["input"], r["level"]) for r in rows] == [("data:1", 3)]
    assert journal(spark, []).count() == 0


LISTING = "file_id bigint, dataset string, path_template string, file_path string, filled_mb double, n_records bigint, content_sha string, listed_at timestamp_ntz, id string, key string"


def listed(spark, rows):
    df = spark.createDataFrame([(i, d, "t", p, mb, n, sha, None, "x", "y") for i, d, p, mb, n, sha in rows], LISTING)
    return {r["file_key"]: r["size"] for r in table_files(df).collect()}


def test_table_files(spark):
    nan = float("nan")
    rows = [
        (7, "a", "/x/a", None, 5, "s1"), (3, "a", "/x/./a", 4.0, 5, None), (9, None, "/y/b", nan, 5, "s1"), (9, None, "/y/b", nan, 5, "s1"),
        (12, "a", "/x/A", 1.0, 5, None), (20, "a", None, None, 1, None), (21, "a", "/z", 2.0, 0, "s2"), (None, "a", "/z", 2.0, 9, "s2"), (30, "a", "/q", nan, 3, "s3"),
    ]
    assert listed(spark, rows) == {3: 4.0, 12: 1.0, 20: None, 30: None}
    assert listed(spark, []) == {}


SEGMENTS = "segment_id bigint, dataset string, camera string, episode_index bigint, src string, dst string, start_s double, end_s double, place string"


def videos(spark, rows):
    df = spark.createDataFrame([(i, "a", "c", 1, src, "d", a, b, "x") for i, src, a, b in rows], SEGMENTS)
    return {r["file_key"]: r["size"] for r in video_files(df).collect()}


def test_video_files(spark):
    rows = [(5, "/v/a", 0.0, 10.1), (4, "/v//a", 0.0, 10.1), (2, "/v/a", 3.0, None), (6, "/v/a", 10.0, 19.9), (1, "/v/b", 5.0, 5.0), (8, None, 0.0, 1.0), (None, "/v/c", 0.0, 1.0), (9, "/v/d", float("nan"), 1.0)]
    assert videos(spark, rows) == {2: pytest.approx(20.0)}
    assert videos(spark, []) == {}


ALL_SMALL = Sizes(small=1.0, good=4.0, unit=0.001)


def records(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def total(spark, folder, state):
    return compact.count_records(compact.live_files(spark, folder, state), folder, state)


# Names that hold the word for a run, blanks, signs that patterns and encodings use.
@pytest.mark.parametrize("name", ["lake/data/run-2026", "a folder 100%25 [x]{y}"])
def test_real_files_are_merged_once(spark, tmp_path, name):
    folder, state = f"{tmp_path}/{name}", f"{tmp_path}/state of {name}"
    write = lambda df, n: df.repartition(n).write.mode("append").parquet(folder)
    row = lambda ids, v: ids.select("id", v.alias("v"), F.col("id").alias("__name"), F.timestamp_micros(F.col("id") * 1000).alias("at"))
    write(row(spark.range(5000), F.concat(F.lit("v"), F.col("id") % 7)), 30)
    before = records(spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path)))
    assert compact.compact(spark, folder, state, ALL_SMALL) == 30
    assert compact.live_files(spark, folder, state).count() < 10
    assert records(compact.read_live(spark, folder, state)) == before
    compact.compact(spark, folder, state, ALL_SMALL)
    write(row(spark.range(9000, 9010), F.lit("n")), 2)
    assert total(spark, folder, state) == 5010
    assert compact.compact(spark, folder, state, ALL_SMALL) >= 2
    assert compact.read_live(spark, folder, state).count() == total(spark, folder, state) == 5010
    assert compact.compact(spark, folder, state, ALL_SMALL) == 0
    assert compact.read_live(spark, folder, state).schema["at"].dataType.typeName() == "timestamp"


def test_large_files_stay_beside_merged_ones(spark, tmp_path):
    """Files that aren't small, below a folder named like a run's, are live before and after."""
    folder, state = f"{tmp_path}/data/run-1", f"{tmp_path}/state"
    rows = lambda a, b: spark.range(a, b).select("id", F.randn(1).alias("x"))
    rows(0, 3000).repartition(1).write.parquet(folder)
    rows(3000, 3100).repartition(5).write.mode("append").parquet(folder)
    sizes = Sizes(small=0.01, good=4.0, unit=0.001)
    assert compact.compact(spark, folder, state, sizes) == 5
    assert compact.read_live(spark, folder, state).count() == 3100
    assert compact.live_files(spark, folder, state).count() == 2


def test_partition_folders_stay_columns(spark, tmp_path):
    folder, state = f"{tmp_path}/t", f"{tmp_path}/state"
    rows = spark.range(400).select("id", (F.col("id") % 3).cast("int").alias("k"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("a b/"), F.col("id") % 5)).alias("l"))
    rows.repartition(6, "id").write.partitionBy("k", "l").parquet(folder)
    before = records(spark.read.parquet(folder))
    assert compact.compact(spark, folder, state, ALL_SMALL) > 15
    live = compact.live_files(spark, folder, state)
    assert live.count() == 15 and live.select("folder").distinct().count() == 15
    out = compact.read_live(spark, folder, state)
    assert records(out) == before and dict(out.dtypes) == {"id": "bigint", "k": "int", "l": "string"}


def test_torn_run_is_taken_up(spark, tmp_path):
    """A run without its journal changes nothing, and the next one takes over its files."""
    folder, state = f"{tmp_path}/t", f"{tmp_path}/state"
    spark.range(900).repartition(9).write.parquet(folder)
    assert compact.compact(spark, folder, state, ALL_SMALL) == 9
    (made,) = (tmp_path / "state" / "data").rglob("*.parquet")
    (run,) = (tmp_path / "state" / "journal").iterdir()
    shutil.move(run, tmp_path / "elsewhere")
    assert total(spark, folder, state) == 900 and compact.live_files(spark, folder, state).count() == 9
    stamp = made.stat().st_mtime_ns
    assert compact.compact(spark, folder, state, ALL_SMALL) == 9
    assert made.stat().st_mtime_ns == stamp and total(spark, folder, state) == 900
    made.write_bytes(made.read_bytes()[:100])  # an output lost after all: an error, not fewer records
    with pytest.raises(Exception, match="(?i)parquet"):
        total(spark, folder, state)


def test_journal_on_disk_holds_every_level(spark, tmp_path):
    folder, state = f"{tmp_path}/t", f"{tmp_path}/state"
    for n in (1, 40, 3000):
        spark.range(n * 12).repartition(12).write.mode("append").parquet(folder)
    compact.compact(spark, folder, state, Sizes(small=1.0, good=4.0, unit=0.0005))
    rows = compact.journal(spark, state).collect()
    assert len({r["level"] for r in rows}) > 1
    assert sum(r["input_path"] is not None for r in rows) == len(list((tmp_path / "t").glob("*.parquet")))
    outputs = {r["output"] for r in rows}
    assert {r["input"] for r in rows if r["input_path"] is None} <= outputs


def test_columns_that_some_files_lack_and_types_that_differ(spark, tmp_path):
    folder, state = f"{tmp_path}/t", f"{tmp_path}/state"
    spark.range(3).coalesce(1).write.parquet(folder)
    spark.range(3, 5).withColumn("x", F.lit("y")).coalesce(1).write.mode("append").parquet(folder)
    assert compact.compact(spark, folder, state, ALL_SMALL) == 2
    assert records(compact.read_live(spark, folder, state)) == [(0, None), (1, None), (2, None), (3, "y"), (4, "y")]
    spark.range(3).select(F.col("id").cast("string")).coalesce(1).write.mode("append").parquet(folder)
    with pytest.raises(Exception, match="id"):
        compact.compact(spark, folder, state, ALL_SMALL)
    assert compact.live_files(spark, folder, state).count() == 2


def test_nothing_to_compact(spark, tmp_path):
    assert compact.compact(spark, f"{tmp_path}/none", f"{tmp_path}/state") == 0
    assert compact.live_files(spark, f"{tmp_path}/none", f"{tmp_path}/state").count() == 0
