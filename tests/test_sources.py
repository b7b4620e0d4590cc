"""Layouts, raw formats and streams on a folder of their own."""

from __future__ import annotations

import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from framemill.functions.jsonpaths import flatten_json
from framemill.sources import formats, layouts
from framemill.streaming import scans as streaming


def frames(spark, n=5):
    rows = [(e, i, [float(i), None], f"task {e % 2}" if e != 3 else None) for e in range(n) for i in range(3 + e)]
    return spark.createDataFrame(rows, "episode_index bigint, frame_index bigint, v array<float>, prompt string")


def back(spark, root):
    rows = layouts.read_frames(spark, root).join(layouts.read_tasks(spark, root), "task_index", "left")
    return sorted((r["episode_index"], r["frame_index"], r["index"], tuple(r["v"]), r["task"]) for r in rows.collect())


def test_layouts_keep_all(spark, tmp_path):
    info = layouts.write_episodes(frames(spark), f"{tmp_path}/a", "prompt", 10.0)
    assert (info["total_episodes"], info["total_frames"], info["total_tasks"], info["total_chunks"]) == (5, 25, 2, 1)
    first = back(spark, f"{tmp_path}/a")
    assert [x[2] for x in first] == list(range(25))
    layouts.pack(spark, f"{tmp_path}/a", f"{tmp_path}/b", 7000)
    assert back(spark, f"{tmp_path}/b") == first
    packed = sorted((tmp_path / "b/data/chunk-000").iterdir())
    assert 1 < len(packed) < 5
    groups = pq.ParquetFile(packed[0])
    assert groups.num_row_groups == len(set(pq.read_table(packed[0])["episode_index"].to_pylist()))
    layouts.unpack(spark, f"{tmp_path}/b", f"{tmp_path}/c")
    assert back(spark, f"{tmp_path}/c") == first
    assert (tmp_path / "c/data/chunk-000/episode_000004.parquet").exists()
    lines = [json.loads(x) for x in (tmp_path / "c/meta/episodes.jsonl").read_text().splitlines()]
    assert [(x["episode_index"], x["tasks"], x["length"]) for x in lines] == [(0, ["task 0"], 3), (1, ["task 1"], 4), (2, ["task 0"], 5), (3, [], 6), (4, ["task 0"], 7)]


def test_documents(spark, tmp_path):
    assert layouts.read_json(spark, f"{tmp_path}/none.json") is None
    (tmp_path / "bad.json").write_text("{")
    assert layouts.read_json(spark, f"{tmp_path}/bad.json") is None
    assert layouts.file_format(None) is None
    assert layouts.file_format({}) == "tfrecord"
    assert layouts.file_format({"fileFormat": "array_record"}) == "array_record"


def test_blank_lines_are_skipped(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text('{"task_index": 0, "task": "a"}\n\n{"task_index": 1, "task": "b"}\n')
    assert layouts.read_lines(spark, f"{tmp_path}/t.jsonl", "task_index bigint, task string").count() == 2


def test_raw_formats(spark, tmp_path):
    good = {"prompt": "p", "frames": [{"t": 0, "state": [1, 2], "action": [3]}, {"t": 1, "state": [1, 2], "action": [3]}]}
    docs = {"a": json.dumps(good), "b": "{", "c": json.dumps({"frames": []}), "d": json.dumps({"frames": [{"t": 0, "state": [1], "action": []}]}), "e": json.dumps({"frames": [{"t": 0}]})}
    for name, text in docs.items():
        (tmp_path / f"{name}.json").write_text(text)
    rows, skipped = formats.read_raw(spark, str(tmp_path), "episode_json", widths='{"state": 2}')
    assert [(r["episode_id"], r["frame_index"]) for r in rows.orderBy("frame_index").collect()] == [("a", 0), ("a", 1)]
    assert {r["episode_id"]: r["reason"] for r in skipped.collect()} == {"b": "unreadable", "c": "no frames", "d": "width of state is 1, expected 2", "e": "width of state is 0, expected 2"}
    with pytest.raises(ValueError, match="unknown format"):
        formats.read_raw(spark, str(tmp_path), "other")
    with pytest.raises(ValueError, match="twice"):
        formats.register_format("episode_json")(lambda data, options: iter(()))


def test_flatten_json(spark):
    df = spark.createDataFrame([(1, '{"a": {"b": 1, "c": {}}, "d": [1, {"e": 2}]}'), (2, "{"), (3, None), (4, "5")], "k bigint, j string")
    assert {(r["k"], r["path"], r["value"]) for r in flatten_json(df, "k", "j").collect()} == {(1, "a.b", "1"), (1, "a.c", "{}"), (1, "d", '[1,{"e":2}]')}


def test_stream_carries_over_batches(spark, tmp_path):
    rows = [(1, i, a) for i, a in enumerate([0.0, -0.5, 0.0, 0.5, 0.0, None, -0.5])]
    for k, part in enumerate((rows[:3], rows[3:5], rows[5:])):
        spark.createDataFrame(part, "episode_index bigint, frame_index bigint, a double").coalesce(1).write.parquet(f"{tmp_path}/in/p={k}")
    stream = spark.readStream.schema("episode_index bigint, frame_index bigint, a double").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    q = streaming.carried_gripper(stream, "a").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out").orderBy("frame_index").collect()
    assert [r["frame_index"] for r in out] == list(range(7))


def test_late_rows_are_dropped(spark, tmp_path):
    base = "timestamp'2024-01-01 00:00:00'"
    for k, hours in enumerate([(0, 1), (9,), (10,), (1, 14)]):
        spark.createDataFrame([(h,) for h in hours], "h int").select(F.expr(f"{base} + make_interval(0,0,0,0,h)").alias("t"), F.lit("k").alias("k"), F.lit(1.0).alias("v")).coalesce(1).write.parquet(f"{tmp_path}/in/p={k}")
    stream = spark.readStream.schema("t timestamp, k string, v double").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    q = streaming.windowed_totals(stream, "t", "k", "v").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").agg(F.sum("n")).first()[0] == 4
