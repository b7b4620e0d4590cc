"""Readers, writers and conversions of the two dataset layouts.

``episodes`` keeps a Parquet file an episode and metadata as JSON Lines; ``packed`` keeps many episodes a file, a row group
each, and metadata as Parquet. Both have ``meta/info.json``.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framemill.operators import bins, metadata, scans
from framemill.session import cut_lineage
from framemill.sources.files import filesystem, write_files, write_json, write_lines

CHUNK = 1000
#: Where things lie.
EPISODE_FILE, PACKED_FILE = "data/chunk-%03d/episode_%06d.parquet", "data/chunk-%03d/file-%03d.parquet"
INFO, TASKS, EPISODES, PACKED_TASKS, PACKED_EPISODES = "meta/info.json", "meta/tasks.jsonl", "meta/episodes.jsonl", "meta/tasks.parquet", "meta/episodes"
#: Bytes of a packed data file, about.
PACKED_BYTES = 100 << 20


def read_json(spark: SparkSession, path: str) -> dict | None:
    """A JSON document as a dict; None if it isn't there or isn't JSON."""
    system, at = filesystem(path)
    try:
        with system.open_input_stream(at) as f:
            found = json.loads(f.read())
    except (OSError, ValueError):
        return None
    return found if isinstance(found, dict) else None


def read_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON Lines file with a given schema; blank lines give no rows."""
    return spark.read.schema(schema).json(path)


def file_format(info: dict | None) -> str | None:
    """Which record format a raw folder has: what its description says, ``tfrecord`` if it doesn't, None without one."""
    return None if info is None else info.get("fileFormat") or "tfrecord"


def info_of(frames: DataFrame, layout: str, fps: float, cameras: int = 0) -> dict:
    """Totals and features, as ``meta/info.json`` holds them. One row of totals comes to the driver."""
    per = frames.groupBy("episode_index").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("task_index").alias("t"))
    totals = per.agg(F.count(F.lit(1)).alias("e"), F.coalesce(F.sum("n"), F.lit(0)).alias("f")).first()
    tasks = frames.agg(F.count_distinct("task_index")).first()[0]
    kinds = {f.name: ("float32" if isinstance(f.dataType, T.ArrayType) else f.dataType.simpleString()) for f in frames.schema}
    return {
        "layout": layout, "fps": fps, "chunks_size": CHUNK, "total_episodes": totals["e"], "total_frames": totals["f"], "total_tasks": tasks,
        "total_chunks": -(-totals["e"] // CHUNK), "total_videos": totals["e"] * cameras, "features": {k: {"dtype": v} for k, v in kinds.items()},
        "data_path": EPISODE_FILE if layout == "episodes" else PACKED_FILE,
    }


def edited_info(info: dict, layout: str, cap_bytes: int = PACKED_BYTES) -> dict:
    """A description as it is after a conversion to ``layout``.

    The packed layout says how large its files may be and counts neither chunks nor videos, which follow from its episode
    table; the other one counts them again, a video being a feature of dtype ``video`` an episode. All else stays.
    """
    out = {k: v for k, v in info.items() if k not in ("total_chunks", "total_videos", "data_files_size_in_bytes")} | {"layout": layout}
    if layout == "packed":
        return out | {"data_path": PACKED_FILE, "data_files_size_in_bytes": cap_bytes}
    episodes = out.get("total_episodes", 0)
    cameras = sum(f.get("dtype") == "video" for f in out.get("features", {}).values())
    return out | {"data_path": EPISODE_FILE, "total_chunks": -(-episodes // out.get("chunks_size", CHUNK)), "total_videos": episodes * cameras}


def prepared(frames: DataFrame, task: str, fps: float) -> tuple[DataFrame, DataFrame]:
    """(frames with ``index, timestamp, task_index`` instead of the task, dictionary of tasks)."""
    tasks = cut_lineage(metadata.task_dictionary(frames, task, ["episode_index", "frame_index"]))
    numbered = scans.global_index(frames.join(tasks, task, "left").drop(task))
    return numbered.withColumn("timestamp", F.col("position") / F.lit(float(fps))).drop("position"), tasks.withColumnRenamed(task, "task")


def episode_table(frames: DataFrame, tasks: DataFrame) -> DataFrame:
    """``episode_index, tasks, length`` with an episode's tasks in the order they first appear."""
    first = frames.groupBy("episode_index", "task_index").agg(F.min("frame_index").alias("at"), F.count(F.lit(1)).alias("n")).join(tasks, "task_index", "left")
    grouped = first.groupBy("episode_index").agg(F.array_sort(F.collect_list(F.when(F.col("task").isNotNull(), F.struct("at", "task")))).alias("s"), F.sum("n").alias("length"))
    return grouped.select("episode_index", F.col("s.task").alias("tasks"), "length")


def write_episodes(frames: DataFrame, root: str, task: str, fps: float) -> dict:
    """Write the ``episodes`` layout; gives the info document. ``frames`` has ``episode_index, frame_index``, the task text and any columns."""
    rows, tasks = prepared(frames, task, fps)
    rows = cut_lineage(rows)
    name = F.format_string(EPISODE_FILE, metadata.chunk_of(F.col("episode_index"), CHUNK), "episode_index")
    write_files(rows, root, name, ["episode_index"], ["frame_index"]).agg(F.sum("n_rows")).collect()
    write_lines(tasks.select("task_index", "task"), f"{root}/{TASKS}", ["task_index"]).collect()
    write_lines(episode_table(rows, tasks), f"{root}/{EPISODES}", ["episode_index"]).collect()
    info = info_of(rows, "episodes", fps)
    write_json(f"{root}/{INFO}", info)
    return info


def read_frames(spark: SparkSession, root: str) -> DataFrame:
    """All data files of either layout; order is by columns, never by file."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(f"{root}/data")


def read_tasks(spark: SparkSession, root: str) -> DataFrame:
    """``task_index, task`` of either layout."""
    info = read_json(spark, f"{root}/{INFO}") or {}
    if info.get("layout") == "packed":
        return spark.read.parquet(f"{root}/{PACKED_TASKS}")
    return read_lines(spark, f"{root}/{TASKS}", "task_index bigint, task string")


def read_episodes(spark: SparkSession, root: str) -> DataFrame:
    """``episode_index, tasks, length`` of either layout; the packed one also has the place of each episode."""
    info = read_json(spark, f"{root}/{INFO}") or {}
    if info.get("layout") == "packed":
        return spark.read.parquet(f"{root}/{PACKED_EPISODES}")
    return read_lines(spark, f"{root}/{EPISODES}", "episode_index bigint, tasks array<string>, length bigint")


def pack(spark: SparkSession, source: str, target: str, cap_bytes: int = PACKED_BYTES) -> dict:
    """From ``episodes`` to ``packed``: episodes in index order into files that stay below ``cap_bytes`` of their old files' sizes."""
    rows = read_frames(spark, source).withColumn("__bytes", F.col("_metadata.file_size"))
    sizes = rows.groupBy("episode_index").agg(F.max("__bytes").alias("bytes"), F.count(F.lit(1)).alias("length"))
    packed = cut_lineage(bins.destinations(sizes, [], ["episode_index"], "bytes", float(cap_bytes)))
    places = scans.episode_ranges(packed).withColumn("chunk_index", metadata.chunk_of(F.col("bin"), CHUNK)).withColumn("file_index", F.col("bin") % CHUNK)
    name = F.format_string(PACKED_FILE, "chunk_index", "file_index")
    placed = rows.drop("__bytes").join(places.select("episode_index", "chunk_index", "file_index"), "episode_index")
    write_files(placed, target, name, ["episode_index"], ["frame_index"], drop=["chunk_index", "file_index"]).agg(F.sum("n_rows")).collect()
    read_episodes(spark, source).drop("length").join(places.select("episode_index", "length", "chunk_index", "file_index", "dataset_from_index", "dataset_to_index"), "episode_index").write.mode("overwrite").parquet(f"{target}/{PACKED_EPISODES}")
    read_tasks(spark, source).write.mode("overwrite").parquet(f"{target}/{PACKED_TASKS}")
    info = edited_info(read_json(spark, f"{source}/{INFO}") or {}, "packed", cap_bytes)
    write_json(f"{target}/{INFO}", info)
    return info


def unpack(spark: SparkSession, source: str, target: str) -> dict:
    """From ``packed`` to ``episodes``: packed rows go back to the episode whose index range they lie in."""
    episodes = read_episodes(spark, source)
    if episodes.filter("dataset_to_index <= dataset_from_index").limit(1).count():
        raise ValueError("an episode without rows can't have a file")
    rows = metadata.split_ranges(read_frames(spark, source).drop("episode_index"), episodes.select("episode_index", "dataset_from_index", "dataset_to_index"))
    name = F.format_string(EPISODE_FILE, metadata.chunk_of(F.col("episode_index"), CHUNK), "episode_index")
    write_files(rows, target, name, ["episode_index"], ["frame_index"]).agg(F.sum("n_rows")).collect()
    write_lines(read_tasks(spark, source), f"{target}/{TASKS}", ["task_index"]).collect()
    write_lines(episodes.select("episode_index", "tasks", "length"), f"{target}/{EPISODES}", ["episode_index"]).collect()
    info = edited_info(read_json(spark, f"{source}/{INFO}") or {}, "episodes")
    write_json(f"{target}/{INFO}", info)
    return info
