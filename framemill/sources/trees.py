"""Raw releases found by walking their folders, and what is known of their episodes from names and JSON alone."""

from __future__ import annotations

from functools import reduce

from pyarrow.fs import FileSelector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framemill.sources.files import filesystem, no_pattern, walk

# Fixed value: where an episode lies below a release's root.
EPISODE_PATH = r"^data/([^/]+)/([^/]+)/success_episodes/([^/]+)/data/[^/]+\.hdf5$"
# Fixed value: what is read of an episode's entry in a task's JSON document.
TASK_INFO = "episode_id bigint, task_name string, init_scene_text string, label_info struct<action_config: array<struct<start_frame: bigint, end_frame: bigint, action_text: string, skill: string>>>"


def discover(spark: SparkSession, roots: list[str]) -> DataFrame:
    """``root, embodiment, task, stamp, path, length`` of every successful episode under the roots, each folder listed by a task.

    Roots may share an embodiment; one named twice counts once, one without a ``data`` folder has nothing. ``path`` is
    below its root; the order is by (root, path), which are unique together.
    """
    found = [walk(spark, f"{root}/data", ".hdf5").select(F.lit(root).alias("root"), F.concat(F.lit("data/"), "path").alias("path"), "length") for root in dict.fromkeys(r.rstrip("/") for r in roots)]
    files = reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], "root string, path string, length bigint")
    return described(files, F.col("path")).select("root", "embodiment", "task", "stamp", "path", "length")


def described(files: DataFrame, path: Column) -> DataFrame:
    """``files`` whose path below the root is an episode's, with ``embodiment, task, stamp`` out of it."""
    part = lambda i: F.regexp_extract(path, EPISODE_PATH, i)
    return files.filter(path.rlike(EPISODE_PATH)).withColumns({"embodiment": part(1), "task": part(2), "stamp": part(3)})


def dataset_root(path: str) -> str:
    """The folder that holds ``meta/``: the path itself, else its only child that has one, else the path."""
    system, base = filesystem(path)
    holds = lambda p: system.get_file_info(f"{p}/meta").type.name == "Directory"
    if holds(base):
        return path
    inside = [i.path for i in system.get_file_info(FileSelector(base, allow_not_found=True)) if not i.is_file and holds(i.path)]
    return inside[0] if len(inside) == 1 else path


def task_info(spark: SparkSession, folder: str) -> DataFrame:
    """``task_id`` and the entries of each ``..._<task_id>.json`` document of a folder, a row an episode; a document that isn't JSON gives no rows."""
    rows = spark.read.option("multiLine", True).schema(TASK_INFO).option("mode", "DROPMALFORMED").option("pathGlobFilter", "*.json").json(no_pattern(folder))
    stem = F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), r"\.json$", "")
    return rows.select(F.substring_index(stem, "_", -1).alias("task_id"), "*").filter("episode_id is not null")


def task_actions(info: DataFrame) -> DataFrame:
    """``task_id, episode_id, step, start_frame, end_frame, action_text, skill``: the annotated stretches of each episode, in their order."""
    steps = info.select("task_id", "episode_id", F.posexplode("label_info.action_config").alias("step", "a"))
    return steps.select("task_id", "episode_id", "step", "a.*")


def stream_reasons(lengths: DataFrame, streams: DataFrame, widths: dict[str, int]) -> DataFrame:
    """``episode_index, reason`` of every episode of ``lengths`` (``episode_index, n_frames`` by the cameras): why its aligned streams can't be used, or null.

    ``streams`` has ``episode_index, stream, n_rows, width, widths``: rows of each stream, its largest width and the number of
    different ones. Streams are judged in the order of ``widths``: absent, of another width or of several, and only then by
    their length against the cameras' frames. Streams that aren't declared don't matter.
    """
    judged = []
    for name, width in widths.items():
        s = F.col(f"s_{name}")
        absent = F.when(s.isNull(), f"{name} is absent")
        wide = F.when((s["width"] != width) | (s["widths"] != 1), F.concat(F.lit(f"{name} is "), s["width"].cast("string"), F.lit(f" wide, expected {width}")))
        judged.append(F.coalesce(absent, wide))
    long = [F.when(F.col(f"s_{n}")["n_rows"] != F.col("n_frames"), F.format_string(f"{n}=%d", F.col(f"s_{n}")["n_rows"])) for n in widths]
    long = F.array_compact(F.array(*long))
    mismatch = F.when(F.size(long) > 0, F.concat(F.format_string("length mismatch against %d camera frames: ", "n_frames"), F.array_join(F.slice(long, 1, 3), ", ")))
    wide_table = streams.groupBy("episode_index").agg(*[F.max(F.when(F.col("stream") == n, F.struct("n_rows", "width", "widths"))).alias(f"s_{n}") for n in widths])
    rows = lengths.join(wide_table, "episode_index", "left")
    return rows.select("episode_index", F.coalesce(*judged, mismatch).alias("reason"))
