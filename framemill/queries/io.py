"""Queries that write, convert and read back, and those over streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framemill.operators.compaction import Sizes
from framemill.registry import query, table
from framemill.session import shared_folder
from framemill.sources import compact, files, formats, layouts
from framemill.streaming import scans as streaming
from framemill.views import FRAMES_SQL, frames

_BACK = f"SELECT episode_index, frame_index, gripper, prompt AS task FROM {FRAMES_SQL}"


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames(spark, sf_dir, "gripper", "prompt")


def _back(spark: SparkSession, root: str) -> DataFrame:
    rows = layouts.read_frames(spark, root).join(layouts.read_tasks(spark, root), "task_index", "left")
    return rows.select("episode_index", "frame_index", "gripper", "task")


@query("roundtrip_episodes", _BACK)
def roundtrip_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames written as a file an episode and read again."""
    root = shared_folder(spark, "episodes")
    layouts.write_episodes(_frames(spark, sf_dir), root, "prompt", 30.0)
    return _back(spark, root)


@query("roundtrip_packed", _BACK)
def roundtrip_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, packed into larger files."""
    root = shared_folder(spark, "packed")
    layouts.write_episodes(_frames(spark, sf_dir), f"{root}/a", "prompt", 30.0)
    layouts.pack(spark, f"{root}/a", f"{root}/b", 64 << 10)
    return _back(spark, f"{root}/b")


@query("roundtrip_unpacked", _BACK)
def roundtrip_unpacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, packed and unpacked again."""
    root = shared_folder(spark, "unpacked")
    layouts.write_episodes(_frames(spark, sf_dir), f"{root}/a", "prompt", 30.0)
    layouts.pack(spark, f"{root}/a", f"{root}/b", 64 << 10)
    layouts.unpack(spark, f"{root}/b", f"{root}/c")
    return _back(spark, f"{root}/c")


@query("episodes_lines", f"SELECT e.episode_index, coalesce(t.tasks, []) AS tasks, e.length FROM (SELECT episode_index, count(*) AS length FROM {FRAMES_SQL} GROUP BY 1) e LEFT JOIN (SELECT episode_index, list(prompt ORDER BY pos) AS tasks FROM (SELECT episode_index, prompt, min(frame_index) AS pos FROM {FRAMES_SQL} WHERE prompt IS NOT NULL GROUP BY ALL) GROUP BY 1) t USING (episode_index)")
def episodes_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episode metadata out of its JSON Lines file."""
    root = shared_folder(spark, "lines")
    layouts.write_episodes(_frames(spark, sf_dir), root, "prompt", 30.0)
    return layouts.read_episodes(spark, root).select("episode_index", "tasks", "length")


@query("episode_files", f"SELECT printf('data/chunk-%03d/episode_%06d.parquet', CAST(floor(episode_index / 1000.0::DOUBLE) AS BIGINT), episode_index) AS file, count(*) AS n_rows FROM {FRAMES_SQL} GROUP BY ALL")
def episode_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files that a write makes, and their rows."""
    root = shared_folder(spark, "files")
    rows = _frames(spark, sf_dir)
    name = F.format_string(layouts.EPISODE_FILE, F.floor(F.col("episode_index") / F.lit(1000)), "episode_index")
    return files.write_files(rows, root, name, ["episode_index"], ["frame_index"]).select("file", "n_rows")


@query("partitioned_split", f"SELECT episode_index, frame_index, gripper, CAST(floor(episode_index / 1000.0::DOUBLE) AS INTEGER) AS chunk FROM {FRAMES_SQL}")
def partitioned_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames split into chunk folders by Spark's own partitioned write, and read with the folder as a column."""
    root = shared_folder(spark, "split")
    rows = frames(spark, sf_dir, "gripper").withColumn("chunk", F.floor(F.col("episode_index") / F.lit(1000)).cast("int"))
    rows.repartition("episode_index").write.partitionBy("chunk").parquet(root)
    return spark.read.parquet(root).select("episode_index", "frame_index", "gripper", "chunk")


@query("csv_roundtrip", "SELECT DISTINCT ref_id, embodiment, task FROM episode_refs WHERE task IS NOT NULL AND task <> ''")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A task table written as CSV, read with a schema, repeats dropped."""
    root = shared_folder(spark, "csv")
    table(spark, sf_dir, "episode_refs").filter("task is not null and task <> ''").select("ref_id", "embodiment", "task").write.option("header", True).csv(root)
    return spark.read.schema("ref_id bigint, embodiment string, task string").option("header", True).csv(root).dropDuplicates()


@query("compacted_records", "SELECT event_id, user_id, event_type FROM events")
def compacted_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of many small files after two runs of compaction."""
    root = shared_folder(spark, "small")
    table(spark, sf_dir, "events").select("event_id", "user_id", "event_type").repartition(24).write.parquet(f"{root}/t")
    sizes = Sizes(small=1.0, good=4.0, unit=0.01)
    compact.compact(spark, f"{root}/t", f"{root}/state", sizes)
    compact.compact(spark, f"{root}/t", f"{root}/state", sizes)
    return compact.read_live(spark, f"{root}/t", f"{root}/state")


@query("raw_episodes", f"SELECT CAST(episode_index AS VARCHAR) AS episode_id, count(*) AS n FROM {FRAMES_SQL} GROUP BY 1")
def raw_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw episode documents read through a Python data source."""
    return _raw(spark, sf_dir, "[]")[0].groupBy("episode_id").agg(F.count(F.lit(1)).alias("n"))


@query("raw_skips", f"SELECT CAST(episode_index AS VARCHAR) AS episode_id, 'width of state is 2, expected 3' AS reason FROM {FRAMES_SQL} GROUP BY 1")
def raw_skips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why raw episodes of another width are left out."""
    return _raw(spark, sf_dir, '{"state": 3}')[1]


def _raw(spark: SparkSession, sf_dir: str, widths: str) -> tuple[DataFrame, DataFrame]:
    root = shared_folder(spark, "raw")
    rows = frames(spark, sf_dir, "gripper")
    frame = F.struct(F.col("frame_index").alias("t"), F.array(F.lit(0.5), F.col("gripper")).alias("state"), F.array(F.col("gripper")).alias("action"))
    documents = rows.groupBy("episode_index").agg(F.array_sort(F.collect_list(frame)).alias("frames"))
    text = documents.select("episode_index", F.to_json(F.struct("frames", F.lit("a prompt").alias("prompt"))).alias("text"))

    def write(batches):
        import pyarrow as pa

        system, base = files.filesystem(root)
        system.create_dir(base, recursive=True)
        for b in batches:
            for e, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with system.open_output_stream(f"{base}/{e}.json") as f:
                    f.write(t.encode())
            yield pa.record_batch([b.column(0)], names=["episode_index"])

    text.mapInArrow(write, "episode_index bigint").count()
    return formats.read_raw(spark, root, "episode_json", widths=widths if widths != "[]" else "{}")


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a bounded stream; a table may be one file or a folder of files."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def _drained(spark: SparkSession, rows: DataFrame, mode: str = "append") -> DataFrame:
    root = shared_folder(spark, "stream")
    out = rows.writeStream.outputMode(mode).format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
    out.awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{root}/out")


@query("stream_distinct", "SELECT event_id, user_id, event_type FROM events")
def stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a stream, each once."""
    return _drained(spark, streaming.distinct_rows(_stream(spark, sf_dir, "events"), "ts", ["event_id"])).select("event_id", "user_id", "event_type")


@query("stream_windows", """SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value) + 1e-9, 6) AS total FROM events
    WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR GROUP BY ALL""")
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of tumbling windows that the watermark has closed."""
    closed = _drained(spark, streaming.windowed_totals(_stream(spark, sf_dir, "events"), "ts", "event_type", "value"))
    return closed.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round(F.col("total") + 1e-9, 6).alias("total"))


@query("stream_gripper", f"""WITH s AS (SELECT episode_index, frame_index, CASE WHEN gripper - 0.5 < -0.1 THEN 1 WHEN NOT isnan(gripper) AND gripper - 0.5 > 0.1 THEN -1 END AS s FROM {FRAMES_SQL})
    SELECT episode_index, frame_index, coalesce(last_value(s IGNORE NULLS) OVER (PARTITION BY episode_index ORDER BY frame_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 1) / 2.0 + 0.5 AS gripper_abs FROM s""")
def stream_gripper(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gripper states carried through a stream of frames."""
    root = shared_folder(spark, "ordered")
    rows = frames(spark, sf_dir, "gripper").withColumn("a", F.col("gripper") - 0.5)
    rows.write.parquet(f"{root}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
    return _drained(spark, streaming.carried_gripper(stream, "a"))


@query("stream_drift", f"SELECT episode_index, CAST(count(*) AS DOUBLE) AS fps, round(abs(count(*) - 60) / 60.0::DOUBLE + 1e-9, 6) AS drift FROM {FRAMES_SQL} GROUP BY 1 HAVING abs(count(*) - 60) / 60.0::DOUBLE > 0.1")
def stream_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes of a stream whose rate drifts from a known one, batch by batch."""
    root = shared_folder(spark, "drift")
    rows = frames(spark, sf_dir).groupBy("episode_index").agg(F.count(F.lit(1)).cast("double").alias("fps"))
    rows.write.parquet(f"{root}/in")
    streaming.rate_drift_batches(spark.readStream.schema(rows.schema).parquet(f"{root}/in"), 60.0, 0.1, f"{root}/out", f"{root}/state").awaitTermination()
    return spark.read.parquet(f"{root}/out").select("episode_index", "fps", F.round(F.col("drift") + 1e-9, 6).alias("drift"))
