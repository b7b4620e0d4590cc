"""Queries of the smaller operators: slices, filters, texts, hashes, findings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framemill.functions import scalar
from framemill.operators import scans, statistics
from framemill.operators.places import places
from framemill.plans import pipeline
from framemill.registry import query, table
from framemill.views import FRAMES_SQL, frames


@query("split_slice", f"WITH e AS (SELECT episode_index, row_number() OVER (ORDER BY episode_index) - 1 AS i FROM (SELECT DISTINCT episode_index FROM frames)) SELECT f.episode_index, frame_index FROM {FRAMES_SQL} f JOIN e USING (episode_index) WHERE i >= 5 AND i < 40")
def split_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of the episodes at places 5 to 39."""
    episodes = places(table(spark, sf_dir, "frames").select("episode_index").dropDuplicates(), [], ["episode_index"])
    return frames(spark, sf_dir).join(episodes.filter("place >= 5 and place < 40"), "episode_index", "left_semi")


@query("first_episodes", "SELECT DISTINCT episode_index FROM frames ORDER BY episode_index LIMIT 20")
def first_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first twenty episodes."""
    return table(spark, sf_dir, "frames").select("episode_index").dropDuplicates().orderBy("episode_index").limit(20)


@query("conversion_tasks", f"WITH n AS (SELECT dataset, count(DISTINCT episode_index) AS n FROM {FRAMES_SQL} GROUP BY 1) SELECT dataset, printf('%s_chunk_%06d_%d_%d', dataset, s // 10, s, least(s + 10, n) - 1) AS task, printf('train[%d:%d]', s, least(s + 10, n)) AS split FROM (SELECT dataset, n, unnest(range(0, n, 10)) AS s FROM n)")
def conversion_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices of ten episodes of each dataset as named tasks."""
    n = table(spark, sf_dir, "frames").select("dataset", "episode_index").dropDuplicates().groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))
    slices = n.select("dataset", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(10).cast("bigint"))).alias("s"))
    end = F.least(F.col("s") + 10, F.col("n"))
    return slices.select("dataset", F.format_string("%s_chunk_%06d_%d_%d", "dataset", F.expr("s div 10"), "s", end - 1).alias("task"), F.format_string("train[%d:%d]", "s", end).alias("split"))


@query("stacked_steps", f"SELECT episode_index, list(gripper ORDER BY frame_index) AS gripper, list(frame_index ORDER BY frame_index) AS frame_index FROM {FRAMES_SQL} GROUP BY 1")
def stacked_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of each episode as one record of arrays, as nested formats hold them."""
    rows = frames(spark, sf_dir, "gripper")
    stacked = rows.groupBy("episode_index").agg(F.array_sort(F.collect_list(F.struct("frame_index", "gripper"))).alias("s"))
    return stacked.select("episode_index", F.col("s.gripper").alias("gripper"), F.col("s.frame_index").alias("frame_index"))


@query("unstacked_steps", f"SELECT episode_index, frame_index, gripper FROM {FRAMES_SQL}")
def unstacked_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of arrays as steps again."""
    zipped = stacked_steps(spark, sf_dir).select("episode_index", F.explode(F.arrays_zip("frame_index", "gripper")).alias("z"))
    return zipped.select("episode_index", "z.frame_index", "z.gripper")


@query("corrupt_lengths", f"WITH f AS (SELECT episode_index, count(state_vec) AS n_state, count(action_vec) AS n_action FROM {FRAMES_SQL} GROUP BY 1) SELECT * FROM f WHERE n_action > n_state")
def corrupt_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes with more actions than states, which are dropped."""
    counts = frames(spark, sf_dir, "state_vec", "action_vec").groupBy("episode_index").agg(F.count("state_vec").alias("n_state"), F.count("action_vec").alias("n_action"))
    return counts.filter("n_action > n_state")


@query("camera_filter", "SELECT DISTINCT shot_id, camera FROM video_shots WHERE camera IN ('observation.images.chest', 'chest') OR split_part(camera, '.', -1) IN ('observation.images.chest', 'chest')")
def camera_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of the declared cameras, under either of a camera's two spellings."""
    declared = ["observation.images.chest", "chest"]
    last = F.element_at(F.split("camera", r"\."), -1)
    return table(spark, sf_dir, "video_shots").filter(F.col("camera").isin(declared) | last.isin(declared)).select("shot_id", "camera").dropDuplicates()


@query("task_contains", "SELECT DISTINCT ref_id, p FROM episode_refs, (VALUES ('mug'), ('towel'), ('cube'), ('push')) AS v(p) WHERE contains(task, p)")
def task_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks that a given short list of words occurs in; the words go into the expression, so nothing is joined."""
    words = F.array(*[F.lit(w) for w in ("mug", "towel", "cube", "push")])
    return table(spark, sf_dir, "episode_refs").select("ref_id", F.explode(F.filter(words, lambda w: F.col("task").contains(w))).alias("p")).dropDuplicates()


@query("unique_tags", "SELECT doc_id, list_filter([source, lang, doc_type, source, dataset], lambda x, i: x IS NOT NULL AND list_position([source, lang, doc_type, source, dataset], x) = i) AS tags FROM documents")
def unique_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags once each, in the order they first appear."""
    return table(spark, sf_dir, "documents").select("doc_id", F.array_distinct(F.array_compact(F.array("source", "lang", "doc_type", "source", "dataset"))).alias("tags"))


@query("spec_hash", "SELECT doc_id, substr(sha256(dataset || '|' || source), 1, 16) AS spec FROM documents")
def spec_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short digest of a declaration."""
    return table(spark, sf_dir, "documents").select("doc_id", F.substring(F.sha2(F.concat("dataset", F.lit("|"), "source"), 256), 1, 16).alias("spec"))


@query("destination_uri", "SELECT DISTINCT dataset, replace(replace('store://{profile}/v1/{dataset}', '{profile}', 'main'), '{dataset}', dataset) AS uri FROM addresses")
def destination_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each dataset is published."""
    uri = F.replace(F.replace(F.lit("store://{profile}/v1/{dataset}"), F.lit("{profile}"), F.lit("main")), F.lit("{dataset}"), F.col("dataset"))
    return table(spark, sf_dir, "addresses").select("dataset", uri.alias("uri")).dropDuplicates()


@query("version_split", "SELECT DISTINCT file_path, regexp_extract(file_path, '/(build-[0-9]+)/', 1) AS version, regexp_matches(regexp_extract(file_path, 'build-([0-9]+)', 1), '^[0-9]+$') AS numbered FROM parquet_files")
def version_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The version folder in a path."""
    return table(spark, sf_dir, "parquet_files").select("file_path", F.regexp_extract("file_path", "/(build-[0-9]+)/", 1).alias("version"), F.regexp_extract("file_path", "build-([0-9]+)", 1).rlike("^[0-9]+$").alias("numbered")).dropDuplicates()


@query("report_numbers", "SELECT event_id, printf('%.11e', value)::DOUBLE AS recorded FROM events")
def report_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers as a report records them, to twelve digits."""
    return table(spark, sf_dir, "events").select("event_id", scalar.significant(F.col("value")).alias("recorded"))


_SHORT = "s AS (SELECT dataset, episode_index, count(*) AS n FROM {f} GROUP BY ALL HAVING count(*) < 60), r AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY episode_index) AS k, count(*) OVER (PARTITION BY dataset) AS total FROM s)"


@query("first_findings", f"WITH {_SHORT.format(f=FRAMES_SQL)} SELECT dataset, list(CAST(episode_index AS VARCHAR) ORDER BY episode_index) || CASE WHEN any_value(total) > 3 THEN ['and ' || (any_value(total) - 3) || ' more'] ELSE [] END AS shown FROM r WHERE k <= 3 GROUP BY 1")
def first_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three short episodes of each dataset, and how many more there are."""
    short = frames(spark, sf_dir, "dataset").groupBy("dataset", "episode_index").agg(F.count(F.lit(1)).alias("n")).filter("n < 60")
    shown = places(short, ["dataset"], ["episode_index"], "k").filter("k < 3").groupBy("dataset").agg(F.array_sort(F.collect_list("episode_index")).cast("array<string>").alias("first"), F.max("k_of").alias("total"))
    more = F.when(F.col("total") > 3, F.array(F.concat(F.lit("and "), (F.col("total") - 3).cast("string"), F.lit(" more")))).otherwise(F.array().cast("array<string>"))
    return shown.select("dataset", F.concat("first", more).alias("shown"))


@query("running_stats", f"WITH g AS (SELECT dataset, episode_index % 2 AS part, gripper AS v FROM {FRAMES_SQL} WHERE gripper IS NOT NULL AND NOT isnan(gripper)) SELECT dataset, count(*) AS n, min(v) AS min, max(v) AS max, round(avg(v) + 1e-9, 6) AS mean, round(stddev_pop(v) + 1e-9, 6) AS std FROM g GROUP BY 1")
def running_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics kept up to date: those so far pooled with those of what came since."""
    rows = frames(spark, sf_dir, "dataset", "gripper").filter("gripper is not null and not isnan(gripper)").withColumn("value", F.col("gripper"))
    parts = rows.groupBy("dataset", (F.col("episode_index") % 2).alias("part")).agg(*statistics.moments())
    return statistics.pooled(parts, ["dataset"], []).withColumns({c: F.round(F.col(c) + 1e-9, 6) for c in ("mean", "std")})


@query("step_pipeline", f"SELECT episode_index, frame_index, coalesce(state_vec[1], 0::FLOAT) AS first, [coalesce(state_vec[3], 0::FLOAT), 0::FLOAT, coalesce(action_vec[1], 0::FLOAT)] AS vec FROM {FRAMES_SQL} WHERE frame_index >= 2")
def step_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered steps composed into one plan; the last does nothing and is left out."""
    config = [("keep_from", {"first": 2}), ("assemble", {"column": "vec", "slots": [("state_vec", 2), None, ("action_vec", 0)]}), ("assemble", {"column": "one", "slots": [("state_vec", 0)]}), ("rename", {"columns": {"vec": "vec"}})]
    rows = pipeline.run(frames(spark, sf_dir, "state_vec", "action_vec"), config)
    return rows.select("episode_index", "frame_index", F.get("one", F.lit(0)).alias("first"), "vec")


@query("video_window", "SELECT DISTINCT segment_id, src, start_s AS from_timestamp, end_s AS to_timestamp, round(end_s - start_s + 1e-9, 6) AS seconds FROM segments WHERE end_s > start_s")
def video_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stretch of a video file that belongs to each piece."""
    rows = table(spark, sf_dir, "segments").filter("end_s > start_s")
    return rows.select("segment_id", "src", F.col("start_s").alias("from_timestamp"), F.col("end_s").alias("to_timestamp"), F.round(F.col("end_s") - F.col("start_s") + 1e-9, 6).alias("seconds")).dropDuplicates()


@query("sorted_frames", f"SELECT episode_index, frame_index, gripper FROM {FRAMES_SQL} ORDER BY 1, 2")
def sorted_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames in the order of episodes, by a range exchange."""
    return frames(spark, sf_dir, "gripper").orderBy("episode_index", "frame_index")


@query("step_seconds", f"WITH t AS (SELECT episode_index, frame_index, epoch_us(sampled_at) AS t FROM {FRAMES_SQL} WHERE sampled_at IS NOT NULL) SELECT episode_index, frame_index, (t - lag(t) OVER (PARTITION BY episode_index ORDER BY frame_index)) / 1e6::DOUBLE AS seconds FROM t")
def step_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds since the frame before."""
    from framemill.operators.blocks import Blocked, boxed

    rows = frames(spark, sf_dir, "sampled_at").filter("sampled_at is not null").withColumn("t", F.unix_micros(F.col("sampled_at").cast("timestamp")))
    b = Blocked(rows.select("episode_index", "frame_index", "t"))
    b.last_before("before", boxed(F.col("t")))
    return b.rows().withColumn("was", b.lag("before", F.col("t"))).select("episode_index", "frame_index", ((F.col("t") - F.col("was")) / F.lit(1e6)).alias("seconds"))


@query("episode_blocks", f"SELECT episode_index, frame_index, CAST(frame_index // 50 AS BIGINT) AS part, CAST(row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) - 1 AS BIGINT) AS position FROM {FRAMES_SQL}")
def episode_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames in parts of fifty indices, with their place in the episode."""
    return scans.positions(frames(spark, sf_dir), block=50).select("episode_index", "frame_index", F.expr("frame_index div 50").alias("part"), "position")
