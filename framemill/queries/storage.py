"""Queries of packing, batching and episode metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framemill.operators import bins, metadata, scans
from framemill.operators.places import places
from framemill.registry import query, table
from framemill.views import FRAMES_SQL, frames

CAP_MB = 100.0

_FILES = "f AS (SELECT dataset, file_id, CAST(round(coalesce(CASE WHEN NOT isnan(max(filled_mb)) THEN max(filled_mb) END, 0) * 1000) AS BIGINT) AS kb FROM parquet_files GROUP BY ALL)"
_GREEDY = f"""{_FILES}, o AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY file_id) AS n FROM f),
    walk AS (SELECT dataset, file_id, kb, n, 0 AS bin, kb AS filled FROM o WHERE n = 1
      UNION ALL SELECT o.dataset, o.file_id, o.kb, o.n, walk.bin + CASE WHEN walk.filled + o.kb >= 100000 THEN 1 ELSE 0 END, CASE WHEN walk.filled + o.kb >= 100000 THEN o.kb ELSE walk.filled + o.kb END FROM walk JOIN o ON o.dataset IS NOT DISTINCT FROM walk.dataset AND o.n = walk.n + 1)"""


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with whole kilobytes, so that sums are exact."""
    known = F.max("filled_mb")
    kb = F.round(F.coalesce(F.when(~F.isnan(known), known), F.lit(0.0)) * 1000).cast("bigint")
    return table(spark, sf_dir, "parquet_files").groupBy("dataset", "file_id").agg(kb.alias("kb"))


@query("file_packing", f"WITH RECURSIVE {_GREEDY} SELECT dataset, file_id, kb, CAST(bin AS BIGINT) AS bin FROM walk")
def file_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Destination of each file of at most 100 MB, file by file."""
    return bins.destinations(_files(spark, sf_dir), ["dataset"], ["file_id"], "kb", CAP_MB * 1000)


@query("packed_files", f"WITH RECURSIVE {_GREEDY} SELECT dataset, CAST(bin AS BIGINT) AS bin, count(*) AS sources, CAST(sum(kb) AS BIGINT) AS kb FROM walk GROUP BY ALL")
def packed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every destination."""
    packed = bins.destinations(_files(spark, sf_dir), ["dataset"], ["file_id"], "kb", CAP_MB * 1000)
    return packed.groupBy("dataset", "bin").agg(F.count(F.lit(1)).alias("sources"), F.sum("kb").alias("kb"))


_SEG = "s AS (SELECT DISTINCT camera, episode_index, segment_id, CAST(round((end_s - start_s) * 1000) AS BIGINT) AS ms FROM segments WHERE end_s > start_s)"


@query("video_offsets", f"""WITH RECURSIVE {_SEG}, o AS (SELECT *, row_number() OVER (PARTITION BY camera, episode_index ORDER BY segment_id) AS n FROM s),
    walk AS (SELECT camera, episode_index, segment_id, ms, n, 0 AS bin, ms AS filled FROM o WHERE n = 1 UNION ALL SELECT o.camera, o.episode_index, o.segment_id, o.ms, o.n, walk.bin + CASE WHEN walk.filled + o.ms >= 6000 THEN 1 ELSE 0 END,
      CASE WHEN walk.filled + o.ms >= 6000 THEN o.ms ELSE walk.filled + o.ms END FROM walk JOIN o ON o.camera = walk.camera AND o.episode_index = walk.episode_index AND o.n = walk.n + 1)
    SELECT camera, episode_index, segment_id, CAST(bin AS BIGINT) AS bin, CAST(filled - ms AS BIGINT) AS from_timestamp, CAST(filled AS BIGINT) AS to_timestamp FROM walk""")
def video_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece lies in the video it is packed into, in milliseconds."""
    ms = F.round((F.col("end_s") - F.col("start_s")) * 1000).cast("bigint")
    pieces = table(spark, sf_dir, "segments").filter("end_s > start_s").select("camera", "episode_index", "segment_id", ms.alias("ms")).dropDuplicates()
    packed = bins.destinations(pieces, ["camera", "episode_index"], ["segment_id"], "ms", 6000.0)
    return metadata.offsets_in_destination(packed, ["camera", "episode_index", "bin"], ["segment_id"], "ms").select("camera", "episode_index", "segment_id", "bin", "from_timestamp", "to_timestamp")


_CAND = "c AS (SELECT plan_id, slot, max(greatest(coalesce(episodes, 0), 0)) AS episodes FROM candidates GROUP BY ALL), o AS (SELECT *, row_number() OVER (PARTITION BY plan_id ORDER BY slot) AS n FROM c)"
_BATCH = f"""{_CAND}, walk AS (SELECT plan_id, slot, n, 0 AS bin, CASE WHEN episodes >= 768 THEN 1 WHEN 8 <= 1 OR episodes >= 768 THEN 1 ELSE 0 END AS next, CASE WHEN episodes >= 768 THEN 0 ELSE 1 END AS held, CASE WHEN episodes >= 768 THEN 0 ELSE episodes END AS total FROM o WHERE n = 1
    UNION ALL SELECT o.plan_id, o.slot, o.n, CASE WHEN o.episodes >= 768 AND walk.held > 0 THEN walk.next + 1 ELSE walk.next END,
      CASE WHEN o.episodes >= 768 THEN CASE WHEN walk.held > 0 THEN walk.next + 2 ELSE walk.next + 1 END WHEN walk.held + 1 >= 8 OR walk.total + o.episodes >= 768 THEN walk.next + 1 ELSE walk.next END,
      CASE WHEN o.episodes >= 768 OR walk.held + 1 >= 8 OR walk.total + o.episodes >= 768 THEN 0 ELSE walk.held + 1 END,
      CASE WHEN o.episodes >= 768 OR walk.held + 1 >= 8 OR walk.total + o.episodes >= 768 THEN 0 ELSE walk.total + o.episodes END FROM walk JOIN o ON o.plan_id = walk.plan_id AND o.n = walk.n + 1)"""


@query("batches", f"WITH RECURSIVE {_BATCH} SELECT plan_id, slot, CAST(bin AS BIGINT) AS bin FROM walk")
def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of each plan: at most 8 datasets, closed at 768 episodes, large ones alone."""
    known = F.greatest(F.coalesce("episodes", F.lit(0)), F.lit(0))
    rows = table(spark, sf_dir, "candidates").groupBy("plan_id", "slot").agg(F.max(known).alias("episodes"))
    return bins.batches(rows, ["plan_id"], ["slot"], "episodes", 8, 768).select("plan_id", "slot", "bin")


@query("smallest_first", "SELECT dataset, file_id, kb, row_number() OVER (PARTITION BY dataset ORDER BY kb, file_id) AS up, row_number() OVER (PARTITION BY dataset ORDER BY kb DESC, file_id) AS down FROM f".replace("FROM f", f"FROM (WITH {_FILES} SELECT * FROM f)"))
def smallest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of each file from the smallest up and from the largest down."""
    up = places(_files(spark, sf_dir), ["dataset"], ["kb", "file_id"], "u")
    both = places(up.drop("u_of"), ["dataset"], ["kb", "file_id"], "d", descending=True)
    return both.select("dataset", "file_id", "kb", (F.col("u") + 1).alias("up"), (F.col("d") + 1).alias("down"))


@query("size_sample", f"WITH {_FILES}, r AS (SELECT dataset, file_id, row_number() OVER (PARTITION BY dataset ORDER BY kb, file_id) - 1 AS i, count(*) OVER (PARTITION BY dataset) AS n FROM f) SELECT dataset, file_id FROM r WHERE n <= 5 OR i IN (CAST(floor(0 * n / 5.0::DOUBLE) AS BIGINT), CAST(floor(1 * (n / 5.0::DOUBLE)) AS BIGINT), CAST(floor(2 * (n / 5.0::DOUBLE)) AS BIGINT), CAST(floor(3 * (n / 5.0::DOUBLE)) AS BIGINT), CAST(floor(4 * (n / 5.0::DOUBLE)) AS BIGINT))")
def size_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five files of each dataset, spread over the sizes."""
    rows = places(_files(spark, sf_dir), ["dataset"], ["kb", "file_id"], "i").withColumnRenamed("i_of", "n")
    steps = F.array(*[F.floor(F.lit(float(k)) * (F.col("n") / 5.0)) for k in range(5)])
    return rows.filter((F.col("n") <= 5) | F.array_contains(steps, F.col("i").cast("bigint"))).select("dataset", "file_id")


@query("chunk_ids", f"SELECT DISTINCT episode_index, CAST(floor(episode_index / 1000.0::DOUBLE) AS BIGINT) AS chunk, printf('data/chunk-%03d/episode_%06d.parquet', CAST(floor(episode_index / 1000.0::DOUBLE) AS BIGINT), episode_index) AS path FROM {FRAMES_SQL}")
def chunk_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk folder and file of each episode."""
    chunk = metadata.chunk_of(F.col("episode_index"), 1000)
    return table(spark, sf_dir, "frames").select("episode_index").dropDuplicates().select("episode_index", chunk.alias("chunk"), F.format_string("data/chunk-%03d/episode_%06d.parquet", chunk, "episode_index").alias("path"))


@query("episode_chunks", f"WITH n AS (SELECT dataset, count(DISTINCT episode_index) AS n FROM {FRAMES_SQL} GROUP BY 1) SELECT dataset, s AS chunk_from, least(s + 25, n) AS chunk_to FROM (SELECT dataset, n, unnest(range(0, n, 25)) AS s FROM n)")
def episode_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episode slices of 25 of each dataset."""
    n = table(spark, sf_dir, "frames").select("dataset", "episode_index").dropDuplicates().groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))
    return n.select("dataset", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(25).cast("bigint"))).alias("chunk_from")).select("dataset", "chunk_from", F.least(F.col("chunk_from") + 25, F.col("n")).alias("chunk_to"))


_RANGES = f"n AS (SELECT episode_index, count(*) AS length FROM {FRAMES_SQL} GROUP BY 1), r AS (SELECT episode_index, length, sum(length) OVER (ORDER BY episode_index) - length AS a, sum(length) OVER (ORDER BY episode_index) AS b FROM n)"


@query("split_by_range", f'WITH {_RANGES}, i AS (SELECT row_number() OVER (ORDER BY episode_index, frame_index) - 1 AS "index", frame_index FROM {FRAMES_SQL}) SELECT CAST("index" AS BIGINT) AS "index", r.episode_index, frame_index FROM i JOIN r ON "index" >= a AND "index" < b')
def split_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed rows given back to their episodes by index range."""
    rows = frames(spark, sf_dir)
    ranges = scans.episode_ranges(rows.groupBy("episode_index").agg(F.count(F.lit(1)).alias("length")))
    packed = scans.global_index(rows).select("index", "frame_index")
    return metadata.split_ranges(packed, ranges).select("index", "episode_index", "frame_index")


@query("episode_lengths", f"SELECT episode_index, count(*) AS length FROM {FRAMES_SQL} GROUP BY 1")
def episode_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of each episode."""
    return frames(spark, sf_dir).groupBy("episode_index").agg(F.count(F.lit(1)).alias("length"))


@query("remap_metadata", f"WITH {_FILES} SELECT file_id, CASE WHEN file_id % 3 = 0 THEN file_id % 10 ELSE 0 END AS chunk, CASE WHEN file_id % 3 = 0 THEN file_id // 10 ELSE 0 END AS file, kb + CASE WHEN file_id % 3 = 0 THEN 1000 ELSE 0 END AS kb FROM f")
def remap_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows re-pointed to the files theirs were merged into, the rest to the default file."""
    rows = _files(spark, sf_dir).select("file_id", (F.col("file_id") % 7).alias("chunk"), F.col("file_id").alias("file"), "kb")
    third = rows.filter("file_id % 3 = 0")
    mapping = third.select("chunk", "file", (F.col("file_id") % 10).alias("to_chunk"), F.expr("file_id div 10").alias("to_file"), F.lit(1000).cast("bigint").alias("shift"))
    return metadata.remap(rows, mapping, ["chunk", "file"], {"chunk": 0, "file": 0}, ("kb", "shift"))


@query("reindex_aggregate", f"""WITH s AS (SELECT dataset, count(DISTINCT episode_index) AS episodes, count(*) AS frames FROM {FRAMES_SQL} GROUP BY 1)
    SELECT a.dataset, a.episodes, a.frames, CAST(coalesce(sum(b.episodes), 0) AS BIGINT) AS episode_offset, CAST(coalesce(sum(b.frames), 0) AS BIGINT) AS frame_offset FROM s a LEFT JOIN s b ON b.dataset < a.dataset GROUP BY ALL""")
def reindex_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets of each dataset's episodes and frames in the joined one."""
    per = frames(spark, sf_dir, "dataset").groupBy("dataset", "episode_index").agg(F.count(F.lit(1)).alias("n")).groupBy("dataset").agg(F.count(F.lit(1)).alias("episodes"), F.sum("n").alias("frames"))
    return metadata.reindexed(per, "dataset")


_PARTS = "d AS (SELECT DISTINCT episode_index FROM frames), v AS (SELECT DISTINCT episode_index FROM video_shots), s AS (SELECT DISTINCT episode_index FROM segments)"


@query("episode_metadata_join", f"WITH {_PARTS} SELECT d.episode_index FROM d JOIN v USING (episode_index) JOIN s USING (episode_index)")
def episode_metadata_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes of which data, images and segments are all there."""
    return metadata.side_by_side(_parts(spark, sf_dir), "episode_index")[0]


@query("episode_metadata_lacking", f"""WITH {_PARTS}, a AS (SELECT episode_index FROM d UNION SELECT episode_index FROM v UNION SELECT episode_index FROM s)
    SELECT a.episode_index, list_filter([CASE WHEN d.episode_index IS NULL THEN 'data' END, CASE WHEN v.episode_index IS NULL THEN 'images' END, CASE WHEN s.episode_index IS NULL THEN 'segments' END], lambda x: x IS NOT NULL) AS lacking
    FROM a LEFT JOIN d ON d.episode_index = a.episode_index LEFT JOIN v ON v.episode_index = a.episode_index LEFT JOIN s ON s.episode_index = a.episode_index WHERE d.episode_index IS NULL OR v.episode_index IS NULL OR s.episode_index IS NULL""")
def episode_metadata_lacking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes that lack some part, and which."""
    return metadata.side_by_side(_parts(spark, sf_dir), "episode_index")[1]


def _parts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {n: table(spark, sf_dir, t).select("episode_index").dropDuplicates() for n, t in (("data", "frames"), ("images", "video_shots"), ("segments", "segments"))}


@query("camera_pivot", "SELECT episode_index, count(*) FILTER (camera = 'observation.images.chest') AS chest, count(*) FILTER (camera = 'observation.images.left_palm') AS left_palm FROM (SELECT DISTINCT episode_index, camera, shot_id FROM video_shots) GROUP BY 1")
def camera_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of each episode, a column a camera."""
    shots = table(spark, sf_dir, "video_shots").select("episode_index", "camera", "shot_id").dropDuplicates()
    wide = shots.groupBy("episode_index").pivot("camera", ["observation.images.chest", "observation.images.left_palm"]).count()
    return wide.select("episode_index", *[F.coalesce(f"`observation.images.{c}`", F.lit(0)).alias(c) for c in ("chest", "left_palm")])


@query("task_dictionary", f"WITH f AS (SELECT prompt, min(episode_index * 1000000 + frame_index) AS first FROM {FRAMES_SQL} WHERE prompt IS NOT NULL GROUP BY 1) SELECT prompt, CAST(row_number() OVER (ORDER BY first) - 1 AS BIGINT) AS task_index FROM f")
def task_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts numbered as they first appear."""
    return metadata.task_dictionary(frames(spark, sf_dir, "prompt"), "prompt", ["episode_index", "frame_index"])


@query("task_encoded", f"WITH f AS (SELECT prompt, min(episode_index * 1000000 + frame_index) AS first FROM {FRAMES_SQL} WHERE prompt IS NOT NULL GROUP BY 1), t AS (SELECT prompt, CAST(row_number() OVER (ORDER BY first) - 1 AS BIGINT) AS task_index FROM f) SELECT episode_index, frame_index, task_index FROM {FRAMES_SQL} LEFT JOIN t USING (prompt)")
def task_encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames with their task's number."""
    rows = frames(spark, sf_dir, "prompt")
    return rows.join(metadata.task_dictionary(rows, "prompt", ["episode_index", "frame_index"]), "prompt", "left").select("episode_index", "frame_index", "task_index")


@query("prompt_lookup", f"SELECT e.episode_index, coalesce(p.prompt, '') AS prompt FROM (SELECT DISTINCT episode_index FROM video_shots) e LEFT JOIN (SELECT episode_index, arg_min(prompt, frame_index) AS prompt FROM {FRAMES_SQL} WHERE prompt IS NOT NULL GROUP BY 1) p USING (episode_index)")
def prompt_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prompt of every filmed episode, empty where it has none."""
    prompts = frames(spark, sf_dir, "prompt").filter("prompt is not null").groupBy("episode_index").agg(F.min_by("prompt", "frame_index").alias("prompt"))
    return table(spark, sf_dir, "video_shots").select("episode_index").dropDuplicates().join(prompts, "episode_index", "left").select("episode_index", F.coalesce("prompt", F.lit("")).alias("prompt"))


@query("sparse_scatter", f"SELECT episode_index, frame_index, CASE WHEN frame_index % 3 = 0 THEN action_vec ELSE state_vec END AS action FROM (SELECT episode_index, frame_index, state_vec, coalesce(action_vec, state_vec) AS action_vec FROM {FRAMES_SQL})")
def sparse_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actions given for some frames only, laid over the states."""
    rows = frames(spark, sf_dir, "state_vec", "action_vec")
    sparse = rows.filter("frame_index % 3 = 0").select("episode_index", "frame_index", F.col("action_vec").alias("action"))
    return metadata.scattered(rows.select("episode_index", "frame_index", "state_vec"), sparse, ["episode_index", "frame_index"], "state_vec", "action").select("episode_index", "frame_index", "action")


@query("semi_subset", "SELECT episode_index, frame_index FROM frames f WHERE EXISTS (SELECT 1 FROM video_shots v WHERE v.episode_index = f.episode_index)")
def semi_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of filmed episodes."""
    return table(spark, sf_dir, "frames").select("episode_index", "frame_index").join(table(spark, sf_dir, "video_shots").select("episode_index"), "episode_index", "left_semi")


@query("deny_list", "SELECT ref_id, task FROM episode_refs r WHERE NOT EXISTS (SELECT 1 FROM (SELECT task FROM episode_refs GROUP BY 1 HAVING count(*) > 50) d WHERE d.task = r.task)")
def deny_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes whose task isn't on the list of frequent ones."""
    refs = table(spark, sf_dir, "episode_refs")
    denied = refs.groupBy("task").agg(F.count(F.lit(1)).alias("n")).filter("n > 50").select("task")
    return refs.join(denied, "task", "left_anti").select("ref_id", "task")


@query("shared_source_guard", "SELECT DISTINCT a.source_mirror FROM addresses a WHERE a.source_mirror IS NOT NULL AND EXISTS (SELECT 1 FROM addresses b WHERE b.source_mirror = a.source_mirror AND (b.delivered_path IS NULL OR trim(b.delivered_path) IN ('', '-', 'n/a')))")
def shared_source_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that an undelivered dataset still needs."""
    a = table(spark, sf_dir, "addresses").filter("source_mirror is not null")
    waiting = a.filter(F.col("delivered_path").isNull() | F.trim("delivered_path").isin("", "-", "n/a")).select("source_mirror")
    return a.select("source_mirror").join(waiting, "source_mirror", "left_semi").dropDuplicates()


@query("videos_complete", "SELECT episode_index, bool_and(n_bytes IS NOT NULL AND n_bytes > 0) AS complete FROM video_shots GROUP BY 1")
def videos_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether every image of an episode has bytes."""
    return table(spark, sf_dir, "video_shots").groupBy("episode_index").agg(F.bool_and(F.coalesce(F.col("n_bytes") > 0, F.lit(False))).alias("complete"))


@query("union_by_name", "SELECT dataset, episode_index, frame_index, gripper FROM frames UNION ALL SELECT dataset, episode_index, frame_index, gripper FROM frames_delivered")
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both copies, columns matched by name."""
    a, b = (table(spark, sf_dir, t) for t in ("frames", "frames_delivered"))
    return a.unionByName(b, allowMissingColumns=True).select("dataset", "episode_index", "frame_index", "gripper")


@query("top_tasks", "SELECT task, count(*) AS n FROM episode_refs WHERE task IS NOT NULL GROUP BY 1 ORDER BY n DESC, task LIMIT 12")
def top_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve most frequent tasks."""
    return table(spark, sf_dir, "episode_refs").filter("task is not null").groupBy("task").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "task").limit(12)


@query("positional_sample", "WITH f AS (SELECT DISTINCT file_path FROM parquet_files), r AS (SELECT file_path, row_number() OVER (ORDER BY file_path) - 1 AS i, count(*) OVER () AS n FROM f) SELECT file_path FROM r WHERE i % greatest(1, n // 100) = 0 AND i // greatest(1, n // 100) < 100")
def positional_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hundred files, evenly spread over the sorted listing."""
    files = places(table(spark, sf_dir, "parquet_files").select("file_path").dropDuplicates(), [], ["file_path"])
    step = F.greatest(F.lit(1), F.expr("place_of div 100"))
    return files.filter((F.col("place") % step == 0) & (F.floor(F.col("place") / step) < 100)).select("file_path")
