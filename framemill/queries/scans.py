"""Queries of the ordered scans and clocks, over the current frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framemill.operators import clocks, scans
from framemill.registry import query, table
from framemill.views import FRAMES_SQL, frames

_G = f"g AS (SELECT episode_index, frame_index, CASE WHEN NOT isnan(gripper) THEN gripper END AS p FROM {FRAMES_SQL})"


def _gripper(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.when(~F.isnan("gripper"), F.col("gripper"))
    return frames(spark, sf_dir, "gripper").select("episode_index", "frame_index", known.alias("p"), (known - 0.5).alias("a"))


@query(
    "gripper_rel2abs",
    f"""WITH {_G}, s AS (SELECT *, CASE WHEN p - 0.5 < -0.1 THEN 1 WHEN p - 0.5 > 0.1 THEN -1 END AS s FROM g)
    SELECT episode_index, frame_index, coalesce(last_value(s IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      -first_value(s IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 1) / 2.0 + 0.5 AS gripper_abs
    FROM s WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index)""",
)
def gripper_rel2abs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absolute gripper states from relative actions."""
    return scans.relative_to_absolute(_gripper(spark, sf_dir), "a").select("episode_index", "frame_index", "gripper_abs")


@query(
    "gripper_binarize",
    f"""WITH {_G}, d AS (SELECT *, CASE WHEN p > 0.95 THEN 1.0::DOUBLE WHEN p < 0.05 THEN 0.0::DOUBLE END AS d FROM g),
    n AS (SELECT a.episode_index, a.frame_index, min(b.frame_index) AS at FROM d a LEFT JOIN d b ON a.episode_index = b.episode_index AND b.frame_index >= a.frame_index AND b.d IS NOT NULL GROUP BY 1, 2),
    e AS (SELECT episode_index, max(frame_index) AS at FROM d GROUP BY 1)
    SELECT n.episode_index, n.frame_index, CASE WHEN n.at IS NOT NULL THEN x.d ELSE y.p END AS gripper_bin
    FROM n JOIN e USING (episode_index) LEFT JOIN d x ON x.episode_index = n.episode_index AND x.frame_index = n.at
    JOIN d y ON y.episode_index = n.episode_index AND y.frame_index = e.at""",
)
def gripper_binarize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary gripper states from continuous values."""
    return scans.binarize(_gripper(spark, sf_dir), "p").select("episode_index", "frame_index", "gripper_bin")


@query(
    "relabel_actions",
    f"""WITH f AS (SELECT *, row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) AS n FROM {FRAMES_SQL})
    SELECT a.episode_index, a.frame_index, CASE WHEN a.state_vec IS NOT NULL AND b.state_vec IS NOT NULL THEN list_append(
      list_transform(generate_series(1, greatest(len(a.state_vec[1:6]), len(b.state_vec[1:6]))), lambda i: b.state_vec[1:6][i] - a.state_vec[1:6][i]), CAST(a.gripper AS FLOAT)) END AS action
    FROM f a JOIN f b ON a.episode_index = b.episode_index AND b.n = a.n + 1""",
)
def relabel_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actions from the states reached, last frames dropped."""
    return scans.relabel_actions(frames(spark, sf_dir, "state_vec", "gripper"), "state_vec", "gripper").select("episode_index", "frame_index", "action")


_STILL = "coalesce(abs(action_vec[2]::DOUBLE - state_vec[2]::DOUBLE) < 0.02 AND abs(action_vec[3]::DOUBLE - state_vec[3]::DOUBLE) < 0.02, FALSE)"


@query(
    "noop_filter",
    f"""WITH RECURSIVE f AS (SELECT episode_index, frame_index, round(CASE WHEN NOT isnan(gripper) THEN gripper END, 1) AS g, {_STILL} AS still,
      row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) AS n FROM {FRAMES_SQL}),
    walk AS (SELECT episode_index, n, NOT still AS kept, NOT still AS seen, CASE WHEN NOT still THEN g END AS held FROM f WHERE n = 1
      UNION ALL SELECT f.episode_index, f.n, NOT (f.still AND (NOT walk.seen OR f.g IS NOT DISTINCT FROM walk.held)),
        walk.seen OR NOT f.still, CASE WHEN NOT (f.still AND (NOT walk.seen OR f.g IS NOT DISTINCT FROM walk.held)) THEN f.g ELSE walk.held END
      FROM walk JOIN f ON f.episode_index = walk.episode_index AND f.n = walk.n + 1)
    SELECT f.episode_index, f.frame_index FROM f JOIN walk USING (episode_index, n) WHERE kept""",
)
def noop_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames left when those that do nothing are gone."""
    rows = frames(spark, sf_dir, "state_vec", "action_vec", "gripper").withColumn("g", F.round(F.when(~F.isnan("gripper"), F.col("gripper")), 1))
    near = lambda i: F.abs(F.get("action_vec", F.lit(i)).cast("double") - F.get("state_vec", F.lit(i)).cast("double")) < 0.02
    return scans.drop_noops(rows, near(1) & near(2), "g").select("episode_index", "frame_index")


@query("first_step_drop", f"SELECT episode_index, frame_index, gripper FROM {FRAMES_SQL} QUALIFY row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) > 1")
def first_step_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes without their first frame."""
    return scans.drop_first(frames(spark, sf_dir, "gripper"))


@query("last_step_drop", f"SELECT episode_index, frame_index, gripper FROM {FRAMES_SQL} QUALIFY lead(frame_index) OVER (PARTITION BY episode_index ORDER BY frame_index) IS NOT NULL")
def last_step_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes without their last frame."""
    return scans.drop_last(frames(spark, sf_dir, "gripper"))


@query(
    "step_flags",
    f"""SELECT episode_index, frame_index, lag(frame_index) OVER w IS NULL AS is_first, lead(frame_index) OVER w IS NULL AS is_last, lead(frame_index) OVER w IS NULL AS is_terminal
    FROM {FRAMES_SQL} WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index)""",
)
def step_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First, last and terminal flags of every frame."""
    return scans.step_flags(frames(spark, sf_dir))


@query(
    "frame_index_timestamp",
    f"""SELECT episode_index, frame_index, CAST(row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) - 1 AS BIGINT) AS position,
      (row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) - 1) / 30.0::DOUBLE AS "timestamp" FROM {FRAMES_SQL}""",
)
def frame_index_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of each frame and its time at 30 frames a second."""
    return scans.timestamps(frames(spark, sf_dir), 30.0).select("episode_index", "frame_index", "position", "timestamp")


@query("global_index", f'SELECT episode_index, frame_index, CAST(row_number() OVER (ORDER BY episode_index, frame_index) - 1 AS BIGINT) AS "index" FROM {FRAMES_SQL}')
def global_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running number of each frame over all episodes."""
    return scans.global_index(frames(spark, sf_dir)).select("episode_index", "frame_index", "index")


@query(
    "episode_ranges",
    f"""WITH n AS (SELECT episode_index, count(*) AS length FROM {FRAMES_SQL} GROUP BY 1)
    SELECT episode_index, length, CAST(sum(length) OVER (ORDER BY episode_index) - length AS BIGINT) AS dataset_from_index, CAST(sum(length) OVER (ORDER BY episode_index) AS BIGINT) AS dataset_to_index FROM n""",
)
def episode_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each episode in the packed order."""
    return scans.episode_ranges(frames(spark, sf_dir).groupBy("episode_index").agg(F.count(F.lit(1)).alias("length"))).select("episode_index", "length", "dataset_from_index", "dataset_to_index")


_TIMES = f"t AS (SELECT episode_index, frame_index, epoch_us(sampled_at) AS t FROM {FRAMES_SQL} WHERE sampled_at IS NOT NULL)"
_SHOTS = "s AS (SELECT DISTINCT episode_index, camera AS stream, shot_id AS reference_id, epoch_us(shot_at) AS t FROM video_shots WHERE shot_at IS NOT NULL)"


def _times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames(spark, sf_dir, "sampled_at").select("episode_index", "frame_index", F.unix_micros(F.col("sampled_at").cast("timestamp")).alias("t")).filter("t is not null")


def _shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.unix_micros(F.col("shot_at").cast("timestamp"))
    return table(spark, sf_dir, "video_shots").select("episode_index", F.col("camera").alias("stream"), F.col("shot_id").alias("reference_id"), at.alias("t")).filter("t is not null").dropDuplicates()


@query("clock_advancing", f"WITH {_TIMES} SELECT episode_index, frame_index FROM t QUALIFY lead(t) OVER (PARTITION BY episode_index ORDER BY frame_index) > t")
def clock_advancing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames after which the sample clock goes on."""
    return clocks.advancing(_times(spark, sf_dir), "t").select("episode_index", "frame_index")


@query("clock_before_last", f"WITH {_TIMES}, {_SHOTS} SELECT reference_id FROM s WHERE EXISTS (SELECT 1 FROM t WHERE t.episode_index = s.episode_index AND t.t > s.t)")
def clock_before_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images taken before the episode's last sample."""
    return clocks.before_last(_shots(spark, sf_dir), _times(spark, sf_dir).withColumnRenamed("t", "u"), "t", "u").select("reference_id")


@query(
    "clock_index",
    f"""WITH {_TIMES}, {_SHOTS}, a AS (SELECT *, row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) - 1 AS position FROM t),
    b AS (SELECT *, row_number() OVER (PARTITION BY episode_index, stream ORDER BY t, reference_id) - 1 AS position FROM s)
    SELECT b.reference_id, a.frame_index FROM a JOIN b ON a.episode_index = b.episode_index AND a.position = b.position""",
)
def clock_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images and frames of one episode paired by position."""
    samples = scans.positions(_times(spark, sf_dir)).select("episode_index", "position", "frame_index")
    shots = _shots(spark, sf_dir).withColumn("one_stream", F.struct("episode_index", "stream"))
    ranked = clocks.Blocked(shots, episode="one_stream", order="t", ties=("reference_id",), size=clocks.TIME_BLOCK)
    ranked.sum_before("__n", F.lit(1))
    places = ranked.rows().withColumn("position", F.row_number().over(ranked.inner) - 1 + F.col("__n")).select("episode_index", "position", "reference_id")
    return places.join(samples, ["episode_index", "position"]).select("reference_id", "frame_index")


@query(
    "clock_nearest",
    f"""WITH RECURSIVE {_TIMES}, {_SHOTS},
    u AS (SELECT episode_index, t FROM t QUALIFY lead(t) OVER (PARTITION BY episode_index ORDER BY frame_index) > t),
    k AS (SELECT episode_index, t, row_number() OVER (PARTITION BY episode_index ORDER BY t) - 1 AS i, count(*) OVER (PARTITION BY episode_index) AS n FROM u),
    r AS (SELECT * FROM s WHERE t < (SELECT max(t) FROM t WHERE t.episode_index = s.episode_index)),
    w AS (SELECT r.*, (SELECT min(i) FROM k WHERE k.episode_index = r.episode_index AND k.t >= r.t) AS nx, (SELECT max(i) FROM k WHERE k.episode_index = r.episode_index AND k.t < r.t) AS pv FROM r),
    v AS (SELECT w.*, a.t AS nt, b.t AS pt, coalesce(a.n, b.n) AS n, row_number() OVER (PARTITION BY w.episode_index, stream ORDER BY w.t, reference_id) AS o
      FROM w LEFT JOIN k a ON a.episode_index = w.episode_index AND a.i = nx LEFT JOIN k b ON b.episode_index = w.episode_index AND b.i = pv WHERE nx IS NOT NULL OR pv IS NOT NULL),
    d AS (SELECT *, CASE WHEN pv IS NOT NULL AND (nx IS NULL OR t - pt < nt - t) THEN pv ELSE nx END AS wish FROM v),
    walk AS (SELECT episode_index, stream, reference_id, o, wish AS claimed, wish AS last FROM d WHERE o = 1
      UNION ALL SELECT d.episode_index, d.stream, d.reference_id, d.o,
        CASE WHEN d.wish > walk.last THEN d.wish WHEN d.wish + 1 > walk.last AND d.wish + 1 < d.n THEN d.wish + 1 END,
        CASE WHEN d.wish > walk.last THEN d.wish WHEN d.wish + 1 > walk.last AND d.wish + 1 < d.n THEN d.wish + 1 ELSE walk.last END
      FROM walk JOIN d ON d.episode_index = walk.episode_index AND d.stream = walk.stream AND d.o = walk.o + 1)
    SELECT episode_index, stream, reference_id, CAST(claimed AS BIGINT) AS sample FROM walk WHERE claimed IS NOT NULL""",
)
def clock_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample that each image claims, by nearest time."""
    times = _times(spark, sf_dir)
    shots = clocks.before_last(_shots(spark, sf_dir), times.withColumnRenamed("t", "u"), "t", "u")
    return clocks.nearest_claimed(clocks.advancing(times, "t"), shots)


_MILLIS = f"m AS (SELECT episode_index, frame_index, epoch_us(sampled_at) // 1000 AS ms, epoch_us(sampled_at) // 1000000 AS sec FROM {FRAMES_SQL} WHERE sampled_at IS NOT NULL)"


@query(
    "episode_fps_millis",
    f"""WITH {_MILLIS}, d AS (SELECT episode_index, ms - lag(ms) OVER (PARTITION BY episode_index ORDER BY frame_index) AS step FROM m)
    SELECT episode_index, count(*) AS n, round(1000 / avg(CASE WHEN step > 0 THEN step END), 6) AS fps FROM d GROUP BY 1""",
)
def episode_fps_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame rates from millisecond stamps."""
    rows = _times(spark, sf_dir).select("episode_index", "frame_index", F.expr("t div 1000").alias("ms"))
    return clocks.clock_rate(rows, "ms", "millis").select("episode_index", "n", F.round("fps", 6).alias("fps"))


@query(
    "episode_fps_seconds",
    f"""WITH {_MILLIS}, d AS (SELECT episode_index, count(*) AS n, arg_max(sec, frame_index) - arg_min(sec, frame_index) AS span FROM m GROUP BY 1)
    SELECT episode_index, n, CASE WHEN span > 0 THEN round(n / span, 6) END AS fps, CASE WHEN span > 0 THEN span END AS span FROM d""",
)
def episode_fps_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame rates from whole-second stamps."""
    rows = _times(spark, sf_dir).select("episode_index", "frame_index", F.expr("t div 1000000").alias("sec"))
    return clocks.clock_rate(rows, "sec", "seconds").select("episode_index", "n", F.round("fps", 6).alias("fps"), "span")
