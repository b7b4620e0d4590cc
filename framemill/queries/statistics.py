"""Queries of the statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framemill.operators import clocks, statistics
from framemill.registry import query, table
from framemill.session import cut_lineage
from framemill.views import DELIVERED_SQL, FRAMES_SQL, frames

WIDTH = 44
# Both engines round after a tiny shift, as they break ties at the last digit differently.
MOMENTS = ["min", "max", "mean", "std"]


def _long(t: str, extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT episode_index{extra}, '{c}' AS feature, i - 1 AS dim, {c}[i]::DOUBLE AS value FROM {t}, generate_series(1, {WIDTH}) AS g(i) WHERE len({c}) = {WIDTH} AND {c}[i] IS NOT NULL AND NOT isnan({c}[i])"
        for c in ("state_vec", "action_vec")
    )


def vectors(spark: SparkSession, sf_dir: str, name: str = "frames") -> DataFrame:
    """``episode_index, feature, dim, value`` of states and actions."""
    rows = frames(spark, sf_dir, "state_vec", "action_vec", name=name)
    parts = [statistics.vector_values(rows, ["episode_index"], c, WIDTH).select("episode_index", F.lit(c).alias("feature"), "dim", "value") for c in ("state_vec", "action_vec")]
    return parts[0].unionByName(parts[1])


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n) + 1e-9, 6) for n in names})


_STATS = "count(*) AS n, min(value) AS min, max(value) AS max, round(avg(value) + 1e-9, 6) AS mean, round(stddev_pop(value) + 1e-9, 6) AS std"


@query("episode_stats", f"SELECT episode_index, feature, CAST(dim AS INTEGER) AS dim, {_STATS} FROM ({_long(FRAMES_SQL)}) GROUP BY ALL")
def episode_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moments of every dimension of every episode."""
    return _rounded(vectors(spark, sf_dir).groupBy("episode_index", "feature", "dim").agg(*statistics.moments()), "mean", "std")


_QS = ", ".join(f"round(quantile_cont(value, {q}) + 1e-9, 6) AS {n}" for n, q in statistics.QUANTILES.items())


@query("episode_quantiles", f"SELECT episode_index, feature, CAST(dim AS INTEGER) AS dim, {_QS} FROM ({_long(FRAMES_SQL)}) GROUP BY ALL")
def episode_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of every dimension of every episode."""
    return _rounded(statistics.exact_quantiles(vectors(spark, sf_dir), ["episode_index", "feature", "dim"], "value", statistics.QUANTILES), *statistics.QUANTILES)


@query("pooled_stats", f"SELECT feature, CAST(dim AS INTEGER) AS dim, CAST(count(*) AS BIGINT) AS n, min(value) AS min, max(value) AS max, round(avg(value) + 1e-9, 6) AS mean, round(stddev_pop(value) + 1e-9, 6) AS std FROM ({_long(FRAMES_SQL)}) GROUP BY ALL")
def pooled_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-dataset moments pooled from the episodes'."""
    by_episode = vectors(spark, sf_dir).groupBy("episode_index", "feature", "dim").agg(*statistics.moments())
    return _rounded(statistics.pooled(by_episode, ["feature", "dim"], []), "mean", "std")


_BY_EPISODE_QS = f"SELECT episode_index, feature, CAST(dim AS INTEGER) AS dim, count(*) AS n, quantile_cont(value, 0.01) AS q01, quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.99) AS q99 FROM ({_long(FRAMES_SQL)}) GROUP BY ALL"


@query("pooled_quantiles", f"SELECT feature, dim, round(sum(n * q50) / sum(n) + 1e-9, 6) AS q50 FROM ({_BY_EPISODE_QS}) GROUP BY ALL")
def pooled_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count-weighted mean of the episodes' medians."""
    by_episode = statistics.described(vectors(spark, sf_dir), ["episode_index", "feature", "dim"], {"q50": 0.5})
    return _rounded(statistics.pooled(by_episode, ["feature", "dim"], ["q50"]), "q50").select("feature", "dim", "q50")


@query("envelope_stats", f"SELECT feature, dim, round(min(q01) + 1e-9, 6) AS q01, round(max(q99) + 1e-9, 6) AS q99 FROM ({_BY_EPISODE_QS}) GROUP BY ALL")
def envelope_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Widest interval of the episodes' outer quantiles."""
    by_episode = statistics.exact_quantiles(vectors(spark, sf_dir), ["episode_index", "feature", "dim"], "value", {"q01": 0.01, "q99": 0.99})
    return _rounded(statistics.envelope(by_episode, ["feature", "dim"], "q01", "q99"), "q01", "q99")


_DIST = f"{_STATS}, round(quantile_cont(value, 0.01) + 1e-9, 6) AS q01, round(quantile_cont(value, 0.5) + 1e-9, 6) AS q50, round(quantile_cont(value, 0.99) + 1e-9, 6) AS q99"
_DIST_QS = {"q01": 0.01, "q50": 0.5, "q99": 0.99}


@query("distribution", f"SELECT feature, CAST(dim AS INTEGER) AS dim, {_DIST} FROM ({_long(FRAMES_SQL)}) GROUP BY ALL")
def distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moments and quantiles of every dimension over the whole copy."""
    return _rounded(statistics.described(vectors(spark, sf_dir), ["feature", "dim"], _DIST_QS), "mean", "std", *_DIST_QS)


def _gap_sql(where: str = "") -> str:
    one = "SELECT feature, dim, min(value) AS min, max(value) AS max, avg(value) AS mean, stddev_pop(value) AS std, quantile_cont(value, 0.01) AS q01, quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.99) AS q99 FROM ({}) {} GROUP BY ALL"
    worst = "greatest(" + ", ".join(f"abs(a.{s} - b.{s})" for s in (*MOMENTS, *_DIST_QS)) + ")"
    return f"""WITH a AS ({one.format(_long(FRAMES_SQL), where)}), b AS ({one.format(_long(DELIVERED_SQL), where)})
    SELECT coalesce(a.feature, b.feature) AS feature, round(max(CASE WHEN a.dim IS NULL OR b.dim IS NULL THEN 'inf'::DOUBLE ELSE {worst} / CASE WHEN b.max > b.min THEN b.max - b.min ELSE 1 END END) + 1e-9, 6) AS gap
    FROM a FULL JOIN b ON a.feature = b.feature AND a.dim = b.dim GROUP BY 1"""


def distribution_of(values: DataFrame) -> DataFrame:
    """Moments and outer quantiles by feature and dimension."""
    return statistics.described(values, ["feature", "dim"], _DIST_QS)


@query("distribution_gap", _gap_sql())
def distribution_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap of the two copies' distributions."""
    mine, theirs = (distribution_of(vectors(spark, sf_dir, t)) for t in ("frames", "frames_delivered"))
    return _rounded(statistics.distribution_gap(mine, theirs, "feature", [*MOMENTS, *_DIST_QS]), "gap")


_SHARED = f"WHERE episode_index IN (SELECT episode_index FROM {FRAMES_SQL} INTERSECT SELECT episode_index FROM {DELIVERED_SQL})"


@query("distribution_gap_shared", _gap_sql(_SHARED))
def distribution_gap_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same gap over the episodes that both copies have."""
    mine, theirs = vectors(spark, sf_dir), vectors(spark, sf_dir, "frames_delivered")
    shared = [table(spark, sf_dir, t).select("episode_index").dropDuplicates() for t in ("frames", "frames_delivered")]
    both = cut_lineage(shared[0].join(shared[1], "episode_index", "left_semi"))
    sides = (distribution_of(v.join(both, "episode_index", "left_semi")) for v in (mine, theirs))
    return _rounded(statistics.distribution_gap(*sides, "feature", [*MOMENTS, *_DIST_QS]), "gap")


@query("width_violations", f"SELECT episode_index, len(state_vec) AS width, count(*) AS n FROM {DELIVERED_SQL} WHERE len(state_vec) <> {WIDTH} GROUP BY ALL")
def width_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames whose state isn't as wide as declared, by episode and width."""
    rows = frames(spark, sf_dir, "state_vec", name="frames_delivered").filter(F.size("state_vec") != WIDTH)
    return rows.groupBy("episode_index", F.size("state_vec").cast("bigint").alias("width")).agg(F.count(F.lit(1)).alias("n"))


@query("image_stats", "SELECT camera, count(n_bytes) AS n, round(avg(n_bytes / 255.0::DOUBLE) + 1e-9, 6) AS mean, round(stddev_pop(n_bytes / 255.0::DOUBLE) + 1e-9, 6) AS std, round(min(n_bytes / 255.0::DOUBLE) + 1e-9, 6) AS min, round(max(n_bytes / 255.0::DOUBLE) + 1e-9, 6) AS max FROM (SELECT DISTINCT camera, shot_id, n_bytes FROM video_shots) GROUP BY 1")
def image_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moments over 255, as image features are scaled."""
    shots = table(spark, sf_dir, "video_shots").select("camera", "shot_id", (F.col("n_bytes") / 255.0).alias("value")).dropDuplicates()
    return _rounded(shots.groupBy("camera").agg(*statistics.moments()), "mean", "std", "min", "max")


@query("video_totals", "SELECT camera, count(*) AS files, CAST(sum(n_bytes) AS BIGINT) AS bytes, round(sum(n_bytes) / count(*) + 1e-9, 6) AS mean_bytes FROM (SELECT DISTINCT camera, shot_id, n_bytes FROM video_shots) GROUP BY 1")
def video_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files, bytes and mean size of each camera."""
    shots = table(spark, sf_dir, "video_shots").select("camera", "shot_id", "n_bytes").dropDuplicates()
    return shots.groupBy("camera").agg(F.count(F.lit(1)).alias("files"), F.sum("n_bytes").alias("bytes"), F.round(F.sum("n_bytes") / F.count(F.lit(1)) + 1e-9, 6).alias("mean_bytes"))


_RATES = f"""m AS (SELECT dataset, episode_index, frame_index, epoch_us(sampled_at) // 1000 AS ms, len(state_vec) AS width FROM {FRAMES_SQL}),
    d AS (SELECT *, ms - lag(ms) OVER (PARTITION BY episode_index ORDER BY frame_index) AS step FROM m WHERE ms IS NOT NULL),
    r AS (SELECT dataset, episode_index, 1000 / avg(CASE WHEN step > 0 THEN step END) AS fps FROM d GROUP BY ALL),
    e AS (SELECT dataset, episode_index, count(*) AS frames, CASE WHEN count(DISTINCT width) > 1 THEN -1 ELSE max(width) END AS width FROM m GROUP BY ALL)"""


def episode_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dataset, episode_index, frames, width, fps``: width -1 if it changes within the episode, fps null if unknown."""
    rows = frames(spark, sf_dir, "dataset", "sampled_at", "state_vec")
    ms = F.expr("unix_micros(cast(sampled_at as timestamp)) div 1000")
    width = F.size("state_vec")
    facts = rows.groupBy("dataset", "episode_index").agg(F.count(F.lit(1)).alias("frames"), F.when(F.min(F.when(width >= 0, width)) < F.max(width), -1).otherwise(F.max(F.when(width >= 0, width))).alias("width"))
    rates = clocks.clock_rate(rows.select("episode_index", "frame_index", ms.alias("ms")).filter("ms is not null"), "ms", "millis")
    return facts.join(rates.select("episode_index", "fps"), "episode_index", "left")


_PROFILE = """p AS (SELECT dataset, median(fps) AS fps FROM r WHERE fps IS NOT NULL AND round_even(fps, 0) >= 1 GROUP BY 1),
    c AS (SELECT dataset, width, count(*) AS n, min(episode_index) AS seen FROM e WHERE width IS NOT NULL GROUP BY ALL),
    w AS (SELECT dataset, width FROM c QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY n DESC, seen) = 1)"""


def profiles(facts: DataFrame) -> DataFrame:
    """``dataset, median_fps, width``: median of the usable rates and the most frequent width, first seen on ties."""
    usable = facts.filter("fps is not null and bround(fps, 0) >= 1")
    rates = statistics.exact_quantiles(usable, ["dataset"], "fps", {"median_fps": 0.5})
    widths = statistics.modal(facts, ["dataset"], "width", "episode_index").select("dataset", "width")
    return widths.join(rates, "dataset", "full_outer")


@query("task_profile", f"WITH {_RATES}, {_PROFILE} SELECT coalesce(w.dataset, p.dataset) AS dataset, round(fps + 1e-9, 6) AS median_fps, CAST(width AS INTEGER) AS width FROM w FULL JOIN p ON w.dataset = p.dataset")
def task_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median rate and modal width of each dataset."""
    return _rounded(profiles(cut_lineage(episode_facts(spark, sf_dir))), "median_fps").select("dataset", "median_fps", "width")


@query("task_max_frames", f"SELECT a.dataset, coalesce(max(f.n), 0) AS max_frames FROM (SELECT DISTINCT dataset FROM addresses) a LEFT JOIN (SELECT dataset, episode_index, count(*) AS n FROM {FRAMES_SQL} GROUP BY ALL) f ON f.dataset = a.dataset GROUP BY 1")
def task_max_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of the longest episode of each listed dataset, 0 without any."""
    lengths = frames(spark, sf_dir, "dataset").groupBy("dataset", "episode_index").agg(F.count(F.lit(1)).alias("n"))
    longest = lengths.groupBy("dataset").agg(F.max("n").alias("n"))
    listed = table(spark, sf_dir, "addresses").select("dataset").dropDuplicates()
    return listed.join(longest, "dataset", "left").select("dataset", F.coalesce("n", F.lit(0)).alias("max_frames"))


@query("min_length", f"SELECT episode_index, count(*) AS frames FROM {FRAMES_SQL} GROUP BY 1 HAVING count(*) >= 50")
def min_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes of at least 50 frames."""
    return frames(spark, sf_dir).groupBy("episode_index").agg(F.count(F.lit(1)).alias("frames")).filter("frames >= 50")


_REASON = """CASE WHEN width = -1 THEN 'malformed' WHEN width IS NULL THEN 'unreadable' WHEN frames < 50 THEN 'too_short' WHEN r.fps IS NULL OR round_even(r.fps, 0) < 1 OR p.fps IS NULL THEN 'rate_unusable'
      WHEN abs(r.fps - p.fps) / p.fps > 0.1 THEN 'rate_drift' WHEN width <> w.width THEN 'resolution_mismatch' ELSE 'written' END"""
_REASONS = f"""WITH {_RATES}, p AS (SELECT dataset, median(fps) AS fps FROM r WHERE fps IS NOT NULL AND round_even(fps, 0) >= 1 GROUP BY 1),
    c AS (SELECT dataset, width, count(*) AS n, min(episode_index) AS seen FROM e WHERE width IS NOT NULL GROUP BY ALL),
    w AS (SELECT dataset, width FROM c QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY n DESC, seen) = 1),
    x AS (SELECT e.dataset, e.episode_index, {_REASON.replace("width =", "e.width =").replace("width IS", "e.width IS").replace("width <>", "e.width <>")} AS reason
      FROM e LEFT JOIN r USING (episode_index) LEFT JOIN p ON p.dataset = e.dataset LEFT JOIN w ON w.dataset = e.dataset)"""


def skip_waterfall(facts: DataFrame, profile: DataFrame, min_frames: int = 50, drift: float = 0.1) -> DataFrame:
    """``dataset, episode_index, reason``: the first reason that keeps an episode out, or ``written``."""
    p = profile.select(F.col("dataset").alias("p_dataset"), "median_fps", F.col("width").alias("p_width"))
    rows = facts.join(p, facts["dataset"].eqNullSafe(F.col("p_dataset")), "left")
    fps, median = F.col("fps"), F.col("median_fps")
    reason = (
        F.when(F.col("width") == -1, "malformed").when(F.col("width").isNull(), "unreadable").when(F.col("frames") < min_frames, "too_short")
        .when(fps.isNull() | (F.bround(fps, 0) < 1) | median.isNull(), "rate_unusable").when(F.abs(fps - median) / median > drift, "rate_drift")
        .when(F.col("width") != F.col("p_width"), "resolution_mismatch").otherwise("written")
    )
    return rows.select("dataset", "episode_index", reason.alias("reason"))


def _reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = cut_lineage(episode_facts(spark, sf_dir))
    return skip_waterfall(facts, profiles(facts))


@query("skip_reasons", f"{_REASONS} SELECT * FROM x")
def skip_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why each episode is kept out, first match wins."""
    return _reasons(spark, sf_dir)


@query("rate_drift", f"WITH {_RATES}, {_PROFILE} SELECT r.episode_index, round(abs(r.fps - p.fps) / p.fps + 1e-9, 6) AS drift FROM r JOIN p USING (dataset) WHERE abs(r.fps - p.fps) / p.fps > 0.1")
def rate_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes whose rate drifts from their dataset's median by more than a tenth."""
    facts = cut_lineage(episode_facts(spark, sf_dir))
    rows = facts.join(profiles(facts).select("dataset", "median_fps"), "dataset")
    drift = F.abs(F.col("fps") - F.col("median_fps")) / F.col("median_fps")
    return rows.filter(drift > 0.1).select("episode_index", F.round(drift + 1e-9, 6).alias("drift"))


@query("summary_rollup", f"{_REASONS} SELECT dataset, reason, count(*) AS n, grouping(dataset) + grouping(reason) AS level FROM x GROUP BY ROLLUP (dataset, reason)")
def summary_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tally by dataset and reason with subtotals."""
    out = _reasons(spark, sf_dir).rollup("dataset", "reason").agg(F.count(F.lit(1)).alias("n"), (F.grouping("dataset").cast("bigint") + F.grouping("reason").cast("bigint")).alias("level"))
    return out.select("dataset", "reason", "n", "level")


@query("summary_flags", f"{_REASONS} SELECT dataset, count(CASE WHEN reason = 'written' THEN 1 END) AS written, count(CASE WHEN reason <> 'written' THEN 1 END) AS skipped, count(CASE WHEN reason <> 'written' THEN 1 END) > count(CASE WHEN reason = 'written' THEN 1 END) AS mostly_skipped FROM x GROUP BY 1")
def summary_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written and skipped episodes, and datasets that lost most."""
    skipped, written = F.count_if(F.col("reason") != "written"), F.count_if(F.col("reason") == "written")
    return _reasons(spark, sf_dir).groupBy("dataset").agg(written.alias("written"), skipped.alias("skipped"), (skipped > written).alias("mostly_skipped"))


@query("dataset_totals", f"SELECT dataset, count(DISTINCT episode_index) AS total_episodes, count(*) AS total_frames, count(DISTINCT prompt) AS total_tasks, count(DISTINCT episode_index) * 2 AS total_videos, CAST(ceil(count(DISTINCT episode_index) / 1000.0::DOUBLE) AS BIGINT) AS total_chunks FROM {FRAMES_SQL} GROUP BY 1")
def dataset_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes, frames, tasks, videos and chunks of each dataset; pre-aggregated so that one dataset may be large."""
    rows = frames(spark, sf_dir, "dataset", "prompt")
    counts = rows.groupBy("dataset", "episode_index").agg(F.count(F.lit(1)).alias("n")).groupBy("dataset").agg(F.count(F.lit(1)).alias("total_episodes"), F.sum("n").alias("total_frames"))
    tasks = rows.filter("prompt is not null").select("dataset", "prompt").dropDuplicates().groupBy("dataset").agg(F.count(F.lit(1)).alias("total_tasks"))
    both = counts.join(tasks, counts["dataset"].eqNullSafe(tasks["dataset"]), "left")
    return both.select(counts["dataset"], "total_episodes", "total_frames", F.coalesce("total_tasks", F.lit(0)).alias("total_tasks"), (F.col("total_episodes") * 2).alias("total_videos"), F.ceil(F.col("total_episodes") / 1000.0).alias("total_chunks"))


@query("contiguity", f"SELECT episode_index, min(frame_index) = 0 AND max(frame_index) = count(DISTINCT frame_index) - 1 AS contiguous FROM {FRAMES_SQL} GROUP BY 1")
def contiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether an episode's frame indices are 0 to n - 1 without a gap."""
    return frames(spark, sf_dir).groupBy("episode_index").agg(((F.min("frame_index") == 0) & (F.max("frame_index") == F.count(F.lit(1)) - 1)).alias("contiguous"))


@query("ordered_tasks", f"SELECT episode_index, list(prompt ORDER BY pos) AS tasks FROM (SELECT episode_index, prompt, min(frame_index) AS pos FROM {FRAMES_SQL} WHERE prompt IS NOT NULL GROUP BY ALL) GROUP BY 1")
def ordered_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct tasks of each episode in the order they first appear."""
    first = frames(spark, sf_dir, "prompt").filter("prompt is not null").groupBy("episode_index", "prompt").agg(F.min("frame_index").alias("at"))
    return first.groupBy("episode_index").agg(F.array_sort(F.collect_list(F.struct("at", "prompt"))).alias("s")).select("episode_index", F.col("s.prompt").alias("tasks"))


@query("stats_close", f"""WITH a AS (SELECT episode_index, avg(gripper) AS m FROM {FRAMES_SQL} WHERE NOT isnan(gripper) GROUP BY 1), b AS (SELECT episode_index, avg(gripper) AS m FROM {DELIVERED_SQL} WHERE NOT isnan(gripper) GROUP BY 1)
    SELECT episode_index, abs(a.m - b.m) <= 0.01 + 0.01 * abs(b.m) AS close FROM a JOIN b USING (episode_index)""")
def stats_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the two copies' mean grippers agree within a relative and an absolute tolerance."""
    sides = [frames(spark, sf_dir, "gripper", name=t).filter(~F.isnan("gripper")).groupBy("episode_index").agg(F.avg("gripper").alias(s)) for t, s in (("frames", "a"), ("frames_delivered", "b"))]
    return sides[0].join(sides[1], "episode_index").select("episode_index", statistics.close_enough(F.col("a"), F.col("b"), 0.01, 0.01).alias("close"))


@query("frame_agreement", f"""WITH p AS (SELECT a.episode_index, a.frame_index, a.state_vec AS x, b.state_vec AS y FROM {FRAMES_SQL} a JOIN {DELIVERED_SQL} b USING (episode_index, frame_index) WHERE a.state_vec IS NOT NULL AND b.state_vec IS NOT NULL
      AND NOT list_contains(list_transform(a.state_vec, lambda v: v IS NULL OR isnan(v)), TRUE) AND NOT list_contains(list_transform(b.state_vec, lambda v: v IS NULL OR isnan(v)), TRUE)),
    c AS (SELECT episode_index, frame_index, len(x) = len(y) AS same, unnest(x)::DOUBLE AS x, unnest(y)::DOUBLE AS y FROM p),
    s AS (SELECT episode_index, frame_index, bool_and(same) AS same, stddev_pop(x) AS sx, stddev_pop(y) AS sy, max(abs(x - y)) AS far, corr(x, y) AS r FROM c GROUP BY ALL)
    SELECT episode_index, round(min(CASE WHEN NOT same THEN 0 WHEN sx = 0 AND sy = 0 THEN CAST(far <= 2 AS INTEGER) WHEN sx = 0 OR sy = 0 THEN 0 ELSE r END) + 1e-9, 6) AS agreement FROM s GROUP BY 1""")
def frame_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weakest frame correlation of each episode between the copies, over states without null and NaN."""
    clean = ~F.exists("state_vec", lambda x: x.isNull() | F.isnan(x))
    a, b = (frames(spark, sf_dir, "state_vec", name=t).filter(clean) for t in ("frames", "frames_delivered"))
    return _rounded(statistics.frame_agreement(a, b, ["episode_index"], "frame_index", "state_vec"), "agreement")


@query("keyframe_gap", f"""WITH k AS (SELECT episode_index, frame_index, row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) AS n FROM {FRAMES_SQL} WHERE gripper > 0.9 AND NOT isnan(gripper)), e AS (SELECT DISTINCT episode_index FROM {FRAMES_SQL})
    SELECT e.episode_index, b.frame_index - a.frame_index AS gap FROM e LEFT JOIN k a ON a.episode_index = e.episode_index AND a.n = 1 LEFT JOIN k b ON b.episode_index = e.episode_index AND b.n = 2""")
def keyframe_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance of the first two frames with a closed gripper."""
    return statistics.keyframe_gap(frames(spark, sf_dir, "gripper"), ["episode_index"], "frame_index", (F.col("gripper") > 0.9) & ~F.isnan("gripper"))
