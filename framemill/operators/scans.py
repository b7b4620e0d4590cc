"""Per-episode ordered scans: gripper states, relabelled actions, no-op removal, step flags, indices.

All take frames with BIGINT ``episode_index`` and ``frame_index`` (unique together) and keep every row they don't
explicitly drop: a null episode is an episode like any other, and a null frame_index comes before all others. ``block`` is the size of ``operators.blocks``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framemill.operators.blocks import BLOCK, KEYS, Blocked, boxed


def relative_to_absolute(df: DataFrame, action: str, out: str = "gripper_abs", block: int = BLOCK) -> DataFrame:
    """Relative gripper actions (+ closes, - opens) to absolute states (1 open, 0 closed).

    Beyond 0.1 either way an action switches; between, the state stays. Before the first switch it is the opposite of
    what that switches to; without any, open. Null and NaN switch nothing.
    """
    a = F.col(action).cast("double")
    switch = F.when(a < -0.1, F.lit(1)).when((a > 0.1) & ~F.isnan(a), F.lit(-1))
    b = Blocked(df.withColumn("__switch", switch), size=block)
    b.last_before("__carried", F.col("__switch"))
    b.first_overall("__first", F.col("__switch"))
    state = F.coalesce(F.last("__switch", ignorenulls=True).over(b.until), F.col("__carried"), -F.col("__first"), F.lit(1))
    return b.rows().withColumn(out, state / F.lit(2.0) + F.lit(0.5)).drop("__switch", "__carried", "__first", *KEYS)


def binarize(df: DataFrame, action: str, out: str = "gripper_bin", block: int = BLOCK) -> DataFrame:
    """Continuous gripper values to 1 (above 0.95) or 0 (below 0.05); one between takes the next decided value, or the
    episode's last value if none is decided any more. Null and NaN are between."""
    p = F.col(action).cast("double")
    decided = F.when((p > 0.95) & ~F.isnan(p), F.lit(1.0)).when(p < 0.05, F.lit(0.0))
    b = Blocked(df.withColumn("__decided", decided), size=block)
    b.first_after("__next", F.col("__decided"))
    b.last_overall("__last", boxed(p))
    value = F.coalesce(F.first("__decided", ignorenulls=True).over(b.onward), F.col("__next"), F.col("__last.v"))
    return b.rows().withColumn(out, value).drop("__decided", "__next", "__last", *KEYS)


def relabel_actions(df: DataFrame, state: str, gripper: str, out: str = "action", width: int = 6, block: int = BLOCK) -> DataFrame:
    """Actions as the state reached next minus the state now (first ``width`` elements), with the row's own gripper
    appended; the last row of an episode, which reaches nothing, is dropped."""
    now = F.slice(state, 1, width)
    b = Blocked(df, size=block)
    b.first_after("__next_block", boxed(now))
    rows = b.rows().withColumn("__next", F.coalesce(F.lead(boxed(now)).over(b.inner), F.col("__next_block")))
    moved = F.zip_with(F.col("__next.v"), now, lambda x, y: x - y)
    return rows.filter(F.col("__next").isNotNull()).withColumn(out, F.concat(moved, F.array(F.col(gripper).cast("float")))).drop("__next", "__next_block", *KEYS)


def drop_noops(df: DataFrame, still: Column, gripper: str, block: int = BLOCK) -> DataFrame:
    """Drop frames that do nothing: ``still`` holds and the gripper equals the one of the last kept frame.

    Before the first kept frame ``still`` alone decides. Between two kept frames all dropped ones have the kept
    gripper, so comparing with the row before is the same as carrying the kept value along.
    """
    b = Blocked(df.withColumn("__still", F.coalesce(still, F.lit(False))), size=block)
    b.last_before("__lag", boxed(F.col(gripper)))
    b.sum_before("__moves", F.when(F.col("__still"), 0).otherwise(1))
    moved = F.coalesce(F.sum(F.when(F.col("__still"), 0).otherwise(1)).over(b.before), F.lit(0)) + F.col("__moves")
    rows = b.rows().withColumn("__seen", moved > 0).withColumn("__before", b.lag("__lag", F.col(gripper)))
    noop = F.col("__still") & (~F.col("__seen") | F.col(gripper).eqNullSafe(F.col("__before")))
    return rows.filter(~noop).drop("__still", "__lag", "__moves", "__seen", "__before", *KEYS)


def _ends(df: DataFrame, block: int) -> DataFrame:
    """``df`` with ``__first`` and ``__last``, the smallest and largest frame_index of its episode."""
    b = Blocked(df, size=block)
    b.total("__first", F.min("frame_index"), F.min("s___first"))
    b.total("__last", F.max("frame_index"), F.max("s___last"))
    return b.rows().drop(*KEYS)


def drop_first(df: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every episode without its first frame. Frames without a frame_index are neither first nor last, and stay."""
    return _ends(df, block).filter("frame_index is null or frame_index > __first").drop("__first", "__last")


def drop_last(df: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every episode without its last frame; see ``drop_first``."""
    return _ends(df, block).filter("frame_index is null or frame_index < __last").drop("__first", "__last")


def step_flags(df: DataFrame, block: int = BLOCK) -> DataFrame:
    """``is_first``, ``is_last`` and ``is_terminal`` (an episode ends with success) of every frame; false without a frame_index."""
    is_ = lambda end: F.coalesce(F.col("frame_index") == F.col(end), F.lit(False))
    return _ends(df, block).withColumn("is_first", is_("__first")).withColumn("is_last", is_("__last")).withColumn("is_terminal", F.col("is_last")).drop("__first", "__last")


def positions(df: DataFrame, block: int = BLOCK) -> DataFrame:
    """``position``: the 0-based place of each frame among the frames there are of its episode."""
    b = Blocked(df, size=block)
    b.sum_before("__rows", F.lit(1))
    return b.rows().withColumn("position", F.row_number().over(b.inner) - 1 + F.col("__rows")).drop("__rows", *KEYS)


def timestamps(df: DataFrame, fps: float) -> DataFrame:
    """``timestamp``: position over frames per second."""
    return positions(df).withColumn("timestamp", F.col("position") / F.lit(float(fps)))


def episode_ranges(lengths: DataFrame) -> DataFrame:
    """``dataset_from_index, dataset_to_index`` of every episode: running totals of ``length`` by episode_index.

    A null episode comes first. The table has one row an episode, by far fewer than frames; totals of blocks of episodes
    come first, so that no task takes all of them.
    """
    b = Blocked(lengths.withColumn("__all", F.lit(0).cast("bigint")), episode="__all", order="episode_index")
    b.sum_before("__from", F.col("length"))
    to = F.col("__from") + F.sum("length").over(b.until)
    rows = b.rows().withColumn("dataset_to_index", to).withColumn("dataset_from_index", F.col("dataset_to_index") - F.col("length"))
    return rows.drop(*KEYS, "__from", "__all")


def global_index(df: DataFrame) -> DataFrame:
    """``index``: the running number of each frame over all episodes."""
    ranges = episode_ranges(df.groupBy("episode_index").agg(F.count(F.lit(1)).alias("length"))).select("episode_index", "dataset_from_index")
    ranges = ranges.withColumnRenamed("episode_index", "__of")
    return positions(df).join(ranges, F.col("episode_index").eqNullSafe(F.col("__of"))).drop("__of").withColumn("index", F.col("dataset_from_index") + F.col("position")).drop("dataset_from_index")
