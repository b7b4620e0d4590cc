"""Alignment of two clocks of one episode: by position, or by nearest time with each sample claimed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framemill.operators.blocks import BLOCK, KEYS, Blocked, boxed
from framemill.operators.places import places
from framemill.session import cut_lineage

#: Microseconds of one block of a time-ordered scan (about a minute).
TIME_BLOCK = 1 << 26


def advancing(samples: DataFrame, time: str, block: int = BLOCK) -> DataFrame:
    """The samples after which the clock goes on: the next frame of the episode has a later time. The last never has one."""
    b = Blocked(samples, size=block)
    b.first_after("__next_block", boxed(F.col(time)))
    rows = b.rows().withColumn("__next", F.coalesce(F.lead(boxed(F.col(time))).over(b.inner), F.col("__next_block")))
    return rows.filter(F.col("__next.v") > F.col(time)).drop("__next", "__next_block", *KEYS)


def by_position(left: DataFrame, right: DataFrame, key: list[str], left_order: list[str], right_order: list[str]) -> DataFrame:
    """Rows of both sides at the same place within ``key``, as far as the shorter side goes."""
    sides = [places(d, key, o, "position").drop("position_of") for d, o in ((left, left_order), (right, right_order))]
    return sides[0].join(sides[1], [*key, "position"])


def nearest_claimed(samples: DataFrame, references: DataFrame, time_block: int = TIME_BLOCK, block: int = BLOCK) -> DataFrame:
    """``episode_index, stream, reference_id, sample``: the sample that each reference claims.

    ``samples``     ``episode_index, t BIGINT`` of usable samples; ``sample`` is a 0-based place among them by time.
    ``references``  ``episode_index, stream, reference_id, t``; each stream claims for itself, in the order of (t, id).

    A reference wants the nearest sample, of two equally near ones the later; if an earlier reference has it, the next
    one; if that is taken too or isn't there, the reference is dropped. As the wanted places never decrease along a
    stream, the claims follow from runs of equal wishes: the first of a run gets its wish unless the run before it
    overflowed onto it, the second the place after, and everyone else nothing. Rows with a null time are left out.
    """
    kind = lambda df, k, *extra: df.filter("t is not null and episode_index is not null").select("episode_index", "t", F.lit(k).alias("kind"), *extra)
    none = lambda c: F.lit(None).cast(dict(references.dtypes)[c]).alias(c)
    union = kind(references, 0, "stream", "reference_id").unionByName(kind(samples, 1, none("stream"), none("reference_id")))
    b = Blocked(union, order="t", ties=("kind",), size=time_block)
    is_sample = F.col("kind") == 1
    b.sum_before("__n_before", F.when(is_sample, 1).otherwise(0))
    b.last_before("__prev_block", F.when(is_sample, F.col("t")))
    b.first_after("__next_block", F.when(is_sample, F.col("t")))
    b.total("__n", F.sum(F.when(is_sample, 1).otherwise(0)), F.sum("s___n"))
    seen = F.coalesce(F.sum(F.when(is_sample, 1).otherwise(0)).over(b.before), F.lit(0)) + F.col("__n_before")
    before = F.coalesce(F.last(F.when(is_sample, F.col("t")), ignorenulls=True).over(b.before), F.col("__prev_block"))
    after = F.coalesce(F.first(F.when(is_sample, F.col("t")), ignorenulls=True).over(b.onward), F.col("__next_block"))
    rows = b.rows().withColumns({"__seen": seen, "__prev": before, "__next": after}).filter("kind = 0 and __n > 0")
    back = F.col("__prev").isNotNull() & (F.col("__next").isNull() | (F.col("t") - F.col("__prev") < F.col("__next") - F.col("t")))
    wishes = rows.select("episode_index", "stream", "reference_id", "t", F.when(back, F.col("__seen") - 1).otherwise(F.col("__seen")).alias("wish"), F.col("__n").alias("n"))
    wishes = cut_lineage(wishes)  # read once for the runs and once for the claims

    runs = wishes.groupBy("episode_index", "stream", "wish").agg(F.count(F.lit(1)).alias("size")).withColumn("stream_key", F.struct("episode_index", "stream"))
    r = Blocked(runs, episode="stream_key", order="wish", size=block)
    r.last_before("__run_before", F.col("wish"))
    marked = r.rows().withColumn("__starts", ~(F.col("wish") - 1).eqNullSafe(F.coalesce(F.lag("wish").over(r.inner), F.col("__run_before")))).drop(*KEYS, "__run_before")
    r = Blocked(marked, episode="stream_key", order="wish", size=block)
    r.last_before("__start_before", F.when(F.col("__starts"), F.col("wish")))
    r.last_before("__big_before", F.when(F.col("size") > 1, F.col("wish")))
    # Overflow onto a run comes from within its island of consecutive wishes, from the first run of two or more on.
    start = F.coalesce(F.last(F.when(F.col("__starts"), F.col("wish")), ignorenulls=True).over(r.until), F.col("__start_before"))
    big = F.coalesce(F.last(F.when(F.col("size") > 1, F.col("wish")), ignorenulls=True).over(r.before), F.col("__big_before"))
    runs = r.rows().select("episode_index", "stream", "wish", F.coalesce(big >= start, F.lit(False)).alias("taken"))

    place = F.row_number().over(Window.partitionBy("episode_index", "stream", "wish").orderBy("t", "reference_id"))
    joined = wishes.withColumn("place", place).join(runs, ["episode_index", "stream", "wish"])
    sample = F.when(F.col("place") == 1, F.col("wish") + F.col("taken").cast("int")).when((F.col("place") == 2) & ~F.col("taken"), F.col("wish") + 1)
    return joined.withColumn("sample", sample).filter("sample < n").select("episode_index", "stream", "reference_id", "sample")


def before_last(references: DataFrame, samples: DataFrame, time: str, sample_time: str) -> DataFrame:
    """References recorded strictly before the episode's last sample."""
    last = samples.groupBy("episode_index").agg(F.max(sample_time).alias("__last"))
    return references.join(last, "episode_index").filter(F.col(time) < F.col("__last")).drop("__last")


def clock_rate(rows: DataFrame, time: str, layout: str, block: int = BLOCK) -> DataFrame:
    """``episode_index, n, fps, span`` of each episode.

    ``seconds``: whole-second stamps, so frames over the span between the first and last; ``millis``: 1000 over the mean
    of the positive steps, span null. fps is null where time doesn't advance.
    """
    if layout == "seconds":
        ends = rows.groupBy("episode_index").agg(F.count(F.lit(1)).alias("n"), (F.max_by(time, "frame_index") - F.min_by(time, "frame_index")).alias("span"))
        return ends.select("episode_index", "n", F.when(F.col("span") > 0, F.col("n") / F.col("span")).alias("fps"), F.when(F.col("span") > 0, F.col("span")).alias("span"))
    b = Blocked(rows, size=block)
    b.last_before("__lag", boxed(F.col(time)))
    step = (F.col(time) - F.col("__before")).alias("step")
    steps = b.rows().withColumn("__before", b.lag("__lag", F.col(time))).select("episode_index", step)
    positive: Column = F.avg(F.when(F.col("step") > 0, F.col("step").cast("double")))
    return steps.groupBy("episode_index").agg(F.count(F.lit(1)).alias("n"), (F.lit(1000.0) / positive).alias("fps")).withColumn("span", F.lit(None).cast("bigint"))


#: Alignment strategies by name.
STRATEGIES = {"index": by_position, "nearest_timestamp_dedup": nearest_claimed}


def align(strategy: str, *args: object, **kwargs: object) -> DataFrame:
    """Align by a strategy of the closed set."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown clock strategy {strategy}; known are {', '.join(sorted(STRATEGIES))}")
    return STRATEGIES[strategy](*args, **kwargs)
