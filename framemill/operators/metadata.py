"""Episode metadata of packed storage: where episodes lie, how tables are put side by side and re-indexed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framemill.operators.places import places


def offsets_in_destination(df: DataFrame, destination: list[str], order: list[str], duration: str) -> DataFrame:
    """``from_timestamp, to_timestamp``: where each piece lies in the file it was packed into."""
    until = F.sum(duration).over(Window.partitionBy(*destination).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn("to_timestamp", until).withColumn("from_timestamp", F.col("to_timestamp") - F.col(duration))


def remap(df: DataFrame, mapping: DataFrame, key: list[str], default: dict[str, int], offset: tuple[str, str] | None = None) -> DataFrame:
    """Rows with ``key`` replaced by where their file went (``to_<key>`` of ``mapping``), or by ``default`` if it isn't
    listed; ``offset`` (column, column of mapping) is added to, by 0 if the file isn't listed."""
    joined = df.join(mapping, key, "left")
    moved = {k: F.coalesce(F.col(f"to_{k}"), F.lit(default[k]).cast("bigint")) for k in key}
    if offset:
        moved[offset[0]] = F.col(offset[0]) + F.coalesce(F.col(offset[1]), F.lit(0))
    return joined.withColumns(moved).select(*df.columns)


def side_by_side(parts: dict[str, DataFrame], key: str) -> tuple[DataFrame, DataFrame]:
    """(rows that all parts have, keys that some part lacks with ``lacking``). Parts have ``key`` unique."""
    marked = [df.withColumn(f"__{name}", F.lit(True)) for name, df in parts.items()]
    joined = reduce(lambda a, b: a.join(b, key, "full_outer"), marked)
    lacking = F.array_compact(F.array(*[F.when(F.col(f"__{n}").isNull(), F.lit(n)) for n in parts]))
    rows = joined.withColumn("lacking", lacking).drop(*[f"__{n}" for n in parts])
    return rows.filter(F.size("lacking") == 0).drop("lacking"), rows.filter(F.size("lacking") > 0).select(key, "lacking")


def reindexed(sources: DataFrame, source: str) -> DataFrame:
    """``episode_offset, frame_offset`` of each source: totals of the sources before it."""
    before = Window.orderBy(source).rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    return sources.withColumn("episode_offset", earlier("episodes")).withColumn("frame_offset", earlier("frames"))


def split_ranges(frames: DataFrame, ranges: DataFrame, index: str = "index") -> DataFrame:
    """Rows of a packed table with the episode whose ``[dataset_from_index, dataset_to_index)`` they fall into.

    Ranges are cut at multiples of a step and rows hashed on theirs, so that this is an equi-join, not a comparison of all with all.
    """
    step = 1 << 12
    cut = ranges.filter("dataset_to_index > dataset_from_index").withColumn("__s", F.explode(F.sequence(F.expr(f"dataset_from_index div {step}"), F.expr(f"(dataset_to_index - 1) div {step}"))))
    rows = frames.withColumn("__s", F.expr(f"`{index}` div {step}"))
    inside = (F.col(index) >= F.col("dataset_from_index")) & (F.col(index) < F.col("dataset_to_index"))
    return rows.join(cut.select("episode_index", "dataset_from_index", "dataset_to_index", "__s"), "__s").filter(inside).drop("__s", "dataset_from_index", "dataset_to_index")


def task_dictionary(df: DataFrame, task: str, order: list[str]) -> DataFrame:
    """``<task>, task_index``: tasks numbered as they first appear."""
    first = df.filter(F.col(task).isNotNull()).groupBy(task).agg(F.min(F.struct(*order)).alias("__f"))
    return places(first, [], ["__f", task], "task_index").select(task, "task_index")


def chunk_of(index: Column, size: int) -> Column:
    """The chunk folder of an episode."""
    return F.floor(index / F.lit(size))


def scattered(base: DataFrame, sparse: DataFrame, key: list[str], state: str, action: str) -> DataFrame:
    """The action of each row: the sparse one where there is one, else the row's state."""
    return base.join(sparse.select(*key, action), key, "left").withColumn(action, F.coalesce(action, state))
