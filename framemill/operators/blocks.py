"""Ordered scans that don't put a whole episode into one task.

Rows of an episode are cut into blocks of its integer order. Within a block ordinary windows run; what a row needs from
outside its block comes from a summary row for each block, of which there are few. Summaries are combined before they are
shuffled; the rows themselves are shuffled once, on (episode, block), for the join that brings the two together and for
the windows. The keys of that join are never null, so no filter on them comes between an input and its two uses, and
Spark shuffles an input that is itself an aggregate once for both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Positions of one block.
BLOCK = 1 << 16
EPISODE, ORDER = "episode_index", "frame_index"
#: Columns that a blocked DataFrame has besides its own: the episode with 0 for null, whether it is null, the block.
KEYS = ("__episode", "__unknown", "__block")


class Blocked:
    """``df`` with a block number, and carries from the other blocks of the same episode.

    ``order`` is a BIGINT column; rows with equal order within an episode need ``ties`` to be put in order. ``episode`` is a
    BIGINT or a struct that isn't null. A null episode is an episode like any other; a null order comes first.
    """

    def __init__(self, df: DataFrame, *, episode: str = EPISODE, order: str = ORDER, ties: tuple[str, ...] = (), size: int = BLOCK):
        self.episode, self.order, self.by = episode, order, [order, *ties]
        column = F.col(f"`{episode}`")
        key = column if dict(df.dtypes)[episode].startswith("struct") else F.coalesce(column, F.lit(0))
        block = F.coalesce(F.expr(f"`{order}` div {size}"), F.lit(-(1 << 62)))
        self.df = df.withColumns(dict(zip(KEYS, (key, column.isNull(), block), strict=True)))
        self.summaries: dict[str, Column] = {}
        self.carries: dict[str, Column] = {}
        self.inner = Window.partitionBy(*KEYS).orderBy(*self.by)
        self.outer = Window.partitionBy(*KEYS[:2]).orderBy(KEYS[2])

    def _key(self) -> Column:
        return F.struct(*self.by)

    def last_before(self, name: str, value: Column) -> None:
        """Carry ``name``: the last non-null ``value`` of earlier blocks."""
        self.summaries[f"s_{name}"] = F.max_by(F.when(value.isNotNull(), value), F.when(value.isNotNull(), self._key()))
        self.carries[name] = F.last(f"s_{name}", ignorenulls=True).over(self.outer.rowsBetween(Window.unboundedPreceding, -1))

    def first_after(self, name: str, value: Column) -> None:
        """Carry ``name``: the first non-null ``value`` of later blocks."""
        self.summaries[f"s_{name}"] = F.min_by(F.when(value.isNotNull(), value), F.when(value.isNotNull(), self._key()))
        self.carries[name] = F.first(f"s_{name}", ignorenulls=True).over(self.outer.rowsBetween(1, Window.unboundedFollowing))

    def first_overall(self, name: str, value: Column) -> None:
        """Carry ``name``: the first non-null ``value`` of the episode."""
        self.summaries[f"s_{name}"] = F.min_by(F.when(value.isNotNull(), value), F.when(value.isNotNull(), self._key()))
        self.carries[name] = F.first(f"s_{name}", ignorenulls=True).over(self.outer.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))

    def last_overall(self, name: str, value: Column) -> None:
        """Carry ``name``: the last non-null ``value`` of the episode."""
        self.summaries[f"s_{name}"] = F.max_by(F.when(value.isNotNull(), value), F.when(value.isNotNull(), self._key()))
        self.carries[name] = F.last(f"s_{name}", ignorenulls=True).over(self.outer.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))

    def sum_before(self, name: str, value: Column) -> None:
        """Carry ``name``: the sum of ``value`` over earlier blocks, 0 without any."""
        self.summaries[f"s_{name}"] = F.sum(value)
        self.carries[name] = F.coalesce(F.sum(f"s_{name}").over(self.outer.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    def total(self, name: str, aggregate: Column, over: Column) -> None:
        """Carry ``name``: ``over`` (an aggregate of column ``s_<name>``) of the blocks' ``aggregate``."""
        self.summaries[f"s_{name}"] = aggregate
        self.carries[name] = over.over(Window.partitionBy(*KEYS[:2]))

    def rows(self) -> DataFrame:
        """The rows with all carries; windows over ``inner`` need no further exchange."""
        if not self.carries:
            return self.df
        blocks = self.df.groupBy(*KEYS).agg(*[c.alias(n) for n, c in self.summaries.items()])
        blocks = blocks.select(*KEYS, *[c.alias(n) for n, c in self.carries.items()])
        return self.df.join(blocks, list(KEYS)).select(*self.df.columns, *self.carries)

    def lag(self, carry: str, value: Column) -> Column:
        """The value of the row before, given a ``last_before`` carry of ``struct(value)``."""
        return F.coalesce(F.lag(F.struct(value.alias("v"))).over(self.inner), F.col(carry))["v"]

    def lead(self, carry: str, value: Column) -> Column:
        """The value of the row after, given a ``first_after`` carry of ``struct(value)``."""
        return F.coalesce(F.lead(F.struct(value.alias("v"))).over(self.inner), F.col(carry))["v"]

    @property
    def before(self) -> Window:
        return self.inner.rowsBetween(Window.unboundedPreceding, -1)

    @property
    def until(self) -> Window:
        return self.inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    @property
    def onward(self) -> Window:
        return self.inner.rowsBetween(Window.currentRow, Window.unboundedFollowing)


def boxed(value: Column) -> Column:
    """A never-null carrier for ``lag`` and ``lead`` carries."""
    return F.struct(value.alias("v"))
