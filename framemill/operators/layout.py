"""Declared column layouts: slots from blocks, checks of a declaration, assembly of vectors, and verification against their sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framemill.operators.blocks import Blocked, boxed

#: Width of one block of edges (microseconds, about a minute).
EDGE_BLOCK = 1 << 26

def block_slots(order: DataFrame, blocks: DataFrame, key: list[str]) -> DataFrame:
    """``<key>, pos, block, width, slot_from, slot_to``: the slots of each block, in the order the layout gives.

    ``order`` has ``<key>, pos, block``; ``blocks`` has ``<key>, block, width``. Blocks are looked up in the layout; use
    ``layout_problems`` first, as unmatched ones are left out here.
    """
    rows = order.join(blocks, [*key, "block"])
    until = F.sum("width").over(Window.partitionBy(*key).orderBy("pos"))
    return rows.select(*key, "pos", "block", "width", (until - F.col("width")).alias("slot_from"), until.alias("slot_to"))


def layout_problems(order: DataFrame, blocks: DataFrame, key: list[str]) -> DataFrame:
    """``<key>, block, problem``: blocks that only the layout or only the dataset names."""
    both = order.select(*key, "block", F.lit(1).alias("o")).join(blocks.select(*key, "block", F.lit(1).alias("b")), [*key, "block"], "full_outer")
    problem = F.when(F.col("b").isNull(), "missing").when(F.col("o").isNull(), "extra")
    return both.select(*key, "block", problem.alias("problem")).filter("problem is not null")


def tiling_problems(pieces: DataFrame, key: list[str]) -> DataFrame:
    """``<key>, slot, n``: slots of 0 .. ``width`` - 1 that the half-open pieces ``[slot_from, slot_to)`` don't cover exactly once, and slots outside."""
    covered = pieces.filter("slot_to > slot_from").select(*key, F.explode(F.sequence(F.col("slot_from"), F.col("slot_to") - 1)).alias("slot")).groupBy(*key, "slot").agg(F.count(F.lit(1)).alias("n"))
    wanted = pieces.groupBy(*key).agg(F.max("width").alias("w")).filter("w > 0").select(*key, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("w") - 1)).alias("slot"), F.lit(True).alias("inside"))
    both = wanted.join(covered, [*key, "slot"], "full_outer")
    return both.filter(F.col("n").isNull() | (F.col("n") > 1) | F.col("inside").isNull()).select(*key, "slot", F.coalesce("n", F.lit(0)).alias("n"))


def ranges_text(df: DataFrame, key: list[str], number: str) -> DataFrame:
    """``<key>, ranges``: the distinct numbers of each key as text such as ``0-3, 7``. Keys hold the runs, not the numbers."""
    rows = df.select(*key, number).dropDuplicates()
    # A run starts at a number whose predecessor isn't there and ends at one whose successor isn't; both are found by joins on
    # (key, number), so that a key with many numbers is no burden. Starts and ends then pair up in order.
    shifted = lambda by: rows.select(*key, (F.col(number) + by).alias(number))
    starts = rows.join(shifted(1), [*key, number], "left_anti").select(*key, F.col(number).alias("a"))
    ends = rows.join(shifted(-1), [*key, number], "left_anti").select(*key, F.col(number).alias("b"))
    nth = lambda c: F.row_number().over(Window.partitionBy(*key).orderBy(c)).alias("nth")
    runs = starts.select("*", nth("a")).join(ends.select("*", nth("b")), [*key, "nth"])
    text = F.transform(F.array_sort(F.collect_list(F.struct("a", "b"))), lambda r: F.when(r["a"] == r["b"], r["a"].cast("string")).otherwise(F.concat_ws("-", r["a"].cast("string"), r["b"].cast("string"))))
    return runs.groupBy(*key).agg(F.array_join(text, ", ").alias("ranges"))


def assemble(slots: list[tuple[str, int] | None]) -> Column:
    """The vector whose slot i is element ``index`` of column ``source``; 0 where a slot has no source or the source is too short or null.

    One expression of plain element accesses, so the generated code reads the sources' memory directly.
    """
    zero = F.lit(0.0).cast("float")
    return F.array(*[zero if s is None else F.coalesce(F.get(F.col(s[0]), F.lit(s[1])).cast("float"), zero) for s in slots])


def slots_of(blocks: list[tuple[str, int, str | None, int]]) -> list[tuple[str, int] | None]:
    """The slot map of ordered blocks ``(block, width, source, first index)``; a block without source is zeros."""
    return [None if source is None else (source, first + i) for _, width, source, first in blocks for i in range(width)]


def slot_mismatches(df: DataFrame, vector: str, slots: list[tuple[str, int] | None]) -> DataFrame:
    """``slot, n``: how many rows of ``df`` have another value in a slot of ``vector`` than its source."""
    pairs = F.arrays_zip(F.col(vector).alias("have"), assemble(slots).alias("want"))
    rows = df.select(F.posexplode(pairs).alias("slot", "p"))
    return rows.filter(~F.col("p.have").eqNullSafe(F.col("p.want"))).groupBy("slot").agg(F.count(F.lit(1)).alias("n"))


def evidence_counts(blocks: DataFrame, key: list[str]) -> DataFrame:
    """``<key>, evidence, width``: slots by what their block's values rest on; constant blocks without source count as padding."""
    kind = F.when(F.col("source").isNull() & (F.col("evidence") == "constant"), "padding").otherwise(F.col("evidence"))
    return blocks.groupBy(*key, kind.alias("evidence")).agg(F.sum("width").alias("width"))


def buildable(blocks: DataFrame, key: list[str]) -> DataFrame:
    """``<key>, buildable, missing``: blocks that have neither a source nor constant evidence make a dataset unbuildable."""
    bad = F.col("source").isNull() & (F.coalesce(F.col("evidence"), F.lit("unknown")) != "constant")
    return blocks.groupBy(*key).agg((F.count_if(bad) == 0).alias("buildable"), F.array_sort(F.collect_list(F.when(bad, F.col("block")))).alias("missing"))


def unknown_keys(raw: Column, allowed: list[str]) -> Column:
    """Keys of a map that aren't allowed, sorted."""
    return F.array_sort(F.array_except(F.map_keys(raw), F.array(*[F.lit(a) for a in allowed])))


def unwritable_settings(settings: Column, writer: dict[str, str]) -> Column:
    """Settings that ask for another value than the one the writer always uses."""
    fixed = F.create_map(*[F.lit(x) for kv in writer.items() for x in kv])
    return F.array_sort(F.map_keys(F.map_filter(settings, lambda k, v: v.isNotNull() & F.map_contains_key(fixed, k) & (v != fixed[k]))))


def uneven_cover(pieces: DataFrame, of: str, begin: str, end: str) -> DataFrame:
    """``<of>, <begin>, <end>, n``: the longest stretches from 0 to the last end that ``n`` pieces cover, n not being 1.

    ``pieces`` has the BIGINTs ``begin`` < ``end`` of each piece. Their edges are walked in blocks, so that a thing of many pieces isn't one task.
    """
    edges = pieces.select(of, F.explode(F.array(F.struct(F.col(begin).alias("at"), F.lit(1).alias("d")), F.struct(F.col(end).alias("at"), F.lit(-1).alias("d")), F.struct(F.lit(0).cast("bigint").alias("at"), F.lit(0).alias("d")))).alias("e"))
    turns = edges.groupBy(of, "e.at").agg(F.sum("e.d").alias("d")).filter("d <> 0 or at = 0").withColumn("__of", F.struct(of))
    b = Blocked(turns, episode="__of", order="at", size=EDGE_BLOCK)
    b.sum_before("__n", F.col("d"))
    b.first_after("__next", boxed(F.col("at")))
    rows = b.rows().select(of, F.col("at").alias(begin), b.lead("__next", F.col("at")).alias(end), (F.sum("d").over(b.until) + F.col("__n")).alias("n"))
    return rows.filter((F.col("n") != 1) & F.col(end).isNotNull())
