"""Pairing of two tables by nearest time within a tolerance, per entity.

The top bits of a timestamp choose a time block; (entity, block) is what Spark hashes on, so an entity that holds a
large part of all rows is spread over as many tasks as it covers blocks. Within a block the remaining bits go into an
x-fast trie: hash tables of bit prefixes, binary search over the prefix length, nearer one of predecessor and successor.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framemill.functions.xfast import XFastTries
from framemill.operators.blocks import Blocked
from framemill.session import cut_lineage, small_side

#: A block of 2**20 microseconds (about a second) holds at most that many distinct times.
BLOCK_BITS = 20
#: Queries of one (entity, block) beyond this many are dealt to several tasks.
HOT_BLOCK_QUERIES = 500_000
#: Widest tolerance.
MAX_TOLERANCE_US = 1 << 50
#: Rows that one vectorised step takes at least, if there are so many.
CHUNK_ROWS = 200_000


def nearest_within(
    points: DataFrame,
    queries: DataFrame,
    *,
    entity: tuple[str, str],
    time: tuple[str, str],
    rank: str,
    point_id: str,
    query_id: str,
    tolerance_us: int,
    block_bits: int = BLOCK_BITS,
    hot_block: int = HOT_BLOCK_QUERIES,
) -> DataFrame:
    """``point_id, query_id, distance_us``: for each query the nearest point of the same entity, if within the tolerance.

    ``entity`` and ``time`` name the columns in (points, queries); times are TIMESTAMP or TIMESTAMP_NTZ. Of equally
    near points the one with the largest ``rank`` wins (a null rank counts as smallest), then the largest point_id.
    Rows with a null entity or time pair with nothing; nor do points with a null id. Exact repeats of a query count
    once; one query id with several times gives one row for each time that finds a point, equal rows once. A distance
    of exactly ``tolerance_us`` is within. Empty tables give no rows; other columns of the inputs are not looked at.

    A task holds the points of a block (``2**block_bits`` microseconds of an entity) at most, whatever the tolerance. Where
    that is narrow against a block, points near an edge go to both blocks; else each block with queries gets the last
    point before it and the first one after it. Tolerances up to ``MAX_TOLERANCE_US`` (some 35 years) are taken.
    """
    if tolerance_us > MAX_TOLERANCE_US:
        raise ValueError(f"the tolerance is above {MAX_TOLERANCE_US} microseconds")
    width = 1 << block_bits
    at = lambda c: F.unix_micros(F.col(f"`{c}`").cast("timestamp"))
    block = lambda c: F.shiftright(c, block_bits)
    id_type, query_type = (dict(d.dtypes)[c] for d, c in ((points, point_id), (queries, query_id)))

    best = F.max(F.struct(F.col(f"`{rank}`").alias("r"), F.col(f"`{point_id}`").alias("p")))
    leaves = (
        points.select(F.col(f"`{entity[0]}`").alias("e"), at(time[0]).alias("t"), f"`{rank}`", f"`{point_id}`")
        .filter(F.col("e").isNotNull() & F.col("t").isNotNull() & F.col(f"`{point_id}`").isNotNull())
        .groupBy("e", "t")
        .agg(best.alias("best"))
        .select("e", "t", F.col("best.r").cast("bigint").alias("r"), F.col("best.p").alias("p"))
    )
    asked = (
        queries.select(F.col(f"`{entity[1]}`").alias("e"), at(time[1]).alias("t"), F.col(f"`{query_id}`").alias("q"))
        .filter(F.col("e").isNotNull() & F.col("t").isNotNull())
        .dropDuplicates()
        .withColumn("b", block(F.col("t")))
    )
    if 2 * tolerance_us <= width:
        # A leaf also serves the queries that lie beyond its block's edge, but within the tolerance.
        leaves = leaves.withColumn("b", F.explode(F.array_distinct(F.array(block(F.col("t") - tolerance_us), block(F.col("t")), block(F.col("t") + tolerance_us)))))
    else:
        leaves = _with_borders(leaves.withColumn("b", block(F.col("t"))), asked.select("e", "b"), width, tolerance_us)

    # Counted before repeats are dropped, so that this needs no shuffle of the queries; blocks only seem hotter by it.
    every = queries.select(F.col(f"`{entity[1]}`").alias("e"), block(at(time[1])).alias("b")).filter("e is not null and b is not null")
    hot = cut_lineage(every.groupBy("e", "b").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_block).select("e", "b", F.ceil(F.col("n") / hot_block).cast("int").alias("salts")))
    n_hot = hot.count()
    if n_hot:
        side = small_side(hot, n_hot)
        asked = asked.join(side, ["e", "b"], "left").withColumn("s", F.pmod(F.xxhash64("q"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
        leaves = leaves.join(side, ["e", "b"], "left").withColumn("s", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
    else:
        asked, leaves = asked.withColumn("s", F.lit(0)), leaves.withColumn("s", F.lit(0))

    offset = F.col("t") - F.shiftleft(F.col("b"), block_bits) + tolerance_us
    rows = leaves.select("e", "b", "s", F.lit(0).cast("tinyint").alias("kind"), offset.alias("x"), "r", "p", F.lit(None).cast(query_type).alias("q"))
    rows = rows.unionByName(asked.select("e", "b", "s", F.lit(1).cast("tinyint").alias("kind"), offset.alias("x"), F.lit(None).cast("bigint").alias("r"), F.lit(None).cast(id_type).alias("p"), "q"))
    ordered = rows.repartition("e", "b", "s").sortWithinPartitions("e", "b", "s", "kind", "x")
    bits = int(width + 2 * tolerance_us).bit_length()
    schema = f"`{point_id}` {id_type}, `{query_id}` {query_type}, distance_us bigint"
    return ordered.mapInArrow(partial(_match, bits=bits, tolerance=tolerance_us, names=(point_id, query_id)), schema).dropDuplicates()


def _with_borders(leaves: DataFrame, asked: DataFrame, width: int, tolerance_us: int) -> DataFrame:
    """``leaves`` (``e, t, r, p, b``), and for each block of ``asked`` (``e, b``) the nearest leaves before and after it that are within the tolerance of its edges."""
    leaf = F.struct("t", "r", "p")
    ends = leaves.groupBy("e", "b").agg(F.min_by(leaf, "t").alias("first"), F.max_by(leaf, "t").alias("last"))
    kind = ends.schema["first"].dataType
    spots = ends.withColumn("wanted", F.lit(False)).unionByName(asked.select("e", "b", *[F.lit(None).cast(kind).alias(c) for c in ("first", "last")], F.lit(True).alias("wanted")))
    spots = spots.groupBy("e", "b").agg(F.max("first").alias("first"), F.max("last").alias("last"), F.bool_or("wanted").alias("wanted"))
    walk = Blocked(spots.withColumn("entity", F.struct("e")), episode="entity", order="b")
    walk.last_before("earlier", F.col("last"))
    walk.first_after("later", F.col("first"))
    before = F.coalesce(F.last("last", ignorenulls=True).over(walk.before), F.col("earlier"))
    after = F.coalesce(F.first("first", ignorenulls=True).over(walk.inner.rowsBetween(1, Window.unboundedFollowing)), F.col("later"))
    rows = walk.rows().select("e", "b", "wanted", F.array(before, after).alias("borders")).filter("wanted")
    borders = rows.select("e", F.explode(F.array_compact("borders")).alias("l"), "b").select("e", "l.t", "l.r", "l.p", "b")
    start = F.col("b") * width
    return leaves.unionByName(borders.filter(F.col("t").between(start - tolerance_us, start + (width - 1) + tolerance_us)))


def _match(batches: Iterator[pa.RecordBatch], bits: int, tolerance: int, names: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (entity, block, salt, kind, x), points first. Whole groups are taken a chunk at a time;
    of a group that goes on in the next chunk only its points are kept."""
    kept: pa.Table | None = None
    waiting, count = [], 0
    for batch in batches:
        waiting.append(batch)
        count += batch.num_rows
        if count >= CHUNK_ROWS:
            kept, found = _chunk(kept, waiting, bits, tolerance, names, last=False)
            waiting, count = [], 0
            yield from found
    _, found = _chunk(kept, waiting, bits, tolerance, names, last=True)
    yield from found


def _chunk(kept: pa.Table | None, waiting: list[pa.RecordBatch], bits: int, tolerance: int, names: tuple[str, str], *, last: bool) -> tuple[pa.Table | None, list[pa.RecordBatch]]:
    tables = [kept] if kept is not None else []
    if waiting:
        tables.append(pa.Table.from_batches(waiting))
    if not tables:
        return None, []
    rows = pa.concat_tables(tables).combine_chunks()
    n = rows.num_rows
    if not n:
        return None, []
    change = np.zeros(n, bool)
    for c in ("e", "b", "s"):
        codes = rows[c].combine_chunks()
        codes = codes.dictionary_encode().indices.to_numpy() if pa.types.is_string(codes.type) or pa.types.is_large_string(codes.type) else codes.to_numpy(zero_copy_only=False)
        change[1:] |= codes[1:] != codes[:-1]
    group = np.cumsum(change)
    kind = rows["kind"].to_numpy()
    x = rows["x"].to_numpy()
    point, query = np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
    if not last:  # the last group may go on: its points stay, and its queries wait if its points may still be coming
        tail = int(group[-1])
        keep = point[group[point] == tail]
        rest = rows.take(pa.array(keep))
    else:
        rest = None
    out = []
    if len(query) and len(point):
        tries = XFastTries(group[point], x[point], bits)
        before, after = tries.neighbours(group[query], x[query])
        gap_before = np.where(before >= 0, x[query] - x[point][before], np.int64(1) << 62)
        gap_after = np.where(after >= 0, x[point][after] - x[query], np.int64(1) << 62)
        rank = rows["r"].fill_null(np.iinfo(np.int64).min).to_numpy()[point]
        later = gap_after < gap_before
        tie = (gap_after == gap_before) & (before >= 0) & (after >= 0) & (before != after)
        later |= tie & (rank[after] >= rank[before])
        even = np.flatnonzero(tie & (rank[after] == rank[before]))
        chosen = np.where(later, after, before)
        if len(even):  # the same rank on both sides: the larger id
            ids = rows["p"].take(pa.array(point)).to_pylist()
            for i in even:
                chosen[i] = after[i] if ids[after[i]] >= ids[before[i]] else before[i]
        gap = np.minimum(gap_before, gap_after)
        good = np.flatnonzero(gap <= tolerance)
        if len(good):
            found = pa.table([rows["p"].take(pa.array(point[chosen[good]])), rows["q"].take(pa.array(query[good])), pa.array(gap[good])], names=[*names, "distance_us"])
            out = found.combine_chunks().to_batches()
    return rest, out
