"""Differences between two copies of a table, row by row and field by field.

Each copy is reduced to one row digest per key, combined before the only shuffle that all rows take part in. Digests are
dealt into small buckets that lie within the partitions of that shuffle, so each side sketches its buckets where they are:
the values of their characteristic polynomials at a few points (``functions.charpoly``). Only sketches meet then. The
digests of buckets whose sketches differ are brought together and reconciled, the degree bound doubling until verified;
what comes out are the digests of rows that the other copy lacks. Only those rows are fetched again and compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framemill.functions.charpoly import ELEMENT_BITS, VERIFY, mul, points, reconcile, sketch
from framemill.functions.rowhash import vector_digest
from framemill.session import BROADCAST_ROWS, cut_lineage, small_side

#: Expected rows of a bucket in each copy.
BUCKET_ROWS = 48
#: First degree bound.
DEGREE = 8
#: Rows that one vectorised step takes at least, if there are so many.
CHUNK_ROWS = 100_000


def _c(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _element(df: DataFrame, key: list[str], fields: list[str]) -> Column:
    """Digest of key and fields, as an element of the field below 2**60."""
    kinds = dict(df.dtypes)
    parts = [_digestible(_c(n), kinds[n]) for n in (*key, *fields)]
    nulls = F.array(*[_c(n).isNull() for n in (*key, *fields)])
    return F.xxhash64(*parts, nulls).bitwiseAND(F.lit((1 << ELEMENT_BITS) - 1))


def _digestible(c: Column, kind: str) -> Column:
    if kind.startswith("array<") and "<" not in kind[6:]:
        return vector_digest(c)
    return F.to_json(F.struct(c)) if "<" in kind else c


def _bucket(key: list[Column], buckets: int, partitions: int) -> Column:
    """Bucket of a key: the partition that Spark's hash gives it, and a share of that partition by another hash."""
    each = -(-buckets // partitions)
    return F.pmod(F.hash(*key), F.lit(partitions)).cast("bigint") * each + F.pmod(F.xxhash64(F.lit(7), *key), F.lit(each))


def differing_digests(left: DataFrame, right: DataFrame, key: list[str], fields: list[str], version: str | None, buckets: int) -> DataFrame:
    """``side (0 left, 1 right), bucket, element`` of each current row whose equal the other copy lacks."""
    spark = left.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [f"k{i}" for i in range(len(key))]
    sides, sketches = [], []
    for side, df in enumerate((left, right)):
        rows = df.select(*[_c(k).alias(n) for k, n in zip(key, keys, strict=True)], (_c(version) if version else F.lit(0)).alias("v"), _element(df, key, fields).alias("element"))
        # Versions of one key meet by their key, combined before the shuffle; only the newest digest goes on.
        newest = rows.groupBy(*keys).agg(F.max(F.struct("v", "element")).alias("m"))
        bucket = _bucket([F.col(k) for k in keys], buckets, partitions).alias("bucket")
        mine = cut_lineage(newest.select(F.lit(side).cast("tinyint").alias("side"), bucket, F.col("m.element").alias("element")).sortWithinPartitions("bucket"))
        sides.append(mine)
        sketches.append(mine.sortWithinPartitions("bucket").mapInArrow(partial(_sketch_batches, degree=DEGREE), _SKETCH))
    met = sketches[0].unionByName(sketches[1]).repartition("bucket").sortWithinPartitions("bucket", "side")
    differing = cut_lineage(met.mapInArrow(_differing_buckets, "bucket bigint").dropDuplicates())
    side = small_side(differing, differing.count())
    both = sides[0].join(side, "bucket", "left_semi").unionByName(sides[1].join(side, "bucket", "left_semi"))
    both = both.select("side", "bucket", "element").repartition("bucket").sortWithinPartitions("bucket", "side", "element")
    return both.mapInArrow(partial(_reconcile_batches, degree=DEGREE), "side tinyint, bucket bigint, element bigint")


_SKETCH = "side tinyint, bucket bigint, n bigint, values array<bigint>"


def _sketch_batches(batches: Iterator[pa.RecordBatch], degree: int) -> Iterator[pa.RecordBatch]:
    """A sketch of each batch's part of each bucket; parts of one bucket are multiplied where they meet."""
    z = points(degree + VERIFY)
    for batch in batches:
        if not batch.num_rows:
            continue
        side, bucket, element = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        size = np.diff(np.append(first, len(bucket)))
        values = sketch(element.astype(np.uint64), np.repeat(np.arange(len(first)), size), len(first), z)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(first) + 1, dtype=np.int32) * len(z)), pa.array(values.ravel().astype(np.int64)))
        yield pa.record_batch([pa.array(side[first]), pa.array(bucket[first]), pa.array(size), lists], names=["side", "bucket", "n", "values"])


def _differing_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets whose two sides' sketches differ; sketches come sorted by bucket. A side without elements has none, which is the product of nothing."""
    held: pa.Table | None = None
    for batch in chain(batches, [None]):
        if batch is not None:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            last = held["bucket"][-1].as_py() if held.num_rows else None
            whole = held.filter(pc.less(held["bucket"], last)) if last is not None else held
            held = held.filter(pc.equal(held["bucket"], last)) if last is not None else None
        else:
            whole, held = held, None
        if whole is None or not whole.num_rows:
            continue
        whole = whole.combine_chunks()
        bucket, side, n = (whole[c].to_numpy() for c in ("bucket", "side", "n"))
        values = whole["values"].chunk(0).flatten().to_numpy().astype(np.uint64).reshape(len(bucket), -1)
        ids, of = np.unique(bucket, return_inverse=True)
        product, size = np.ones((2, len(ids), values.shape[1]), np.uint64), np.zeros((2, len(ids)), np.int64)
        for s in (0, 1):
            rows = np.flatnonzero(side == s)
            np.add.at(size[s], of[rows], n[rows])
            while len(rows):  # the first part left of each bucket, until there are none
                at, first = np.unique(of[rows], return_index=True)
                product[s, at] = mul(product[s, at], values[rows[first]])
                rows = np.delete(rows, first)
        yield pa.record_batch([pa.array(ids[(product[0] != product[1]).any(axis=1) | (size[0] != size[1])])], names=["bucket"])


def _reconcile_batches(batches: Iterator[pa.RecordBatch], degree: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (bucket, side); whole buckets are taken a chunk at a time."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    count = 0
    for batch in batches:
        held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)))
        count += batch.num_rows
        if count < CHUNK_ROWS:
            continue
        side, bucket, element = (np.concatenate(x) for x in zip(*held, strict=True))
        end = int(np.searchsorted(bucket, bucket[-1]))
        yield from _differences(side[:end], bucket[:end], element[:end], degree)
        held, count = [(side[end:], bucket[end:], element[end:])], len(side) - end
    if held:
        yield from _differences(*(np.concatenate(x) for x in zip(*held, strict=True)), degree)


def _differences(side: np.ndarray, bucket: np.ndarray, element: np.ndarray, degree: int) -> Iterator[pa.RecordBatch]:
    if not len(side):
        return
    number = np.cumsum(np.append(False, bucket[1:] != bucket[:-1]))
    a, b = side == 0, side == 1
    values = element.astype(np.uint64)
    out = np.zeros(len(side), bool)
    out[a], out[b] = reconcile(values[a], number[a], values[b], number[b], int(number[-1]) + 1, degree)
    if out.any():
        yield pa.record_batch([pa.array(side[out], pa.int8()), pa.array(bucket[out]), pa.array(element[out])], names=["side", "bucket", "element"])


def table_differences(left: DataFrame, right: DataFrame, key: list[str], fields: list[str], *, version: str | None = None, only_left: str = "only_left", only_right: str = "only_right", bucket_rows: int = BUCKET_ROWS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``<key>, finding``: one row for each row that one copy lacks and for each differing field of a shared row.

    ``key``      identifies a row; null is a value like any other.
    ``version``  of several rows with one key the one with the largest version stands (null is the smallest; among equal
                 versions the one with the larger digest). Without it, the row with the larger digest.
    ``fields``   compared exactly: null equals null, NaN equals NaN, 0.0 equals -0.0; arrays by length and element,
                 strings by code points. ``right``'s fields are cast to ``left``'s types. Maps aren't supported.
    ``finding``  ``only_left`` / ``only_right`` for a row that just one copy has, else the name of a differing field.

    Empty tables are copies without rows. Other columns aren't read; names may clash with those used inside.
    Two different rows count as equal if their 60-bit digests agree within one bucket. Up to ``broadcast_rows`` differing
    digests are broadcast to fetch their rows; more are joined by a shuffle of what a bit map lets through.
    """
    kinds = dict(left.dtypes)
    left = left.select(*[_c(n) for n in dict.fromkeys([*key, *fields, *([version] if version else [])])])
    right = right.select(*[_c(n).cast(kinds[n]).alias(n) if n != version else _c(n) for n in dict.fromkeys([*key, *fields, *([version] if version else [])])])
    rows = left.count() + right.count()
    buckets = max(1, rows // (2 * bucket_rows))
    found = cut_lineage(differing_digests(left, right, key, fields, version, buckets))
    n_found = found.count()
    parts = []
    for side, df in enumerate((left, right)):
        wanted = found.filter(F.col("side") == side).select("element")
        located = df.select(*[_c(k).alias(f"k{i}") for i, k in enumerate(key)], *[_c(f).alias(f"f{i}") for i, f in enumerate(fields)], _element(df, key, fields).alias("element"))
        fetched = _fetch(located, wanted, n_found, broadcast_rows)
        parts.append(fetched.drop("element").dropDuplicates([f"k{i}" for i in range(len(key))]).withColumn("there", F.lit(True)))
    a, b = parts[0].alias("a"), parts[1].alias("b")
    same_key = reduce(lambda x, y: x & y, [F.col(f"a.k{i}").eqNullSafe(F.col(f"b.k{i}")) for i in range(len(key))])
    joined = a.join(b, same_key, "full_outer")
    fields_differ = [F.when(~F.col(f"a.f{i}").eqNullSafe(F.col(f"b.f{i}")), F.lit(f)) for i, f in enumerate(fields)]
    findings = F.when(F.col("a.there").isNull(), F.array(F.lit(only_right))).when(F.col("b.there").isNull(), F.array(F.lit(only_left))).otherwise(F.array_compact(F.array(*fields_differ)))
    of_key = [F.when(F.col("a.there").isNull(), F.col(f"b.k{i}")).otherwise(F.col(f"a.k{i}")).alias(k) for i, k in enumerate(key)]
    return joined.select(*of_key, F.explode(findings).alias("finding"))


#: Words of 64 bits of the bit map that thins out rows before a join with many digests.
BIT_MAP_WORDS = 1 << 18


def _fetch(located: DataFrame, wanted: DataFrame, n: int, broadcast_rows: int) -> DataFrame:
    """The rows of ``located`` whose ``element`` is among the ``n`` at most of ``wanted``."""
    if n <= broadcast_rows:
        return located.join(F.broadcast(wanted), "element", "left_semi")
    word = F.pmod("element", F.lit(BIT_MAP_WORDS)).alias("word")
    bit = F.expr(f"shiftleft(1L, cast(pmod(element div {BIT_MAP_WORDS}, 64) as int))")
    bits = wanted.select(word, bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))  # at most BIT_MAP_WORDS rows
    likely = located.withColumn("word", word).join(F.broadcast(bits), "word").filter(F.col("bits").bitwiseAND(bit) != 0).drop("word", "bits")
    return likely.join(wanted.hint("shuffle_hash"), "element", "left_semi")
