"""Per-key totals whose work stays even however much one key holds.

Rows are range-partitioned on (key, secondary order) with boundaries from sampled quantiles, so a heavy key covers
as many partitions as its share asks for. Each partition reduces its stretch of every key to one partial state;
a key that crosses partition boundaries is stitched from its partial states, which are a few numbers each.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framemill.functions.rowhash import row_digest


def _merge_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map-side combine: identical rows of a batch become one before anything is shuffled."""
    for batch in batches:
        merged = pa.Table.from_batches([batch]).group_by(batch.schema.names).aggregate([])
        yield from merged.select(batch.schema.names).to_batches()


def key_totals(df: DataFrame, key: Column, order: list[str], sums: dict[str, Column] | None = None, *, distinct_rows: bool = True) -> DataFrame:
    """One row per key: ``key_value, n_rows, <each of sums>, pieces``.

    ``key``     any expression over ``df``; a null key is a key of its own (key_value null).
    ``order``   secondary columns that spread the rows of one key, best nearly unique; nulls sort first.
    ``sums``    BIGINT expressions to add up; nulls add nothing, a key with only nulls has sum null, and so has a
                sum beyond the BIGINT range.
    ``pieces``  the number of range partitions the key was split over, each of which gave one partial state.

    With ``distinct_rows`` exact repeats (all columns of ``df`` equal, null equal to null) count once. Repeats are
    first merged within each input batch and then meet in one range partition, as the range is on the whole row's
    digest after key and order. An empty table gives no rows. Names of ``df`` may clash with the result's names.
    """
    sums = sums or {}
    digest = row_digest(df)
    rows = df.select(
        key.alias("key_value"),
        *[F.col(f"`{c}`").alias(f"order_{i}") for i, c in enumerate(order)],
        digest.alias("digest"),
        *[c.cast("bigint").alias(f"sum_{i}") for i, c in enumerate(sums.values())],
    )
    if distinct_rows:
        rows = rows.mapInArrow(_merge_copies, rows.schema)
    ranged = rows.repartitionByRange("key_value", *[f"order_{i}" for i in range(len(order))], "digest")
    if distinct_rows:
        ranged = ranged.dropDuplicates()
    pieces = ranged.withColumn("piece", F.spark_partition_id())
    return pieces.groupBy("key_value").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.try_sum(f"sum_{i}").alias(name) for i, name in enumerate(sums)],
        (F.max("piece") - F.min("piece") + 1).alias("pieces"),
    )
