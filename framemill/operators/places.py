"""Places of rows within their group, without bringing a group together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framemill.session import cut_lineage


def places(df: DataFrame, group: list[str], order: list[str], name: str = "place", descending: bool = False) -> DataFrame:
    """``df`` with BIGINT ``<name>``, the 0-based place of each row in its group, and ``<name>_of``, the group's rows.

    Rows are range-partitioned on (group, order) with sampled boundaries, so a large group covers several partitions.
    A row's place is its place within the partition and the sizes of its group's earlier ones. ``order`` must be unique
    within a group for the places to be defined; ``descending`` turns its first column round. Nulls are a group like any other.
    """
    first = F.desc_nulls_last(order[0]) if descending else F.asc_nulls_first(order[0])
    sorting = [first, *[F.asc_nulls_first(o) for o in order[1:]]]
    ranged = cut_lineage(df.repartitionByRange(*[F.asc_nulls_first(g) for g in group], *sorting).withColumn("__part", F.spark_partition_id()))
    sizes = ranged.groupBy(*group, "__part").agg(F.count(F.lit(1)).alias("__size"))
    # There are as many rows here as groups and partitions together; whether that is little enough to broadcast shows at run time.
    mine = Window.partitionBy(*[F.col(g) for g in group])
    earlier = F.coalesce(F.sum("__size").over(mine.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], F.col("__part").alias("__p"), earlier.alias("__before"), F.sum("__size").over(mine).alias("__all"))
    same = F.col("__part") == F.col("__p")
    for i, g in enumerate(group):
        same = same & F.col(f"`{g}`").eqNullSafe(F.col(f"__g{i}"))
    inner = Window.partitionBy("__part", *group).orderBy(*sorting)
    rows = ranged.join(sizes, same)
    rows = rows.withColumn(name, F.row_number().over(inner).cast("bigint") - 1 + F.col("__before")).withColumn(f"{name}_of", F.col("__all"))
    return rows.select(*df.columns, name, f"{name}_of")
