"""Connected components of links between rows, by alternating star contraction.

Every round points the neighbours of each node at the smallest node nearby, first the larger ones, then the smaller
ones, until all components are stars around their smallest node; this takes logarithmically many rounds in practice,
whatever the shape. Nothing but a yes or no a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framemill.session import cut_lineage


def links_from_keys(rows: DataFrame) -> DataFrame:
    """Links ``u > v`` from ``id, key`` rows: each id to the smallest id that shares one of its keys. Null keys link nothing."""
    keyed = rows.filter(F.col("key").isNotNull() & F.col("id").isNotNull()).dropDuplicates(["id", "key"])
    smallest = keyed.groupBy("key").agg(F.min("id").alias("v"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", "v")
    return keyed.join(smallest, "key").filter("id > v").select(F.col("id").alias("u"), "v").dropDuplicates()


def component_labels(links: DataFrame) -> DataFrame:
    """``id, label`` for every id that isn't the smallest of its component: the label is the smallest id.

    ``links`` has BIGINT ``u, v``; order, repeats and self links don't matter. No links, no rows.
    """
    ordered = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = cut_lineage(ordered.filter("u > v").dropDuplicates())
    while not _stars(edges):
        edges = cut_lineage(_small_star(_large_star(edges)))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("label"))


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one centre, and no centre on another."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("hangs"), F.lit(0).alias("centre")).unionByName(edges.select(F.col("v").alias("id"), F.lit(0).alias("hangs"), F.lit(1).alias("centre")))
    return ends.groupBy("id").agg(F.sum("hangs").alias("hangs"), F.max("centre").alias("centre")).filter("hangs + centre > 1").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).dropDuplicates()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    pulled = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return pulled.unionByName(least.select("u", F.col("m").alias("v"))).dropDuplicates()
