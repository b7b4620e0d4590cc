"""Statistics of vector columns: by episode, pooled, as distributions, and their gaps between two copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framemill.session import cut_lineage

QUANTILES = {"q01": 0.01, "q10": 0.10, "q50": 0.50, "q90": 0.90, "q99": 0.99}


def vector_values(df: DataFrame, key: list[str], column: str, width: int | None = None, scale: float = 1.0) -> DataFrame:
    """``<key>, dim, value``: the numbers of a vector column, over ``scale``. Null vectors, vectors of another than the
    given width, and null and NaN elements are left out."""
    rows = df if width is None else df.filter(F.size(column) == width)
    values = rows.select(*key, F.posexplode(column).alias("dim", "value")).withColumn("value", F.col("value").cast("double") / F.lit(scale) if scale != 1.0 else F.col("value").cast("double"))
    return values.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def moments(value: str = "value") -> list[Column]:
    """Count, extremes, mean and population deviation."""
    return [F.count(value).alias("n"), F.min(value).alias("min"), F.max(value).alias("max"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std")]


def exact_quantiles(df: DataFrame, group: list[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """``<group>, <quantiles>``: exact linear quantiles of each group, however large a group is.

    Equal values are counted before the shuffle. The distinct values of all groups are then range-partitioned together, so
    a large group covers several partitions; each value's rank is its partition's offset plus its place in it. Nulls are
    left out; a group without values has no row.
    """
    return quantiles_of_counts(counted(df, group, value), group, value, quantiles)


def counted(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """``<group>, <value>, __n``: how often each value that isn't null occurs."""
    return df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("__n"))


def quantiles_of_counts(counts: DataFrame, group: list[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """``exact_quantiles`` of values that are ``counted`` already."""
    ranged = cut_lineage(counts.repartitionByRange(*group, value).withColumn("__part", F.spark_partition_id()))
    parts = ranged.groupBy(*group, "__part").agg(F.sum("__n").alias("__size"))
    in_group = Window.partitionBy(*group)
    earlier = F.sum("__size").over(in_group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = parts.select(*group, "__part", F.coalesce(earlier, F.lit(0)).alias("__offset"), F.sum("__size").over(in_group).alias("__total"))
    same = [F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in group] + [F.col("a.__part") == F.col("b.__part")]
    rows = ranged.alias("a").join(offsets.alias("b"), same).select(*[F.col(f"a.{g}") for g in group], F.col(f"a.{value}"), "__n", "a.__part", "__offset", "__total")
    until = F.sum("__n").over(Window.partitionBy(*group, "__part").orderBy(value)) + F.col("__offset")
    rows = rows.withColumn("__until", until)
    picked = {}
    for name, q in quantiles.items():
        place = F.lit(float(q)) * (F.col("__total") - 1)
        for side, at in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            here = (F.col("__until") > at) & (F.col("__until") - F.col("__n") <= at)
            picked[f"__{name}_{side}"] = F.max(F.when(here, F.col(value)))
    found = rows.groupBy(*group).agg(*[c.alias(n) for n, c in picked.items()], F.max("__total").alias("__total"))
    out = []
    for name, q in quantiles.items():
        place = F.lit(float(q)) * (F.col("__total") - 1)
        lo, hi = F.col(f"__{name}_lo"), F.col(f"__{name}_hi")
        out.append((lo + (hi - lo) * (place - F.floor(place))).alias(name))
    return found.select(*group, *out)


def described(values: DataFrame, group: list[str], quantiles: dict[str, float]) -> DataFrame:
    """Moments and quantiles of each group."""
    sides = values.groupBy(*group).agg(*moments()).alias("a"), exact_quantiles(values, group, "value", quantiles).alias("b")
    same = [F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in group]
    return sides[0].join(sides[1], same, "left").select("a.*", *[f"b.{q}" for q in quantiles])


def pooled(stats: DataFrame, group: list[str], quantiles: list[str]) -> DataFrame:
    """Whole-dataset statistics from those of its episodes, without another look at the data.

    ``stats`` has ``n, min, max, mean, std`` and the quantiles of each episode. The mean is weighted by count; the variance
    is the mean of squares less the squared mean, not below 0; a quantile is the count-weighted mean, and null unless
    every episode has it. Episodes with a count of 0 or none don't count.
    """
    w = F.col("n").cast("double")
    rows = stats.filter("n > 0")
    total = F.sum(w)
    sums = rows.groupBy(*group).agg(
        F.sum("n").alias("n"), F.min("min").alias("min"), F.max("max").alias("max"), (F.sum(w * F.col("mean")) / total).alias("mean"),
        (F.sum(w * (F.col("std") * F.col("std") + F.col("mean") * F.col("mean"))) / total).alias("__square"),
        *[F.when(F.count(q) == F.count(F.lit(1)), F.sum(w * F.col(q)) / total).alias(q) for q in quantiles],
    )
    return sums.select(*group, "n", "min", "max", "mean", F.sqrt(F.greatest(F.col("__square") - F.col("mean") * F.col("mean"), F.lit(0.0))).alias("std"), *quantiles)


def combined_moments(stats: DataFrame, group: list[str]) -> DataFrame:
    """``<group>, n, min, max, mean, std`` of the union of disjoint parts, from the same moments of each part."""
    w = F.col("n").cast("double")
    total = F.sum(w)
    sums = stats.filter("n > 0").groupBy(*group).agg(
        F.sum("n").alias("n"), F.min("min").alias("min"), F.max("max").alias("max"), (F.sum(w * F.col("mean")) / total).alias("mean"),
        (F.sum(w * (F.col("std") * F.col("std") + F.col("mean") * F.col("mean"))) / total).alias("__square"))
    return sums.select(*group, "n", "min", "max", "mean", F.sqrt(F.greatest(F.col("__square") - F.col("mean") * F.col("mean"), F.lit(0.0))).alias("std"))


def envelope(stats: DataFrame, group: list[str], low: str, high: str) -> DataFrame:
    """The widest interval over episodes: the smallest low and the largest high quantile."""
    return stats.groupBy(*group).agg(F.min(low).alias(low), F.max(high).alias(high))


def distribution_gap(mine: DataFrame, theirs: DataFrame, feature: str, stats: list[str]) -> DataFrame:
    """``<feature>, gap``: the largest difference of any statistic in any dimension, as a share of ``theirs``' span.

    A span that isn't positive counts as 1; a feature or dimension that only one side has makes the gap infinite.
    """
    keyed = [d.select(feature, "dim", F.struct(*[F.col(s).cast("double").alias(s) for s in stats]).alias(side)) for d, side in ((mine, "a"), (theirs, "b"))]
    both = keyed[0].join(keyed[1], [feature, "dim"], "full_outer")
    span = F.col("b.max") - F.col("b.min")
    span = F.when(span > 0, span).otherwise(F.lit(1.0))
    worst = F.greatest(*[F.abs(F.col(f"a.{s}") - F.col(f"b.{s}")) for s in stats]) / span
    gap = F.when(F.col("a").isNull() | F.col("b").isNull(), F.lit(float("inf"))).otherwise(worst)
    return both.groupBy(feature).agg(F.max(gap).alias("gap"))


def modal(df: DataFrame, group: list[str], value: str, seen: str) -> DataFrame:
    """``<group>, <value>, n``: the most frequent value; of equally frequent ones the one seen first (smallest ``seen``)."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("n"), F.min(seen).alias("__seen"))
    best = F.max_by(F.struct(value, "n"), F.struct(F.col("n"), -F.col("__seen"))).alias("__best")
    return counts.groupBy(*group).agg(best).select(*group, f"__best.{value}", "__best.n")


def close_enough(a: Column, b: Column, rtol: float, atol: float) -> Column:
    """|a - b| <= atol + rtol * |b|; null and NaN only match their like."""
    both = F.isnan(a) & F.isnan(b)
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(both | (~F.isnan(a) & ~F.isnan(b) & (F.abs(a - b) <= atol + rtol * F.abs(b))))


def frame_agreement(a: DataFrame, b: DataFrame, key: list[str], frame: str, column: str) -> DataFrame:
    """``<key>, agreement``: the weakest correlation of any shared frame's numbers.

    Two flat frames agree (1) if all numbers are within 2 of each other, else not (0); one flat frame, or frames of
    different size, give 0. Keys without a shared frame have no row.
    """
    sides = [d.select(*key, frame, F.col(column).alias(s)) for d, s in ((a, "x"), (b, "y"))]
    pairs = sides[0].join(sides[1], [*key, frame]).filter("x is not null and y is not null")
    sized = pairs.withColumn("__same", F.size("x") == F.size("y"))
    cells = sized.select(*key, frame, "__same", F.explode_outer(F.when(F.col("__same"), F.arrays_zip("x", "y"))).alias("c"))
    x, y = F.col("c.x").cast("double"), F.col("c.y").cast("double")
    parts = cells.groupBy(*key, frame).agg(
        F.first("__same").alias("__same"), F.stddev_pop(x).alias("__sx"), F.stddev_pop(y).alias("__sy"), F.max(F.abs(x - y)).alias("__far"), F.corr(x, y).alias("__r"))
    score = F.when(~F.col("__same"), 0.0).when((F.col("__sx") == 0) & (F.col("__sy") == 0), (F.col("__far") <= 2).cast("double")).when((F.col("__sx") == 0) | (F.col("__sy") == 0), 0.0).otherwise(F.col("__r"))
    return parts.groupBy(*key).agg(F.min(score).alias("agreement"))


def keyframe_gap(df: DataFrame, key: list[str], order: str, flag: Column) -> DataFrame:
    """``<key>, gap``: distance of the first two flagged rows, null with fewer; two numbers of each key are held."""
    first = df.groupBy(*key).agg(F.min(F.when(flag, F.col(order))).alias("__a"))
    second = df.join(first, key).groupBy(*key).agg(F.min("__a").alias("__a"), F.min(F.when(flag & (F.col(order) > F.col("__a")), F.col(order))).alias("__b"))
    return second.select(*key, (F.col("__b") - F.col("__a")).alias("gap"))
