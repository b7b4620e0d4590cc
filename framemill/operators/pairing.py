"""Content-addressed pairing of two copies' episodes, and what follows from the pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framemill.functions.rowhash import exact_digest
from framemill.operators.places import places
from framemill.operators.scans import positions
from framemill.session import cut_lineage

#: Rows whose content identifies the start of an episode.
PREFIX_ROWS = 8
#: Rows by which paired episodes may differ in length.
ROW_TOLERANCE = 2


def number_text(vector: Column, scale: int = 1 << 16) -> Column:
    """Text of a vector that every engine writes alike: its elements as whole multiples of 1 / scale."""
    one = lambda x: F.when(x.isNull(), "null").when(F.isnan(x), "nan").otherwise(F.round(x.cast("double") * scale).cast("bigint").cast("string"))
    return F.coalesce(F.array_join(F.transform(vector, one), ","), F.lit("none"))


def fingerprints(frames: DataFrame, columns: list[str], prefix_rows: int = PREFIX_ROWS, also: Sequence[Column] = ()) -> DataFrame:
    """``episode_index, n_rows, whole, prefix``: digests of an episode's vectors, over all rows and over its first ones.

    Each row's digest covers its place in the episode, so the digests of a set of rows can be added up in any order: no
    episode is brought together in one place. Frames that have their ``position`` already keep it. ``also`` are further
    aggregates of an episode's frames.
    """
    placed = frames if "position" in frames.columns else positions(frames.select("episode_index", "frame_index", *columns))
    text = F.concat_ws("|", F.col("position").cast("string"), *[number_text(F.col(c)) for c in columns])
    digest = F.sha2(text, 256)
    parts = [F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)") for i in (0, 1)]
    rows = placed.withColumns({f"d{i}": p for i, p in enumerate(parts)})
    first = F.col("position") < prefix_rows
    joined = lambda cond: F.concat_ws("-", *[F.sum(F.when(cond, F.col(f"d{i}"))).cast("string") for i in (0, 1)])
    return rows.groupBy("episode_index").agg(F.count(F.lit(1)).alias("n_rows"), joined(F.lit(True)).alias("whole"), joined(first).alias("prefix"), *also)


def pair_digests(a: DataFrame, b: DataFrame, digest: str) -> DataFrame:
    """``one, other``: episodes of both sides with equal digests, in index order; a digest that occurs a different number of times on the two sides pairs nothing."""
    counts = [d.groupBy(digest).agg(F.count(F.lit(1)).alias("n")) for d in (a, b)]
    even = counts[0].join(counts[1], [digest, "n"]).select(digest)
    sides = [d.select(F.lit(i).alias("side"), "episode_index", digest).join(even, digest, "left_semi") for i, d in enumerate((a, b))]
    placed = places(sides[0].unionByName(sides[1]), ["side", digest], ["episode_index"]).drop("place_of")
    one, other = (placed.filter(F.col("side") == i).select(F.col("episode_index").alias(n), digest, "place") for i, n in enumerate(("one", "other")))
    return one.join(other, [digest, "place"]).select("one", "other")


def pair_episodes(a: DataFrame, b: DataFrame) -> DataFrame:
    """``one, other, basis, row_delta`` of two sets of fingerprints: ``exact`` pairs first, then ``prefix`` pairs of what is
    left; the rest as ``one_only`` and ``other_only``. ``row_delta`` is the length of one less that of the other."""
    a, b = cut_lineage(a), cut_lineage(b)  # a row an episode, read several times below
    exact = cut_lineage(pair_digests(a, b, "whole").withColumn("basis", F.lit("exact")))
    rest_a = a.join(exact, a.episode_index == exact.one, "left_anti")
    rest_b = b.join(exact, b.episode_index == exact.other, "left_anti")
    pairs = exact.unionByName(pair_digests(rest_a, rest_b, "prefix").withColumn("basis", F.lit("prefix")))
    rows_a = a.select(F.col("episode_index").alias("one"), F.col("n_rows").alias("rows_one"))
    rows_b = b.select(F.col("episode_index").alias("other"), F.col("n_rows").alias("rows_other"))
    both = rows_a.join(pairs, "one", "left").join(rows_b, "other", "full_outer")
    basis = F.when(F.col("rows_one").isNull(), "other_only").when(F.col("basis").isNull(), "one_only").otherwise(F.col("basis"))
    return both.select("one", "other", basis.alias("basis"), (F.col("rows_one") - F.col("rows_other")).alias("row_delta"))


def pair_places(pairing: DataFrame) -> DataFrame:
    """``one, other``: the episodes of a pairing by their place in each side's index order; ``other`` is null past the other side's last."""
    sides = [pairing.filter(F.col(n).isNotNull()).select(F.lit(i).alias("side"), F.col(n).alias("episode_index")) for i, n in enumerate(("one", "other"))]
    placed = places(sides[0].unionByName(sides[1]), ["side"], ["episode_index"]).drop("place_of")
    one, other = (placed.filter(F.col("side") == i).select(F.col("episode_index").alias(n), "place") for i, n in enumerate(("one", "other")))
    return one.join(other, "place", "left").select("one", "other")


def pairing_summary(pairing: DataFrame) -> DataFrame:
    """Counts of one row: exact and prefix pairs, leftovers, moved episodes, equal lengths among prefix pairs, the worst row difference."""
    b = F.col("basis")
    return pairing.agg(
        *[F.count_if(b == x).alias(x) for x in ("exact", "prefix", "one_only", "other_only")],
        F.count_if(b.isin("exact", "prefix") & (F.col("one") != F.col("other"))).alias("moved"),
        F.count_if((b == "prefix") & (F.col("row_delta") == 0)).alias("same_length"),
        F.coalesce(F.max(F.when(b == "prefix", F.abs("row_delta"))), F.lit(0)).alias("worst_row_delta"),
    )


def both_ends(pairs: DataFrame, key: str, n: int) -> DataFrame:
    """At most ``n`` rows: half from each end of ``key``'s order, an odd one from the front."""
    back = n // 2
    front = pairs.orderBy(F.asc(key)).limit(n - back)
    return front.unionByName(pairs.orderBy(F.desc(key)).limit(back)).dropDuplicates([key])


def first_divergence(pairs: DataFrame, a: DataFrame, b: DataFrame, columns: list[str], row_tolerance: int = ROW_TOLERANCE) -> DataFrame:
    """``one, other, compared_rows, first_divergence, differing, ok`` of each pair over the rows both have.

    Rows meet by their place in the episode, as 128-bit digests of their columns, so no vector is shuffled for it; null
    equals null, NaN equals NaN, 0.0 equals -0.0. ``differing`` counts unequal rows; ``ok`` means that none is and that
    the lengths are within the tolerance. Frames that have their ``position`` already keep it.
    """
    sides = []
    for df, name, tag in ((a, "one", "a"), (b, "other", "b")):
        placed = df if "position" in df.columns else positions(df)
        digest = F.struct(*[exact_digest(placed, columns, seed).alias(f"d{seed}") for seed in (1, 2)])
        rows = placed.select(F.col("episode_index").alias(name), "position", digest.alias(tag))
        sides.append(rows.join(pairs.select(name), name, "left_semi"))
    keyed = pairs.select("one", "other").join(sides[0], "one")
    rows = keyed.join(sides[1], ["other", "position"], "full_outer")
    # Rows of the other side beyond the shorter length know their pair by the other's index only.
    back = pairs.select("other", F.col("one").alias("__one"))
    rows = rows.join(back, "other", "left").withColumn("one", F.coalesce("one", "__one"))
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    unequal = both & (F.col("a") != F.col("b"))
    out = rows.groupBy("one", "other").agg(
        F.count_if(both).alias("compared_rows"), F.min(F.when(unequal, F.col("position"))).alias("first_divergence"), F.count_if(unequal).alias("differing"),
        F.abs(F.count("a") - F.count("b")).alias("__apart"))
    return out.withColumn("ok", (F.col("differing") == 0) & (F.col("__apart") <= row_tolerance)).drop("__apart")


def multiset_difference(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """``<column>, a_only, b_only``: how often a value occurs more often on one side than on the other."""
    counts = [d.groupBy(column).agg(F.count(F.lit(1)).alias(n)) for d, n in ((a, "na"), (b, "nb"))]
    both = counts[0].join(counts[1], counts[0][column].eqNullSafe(counts[1][column]), "full_outer")
    na, nb = F.coalesce("na", F.lit(0)), F.coalesce("nb", F.lit(0))
    value = F.coalesce(counts[0][column], counts[1][column]).alias(column)
    return both.filter(na != nb).select(value, F.greatest(na - nb, F.lit(0)).alias("a_only"), F.greatest(nb - na, F.lit(0)).alias("b_only"))


def path_difference(a: DataFrame, b: DataFrame, counts: list[str]) -> DataFrame:
    """``path, bucket, a, b`` of two flattened documents (``path, value``): equal, one-sided, a count, or a difference."""
    both = a.select("path", F.col("value").alias("a"), F.lit(1).alias("ia")).join(b.select("path", F.col("value").alias("b"), F.lit(1).alias("ib")), "path", "full_outer")
    bucket = F.when(F.col("ia").isNull() | F.col("ib").isNull(), "one_sided").when(F.col("a").eqNullSafe(F.col("b")), "equal").when(F.col("path").isin(counts), "counts").otherwise("differences")
    return both.select("path", bucket.alias("bucket"), "a", "b")


def stat_blocks(pairs: DataFrame, a: DataFrame, b: DataFrame, stats: list[str], tolerance: float) -> DataFrame:
    """``feature, stat, seen, bad, worst, zeroed`` over all pairs: how many differ by more than the tolerance, the worst gap
    among them, and whether the other side is zero everywhere. ``a`` and ``b`` have ``episode_index, feature, dim`` and the stats."""
    long = lambda d, key, v: d.select(F.col("episode_index").alias(key), "feature", "dim", F.explode(F.create_map(*[x for s in stats for x in (F.lit(s), F.col(s).cast("double"))])).alias("stat", v))
    rows = pairs.select("one", "other").join(long(a, "one", "x"), "one").join(long(b, "other", "y"), ["other", "feature", "dim", "stat"])
    by_pair = rows.groupBy("one", "feature", "stat").agg(F.max(F.abs(F.col("x") - F.col("y"))).alias("gap"), F.bool_and(F.col("y") == 0).alias("zero"))
    return by_pair.groupBy("feature", "stat").agg(F.count(F.lit(1)).alias("seen"), F.count_if(F.col("gap") > tolerance).alias("bad"), F.coalesce(F.max(F.when(F.col("gap") > tolerance, F.col("gap"))), F.lit(0.0)).alias("worst"), F.bool_and("zero").alias("zeroed"))
