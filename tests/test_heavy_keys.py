"""Per-key totals: evenness, repeats, nulls, empties, clashing names."""

from __future__ import annotations

from pyspark.sql import functions as F

from framemill.operators.heavy_keys import key_totals
from framemill.queries.heavy import heavy_keys

SCHEMA = "k string, id bigint, n bigint"


def rows(df):
    return {r["key_value"]: (r["n_rows"], r["total"]) for r in df.collect()}


def test_repeats_nulls_and_ties(spark):
    data = [("a", 1, 5), ("a", 1, 5), ("a", 2, None), (None, 3, 7), (None, 3, 7), ("", None, 1), ("b", None, None), ("b", 4, None)]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(key_totals(df, F.col("k"), ["id"], {"total": F.col("n")})) == {"a": (2, 5), None: (1, 7), "": (1, 1), "b": (2, None)}


def test_rows_that_differ_only_in_which_column_is_null_are_not_repeats(spark):
    df = spark.createDataFrame([("a", 5, None), ("a", None, 5)], SCHEMA)
    assert rows(key_totals(df, F.col("k"), ["id"], {"total": F.col("n")})) == {"a": (2, 5)}


def test_repeats_count_when_asked(spark):
    df = spark.createDataFrame([("a", 1, 5)] * 3, SCHEMA)
    assert rows(key_totals(df, F.col("k"), ["id"], {"total": F.col("n")}, distinct_rows=False)) == {"a": (3, 15)}


def test_empty_table(spark):
    assert key_totals(spark.createDataFrame([], SCHEMA), F.col("k"), ["id"], {"total": F.col("n")}).count() == 0


def test_clashing_names_and_other_columns(spark):
    df = spark.createDataFrame([("a", 1, 2, {"x": 1}, "p"), ("a", 1, 2, {"x": 2}, "p")], "key_value string, digest bigint, order_0 bigint, sum_0 map<string,bigint>, piece string")
    out = key_totals(df, F.col("key_value"), ["order_0"], {"total": F.col("digest")})
    assert rows(out) == {"a": (2, 2)}


def test_a_heavy_key_is_split(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.concat(F.lit("k"), F.col("id") % 50)).otherwise("hot").alias("k"), "id", F.lit(1).alias("n"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = {r["key_value"]: r for r in key_totals(df, F.col("k"), ["id"], {"total": F.col("n")}).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert out["hot"]["pieces"] >= 4
    assert out["hot"]["n_rows"] == out["hot"]["total"] == sum(1 for i in range(20_000) if i % 3)


def test_share_at_the_limit(spark):
    totals = spark.createDataFrame([("a", 3), ("b", 2), (None, 95)], "key_value string, n bigint")
    assert [r["key_value"] for r in heavy_keys(totals, "f", "n").collect()] == ["a"]


def test_very_long_key(spark):
    df = spark.createDataFrame([("x" * 200_000, 1, 1), ("x" * 200_000, 2, 1)], SCHEMA)
    assert [r["n_rows"] for r in key_totals(df, F.col("k"), ["id"]).collect()] == [2]
