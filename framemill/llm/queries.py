"""Queries of the text problems and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framemill.llm.packing import containers
from framemill.llm.tokens import token_ids
from framemill.llm.toxicity import source_rates, toxicity
from framemill.registry import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

CAPACITY = 2048


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@_query
def p5_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return token_ids(table(spark, sf_dir, "documents"))


@_query
def p6_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of every document or piece."""
    return containers(table(spark, sf_dir, "documents"), capacity=CAPACITY)


@_query
def p6_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full each container is."""
    placed = p6_containers(spark, sf_dir).filter("container_id is not null")
    return placed.groupBy("container_id").agg(F.count(F.lit(1)).alias("n_items"), F.sum("n_tokens").alias("n_tokens"), (F.lit(CAPACITY) - F.sum("n_tokens")).alias("unused"))


@_query
def p7_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "doc_labels"))


@_query
def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with abusive, hateful or sexual content."""
    return p7_scores(spark, sf_dir).filter("toxic").select("doc_id")


@_query
def p7_source_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate of such documents by source."""
    return source_rates(p7_scores(spark, sf_dir))
