"""Queries of problem 1: a few keys hold most records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framemill.operators.heavy_keys import key_totals
from framemill.registry import query, table
from framemill.session import cut_lineage

#: A key is a case from this share of its table on, in percent.
HEAVY_PERCENT = 3

_SPELLED = "replace(replace(lower(trim(dataset)), ' ', '_'), '-', '_')"


def dataset_totals(candidates: DataFrame) -> DataFrame:
    """Rows and the sum of positive episodes by dataset, spellings brought together; the null dataset keeps its row."""
    spelled = F.translate(F.lower(F.regexp_replace("dataset", r"^\s+|\s+$", "")), " -", "__")
    return key_totals(candidates, spelled, ["plan_id", "slot"], {"episodes": F.when(F.col("episodes") > 0, F.col("episodes"))})


def task_totals(refs: DataFrame) -> DataFrame:
    """Rows by task as it stands; null and the empty task keep their rows."""
    return key_totals(refs, F.col("task"), ["ref_id"])


def heavy_keys(totals: DataFrame, field: str, measure: str, percent: int = HEAVY_PERCENT) -> DataFrame:
    """Keys of ``totals`` that hold at least ``percent`` of ``measure`` over all keys; null and empty keys only count in the total."""
    whole = totals.agg(F.sum(F.col(measure).cast("decimal(38,0)"))).scalar()
    share = F.col(measure).cast("decimal(38,0)") * 100 >= whole * percent
    return totals.filter(share & F.col("key_value").isNotNull() & (F.col("key_value") != "") & (F.col(measure) > 0)).select(F.lit(field).alias("field"), "key_value")


_TOTALS = f"""
    SELECT 'candidates.dataset' AS field, {_SPELLED} AS key_value, count(*) AS n_rows,
           CAST(sum(CASE WHEN episodes > 0 THEN episodes END) AS BIGINT) AS episodes
    FROM (SELECT DISTINCT * FROM candidates) GROUP BY ALL
    UNION ALL
    SELECT 'episode_refs.task', task, count(*), CAST(NULL AS BIGINT) FROM (SELECT DISTINCT * FROM episode_refs) GROUP BY ALL"""


@query("p1_key_totals", _TOTALS)
def p1_key_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-key results of both tables, every key."""
    by_dataset = dataset_totals(table(spark, sf_dir, "candidates"))
    by_task = task_totals(table(spark, sf_dir, "episode_refs"))
    none = F.lit(None).cast("bigint").alias("episodes")
    return by_dataset.select(F.lit("candidates.dataset").alias("field"), "key_value", "n_rows", "episodes").unionByName(
        by_task.select(F.lit("episode_refs.task").alias("field"), "key_value", "n_rows", none)
    )


@query(
    "p1_found",
    f"""
    WITH t AS ({_TOTALS}),
    w AS (SELECT field, sum(n_rows) AS all_rows, sum(episodes) AS all_episodes FROM t GROUP BY field)
    SELECT field, key_value FROM t JOIN w USING (field) WHERE key_value <> '' AND n_rows * 100 >= all_rows * 3
    UNION ALL
    SELECT 'candidates.episodes', key_value FROM t JOIN w USING (field)
    WHERE field = 'candidates.dataset' AND key_value <> '' AND episodes * 100 >= all_episodes * 3""",
)
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that hold at least 3 % of their table."""
    by_dataset = cut_lineage(dataset_totals(table(spark, sf_dir, "candidates")))
    by_task = cut_lineage(task_totals(table(spark, sf_dir, "episode_refs")))
    return (
        heavy_keys(by_dataset, "candidates.dataset", "n_rows")
        .unionByName(heavy_keys(by_dataset, "candidates.episodes", "episodes"))
        .unionByName(heavy_keys(by_task, "episode_refs.task", "n_rows"))
    )
