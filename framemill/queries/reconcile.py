"""Queries of problem 3: differences between two copies of data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framemill.operators.set_reconcile import table_differences
from framemill.registry import query, table

FIELDS = ["sampled_at", "state_vec", "action_vec", "gripper", "prompt"]

# Texts that stand for an absent address.
NO_ADDRESS = ["", "-", "n/a"]


def copied_datasets(addresses: DataFrame) -> DataFrame:
    """Datasets that some row gives a source_mirror and some row a delivered_path."""

    def known(c: str) -> Column:
        text = F.regexp_replace(c, r"^\s+|\s+$", "")
        return F.max(F.coalesce(~text.isin(NO_ADDRESS), F.lit(False)))

    both = addresses.filter(F.col("dataset").isNotNull()).groupBy("dataset").agg(known("source_mirror").alias("s"), known("delivered_path").alias("d"))
    return both.filter(F.col("s") & F.col("d")).select("dataset")


def frame_differences(frames: DataFrame, delivered: DataFrame, addresses: DataFrame) -> DataFrame:
    """Findings over the copied datasets: ``episode_index, frame_index, finding``."""
    datasets = copied_datasets(addresses)
    mine, theirs = (x.join(datasets, "dataset", "left_semi") for x in (frames, delivered))
    return table_differences(mine, theirs, ["episode_index", "frame_index"], FIELDS, version="loaded_at", only_left="only_source", only_right="only_delivered")


_CURRENT = """
    SELECT episode_index, frame_index, sampled_at, list_transform(state_vec, lambda x: CASE WHEN x = 0 THEN 0 ELSE x END) AS state_vec,
           list_transform(action_vec, lambda x: CASE WHEN x = 0 THEN 0 ELSE x END) AS action_vec, gripper, prompt, TRUE AS there
    FROM {t} WHERE dataset IN (SELECT dataset FROM copied)
    QUALIFY row_number() OVER (PARTITION BY episode_index, frame_index ORDER BY loaded_at DESC) = 1"""
_FOUND = f"""
    WITH copied AS (
      SELECT dataset FROM addresses GROUP BY dataset
      HAVING bool_or(coalesce(trim(source_mirror) NOT IN ('', '-', 'n/a'), FALSE)) AND bool_or(coalesce(trim(delivered_path) NOT IN ('', '-', 'n/a'), FALSE))),
    a AS ({_CURRENT.format(t="frames")}), b AS ({_CURRENT.format(t="frames_delivered")}),
    j AS (SELECT coalesce(a.episode_index, b.episode_index) AS episode_index, coalesce(a.frame_index, b.frame_index) AS frame_index,
            CASE WHEN a.there IS NULL THEN ['only_delivered'] WHEN b.there IS NULL THEN ['only_source'] ELSE
            [CASE WHEN a.sampled_at IS DISTINCT FROM b.sampled_at THEN 'sampled_at' END,
             CASE WHEN a.state_vec IS DISTINCT FROM b.state_vec THEN 'state_vec' END,
             CASE WHEN a.action_vec IS DISTINCT FROM b.action_vec THEN 'action_vec' END,
             CASE WHEN a.gripper IS DISTINCT FROM b.gripper THEN 'gripper' END,
             CASE WHEN a.prompt IS DISTINCT FROM b.prompt THEN 'prompt' END] END AS findings
          FROM a FULL JOIN b USING (episode_index, frame_index)),
    u AS (SELECT episode_index, frame_index, unnest(findings) AS finding FROM j)"""


@query("p3_found", f"{_FOUND} SELECT * FROM u WHERE finding IS NOT NULL")
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows missing on either side and differing fields, field by field."""
    return frame_differences(*(table(spark, sf_dir, t) for t in ("frames", "frames_delivered", "addresses")))


@query("p3_summary", f"{_FOUND} SELECT finding, count(*) AS n_rows, count(DISTINCT episode_index) AS n_episodes FROM u WHERE finding IS NOT NULL GROUP BY finding")
def p3_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows and episodes each finding concerns."""
    found = p3_found(spark, sf_dir).groupBy("finding", "episode_index").agg(F.count(F.lit(1)).alias("n"))
    return found.groupBy("finding").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_episodes"))
