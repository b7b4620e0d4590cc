"""Views of the tables that several queries share, each with its SQL counterpart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framemill.functions.rowhash import row_digest
from framemill.registry import table

#: SQL: the current row of every (episode_index, frame_index). A join, as an engine may turn a numbering of which only the
#: first is kept into an aggregate that takes -0.0 for 0.0; here and in ``newest`` vectors come out bit by bit.
CURRENT_FRAMES = """(SELECT DISTINCT c.* FROM {t} c JOIN (SELECT episode_index, frame_index, max(loaded_at) AS loaded_at FROM {t} GROUP BY ALL) m
    ON c.episode_index IS NOT DISTINCT FROM m.episode_index AND c.frame_index IS NOT DISTINCT FROM m.frame_index AND c.loaded_at IS NOT DISTINCT FROM m.loaded_at)"""
FRAMES_SQL = CURRENT_FRAMES.format(t="frames")
DELIVERED_SQL = CURRENT_FRAMES.format(t="frames_delivered")


def newest(df: DataFrame, key: list[str], version: str, columns: list[str]) -> DataFrame:
    """The row with the largest ``version`` of each key, combined before the shuffle; among equal versions the one with the larger digest."""
    kept = [c for c in columns if c not in key]
    if not kept:
        return df.select(*key).dropDuplicates()
    best = F.max_by(F.struct(*kept), F.struct(version, row_digest(df, *kept)))
    return df.groupBy(*key).agg(best.alias("newest_row")).select(*key, *[F.col(f"newest_row.{c}").alias(c) for c in kept])


def frames(spark: SparkSession, sf_dir: str, *columns: str, name: str = "frames") -> DataFrame:
    """The current frames with the named columns besides the key."""
    return newest(table(spark, sf_dir, name), ["episode_index", "frame_index"], "loaded_at", ["episode_index", "frame_index", *columns])
