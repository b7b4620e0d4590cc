"""Queries of problem 2: records matched by nearest time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framemill.operators.nearest_time import nearest_within
from framemill.registry import query, table

#: The widest distance of a pair, in microseconds.
TOLERANCE_US = 25_000


def shot_frames(frames: DataFrame, shots: DataFrame, tolerance_us: int = TOLERANCE_US) -> DataFrame:
    """The nearest frame of each shot: ``frame_id, shot_id, distance_us``."""
    return nearest_within(
        frames, shots, entity=("episode_index", "episode_index"), time=("sampled_at", "shot_at"),
        rank="frame_index", point_id="frame_id", query_id="shot_id", tolerance_us=tolerance_us,
    )


_NEAREST = """
    WITH f AS (SELECT DISTINCT episode_index, epoch_us(sampled_at) AS t, frame_index, frame_id FROM frames
               WHERE sampled_at IS NOT NULL AND episode_index IS NOT NULL),
    s AS (SELECT DISTINCT shot_id, episode_index, epoch_us(shot_at) AS t FROM video_shots WHERE shot_at IS NOT NULL),
    c AS (SELECT s.shot_id, s.t, f.frame_id, f.frame_index, abs(f.t - s.t) AS distance_us
          FROM s JOIN f ON f.episode_index = s.episode_index AND f.t BETWEEN s.t - 25000 AND s.t + 25000),
    r AS (SELECT *, row_number() OVER (PARTITION BY shot_id, t ORDER BY distance_us, frame_index DESC, frame_id DESC) AS n FROM c)
    SELECT DISTINCT frame_id, shot_id{more} FROM r WHERE n = 1"""


@query("p2_found", _NEAREST.format(more=""))
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of every shot with its nearest frame within 25 ms."""
    return shot_frames(table(spark, sf_dir, "frames"), table(spark, sf_dir, "video_shots")).select("frame_id", "shot_id")


@query("p2_pairs", _NEAREST.format(more=", distance_us"))
def p2_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pairs with their distance."""
    return shot_frames(table(spark, sf_dir, "frames"), table(spark, sf_dir, "video_shots"))
