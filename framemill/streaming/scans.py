"""Ordered scans over unbounded input, beyond what the batch operators cover."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def windowed_totals(events: DataFrame, time: str, key: str, value: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """``start, <key>, n, total`` of tumbling windows; rows later than ``late`` behind the newest are dropped."""
    stamped = events.withColumn("__t", F.col(time).cast("timestamp")).withWatermark("__t", late)
    out = stamped.groupBy(F.window("__t", width), key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("window.start").alias("start"), key, "n", "total")


def distinct_rows(events: DataFrame, time: str, keys: list[str], late: str = "2 hours") -> DataFrame:
    """Rows delivered more than once come out once, within the watermark."""
    return events.withColumn("__t", F.col(time).cast("timestamp")).withWatermark("__t", late).dropDuplicatesWithinWatermark(keys).drop("__t")


def carried_gripper(frames: DataFrame, action: str) -> DataFrame:
    """``episode_index, frame_index, gripper_abs``: absolute gripper states from relative actions, as frames arrive in order.

    The state of an episode is its last switch. What comes before the first switch counts as open, as a stream can't
    look ahead. Frames of one micro-batch are put in order first; an episode's batch is small beside the stream.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values("frame_index")
        now = state.get[0] if state.exists else 1
        out = []
        for a in rows[action].tolist():
            now = 1 if a is not None and a < -0.1 else -1 if a is not None and a > 0.1 else now
            out.append(now / 2 + 0.5)
        state.update((now,))
        yield pd.DataFrame({"episode_index": key[0], "frame_index": rows["frame_index"].to_numpy(), "gripper_abs": out})

    kept = frames.select("episode_index", "frame_index", action)
    return kept.groupBy("episode_index").applyInPandasWithState(step, "episode_index bigint, frame_index bigint, gripper_abs double", "now int", "append", GroupStateTimeout.NoTimeout)


def rate_drift_batches(rates: DataFrame, median: float, threshold: float, sink: str, checkpoint: str):
    """A running query that appends episodes whose rate drifts from a known median to a Parquet table, batch by batch."""

    def keep(batch: DataFrame, number: int) -> None:
        drift = F.abs(F.col("fps") - F.lit(median)) / F.lit(median)
        batch.filter(drift > threshold).withColumn("drift", drift).withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    return rates.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
