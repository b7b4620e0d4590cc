"""Ordered greedy grouping: files into destinations, datasets into batches.

The rules take one item after the other, so a group is walked in order; that happens as a stream over sorted batches
with a few numbers of state, whatever the group's size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _walk(df: DataFrame, group: list[str], order: list[str], sizes: list[str], start: Callable[[], list], step: Callable[[list, list[np.ndarray]], np.ndarray]) -> DataFrame:
    """``df`` with BIGINT ``bin``: ``step`` takes the state and a stretch of one group's sizes, and gives their bins."""
    keyed = df.withColumn("__g", F.struct(*group) if group else F.lit(0)).withColumn("__h", F.xxhash64("__g", *group) if group else F.lit(0).cast("bigint"))
    columns = [c for c in keyed.columns if c not in ("__g", "__h")]
    ready = keyed.drop("__g").repartition("__h").sortWithinPartitions("__h", *group, *order)
    names = ready.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, start()
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            marks = np.zeros(n, bool)
            keys = [batch.column(names.index(g)) for g in group]
            for k in keys:
                codes = k.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
                marks[1:] |= codes[1:] != codes[:-1]
            begins = [0, *np.flatnonzero(marks).tolist(), n]
            values = [batch.column(names.index(s)).cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False) for s in sizes]
            bins = np.zeros(n, np.int64)
            for a, b in zip(begins, begins[1:], strict=False):
                if a == b:
                    continue
                mine = tuple(k[a].as_py() for k in keys)
                if mine != last:
                    last, state = mine, start()
                bins[a:b] = step(state, [v[a:b] for v in values])
            yield pa.record_batch([*[batch.column(names.index(c)) for c in columns], pa.array(bins)], names=[*columns, "bin"])

    schema = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    return ready.mapInArrow(run, f"{schema}, bin bigint")


def destinations(df: DataFrame, group: list[str], order: list[str], size: str, cap: float) -> DataFrame:
    """``df`` with ``bin``: the destination of each source within its group.

    A destination takes its first source whatever its size, and another one as long as the sum stays below ``cap``.
    A null size counts as 0. ``order`` must be unique within a group for the result to be defined.
    """

    def step(state: list, sizes: list[np.ndarray]) -> np.ndarray:
        out = np.empty(len(sizes[0]), np.int64)
        for i, s in enumerate(sizes[0].tolist()):
            if state[2] and state[1] + s >= cap:
                state[0] += 1
                state[1] = 0.0
            state[1] += s
            state[2] = True
            out[i] = state[0]
        return out

    return _walk(df, group, order, [size], lambda: [0, 0.0, False], step)


def batches(df: DataFrame, group: list[str], order: list[str], episodes: str, most: int, target: int) -> DataFrame:
    """``df`` with ``bin``: batches of at most ``most`` datasets that close when they reach ``target`` episodes.

    A dataset that reaches the target alone is a batch of its own and closes the one being filled. An unknown (null)
    count adds nothing. Negative counts are refused.
    """
    if most < 1 or target < 1:
        raise ValueError("a batch needs room for a dataset and for an episode")

    def step(state: list, sizes: list[np.ndarray]) -> np.ndarray:
        out = np.empty(len(sizes[0]), np.int64)
        for i, s in enumerate(sizes[0].tolist()):
            if s < 0:
                raise ValueError("episodes must not be negative")
            if s >= target:
                if state[1]:
                    state[0] += 1
                out[i] = state[0]
                state[:] = [state[0] + 1, 0, 0.0]
                continue
            out[i] = state[0]
            state[1] += 1
            state[2] += s
            if state[1] >= most or state[2] >= target:
                state[:] = [state[0] + 1, 0, 0.0]
        return out

    return _walk(df, group, order, [episodes], lambda: [0, 0, 0.0], step)
