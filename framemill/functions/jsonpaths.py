"""Nested JSON documents as dotted paths, and back."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _paths(value: object, at: str = "") -> Iterator[tuple[str, str]]:
    if isinstance(value, dict) and (value or not at):
        for k, v in value.items():
            yield from _paths(v, f"{at}.{k}" if at else k)
    else:
        yield at, json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def flatten_json(df: DataFrame, key: str, column: str) -> DataFrame:
    """``<key>, path, value``: every leaf of a JSON text, its path with dots and its value as compact JSON.

    Lists and empty objects are leaves. Text that isn't JSON, null and a bare leaf give no rows.
    """
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, paths, values = [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                try:
                    document = json.loads(text) if text else None
                except ValueError:
                    continue
                if not isinstance(document, dict):
                    continue
                for p, v in _paths(document):
                    at.append(i)
                    paths.append(p)
                    values.append(v)
            yield pa.record_batch([batch.column(0).take(pa.array(at, pa.int64())), pa.array(paths, pa.string()), pa.array(values, pa.string())], names=[key, "path", "value"])

    return df.select(key, F.col(column)).mapInArrow(run, f"`{key}` {kind}, path string, value string")


def unflatten(rows: DataFrame, key: str, separator: str = "/") -> DataFrame:
    """``<key>, document``: JSON of one level of nesting from ``path`` (outer/inner) and DOUBLE ``value`` rows."""
    parts = F.split("path", separator)
    inner = rows.withColumn("o", F.get(parts, F.lit(0))).withColumn("i", F.get(parts, F.lit(1)))
    level = inner.groupBy(key, "o").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("i", "value")))).alias("m"))
    return level.groupBy(key).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("o"), F.to_json("m").alias("v")))))).alias("document"))
