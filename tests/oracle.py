"""Comparison of a query with its SQL counterpart on the same files."""

from __future__ import annotations

import math
import os

import duckdb


def connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in sorted(os.listdir(folder)):
        path = f"{folder}/{name}" + ("/*.parquet" if os.path.isdir(f"{folder}/{name}") else "")
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if hasattr(value, "asDict"):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(plain(v) for v in value.values())
    if isinstance(value, list | tuple):
        return tuple(plain(v) for v in value)
    return value


def assert_same(df, con: duckdb.DuckDBPyConnection, sql: str) -> None:
    columns = sorted(df.columns)
    ours = sorted(repr(tuple(plain(v) for v in row)) for row in df.select(*[f"`{c}`" for c in columns]).collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    theirs = sorted(repr(tuple(plain(row[i]) for i in order)) for row in cursor.fetchall())
    assert sorted(names) == columns
    assert ours == theirs
