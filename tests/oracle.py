"""Compares a registered query with its SQL on the same parquet files."""

from __future__ import annotations

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    columns = sorted(df.columns)
    return columns, [tuple(row) for row in df.select(*columns).collect()]


def sql_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    columns = sorted(names)
    order = [names.index(c) for c in columns]
    return columns, [tuple(row[i] for i in order) for row in result.fetchall()]


def difference(df, connection, sql: str) -> str | None:
    """What differs, or None."""
    ours, theirs = spark_rows(df), sql_rows(connection, sql)
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    left, right = sorted(map(repr, ours[1])), sorted(map(repr, theirs[1]))
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    odd = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(odd)} of {len(left)} rows differ, first {odd[0][0][:300]} != {odd[0][1][:300]}" if odd else None
