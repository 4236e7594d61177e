"""Compare registered queries with their SQL in DuckDB, value by value."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return float(f"{value:.12g}")
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def bag(rows, names) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(df, connection, sql: str) -> str | None:
    """None when both agree; else a description of the difference."""
    result = connection.execute(sql)
    expected_names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(df.columns) != sorted(expected_names):
        return f"columns {sorted(df.columns)} != {sorted(expected_names)}"
    rows = df.collect()
    got, want = bag(rows, df.columns), bag(expected, expected_names)
    if got != want:
        extra, lacking = list((got - want).items())[:2], list((want - got).items())[:2]
        return f"{len(rows)} rows, expected {len(expected)}; extra {extra}; lacking {lacking}"
    return None
