"""Identifier quoting and column-name checks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

from pyspark.sql import DataFrame


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def qualified(database: str, table: str) -> str:
    return f"{quote(database)}.{quote(table)}"


def case_sensitive(df: DataFrame) -> bool:
    return df.sparkSession.conf.get("spark.sql.caseSensitive", "false").lower() == "true"


def folded(df: DataFrame, name: str) -> str:
    """``name`` as the session's resolver compares it."""
    return name if case_sensitive(df) else name.lower()


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    present = {folded(df, c) for c in df.columns}
    missing = [n for n in names if folded(df, n) not in present]
    if missing:
        raise ValueError(f"missing columns {missing}; table has {df.columns}")


def require_distinct(df: DataFrame, names: Iterable[str]) -> None:
    counts = Counter(folded(df, n) for n in names)
    twice = sorted(n for n, count in counts.items() if count > 1)
    if twice:
        raise ValueError(f"column names would collide: {twice}")
