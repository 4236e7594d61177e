"""Derive functions, their date patterns, and pruning on derived partitions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lakeferry.functions.names import quote

# Derive function -> date pattern.
DERIVE_FORMATS = {
    "day num in month": "dd",
    "month": "MM",
    "year": "yyyy",
    "year month": "yyyyMM",
    "month day": "MMdd",
    "year month day": "yyyyMMdd",
}

# Patterns whose text order is the order of the parent date, with the length of
# the ISO date digits they keep.
ORDERED_FORMATS = {"yyyy": 4, "yyyyMM": 6, "yyyyMMdd": 8}


def spaced(function: Column) -> Column:
    """Derive function with hyphens read as blanks."""
    return F.replace(function, F.lit("-"), F.lit(" "))


def derive_format(function: Column) -> Column:
    """Date pattern of a derive function; null when the function is not known."""
    pairs = [F.lit(part) for item in DERIVE_FORMATS.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), F.trim(spaced(function)))


def derived_value(df: DataFrame, parent: str, fmt: str) -> Column:
    """``parent`` under a date pattern, as text.

    Every pattern is day-grained, so a timestamp without zone goes through its
    date: the value then never meets a daylight-saving gap of the session zone.
    """
    if fmt not in DERIVE_FORMATS.values():
        raise ValueError(f"unsupported derive format {fmt!r}")
    column = F.col(quote(parent))
    if isinstance(df.schema[parent].dataType, T.TimestampNTZType):
        column = column.cast("date")
    return F.date_format(column, fmt)


def add_derived_partitions(df: DataFrame, specs: list[tuple[str, str, str]]) -> DataFrame:
    """Add ``(parent_column, derive_format, partition_column)`` columns."""
    return df.withColumns({name: derived_value(df, parent, fmt) for parent, fmt, name in specs})


def where_parent_between(
    df: DataFrame, spec: tuple[str, str, str], lo: dt.datetime, hi: dt.datetime
) -> DataFrame:
    """Rows with ``lo <= parent <= hi``, with the implied predicate on the derived partition.

    Catalyst cannot infer a partition filter from a filter on the parent column.
    Only patterns that keep the date order allow one; for the cyclic patterns
    (month, day) nothing is added. A parent with time zone must be read under
    the session zone its partition was written with.
    """
    parent, fmt, partition = spec
    kind = df.schema[parent].dataType
    bounds = [F.lit(bound.isoformat(sep=" ")).cast(kind) for bound in (lo, hi)]
    kept = df.where(F.col(quote(parent)).between(*bounds))
    digits = ORDERED_FORMATS.get(fmt)
    if digits is None:
        return kept
    first, last = (bound.date().isoformat().replace("-", "")[:digits] for bound in (lo, hi))
    return kept.where(F.col(quote(partition)).between(first, last))
