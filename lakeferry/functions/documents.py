"""Extended-JSON fields: typed ids and epoch-millisecond dates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def typed_id(value: Column) -> Column:
    """The id text of ``{"$type": "oid", "$value": ...}``."""
    return value.getField("$value")


def millis_date(value: Column) -> Column:
    """The timestamp of ``{"$date": epoch millis}``."""
    return F.timestamp_millis(value.getField("$date"))
