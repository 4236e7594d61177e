"""Watermarks that mean the same in every session: a value with its type and its zone."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, TimestampType

from lakeferry.functions.names import quote

STRUCT = "struct<type:string,value:string,zone:string>"


@dataclass(frozen=True)
class Watermark:
    """``type`` is Spark's name of the column's type; ``zone`` is set for zoned timestamps only.

    Values of zoned timestamps are UTC and say so (``2024-01-01 10:00:00.000000Z``).
    """

    type: str
    value: str
    zone: str | None = None

    def bound(self, kind: DataType) -> Column:
        """The value as a literal of a column's type, which must be the watermark's own.

        Whole numbers and decimals of any width stand for each other; a zoned and a
        zoneless timestamp do not, since no session's zone could be the right one.
        """
        if family(self.type) != family(kind.simpleString()):
            raise ValueError(f"a watermark of type {self.type} cannot bound a column of type {kind.simpleString()}")
        return F.lit(self.value).cast(kind)


def family(type_name: str) -> str:
    """Types whose values are compared without a conversion that loses anything."""
    if type_name in ("tinyint", "smallint", "int", "bigint") or type_name.startswith("decimal"):
        return "number"
    if type_name in ("float", "double"):
        return "floating"
    return "text" if type_name.startswith(("string", "char", "varchar")) else type_name


def watermark_text(column: Column, kind: DataType) -> Column:
    """A value as text that means the same in every session."""
    if not isinstance(kind, TimestampType):
        return column.cast("string")
    # Through a timestamp without zone: the session's own has hours that some instants cannot be shown in.
    seconds = (F.unix_micros(column).cast("decimal(38,0)") / 1_000_000).cast("decimal(18,6)")
    zero = F.lit(0)
    moment = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)
    shown = moment.cast("string")
    micros = F.when(F.instr(shown, ".") > 0, F.rpad(shown, 26, "0")).otherwise(F.concat(shown, F.lit(".000000")))
    return F.concat(micros, F.lit("Z"))


def watermark_struct(column: Column, kind: DataType) -> Column:
    """``STRUCT`` of a value; null for a null."""
    zone = F.lit("UTC" if isinstance(kind, TimestampType) else None).cast("string")
    parts = F.struct(
        F.lit(kind.simpleString()).alias("type"), watermark_text(column, kind).alias("value"), zone.alias("zone")
    )
    return F.when(column.isNotNull(), parts)


def literal(mark: Watermark | None) -> Column:
    if mark is None:
        return F.lit(None).cast(STRUCT)
    return F.struct(*[F.lit(v).cast("string").alias(n) for n, v in vars(mark).items()])


def given(spark: SparkSession, value: str | Watermark | None, kind: DataType) -> Watermark | None:
    """A watermark given as text, of a column's type; text without a zone is in the session's zone."""
    if value is None or value == "" or isinstance(value, Watermark):
        return value or None
    found = spark.range(1).select(watermark_struct(F.lit(value).cast(kind), kind)).first()[0]
    return Watermark(*found)


def typed_watermark(df: DataFrame, watermark: str, last: str | Watermark | None = None) -> DataFrame:
    """One row: the highest watermark as ``STRUCT``, the former one where ``df`` has none."""
    kind = df.schema[watermark].dataType
    reached = watermark_struct(F.max(quote(watermark)), kind)
    return df.agg(F.coalesce(reached, literal(given(df.sparkSession, last, kind))).alias("watermark"))


def reached(df: DataFrame, watermark: str) -> Watermark | None:
    """The highest watermark of ``df``; reads that one column."""
    found = typed_watermark(df, watermark).first()[0]
    return Watermark(*found) if found else None
