"""Reconciliation of two tables: one aggregate per side, or row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lakeferry.functions.names import quote
from lakeferry.operators.incremental import orderable

# Sums are exact decimals: a floating sum would depend on the order of rows. Floats are
# rounded for it, so their equality is judged by a sum over hashes of all their digits.
ROWS = "*"
SURPLUS = "_surplus"


def reconcile(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows ``(column_name, measure, left_value, right_value, matches)``.

    Measures are the row count, and per column the non-null count, minimum,
    maximum and, for numbers, the sum; for floating numbers also ``bits``, which
    differs wherever any digit does. A sum that does not fit, or that leaves out
    numbers no decimal can hold, matches nothing. Each table is scanned once.
    """
    both = _measures(left, "left").unionByName(_measures(right, "right"))
    value = lambda side: F.max(F.when(F.col("side") == side, F.col("value")))
    return (
        both.groupBy("column_name", "measure")
        .agg(
            value("left").alias("left_value"),
            value("right").alias("right_value"),
            F.countDistinct("side").alias("sides"),
        )
        .withColumn(
            "matches",
            (F.col("sides") == 2) & F.col("left_value").eqNullSafe(F.col("right_value")),
        )
        .drop("sides")
    )


def _measures(df: DataFrame, side: str) -> DataFrame:
    """All measures of one side as rows; the unpivot works on the one aggregated row."""
    measures: list[tuple[str, str, Column]] = [(ROWS, "rows", F.count(F.lit(1)))]
    for f in df.schema.fields:
        column = F.col(quote(f.name))
        measures.append((f.name, "non_null", F.count(column)))
        if orderable(f.dataType) and isinstance(f.dataType, T.AtomicType):
            measures.append((f.name, "min", F.min(column)))
            measures.append((f.name, "max", F.max(column)))
        if isinstance(f.dataType, T.NumericType):
            measures.append((f.name, "sum", _exact_sum(column, f.dataType, side)))
        if isinstance(f.dataType, T.FractionalType) and not isinstance(f.dataType, T.DecimalType):
            measures.append((f.name, "bits", F.sum(F.when(column.isNotNull(), F.xxhash64(column).cast("decimal(38,0)")))))
    aggregated = df.agg(*[m.cast("string").alias(f"m{i}") for i, (_, _, m) in enumerate(measures)])
    listed = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(measure).alias("measure"),
                F.col(f"m{i}").alias("value"),
            )
            for i, (name, measure, _) in enumerate(measures)
        ]
    )
    return aggregated.select(F.lit(side).alias("side"), F.inline(listed))


def _exact_sum(column: Column, kind: T.DataType, side: str) -> Column:
    scale = max(kind.scale, 6) if isinstance(kind, T.DecimalType) else 6
    summand = f"decimal(38,{scale})"
    held = column.try_cast(summand)
    total = F.when(F.count(held) == F.count(column), F.try_sum(held)).cast("string")
    return F.when(F.count(column) > 0, F.coalesce(total, F.lit(f"not a sum ({side})")))


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows one side has more copies of, with that ``side`` and the surplus ``copies``.

    One aggregate over both sides; copies are combined before the shuffle, and a
    surplus is a number, not so many rows.
    """
    names = [quote(c) for c in left.columns]
    signed = left.withColumn(SURPLUS, F.lit(1)).unionByName(right.withColumn(SURPLUS, F.lit(-1)))
    surplus = F.col(SURPLUS)
    return (
        signed.groupBy(*names)
        .agg(F.sum(SURPLUS).alias(SURPLUS))
        .where(surplus != 0)
        .select(
            *names,
            F.when(surplus > 0, F.lit("left")).otherwise(F.lit("right")).alias("side"),
            F.abs(surplus).alias("copies"),
        )
    )
