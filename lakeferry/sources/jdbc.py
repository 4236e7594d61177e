"""Split-parallel JDBC reads."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakeferry.functions.names import quote


@dataclass(frozen=True)
class RangeSplit:
    """A plain split column: equal-width ranges between two bounds."""

    column: str
    lower: str
    upper: str
    partitions: int


@dataclass(frozen=True)
class BoundSplit:
    """A plain split column: ranges between given bounds, such as ``quantile_bounds``.

    Bounds are SQL literals in ascending order; rows below the first, above the last,
    and with a null belong to a range too.
    """

    column: str
    bounds: tuple[str, ...]


@dataclass(frozen=True)
class PeriodSplit:
    """A date-derived split: one predicate per period of the parent column.

    ``lower`` and ``upper`` only shape the periods; rows outside them, and rows
    with a null parent, still belong to exactly one predicate.
    """

    parent: str
    fmt: str
    lower: dt.date
    upper: dt.date


@dataclass(frozen=True)
class Dialect:
    """How a database writes parts of a date and a point in time."""

    month: str
    day: str
    moment: str


STANDARD = Dialect("EXTRACT(MONTH FROM {})", "EXTRACT(DAY FROM {})", "TIMESTAMP '{} {}'")
SQL_SERVER = Dialect("MONTH({})", "DAY({})", "CAST('{}T{}' AS datetime2)")


def dialect(url: str) -> Dialect:
    """SQL Server has no ``EXTRACT`` and no ``TIMESTAMP`` literal; the others split here have both."""
    return SQL_SERVER if url.startswith("jdbc:sqlserver:") else STANDARD


def read_jdbc_split(
    spark: SparkSession, options: Mapping[str, str], split: RangeSplit | BoundSplit | PeriodSplit
) -> DataFrame:
    """Read ``options["dbtable"]`` with one task per range or period.

    Filters on the result, such as the incremental one, are pushed to the database.
    """
    if isinstance(split, RangeSplit):
        return (
            spark.read.format("jdbc")
            .options(**options)
            .option("partitionColumn", split.column)
            .option("lowerBound", split.lower)
            .option("upperBound", split.upper)
            .option("numPartitions", split.partitions)
            .load()
        )
    rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    predicates = (
        bound_predicates(split) if isinstance(split, BoundSplit) else period_predicates(split, dialect(options["url"]))
    )
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=predicates, properties=rest)


def quantile_bounds(df: DataFrame, column: str, partitions: int, where: Dialect = STANDARD) -> BoundSplit:
    """Ranges with about the same number of rows each, by approximate quantiles of ``df``.

    Ranges of equal width leave most rows of a skewed key to one task. ``df`` may be any
    table with the key's values, such as the copy landed by the last load. Quantiles are
    off by less than a hundredth of a range; a single value stays in one range.
    """
    kind = df.schema[column].dataType
    shares = [i / partitions for i in range(1, partitions)]
    if not shares:
        return BoundSplit(column, ())
    # Points in time are ordered by their microseconds since 1970, which are numbers like any key.
    timed = isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType))
    value = F.unix_micros(F.col(quote(column)).cast("timestamp")) if timed else F.col(quote(column))
    found = df.agg(F.percentile_approx(value, shares, F.lit(100 * partitions)).alias("q")).first()["q"] or []
    literals = [_number_or_moment(x, timed, where) for x in sorted(set(found))]
    return BoundSplit(column, tuple(literals))


def _number_or_moment(value: object, timed: bool, where: Dialect) -> str:
    if not timed:
        return str(value)
    moment = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=int(value))
    return where.moment.format(moment.date().isoformat(), moment.time().isoformat(timespec="microseconds"))


def bound_predicates(split: BoundSplit) -> list[str]:
    """Disjoint SQL conditions that together take every row."""
    c, bounds = split.column, split.bounds
    if not bounds:
        return ["1 = 1"]
    return [
        f"{c} < {bounds[0]} OR {c} IS NULL",
        *[f"{c} >= {a} AND {c} < {b}" for a, b in zip(bounds, bounds[1:])],
        f"{c} >= {bounds[-1]}",
    ]


def period_predicates(split: PeriodSplit, where: Dialect = STANDARD) -> list[str]:
    """Disjoint SQL conditions that together take every row."""
    month, day = where.month.format(split.parent), where.day.format(split.parent)
    cyclic = {
        "MM": [f"{month} = {m}" for m in range(1, 13)],
        "dd": [f"{day} = {d}" for d in range(1, 32)],
        "MMdd": [f"{month} = {m} AND {day} = {d}" for m in range(1, 13) for d in range(1, _longest_month(m) + 1)],
    }
    if split.fmt in cyclic:
        return cyclic[split.fmt] + [f"{split.parent} IS NULL"]
    starts = [where.moment.format(d.isoformat(), "00:00:00") for d in _period_starts(split)]
    # Ranges on the bare column, so that the database can use an index on it.
    return bound_predicates(BoundSplit(split.parent, tuple(starts)))


def _longest_month(month: int) -> int:
    following = dt.date(2000 + month // 12, month % 12 + 1, 1)
    return (following - dt.timedelta(days=1)).day


def _period_starts(split: PeriodSplit) -> list[dt.date]:
    steps = {
        "yyyy": lambda d: dt.date(d.year + 1, 1, 1),
        "yyyyMM": lambda d: dt.date(d.year + d.month // 12, d.month % 12 + 1, 1),
        "yyyyMMdd": lambda d: d + dt.timedelta(days=1),
    }
    if split.fmt not in steps:
        raise ValueError(f"unsupported derive format {split.fmt!r}")
    if split.lower > split.upper:
        raise ValueError(f"empty period range {split.lower} .. {split.upper}")
    first = {
        "yyyy": split.lower.replace(month=1, day=1),
        "yyyyMM": split.lower.replace(day=1),
        "yyyyMMdd": split.lower,
    }[split.fmt]
    starts = [first]
    while starts[-1] <= split.upper:
        starts.append(steps[split.fmt](starts[-1]))
    return starts
