"""Incremental loads: watermark filter, latest rows, merge, views.

Order within a key: later watermark first, null watermark last, then the
tie-break columns, then all remaining columns, so that a result never depends
on how rows were partitioned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from lakeferry.functions.columns import to_boolean
from lakeferry.functions.names import quote, require_columns
from lakeferry.operators.watermarks import Watermark, typed_watermark

RANK = "_rank"
ORIGIN = "_origin"
HIT = "_hit"


def incremental_filter(
    df: DataFrame, watermark: str, last: str | Watermark | None, upto: Watermark | None = None
) -> DataFrame:
    """Rows strictly after the last ingested value; all rows when there is none.

    The value is cast to the column's own type, so the predicate is pushed to the
    scan. Text of a timestamp without a zone is in the session's zone; a ``Watermark``
    means the same in all of them. ``upto`` is the last value still taken: a source that
    grows meanwhile then gives the same rows however often a part of it is read.
    """
    column, kind = F.col(quote(watermark)), df.schema[watermark].dataType
    after = last is not None and last != ""
    if after:
        df = df.where(column > (last.bound(kind) if isinstance(last, Watermark) else F.lit(last).cast(kind)))
    if upto is not None:
        within = column <= upto.bound(kind)
        # Without a last value rows that have no watermark are taken too.
        df = df.where(within if after else within | column.isNull())
    return df


def high_watermark(df: DataFrame, watermark: str, last: str | Watermark | None = None) -> DataFrame:
    """The highest watermark as text (``typed_watermark`` has type and zone too); the former one when ``df`` has none."""
    return typed_watermark(df, watermark, last).select(F.col("watermark.value").alias("high_watermark"))


def orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(orderable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def recency(df: DataFrame, keys: Sequence[str], leading: Sequence[str]) -> list[Column]:
    """Sort order, latest first; ``leading`` columns before all other non-key ones."""
    rest = [
        f.name
        for f in df.schema.fields
        if f.name not in leading and f.name not in keys and orderable(f.dataType)
    ]
    return [F.col(quote(c)).desc_nulls_last() for c in [*leading, *rest]]


def latest_per_key(
    df: DataFrame, keys: Sequence[str], watermark: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The latest row of every key.

    ``row_number() = 1`` makes Spark cut every key to one row in each task
    before the shuffle (a partial window group limit) and again after it, so a
    key holding most rows sends one row per input task.
    """
    return _first_per_key(df, keys, [watermark, *tiebreak])


def _first_per_key(df: DataFrame, keys: Sequence[str], leading: Sequence[str]) -> DataFrame:
    return df.withColumn(RANK, rank(df, keys, leading)).where(F.col(RANK) == 1).drop(RANK)


def rank(df: DataFrame, keys: Sequence[str], leading: Sequence[str]) -> Column:
    """Position of a row within its key, latest first."""
    require_columns(df, [*keys, *leading])
    newest_first = Window.partitionBy(*[quote(k) for k in keys]).orderBy(
        *recency(df, keys, leading)
    )
    return F.row_number().over(newest_first)


def has_null_key(df: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(False)
    for key in keys:
        condition = condition | df[quote(key)].isNull()
    return condition


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a complete natural key, and the others."""
    condition = has_null_key(df, keys)
    return df.where(~condition), df.where(condition)


def require_total_order(
    df: DataFrame, keys: Sequence[str], watermark: str, tiebreak: Sequence[str] = ()
) -> None:
    """Raise when two rows of a key tie on watermark and tie-break.

    Runs a job. Ties are still resolved by the other columns without it.
    """
    columns = [quote(c) for c in (*keys, watermark, *tiebreak)]
    tied = df.groupBy(*columns).count().where(F.col("count") > 1)
    if not tied.isEmpty():
        raise ValueError(f"rows of a key tie on {[watermark, *tiebreak]}")


def merge_upsert(
    base: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    watermark: str,
    tiebreak: Sequence[str] = (),
    base_unique: bool = False,
    delta_unique: bool = False,
) -> DataFrame:
    """The latest row per natural key over both inputs; equal watermarks favour ``delta``.

    Late delta rows lose; deletes are tombstone rows and stay. Delta rows with a
    null key are not merged (see ``split_null_keys``), such base rows pass through.

    ``base_unique`` states that the base holds one row per key, as every merged
    table does. Then the base is only joined: Spark broadcasts a small delta, and
    the base is neither shuffled nor sorted. Otherwise both are shuffled by key.
    ``delta_unique`` spares reducing a delta that is reduced already.
    """
    require_columns(base, [*keys, watermark, *tiebreak])
    delta = delta.select(*[quote(c) for c in base.columns])
    valid, _ = split_null_keys(delta, keys)
    newest = valid if delta_unique else latest_per_key(valid, keys, watermark, tiebreak)
    keyed, keyless = split_null_keys(base, keys)
    if base_unique:
        changed = valid.select(*[quote(k) for k in keys])
        if not delta_unique:
            changed = changed.distinct()
        return _merge_by_join(keyed, newest, changed, keys, watermark).unionByName(keyless)
    tagged = keyed.withColumn(ORIGIN, F.lit(0)).unionByName(newest.withColumn(ORIGIN, F.lit(1)))
    merged = _first_per_key(tagged, keys, [watermark, ORIGIN, *tiebreak]).drop(ORIGIN)
    return merged.unionByName(keyless)


def _merge_by_join(
    base: DataFrame, newest: DataFrame, changed: DataFrame, keys: Sequence[str], watermark: str
) -> DataFrame:
    """Merge where both sides have unique keys; ``changed`` holds the delta's keys."""
    b, d = base.alias("b"), newest.withColumn(HIT, F.lit(True)).alias("d")
    same_key = [F.col(f"b.{quote(k)}") == F.col(f"d.{quote(k)}") for k in keys]
    old, new = F.col(f"b.{quote(watermark)}"), F.col(f"d.{quote(watermark)}")
    replaced = F.col(f"d.{HIT}") & (old.isNull() | (new >= old))
    # Key columns too go through the expression. Passed on as they are, they would
    # let Spark 4.1 plan the union below by partition, which fails at run time
    # when adaptive execution has coalesced its inputs differently.
    kept_or_updated = b.join(d, same_key, "left").select(
        *[
            F.when(replaced, F.col(f"d.{quote(c)}")).otherwise(F.col(f"b.{quote(c)}")).alias(c)
            for c in base.columns
        ]
    )
    # Only key columns of the base are read for this, and at most the delta's
    # keys leave the semi join.
    names = [quote(k) for k in keys]
    known = base.select(*names).join(changed, list(keys), "left_semi")
    inserted = newest.join(known, list(keys), "left_anti").select(*[quote(c) for c in base.columns])
    return kept_or_updated.unionByName(inserted)


def incremental_merge(
    base: DataFrame,
    feed: DataFrame,
    keys: Sequence[str],
    watermark: str,
    last: str | Watermark | None,
    tiebreak: Sequence[str] = (),
    base_unique: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """One incremental load: the merged table and its new high watermark."""
    fresh = incremental_filter(feed, watermark, last)
    merged = merge_upsert(base, fresh, keys, watermark, tiebreak, base_unique)
    return merged, high_watermark(fresh, watermark, last)


def current_view(df: DataFrame, deleted: str) -> DataFrame:
    """Rows not marked as deleted; an unknown flag counts as not deleted."""
    return df.where(~F.coalesce(to_boolean(F.col(quote(deleted))), F.lit(False)))
