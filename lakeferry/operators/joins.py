"""Joins that keep a hot key from landing in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from lakeferry.functions.names import quote

SALT = "_salt"
DEFAULT_SALTS = 32


def join_null_safe(
    left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "left"
) -> DataFrame:
    """Equi-join on equally named columns in which nulls match nulls.

    The right side's join columns are renamed first, so that both sides may come
    from one table; they are not part of the result.
    """
    renamed = [f"_right_{i}" for i in range(len(names))]
    condition = F.lit(True)
    for name, other in zip(names, renamed):
        condition = condition & F.col(quote(name)).eqNullSafe(F.col(other))
        right = right.withColumnRenamed(name, other)
    return left.join(right, condition, how).drop(*renamed)


def semi_null_safe(
    df: DataFrame, other: DataFrame, names: Sequence[str], how: str = "left_semi"
) -> DataFrame:
    """Rows whose columns ``names`` are, or with ``left_anti`` are not, among ``other``'s; nulls match nulls."""
    listed = other.select(*[F.col(quote(n)).alias(f"_key_{i}") for i, n in enumerate(names)]).distinct()
    condition = F.lit(True)
    for i, name in enumerate(names):
        condition = condition & df[quote(name)].eqNullSafe(listed[f"_key_{i}"])
    return df.join(listed, condition, how)


def estimated_bytes(df: DataFrame) -> int:
    """Upper estimate of a relation's size by Spark's statistics; runs no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _threshold(df: DataFrame, limit: int | None) -> int:
    if limit is not None:
        return limit
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


LOOKUP_JOINS = ("inner", "left", "left_semi", "left_anti")


def join_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, str],
    spread_by: Sequence[str],
    how: str = "inner",
    salts: int = DEFAULT_SALTS,
    broadcast_bytes: int | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Join rows to a lookup that has one row per key, where one key may hold most rows.

    ``on`` names the lookup column of each fact column. A lookup that Spark's
    statistics hold to ``broadcast_bytes`` (by default the session's broadcast
    threshold) is left to Spark to broadcast; no job runs to find out. A larger one
    is joined by a shuffle that spreads each key over ``salts`` tasks: the lookup
    row is repeated per salt, and every fact takes the salt its ``spread_by``
    columns hash to. The lookup's key columns are not returned. Nulls match nulls
    where ``null_safe`` is set.
    """
    if how not in LOOKUP_JOINS:
        raise ValueError(f"a lookup join cannot be {how!r}")
    condition, keys = F.lit(True), []
    for i, (fact_key, lookup_key) in enumerate(on.items()):
        keys.append(f"_lookup_{i}")
        lookup = lookup.withColumnRenamed(lookup_key, keys[-1])
        fact, other = F.col(quote(fact_key)), F.col(keys[-1])
        condition = condition & (fact.eqNullSafe(other) if null_safe else fact == other)
    if estimated_bytes(lookup) <= _threshold(lookup, broadcast_bytes):
        return facts.join(lookup, condition, how).drop(*keys)
    salt = F.pmod(F.xxhash64(*[F.col(quote(c)) for c in spread_by]), F.lit(salts)).cast("int")
    repeated = lookup.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = facts.withColumn("_fact_salt", salt)
    return salted.join(
        repeated.hint("merge"), condition & (F.col("_fact_salt") == F.col(SALT)), how
    ).drop(*keys, SALT, "_fact_salt")
