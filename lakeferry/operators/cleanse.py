"""Column-level preparation of a landed table: audit columns, renames, partitions.

All steps are projections; a migrated table needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from lakeferry.functions.columns import to_boolean
from lakeferry.functions.names import folded, quote, require_columns, require_distinct
from lakeferry.model import AuditProfile, PartitionSpec


def active_rows(df: DataFrame, audit: AuditProfile = AuditProfile()) -> DataFrame:
    """Only rows whose active flag is set; reaches the scan as a pushed filter."""
    return df.where(to_boolean(F.col(quote(audit.name("active")))))


def cleanse_audit(
    df: DataFrame, audit: AuditProfile = AuditProfile(), src_type: str = "rdbms"
) -> DataFrame:
    """Drop, rename and cast audit columns; absent columns to drop or rename are skipped.

    The deleted flag is required. File sources also get their file columns.
    """
    deleted = audit.name("is_deleted")
    arrived = audit.name("target_timestamp")
    require_columns(df, [deleted])
    out = (
        df.drop(*audit.dropped)
        .withColumnRenamed(audit.name("target_start_timestamp"), arrived)
        .withColumn(deleted, to_boolean(F.col(quote(deleted))))
    )
    if src_type.lower() == "file":
        require_columns(out, [arrived])
        out = out.withColumnRenamed(audit.name("filename"), audit.name("file_name")).withColumn(
            audit.name("file_modified_timestamp"), F.col(quote(arrived))
        )
    return out


def rename_columns(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Rename all columns at once, so that names can be swapped.

    Keys match exactly, case included; an empty new name leaves the column as is.
    """
    names = [renames.get(c) or c for c in df.columns]
    require_distinct(df, names)
    return df.select(*[F.col(quote(old)).alias(new) for old, new in zip(df.columns, names)])


def apply_partition_spec(
    df: DataFrame,
    spec: PartitionSpec,
    renames: Mapping[str, str] | None = None,
    strict_reference: bool = False,
) -> tuple[DataFrame, list[str]]:
    """The table without its regex partition columns, and its partition column names.

    Names in ``spec`` are those before ``renames``. With ``strict_reference``
    regex columns stay unless the table has a normal partition too, and names
    are taken as they are.
    """
    renames = {} if strict_reference else (renames or {})
    normal = [renames.get(c) or c for c in spec.normal]
    drop = [renames.get(c) or c for c in spec.drop]
    require_columns(df, normal)
    both = {folded(df, c) for c in normal} & {folded(df, c) for c in drop}
    if both:
        raise ValueError(f"partition columns both kept and dropped: {sorted(both)}")
    if drop and (normal or not strict_reference):
        df = df.drop(*drop)
    return df, normal
