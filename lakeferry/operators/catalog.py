"""Migration planning over catalog documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeferry.functions.columns import (
    compose_renames,
    non_empty,
    partition_spec,
    rename_map,
)
from lakeferry.functions.names import quote, require_columns
from lakeferry.model import (
    CONNECTION_FIELDS,
    INCREMENTAL_SYNC_TYPES,
    PLAN_COLUMNS,
    SOURCE_DUMP_COLUMNS,
)
from lakeferry.operators.joins import join_lookup

# The source subtypes whose connections are exported.
DUMPED_SUBTYPES = ("sqlserver", "teradata", "oracle", "netezza")

# Fixed value: the directory of a target table below its document's path.
TARGET_SUBDIR = "merged"

# Longer id lists are joined instead of being spelled out in a predicate.
MAX_LISTED_IDS = 1000


def parse_ids(text: str) -> list[str]:
    """Ids of a comma list."""
    return [part.strip() for part in text.split(",") if part.strip()]


def of_sources(tables: DataFrame, source_ids: Sequence[str] | DataFrame) -> DataFrame:
    """Tables of the given sources; ids as a list or as a one-column DataFrame."""
    if isinstance(source_ids, DataFrame):
        ids = source_ids
    elif len(source_ids) <= MAX_LISTED_IDS:
        return tables.where(F.col("source").isin(*source_ids))
    else:
        ids = tables.sparkSession.createDataFrame([(i,) for i in source_ids], "source string")
    ids = ids.toDF("id").distinct()
    return join_lookup(tables, ids, {"source": "id"}, ["table_id"], "left_semi")


def plan_tables(
    tables: DataFrame, source_ids: Sequence[str] | DataFrame | None = None
) -> DataFrame:
    """Parameter rows of the ready, incrementally loaded tables. Shuffle-free."""
    ready = tables.where(
        (F.col("state") == "ready")
        & F.col("ingestion_configuration.sync_type").isin(*INCREMENTAL_SYNC_TYPES)
    )
    if source_ids is not None:
        ready = of_sources(ready, source_ids)
    return ready.select(
        F.col("table_id").cast("string").alias("table_id"),
        F.col("table").alias("table_name"),
        F.col("ingestion_configuration.storage_format").alias("storage_format"),
        F.col("hdfs_path").alias("src_dir"),
        F.col("source").cast("string").alias("source_id"),
        "last_ingested_cdc_value",
        F.col("last_merged_timestamp").cast("string").alias("last_merged_timestamp"),
        F.col("ingestion_configuration.sync_type").alias("sync_type"),
        F.to_json(partition_spec(F.col("ingestion_configuration.partition_key"))).alias(
            "partition_column"
        ),
        F.to_json(rename_map(F.col("columns"))).alias("override_columns"),
    )


def plan_migration(
    tables: DataFrame,
    sources: DataFrame,
    source_ids: Sequence[str] | DataFrame | None = None,
) -> DataFrame:
    """The full plan: parameter rows with their source's fields.

    Tables of unknown sources drop out. One source may own most tables, so the
    lookup is salted by table.
    """
    described = sources.select(
        "src_id",
        F.col("name").alias("source_name"),
        "hive_schema",
        F.col("sourceType").alias("source_type"),
        "sourceSubtype",
    )
    rows = plan_tables(tables, source_ids)
    joined = join_lookup(rows, described, {"source_id": "src_id"}, spread_by=["table_id"])
    return joined.select(*PLAN_COLUMNS)


def distinct_sources(tables: DataFrame) -> DataFrame:
    return tables.select(F.col("source").alias("source_id")).distinct()


def table_counts(tables: DataFrame) -> DataFrame:
    """Tables per source and sync type."""
    return tables.groupBy(
        F.col("source").alias("source_id"),
        F.col("ingestion_configuration.sync_type").alias("sync_type"),
    ).agg(F.count(F.lit(1)).alias("table_count"))


def match_targets(plan: DataFrame, target: DataFrame) -> DataFrame:
    """Plan rows with the target document of their schema and table name.

    A row gains ``target_id`` and ``target_dir``, and its renames are composed
    with the target's; without a target it keeps its renames and both are null.
    Where several documents share a name the first by id is taken.
    """
    first = Window.partitionBy("hive_schema", "table").orderBy("table_id")
    documents = (
        target.select(
            "hive_schema", "table", "table_id", "hdfs_path", rename_map(F.col("columns")).alias("m")
        )
        .withColumn("_n", F.row_number().over(first))
        .where("_n = 1")
        .select(
            F.col("hive_schema").alias("_schema"),
            F.col("table").alias("_table"),
            F.col("table_id").alias("target_id"),
            # Null without a path: ``merged`` alone would be one folder for all such tables.
            F.when(
                F.trim("hdfs_path") != "",
                F.concat_ws("/", F.rtrim("hdfs_path", F.lit("/")), F.lit(TARGET_SUBDIR)),
            ).alias("target_dir"),
            F.col("m").alias("target_renames"),
        )
    )
    joined = plan.join(
        documents,
        (plan["hive_schema"] == documents["_schema"]) & (plan["table_name"] == documents["_table"]),
        "left",
    ).drop("_schema", "_table")
    onprem = F.from_json("override_columns", "map<string,string>")
    composed = F.to_json(compose_renames(onprem, F.col("target_renames")))
    return joined.withColumn(
        "override_columns",
        F.when(F.col("target_id").isNotNull(), composed).otherwise(F.col("override_columns")),
    ).drop("target_renames")


def resolve_targets(plan: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plan rows ready for ``migrate_batch``, and those that must not run, with a ``reason``.

    A row needs a target document with a path. Of rows that would write to one path
    the first by table id is ready; the others would overwrite it.
    """
    matched = match_targets(plan, target)
    # Rows without a path share none: each is a group of its own, so that they do not meet in one task.
    alone = F.when(F.col("target_dir").isNull(), F.col("table_id"))
    same_path = Window.partitionBy("target_dir", alone).orderBy("table_id", "source_id")
    judged = matched.withColumn("_n", F.row_number().over(same_path)).withColumn(
        "reason",
        F.when(F.col("target_id").isNull(), "no target")
        .when(F.col("target_dir").isNull(), "no target path")
        .when(F.col("_n") > 1, "shared target"),
    )
    ready = judged.where(F.col("reason").isNull()).drop("_n", "reason")
    return ready, judged.where(F.col("reason").isNotNull()).select(*plan.columns, "reason")


def source_dump(sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Flat connection rows of the exportable sources, and the sources rejected.

    A source lacking any connection field is rejected.
    """
    exported = sources.where(
        (F.col("sourceType") == "rdbms") & F.col("sourceSubtype").isin(*DUMPED_SUBTYPES)
    )
    complete = F.lit(True)
    for name in CONNECTION_FIELDS:
        complete = complete & F.col(f"connection.{name}").isNotNull()
    valid = exported.where(complete).select(
        *[F.col(name).alias(name) for name in SOURCE_DUMP_COLUMNS]
    )
    rejected = exported.where(~complete).select(
        "src_id", "name", F.lit("missing connection field").alias("reason")
    )
    return valid, rejected


# The defaults a source descriptor starts from.
DESCRIPTOR_DEFAULTS: Mapping[str, object] = {
    **{f"connection.{name}": "" for name in CONNECTION_FIELDS},
    "hive_schema": "",
    "sourceType": "",
    "sourceSubtype": "",
    "name": "",
    "hdfs_path": "",
    "isPublic": True,
}


def overlay(value: Column, default: object) -> Column:
    """The configured value, else the template's."""
    return F.coalesce(value, F.lit(default))


def source_descriptors(dump: DataFrame) -> DataFrame:
    """Creation descriptors from dump rows: template defaults, then subtype rules."""
    subtype = F.col("sourceSubtype")
    method = F.col(quote("connection.connection_method"))
    fields = {}
    for name, default in DESCRIPTOR_DEFAULTS.items():
        value = F.col(quote(name))
        if name.startswith("connection."):
            value = non_empty(value)
        fields[name] = overlay(value, default)
    teradata = subtype == "teradata"
    fields["connection.connection_method"] = F.when(teradata, F.lit("jdbc")).otherwise(
        fields["connection.connection_method"]
    )
    return dump.select(
        *[column.alias(name) for name, column in fields.items()],
        F.when(teradata, ~method.eqNullSafe("jdbc")).alias("connection.enable_tpt_for_source"),
        F.when(subtype == "oracle", F.lit(False)).alias(
            "configuration.oracle_logbased_cdc_enabled"
        ),
    )


def idle_jobs(jobs: DataFrame, runs: DataFrame) -> DataFrame:
    """Jobs without an active run, latest id first.

    Runs are reduced to their distinct jobs before the join, so a job with very
    many runs is no hot key.
    """
    active = runs.select("job_id").distinct()
    return (
        jobs.join(active, "job_id", "left_anti")
        .select("job_id", F.lit("idle").alias("status"))
        .orderBy(F.desc("job_id"))
    )


def existing(
    df: DataFrame, target: DataFrame, keys: Sequence[str], spread_by: Sequence[str] = ()
) -> DataFrame:
    """Rows whose keys occur in ``target``; ``spread_by`` names their id columns."""
    known = target.select(*[quote(k) for k in keys]).distinct()
    return join_lookup(df, known, {k: k for k in keys}, spread_by or keys, "left_semi")


def find_one(df: DataFrame, key: Mapping[str, object], order_by: Sequence[str]) -> DataFrame:
    """The first row with the given key values, in a stated order."""
    found = df
    for name, value in key.items():
        found = found.where(F.col(quote(name)) == F.lit(value))
    return found.orderBy(*order_by).limit(1)


def update_where(df: DataFrame, condition: Column, assignments: Mapping[str, object]) -> DataFrame:
    """``UPDATE … SET … WHERE``: values are literals or Columns over the old row."""
    require_columns(df, assignments)
    return df.withColumns(
        {
            name: F.when(condition, value if isinstance(value, Column) else F.lit(value))
            .otherwise(F.col(quote(name)))
            .cast(df.schema[name].dataType)
            for name, value in assignments.items()
        }
    )


def grant(accessible: Column, source: Column) -> Column:
    """Access list with one more source; granting twice changes nothing."""
    return F.array_union(F.coalesce(accessible, F.array().cast("array<string>")), F.array(source))


def grant_sources(access: DataFrame, grants: DataFrame) -> DataFrame:
    """Bulk grants over (template_id, source_id) rows.

    The lists stay rows: a template open to very many sources is never gathered
    into one array.
    """
    columns = ["template_id", "source_id"]
    return access.select(*columns).unionByName(grants.select(*columns)).distinct()
