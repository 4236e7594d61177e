"""Configuration conversion, updates, grants, state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeferry.operators.catalog import grant_sources, update_where
from lakeferry.functions.documents import typed_id
from lakeferry.operators.config import (
    bind_clusters,
    config_documents,
    convert_groups,
    convert_sources,
    convert_tables,
)
from lakeferry.operators.state import FAILED, STATE, SUCCEEDED, apply_state
from lakeferry.session import fresh_dir
from lakeferry.sources.documents import (
    envelope_groups,
    envelope_sources,
    envelope_tables,
    read_documents,
    write_documents,
)
from lakeferry.workload import fixtures as fx
from lakeferry.workload.plan import SOURCE, SUBTYPE, SYNC

CLUSTER = "cluster-1"
DOCUMENT_TABLES = 50


def converted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return convert_tables(envelope_tables(fx.envelopes(spark, sf_dir)))


def config_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    configs, _ = converted(spark, sf_dir)
    split = F.col("split_by_key")
    return configs.select(
        *[
            c
            for c, kind in configs.dtypes
            if not kind.startswith(("array", "struct"))
        ],
        F.array_join("read_supported_engines", ",").alias("read_supported_engines"),
        F.array_join("write_supported_engines", ",").alias("write_supported_engines"),
        F.array_join("natural_keys", ",").alias("natural_keys"),
        F.size("partition_keys").alias("partition_key_count"),
        split["parent_column"].alias("split_parent"),
        split["derive_function"].alias("split_function"),
        split["derive_format"].alias("split_format"),
        split["is_derived_split"].alias("split_derived"),
        split["split_column"].alias("split_column"),
    )


def config_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    configs, _ = converted(spark, sf_dir)
    return configs.select("table_id", F.posexplode("partition_keys").alias("position", "k")).select(
        "table_id", "position", "k.*"
    )


def config_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return converted(spark, sf_dir)[0].select("table_id", "sync_type", "watermark_column")


def config_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return converted(spark, sf_dir)[1]


def config_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = convert_groups(envelope_groups(fx.envelopes(spark, sf_dir)), CLUSTER)
    return groups.select("*", F.inline("tables")).drop("tables")


def config_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete and incomplete sources under the strict overlay."""
    complete, incomplete = convert_sources(envelope_sources(fx.envelopes(spark, sf_dir)))
    columns = ["hive_schema", "source_type"]
    return complete.select(*columns, F.lit("").alias("missing")).unionByName(
        incomplete.select(*columns, "missing")
    )


def clustered_groups(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Groups whose source names a cluster template; two templates share a name, and one name is unknown."""
    named = envelope_groups(fx.envelopes(spark, sf_dir)).withColumn(
        "cluster_name", F.expr("nullif(concat('cluster_', cast(source as bigint) % 6), 'cluster_5')")
    )
    templates = fx.table(spark, sf_dir, "nation").where("n_nationkey % 5 <> 4").select(
        F.concat(F.lit("cluster_"), F.col("n_nationkey") % 5).alias("cluster_name"),
        F.concat(F.lit("c"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0")).alias("cluster_id"),
    )
    return bind_clusters(named, templates)


def config_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound, missed = clustered_groups(spark, sf_dir)
    groups = convert_groups(bound, F.col("cluster_id")).select("group_id", "name", "cluster_id", F.lit("").alias("reason"))
    return groups.unionByName(missed, allowMissingColumns=True)


def config_documents_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All converted configurations as documents, written and read back; one row per table, group or empty source."""
    envelopes = fx.envelopes(spark, sf_dir)
    sources, _ = convert_sources(envelope_sources(envelopes))
    configs, _ = converted(spark, sf_dir)
    bound, _ = clustered_groups(spark, sf_dir)
    groups = convert_groups(bound, F.col("cluster_id"), carried=["hive_schema"])
    documents = config_documents(sources, configs, groups, DOCUMENT_TABLES)
    path = fresh_dir(spark, "config-documents")
    write_documents(documents, path)
    connection = [f.name for f in documents.schema["source"].dataType["connection"].dataType.fields]
    read = read_documents(spark, path, connection)
    schema = F.col("source.hive_schema").alias("hive_schema")
    held = (F.size("tables") + F.size("table_groups") <= DOCUMENT_TABLES).alias("within")
    entry = F.col("e.configuration")
    tables = read.select(schema, held, F.explode("tables").alias("e")).select(
        "hive_schema", "within", F.lit("table").alias("kind"), typed_id(F.col("e.entity_id")).alias("id"),
        entry["table"].alias("name"), entry["configuration"]["sync_type"].alias("detail"),
        entry["configuration"]["split_by_key"]["split_column"].alias("more"),
    )
    listed = read.select(schema, held, F.explode("table_groups").alias("e")).select(
        "hive_schema", "within", F.lit("group").alias("kind"), typed_id(F.col("e.entity_id")).alias("id"),
        entry["name"].alias("name"), entry["cluster_template"]["cluster_id"].alias("detail"),
        typed_id(entry["tables"][0]["table_id"]).alias("more"),
    )
    empty = read.where("size(tables) = 0 and size(table_groups) = 0").select(schema, held, F.lit("empty").alias("kind"))
    return tables.unionByName(listed).unionByName(empty, allowMissingColumns=True)


def updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = fx.table_documents(spark, sf_dir).select("table_id", "source", "state", "hdfs_path")
    moved = {"state": "ready", "hdfs_path": F.concat(F.lit("/moved/"), F.col("table_id"))}
    return update_where(tables, F.col("source") == "0", moved)


def granted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").cast("string").alias("template_id"),
        F.col("c_custkey").cast("string").alias("source_id"),
    )
    number = F.col("source_id").cast("bigint")
    return grant_sources(rows.where(number % 2 == 0), rows.where((number % 2 == 1) | (number % 3 == 0)))


def state_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = fx.table_documents(spark, sf_dir)
    plan = documents.select("table_id", "last_ingested_cdc_value", "last_merged_timestamp")
    number = F.substring("table_id", 2, 20).cast("bigint")
    results = documents.select(
        "table_id", F.when(number % 13 == 0, FAILED).otherwise(SUCCEEDED).alias("status")
    )
    before = spark.createDataFrame([], STATE)
    state = documents.select(
        "table_id",
        F.lit(False).alias("full_load_performed"),
        F.lit("migrating").alias("state"),
        *[
            F.lit(None if f.dataType.simpleString() == "string" else True)
            .cast(f.dataType)
            .alias(f.name)
            for f in before.schema.fields[3:]
        ],
    )
    return apply_state(state, plan, results)


QUERIES = {
    "config_tables": config_tables,
    "config_partitions": config_partitions,
    "config_watermark": config_watermark,
    "config_rejected": config_rejected,
    "config_groups": config_groups,
    "config_sources": config_sources,
    "config_clusters": config_clusters,
    "config_documents": config_documents_read,
    "update_where": updated,
    "grant_sources": granted,
    "state_update": state_update,
}

_SFDC = "s_suppkey % 10 = 4"
_DERIVED = "p_partkey % 4 IN (2, 3)"
_REASON = f"""
CASE WHEN s_suppkey % 10 = 9 THEN 'unsupported source type: file'
     WHEN p_size % 4 = 3 THEN 'unsupported sync type: query-based'
     WHEN {_DERIVED} AND p_partkey % 11 = 0 THEN 'unknown split derive function' END"""
_TABLES = f"""
SELECT part.*, supplier.*, {SYNC} AS sync, {SUBTYPE} AS subtype, {_REASON} AS reason
FROM part JOIN supplier ON {SOURCE} = cast(s_suppkey AS varchar)"""
_SYNC_TYPE = "if(sync = 'full-load', sync, 'incremental')"
_WATERMARK = f"""
CASE WHEN {_SFDC} THEN 'SystemModstamp' WHEN p_size % 4 = 2 THEN 'batch_id'
     WHEN p_size % 4 = 1 THEN 'upd_ts' END"""

# Templates 0 to 3 exist; 4 and, as no name, 5 do not.
_CLUSTERED = "s_suppkey % 6 < 4"
_COMPLETE = "s_suppkey % 10 <> 9 AND NOT (s_suppkey % 20 = 14 OR s_suppkey % 6 = 0)"

ORACLES = {
    "config_tables": f"""
SELECT 'table' AS entity_type, 't' || p_partkey AS table_id, 'tbl_' || p_partkey AS "table",
       'h_' || p_partkey AS target_table_name, 'supp_' || s_suppkey AS target_schema_name,
       {_SYNC_TYPE} AS sync_type,
       p_partkey % 7 <> 0 AND p_partkey % 3 = 0 AS is_scd2_table,
       p_partkey % 7 <> 0 AND p_partkey % 3 = 0 AS is_archive_enabled,
       p_partkey % 7 <> 0 AND p_partkey % 2 = 0 AS generate_history_view,
       'read' AS storage_format, if(sync <> 'full-load', 'merge', NULL) AS update_strategy,
       {_WATERMARK} AS watermark_column,
       if(sync <> 'full-load' AND subtype = 'sqlserver', false, NULL) AS use_capture_table,
       CASE WHEN subtype IN ('teradata', 'oracle') THEN 'bulk'
            WHEN {_SFDC} THEN if(p_partkey % 2 = 0, 'rest', 'soap') END AS fetch_mechanism,
       if({_SFDC}, p_partkey % 2 = 0, NULL) AS enable_pk_chunk,
       if(subtype = 'teradata', false, NULL) AS use_jdbc,
       if(subtype IN ('teradata', 'oracle'), true, NULL) AS exclude_legacy_audit_columns,
       'SPARK' AS read_supported_engines, 'SPARK' AS write_supported_engines,
       'c1' AS natural_keys, cast(if(p_partkey % 4 = 0, 0, 1) AS integer) AS partition_key_count,
       if({_DERIVED}, 'c1', NULL) AS split_parent,
       if({_DERIVED}, 'year month', NULL) AS split_function,
       if({_DERIVED}, 'yyyyMM', NULL) AS split_format,
       if(p_partkey % 4 = 0, NULL, {_DERIVED}) AS split_derived,
       CASE WHEN {_DERIVED} THEN 'c1_ym' WHEN p_partkey % 4 = 1 THEN 'c1' END AS split_column
FROM ({_TABLES}) WHERE reason IS NULL""",
    "config_partitions": f"""
SELECT 't' || p_partkey AS table_id, cast(0 AS integer) AS position,
       if(p_partkey % 4 = 2, 'c2', NULL) AS parent_column,
       if(p_partkey % 4 = 2, 'year month', NULL) AS derive_function,
       if(p_partkey % 4 = 2, 'yyyyMM', NULL) AS derive_format,
       p_partkey % 4 = 2 AS is_derived_partition,
       if(p_partkey % 4 = 2, 'c2_ym', 'pk_a') AS partition_column
FROM ({_TABLES}) WHERE reason IS NULL AND p_partkey % 4 <> 0""",
    "config_watermark": f"""
SELECT 't' || p_partkey AS table_id, {_SYNC_TYPE} AS sync_type, {_WATERMARK} AS watermark_column
FROM ({_TABLES}) WHERE reason IS NULL""",
    "config_rejected": f"""
SELECT 't' || p_partkey AS table_id, 'tbl_' || p_partkey AS "table", reason
FROM ({_TABLES}) WHERE reason IS NOT NULL
UNION ALL
SELECT 't' || p_partkey, 'tbl_' || p_partkey, 'unsupported source type: none'
FROM part WHERE {SOURCE} NOT IN (SELECT cast(s_suppkey AS varchar) FROM supplier)""",
    "config_clusters": f"""
SELECT 'g' || s_suppkey AS group_id, 'group_' || s_suppkey AS name,
       if({_CLUSTERED}, 'c' || lpad(cast(s_suppkey % 6 AS varchar), 3, '0'), NULL) AS cluster_id,
       if({_CLUSTERED}, '', 'unknown cluster template: ' || if(s_suppkey % 6 = 5, 'none', 'cluster_' || s_suppkey % 6)) AS reason
FROM supplier""",
    "config_documents": f"""
WITH complete AS (SELECT * FROM supplier WHERE {_COMPLETE}),
tables AS (SELECT 'supp_' || s_suppkey AS hive_schema, true AS within, 'table' AS kind, 't' || p_partkey AS id,
       'tbl_' || p_partkey AS name, {_SYNC_TYPE} AS detail,
       CASE WHEN {_DERIVED} THEN 'c1_ym' WHEN p_partkey % 4 = 1 THEN 'c1' END AS more
    FROM ({_TABLES}) WHERE reason IS NULL AND {_COMPLETE}),
groups AS (SELECT 'supp_' || s_suppkey, true, 'group', 'g' || s_suppkey, 'group_' || s_suppkey,
       'c' || lpad(cast(s_suppkey % 6 AS varchar), 3, '0'), 't' || (s_suppkey * 16)
    FROM complete WHERE {_CLUSTERED})
SELECT * FROM tables UNION ALL SELECT * FROM groups
UNION ALL SELECT 'supp_' || s_suppkey, true, 'empty', NULL, NULL, NULL, NULL FROM complete
WHERE NOT {_CLUSTERED} AND 'supp_' || s_suppkey NOT IN (SELECT hive_schema FROM tables)""",
    "config_groups": f"""
SELECT 'table_group' AS entity_type, 'g' || s_suppkey AS group_id, 'group_' || s_suppkey AS name,
       cast(s_suppkey + 1 AS integer) AS max_connections,
       cast(if(s_suppkey % 4 = 0, 1, 2) AS integer) AS max_parallel_entities,
       cast(s_suppkey AS varchar) AS source, '{CLUSTER}' AS cluster_id,
       if({_SFDC}, 'group_' || s_suppkey, NULL) AS job_name,
       if({_SFDC}, true, NULL) AS is_table_group_job,
       't' || (s_suppkey * 16) AS table_id, cast(100 AS integer) AS connection_quota
FROM supplier""",
    "config_sources": """
SELECT 'supp_' || s_suppkey AS hive_schema,
       CASE s_suppkey % 10 WHEN 4 THEN 'sfdc' WHEN 9 THEN 'file' ELSE 'rdbms' END AS source_type,
       CASE WHEN s_suppkey % 10 = 9 THEN 'supported source type'
            ELSE concat_ws(',', if(s_suppkey % 20 = 14, 'api_version', NULL),
                           if(s_suppkey % 6 = 0, 'username', NULL)) END AS missing
FROM supplier
UNION ALL
SELECT DISTINCT NULL, NULL, 'supported source type'
FROM part WHERE """ + SOURCE + """ NOT IN (SELECT cast(s_suppkey AS varchar) FROM supplier)""",
    "update_where": f"""
SELECT 't' || p_partkey AS table_id, {SOURCE} AS source,
       if({SOURCE} = '0' OR p_partkey % 5 <> 0, 'ready', 'new') AS state,
       if({SOURCE} = '0', '/moved/t', '/lake/') || p_partkey AS hdfs_path
FROM part""",
    "grant_sources": """
SELECT DISTINCT cast(c_nationkey AS varchar) AS template_id, cast(c_custkey AS varchar) AS source_id
FROM customer""",
    "state_update": """
SELECT 't' || p_partkey AS table_id, ok AS full_load_performed,
       if(ok, 'ready', 'migrating') AS state,
       if(ok AND p_size % 10 <> 0, cast(p_size AS varchar), NULL) AS last_ingested_cdc_value,
       if(ok, '2020-01-01 00:00:00', NULL) AS last_merged_watermark,
       NOT ok AS state_export_data, NOT ok AS state_fetch_delta, NOT ok AS state_merge_delta,
       NOT ok AS state_reconcile_data
FROM (SELECT *, p_partkey % 13 <> 0 AS ok FROM part)""",
}
