"""Inputs of the registered queries, as pure functions of the given tables.

Landed trees and documents are written by Spark once per session and table set,
below the shared folder (see ``FIXTURES.md``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeferry.model import AuditProfile, MergeSpec, PartitionSpec
from lakeferry.session import fresh_dir
from lakeferry.sources.documents import read_envelopes, read_jobs, read_sources, read_tables

AUDIT = AuditProfile()
ORDER_PARTITIONS = PartitionSpec(normal=("o_year",), drop=("o_prio_rx",))
ORDER_RENAMES = {"o_custkey": "customer_id", "o_totalprice": "total_price"}
SWAP_RENAMES = {"o_custkey": "o_orderkey", "o_orderkey": "o_custkey"}
ORDER_MERGE = MergeSpec(keys=("o_orderkey",), watermark="o_orderdate")

_written: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """The folder ``write`` filled, written at most once per session and table set."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = fresh_dir(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


# --- A, B: landed trees -------------------------------------------------------


def audited(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    return df.withColumns({AUDIT.name(k): F.expr(v) for k, v in expressions.items()})


def orders_with_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, stamp = "cast(o_orderdate as date)", "o_orderdate"
    return audited(
        table(spark, sf_dir, "orders"),
        {
            "row_id": "cast(o_orderkey as string)",
            "scn": "o_orderkey",
            "offset": "o_orderkey",
            "source_start_date": day,
            "target_start_date": day,
            "source_end_date": day,
            "target_end_date": day,
            "source_start_timestamp": stamp,
            "source_end_timestamp": stamp,
            "target_end_timestamp": stamp,
            "target_start_timestamp": stamp,
            "active": "o_orderstatus <> 'F'",
            "status_flag": "'I'",
            "is_deleted": "case o_orderstatus when 'F' then 'true' when 'O' then '0' else 'N' end",
        },
    ).withColumns(
        {
            "o_year": F.date_format(F.col("o_orderdate").cast("date"), "yyyy"),
            "o_prio_rx": F.substring("o_orderpriority", 1, 1),
        }
    )


def landed_orders(spark: SparkSession, sf_dir: str, fmt: str) -> str:
    """A landed tree of orders; partition columns stay inside the files."""

    def write(path: str) -> None:
        levels = {"p1": F.col("o_year"), "p2": F.col("o_prio_rx")}
        levels |= {k: F.lit(0) for k in ("k1", "k2", "k3")}
        orders_with_audit(spark, sf_dir).withColumns(levels).write.partitionBy(*levels).format(
            fmt
        ).save(f"{path}/merged/{fmt}")

    return once(spark, sf_dir, f"landed-orders-{fmt}", write)


def landed_events(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        levels = {k: F.lit(0) for k in ("k1", "k2", "k3")}
        audited(
            table(spark, sf_dir, "events"),
            {
                "filename": "concat('events_', event_type, '.json')",
                "target_start_timestamp": "ts",
                "is_deleted": "if(event_id % 10 = 0, '1', '0')",
            },
        ).withColumns(levels).write.partitionBy(*levels).parquet(f"{path}/merged/parquet")

    return once(spark, sf_dir, "landed-events", write)


# --- C, D: documents ----------------------------------------------------------

# Source 0 owns a third of all tables; ids past the last supplier dangle.
SOURCE_OF_PART = "if(p_partkey % 3 = 0, '0', cast(p_partkey div 16 as string))"


def table_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_tables(spark, once(spark, sf_dir, "tables", lambda path: _write_tables(spark, sf_dir, path)))


def _write_tables(spark: SparkSession, sf_dir: str, path: str) -> None:
    document = table(spark, sf_dir, "part").selectExpr(
        "concat('t', p_partkey) as table_id",
        f"{SOURCE_OF_PART} as source",
        "concat('tbl_', p_partkey) as `table`",
        f"concat('supp_', {SOURCE_OF_PART}) as hive_schema",
        "if(p_partkey % 5 = 0, 'new', 'ready') as state",
        "concat('/lake/', p_partkey) as hdfs_path",
        "if(p_size % 10 = 0, null, cast(p_size as string)) as last_ingested_cdc_value",
        "'2020-01-01 00:00:00' as last_merged_timestamp",
        "array("
        "named_struct('origName', 'c1', 'name', 'c1'),"
        "named_struct('origName', 'c2', 'name', if(p_partkey % 2 = 0, 'c2', 'c2_new')),"
        "named_struct('origName', 'c3', 'name', 'c3_new')) as columns",
        f"{INGESTION} as ingestion_configuration",
    )
    document.write.json(path)


def _partition_key(column: str, function: str | None = None, derived: str | None = None) -> str:
    text = lambda v: "cast(null as string)" if v is None else f"'{v}'"
    return (
        f"named_struct('partition_key_column', '{column}', "
        f"'partition_key_extract_from_col', {str(function is not None).lower()}, "
        f"'partition_key_derive_function', {text(function)}, "
        f"'partition_key_derive_column', {text(derived)})"
    )


_PLAIN = _partition_key("pk_a")
_YEAR_MONTH = _partition_key("c2", "year-month", "c2_ym")
_REGEX = _partition_key("c3", "regex", "c3_rx")

INGESTION = (
    "named_struct("
    "'sync_type', element_at(array('full-load','cdc-timestamp-column','cdc-batch-id',"
    "'query-based'), p_size % 4 + 1),"
    "'storage_format', if(p_partkey % 2 = 0, 'parquet', 'orc'),"
    "'hive_table_name', concat('h_', p_partkey),"
    "'natural_key', array('c1'),"
    "'is_scd2_table', if(p_partkey % 7 = 0, null, p_partkey % 3 = 0),"
    "'is_archive_enabled', if(p_partkey % 7 = 0, null, p_partkey % 3 = 0),"
    "'generate_history_view', if(p_partkey % 7 = 0, null, p_partkey % 2 = 0),"
    "'timestamp_column_update', if(p_size % 4 = 1 or p_size % 8 = 2, 'upd_ts', null),"
    "'batch_id_cdc_column', if(p_size % 4 = 2, 'batch_id', null),"
    "'fetch_mechanism', if(p_partkey % 2 = 0, 'rest', 'soap'),"
    "'pk_chunking_enabled', p_partkey % 2 = 0,"
    "'split_by_key', if(p_partkey % 4 = 0, null, 'c1'),"
    "'split_by_key_extract_from_col', p_partkey % 4 in (2, 3),"
    "'split_by_key_derive_function', if(p_partkey % 4 in (2, 3),"
    " if(p_partkey % 11 = 0, 'week', 'year-month'), null),"
    "'split_by_key_derive_column', if(p_partkey % 4 in (2, 3), 'c1_ym', null),"
    f"'partition_key', case p_partkey % 4 when 1 then array({_PLAIN})"
    f" when 2 then array({_YEAR_MONTH}) when 3 then array({_PLAIN}, {_REGEX})"
    f" else filter(array({_PLAIN}), k -> false) end)"
)


def target_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target catalog: other renames, and no counterpart for every eleventh table."""
    return (
        table_documents(spark, sf_dir)
        .where("cast(substring(table_id, 2) as bigint) % 11 <> 0")
        .withColumn("hdfs_path", F.concat(F.lit("/target/"), F.substring("table_id", 2, 20)))
        .withColumn(
            "columns",
            F.expr(
                "array(named_struct('origName', 'c1', 'name', 'c1_t'),"
                "named_struct('origName', 'c2', 'name', 'c2'),"
                "named_struct('origName', 'c3', 'name', 'c3_t'))"
            ),
        )
        .withColumn("table_id", F.concat(F.lit("n"), F.col("table_id")))
    )


def source_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(path: str) -> None:
        table(spark, sf_dir, "supplier").selectExpr(
            "cast(s_suppkey as string) as src_id",
            "s_name as name",
            "concat('supp_', s_suppkey) as hive_schema",
            "if(s_suppkey % 2 = 0, 'rdbms', 'file') as sourceType",
            "element_at(array('sqlserver','teradata','oracle','netezza','db2'),"
            " cast(s_suppkey % 5 as int) + 1) as sourceSubtype",
            "concat('/src/', s_suppkey) as hdfs_path",
            "s_suppkey % 4 <> 0 as isPublic",
            "named_struct('driver_name', 'drv', 'schema', 'dbo', 'database', s_name,"
            " 'connection_method', if(s_suppkey % 4 = 0, 'jdbc', 'tpt'),"
            " 'connection_string', 'jdbc:x', 'username', if(s_suppkey % 6 = 0, null, 'u'))"
            " as connection",
        ).write.json(path)

    return read_sources(spark, once(spark, sf_dir, "sources", write))


# Tables per exported envelope: a source's export comes in bounded pieces.
ENVELOPE_SPAN = 100


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported configurations, one line per source and span of tables."""

    def write(path: str) -> None:
        sources = source_documents(spark, sf_dir).selectExpr(
            "src_id",
            "named_struct('hive_schema', hive_schema, 'sourceType',"
            " case cast(src_id as int) % 10 when 4 then 'crm' when 9 then 'file'"
            " else 'rdbms' end, 'sourceSubtype',"
            " if(cast(src_id as int) % 10 = 4, 'salesforce', sourceSubtype),"
            " 'connection', named_struct('driver_name', connection.driver_name,"
            " 'schema', connection.schema, 'database', connection.database,"
            " 'connection_method', connection.connection_method,"
            " 'connection_string', connection.connection_string,"
            " 'username', connection.username, 'fileType', 'salesforce',"
            " 'environment', 'trial', 'fetch_mechanism', 'rest',"
            " 'api_version', if(cast(src_id as int) % 20 = 4, '7.1', null)))"
            " as source_struct",
            "array(named_struct('entity_type', 'table_group', 'entity_id',"
            " named_struct('$type', 'oid', '$value', concat('g', src_id)), 'configuration',"
            " named_struct('name', concat('group_', src_id), 'max_connections',"
            " cast(src_id as int) + 1, 'max_parallel_entities',"
            " if(cast(src_id as int) % 4 = 0, null, 2), 'tables',"
            " array(named_struct('table_id', named_struct('$type', 'oid', '$value',"
            " concat('t', cast(src_id as int) * 16)), 'connection_quota', 100)), 'source',"
            " named_struct('$type', 'oid', '$value', src_id)))) as groups",
        )
        tables = table_documents(spark, sf_dir).selectExpr(
            "source",
            f"cast(substring(table_id, 2) as bigint) div {ENVELOPE_SPAN} as span",
            "named_struct('entity_type', 'table', 'entity_id',"
            " named_struct('$type', 'oid', '$value', table_id), 'configuration',"
            " named_struct('table', `table`, 'ingestion_configuration',"
            " ingestion_configuration)) as t",
        )
        pieces = tables.groupBy("source", "span").agg(F.collect_list("t").alias("tables"))
        # Tables whose source is not known are exported without one.
        listed = pieces.join(sources, pieces["source"] == sources["src_id"], "left").select(
            F.col("source_struct").alias("source"),
            "tables",
            F.expr("filter(groups, g -> false)").alias("table_groups"),
        )
        grouped = sources.select(
            F.col("source_struct").alias("source"), F.col("groups").alias("table_groups")
        )
        listed.unionByName(grouped, allowMissingColumns=True).withColumn(
            "export",
            F.expr(
                "named_struct('exportedAt', named_struct('$date', 1700000000123),"
                " 'exportedBy', 'admin')"
            ),
        ).write.json(path)

    path = once(spark, sf_dir, "envelopes", write)
    return read_envelopes(spark, path, multi_line=False)


# --- G: jobs ------------------------------------------------------------------


def job_records(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All jobs, and their active runs."""

    def write_jobs(path: str) -> None:
        table(spark, sf_dir, "customer").selectExpr("c_custkey as job_id", "c_name").write.json(path)

    def write_runs(path: str) -> None:
        table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").selectExpr(
            "o_custkey as job_id", "o_orderkey as run_id"
        ).write.json(path)

    jobs = once(spark, sf_dir, "jobs", write_jobs)
    return read_jobs(spark, jobs), read_jobs(spark, once(spark, sf_dir, "runs", write_runs))


# --- E: incremental orders ----------------------------------------------------


def order_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .where("o_orderkey % 10 <> 0")
        .withColumn("is_deleted", F.lit(False))
    )


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New and updated orders, and late older ones that must lose."""
    orders = table(spark, sf_dir, "orders")
    fresh = orders.where("o_orderkey % 5 = 0").withColumns(
        {
            "o_totalprice": F.col("o_totalprice") + 1,
            "o_orderdate": F.expr("o_orderdate + interval 1 day"),
            "is_deleted": F.expr("o_orderkey % 20 = 0"),
        }
    )
    stale = orders.where("o_orderkey % 7 = 0").withColumns(
        {
            "o_totalprice": F.col("o_totalprice") - 1,
            "o_orderdate": F.expr("o_orderdate - interval 1 day"),
            "is_deleted": F.lit(False),
        }
    )
    return fresh.unionByName(stale)


# --- F: event history ---------------------------------------------------------


def event_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def skewed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event history with a third of all rows under one user."""
    return event_versions(spark, sf_dir).withColumn(
        "user_id", F.expr("if(event_id % 3 = 0, -1, user_id)")
    )


def unmarked_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event history with some rows of every user that have no time."""
    return event_versions(spark, sf_dir).withColumn("ts", F.expr("if(event_id % 11 = 0, null, ts)"))


def repeated_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event history in which a third of all rows are one and the same, the latest of its user."""
    events = event_versions(spark, sf_dir)
    last = events.orderBy(F.desc("ts"), F.desc("event_id")).first()
    same = {f.name: F.when(F.expr("event_id % 3 = 0"), F.lit(last[f.name]).cast(f.dataType)).otherwise(F.col(f.name)) for f in events.schema}
    return events.select(*[column.alias(name) for name, column in same.items()])


# --- H: customers of each region as landed tables, with their documents ---------


def customers_of_regions(spark: SparkSession, sf_dir: str) -> str:
    """A landed tree per region, ``<n>/merged/parquet``; nations stay inside the files."""

    def write(path: str) -> None:
        customers = table(spark, sf_dir, "customer").join(
            table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        landed = audited(
            customers.select("c_custkey", "c_name", "n_name", "n_regionkey"),
            {"is_deleted": "'0'", "target_start_timestamp": "timestamp_ntz'2020-01-01 00:00:00'", "row_id": "'r'"},
        )
        for region in table(spark, sf_dir, "region").select("r_regionkey").collect():
            rows = landed.where(F.col("n_regionkey") == region[0]).drop("n_regionkey")
            levels = {"p1": F.col("n_name"), **{k: F.lit(0) for k in ("k1", "k2", "k3")}}
            rows.withColumns(levels).write.partitionBy(*levels).parquet(f"{path}/{region[0]}/merged/parquet")

    return once(spark, sf_dir, "landed-regions", write)


def region_documents(spark: SparkSession, sf_dir: str, lake: str) -> tuple[DataFrame, DataFrame]:
    """(documents of the landed region tables, documents of their targets below ``lake``)."""
    landed = customers_of_regions(spark, sf_dir)
    key = _partition_key("n_name")
    document = table(spark, sf_dir, "region").selectExpr(
        "concat('r', r_regionkey) as table_id", "'0' as source", "concat('customers_', r_regionkey) as `table`",
        "'supp_0' as hive_schema", "'ready' as state", f"concat('{landed}/', r_regionkey) as hdfs_path",
        "cast(r_regionkey as string) as last_ingested_cdc_value", "'2020-01-01 00:00:00' as last_merged_timestamp",
        "array(named_struct('origName', 'c_name', 'name', 'customer')) as columns",
        "named_struct('sync_type', 'cdc-batch-id', 'storage_format', 'parquet',"
        f" 'partition_key', array({key})) as ingestion_configuration",
    )
    path = once(spark, sf_dir, f"region-documents-{lake.rsplit('/', 1)[-1]}", lambda p: document.write.json(p))
    onprem = read_tables(spark, path)
    target = onprem.withColumns(
        {
            "table_id": F.concat(F.lit("n"), "table_id"),
            "hdfs_path": F.concat(F.lit(f"{lake}/"), F.substring("table_id", 2, 20)),
            "columns": F.expr("array(named_struct('origName', 'c_custkey', 'name', 'customer_id'))"),
        }
    )
    return onprem, target
