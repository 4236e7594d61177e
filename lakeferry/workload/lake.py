"""Landed scans, cleansing, renames, writes, registration, migration."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeferry.functions.dates import (
    DERIVE_FORMATS,
    add_derived_partitions,
    where_parent_between,
)
from lakeferry.model import PartitionSpec, TableSpec
from lakeferry.operators.catalog import plan_migration, resolve_targets
from lakeferry.operators.cleanse import cleanse_audit, rename_columns
from lakeferry.operators.state import FLAGS, apply_state
from lakeferry.plans.migrate import migrate_batch, migrate_table, outcomes, prepare_table
from lakeferry.session import fresh_dir
from lakeferry.sinks.tables import register_table, write_table
from lakeferry.sources.landed import scan_landed
from lakeferry.workload import fixtures as fx

DATABASE = "lakeferry_check"


def scan(fmt: str, layout: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = fx.landed_orders(spark, sf_dir, fmt)
        landed = scan_landed(spark, root, fmt, fx.ORDER_PARTITIONS, layout)
        days = [f.name for f in landed.schema.fields if f.dataType.simpleString() == "date"]
        return landed.withColumns({c: F.col(c).cast("string") for c in days})

    return query


def scan_format_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats are named in any case; the columns' names need quoting."""
    root = fx.landed_orders(spark, sf_dir, "orc")
    landed = cleanse_audit(scan_landed(spark, root, "ORC"))
    return rename_columns(landed, {"o_orderkey": "order key", "o_year": "a.year"})


def scan_drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files of which some lack a column and some have one more."""

    def write(path: str) -> None:
        orders, top = fx.table(spark, sf_dir, "orders"), f"{path}/merged/parquet"
        orders.where("o_orderkey % 3 = 0").drop("o_orderstatus").write.parquet(f"{top}/a")
        orders.where("o_orderkey % 3 = 1").write.parquet(f"{top}/b")
        orders.where("o_orderkey % 3 = 2").withColumn("newcol", F.col("o_custkey") * 2).write.parquet(f"{top}/c")

    return scan_landed(spark, fx.once(spark, sf_dir, "drifted-orders", write), "parquet")


def cleansed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fx.landed_orders(spark, sf_dir, "parquet")
    return cleanse_audit(scan_landed(spark, root, "parquet"))


def cleanse_file_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = scan_landed(spark, fx.landed_events(spark, sf_dir), "parquet")
    return cleanse_audit(landed, src_type="file")


def renamed(renames: dict[str, str]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rename_columns(cleansed_orders(spark, sf_dir), renames)

    return query


def order_spec(spark: SparkSession, sf_dir: str, table: str, fmt: str = "parquet") -> TableSpec:
    return TableSpec(
        src_dir=fx.landed_orders(spark, sf_dir, fmt),
        target_dir=fresh_dir(spark, table),
        database=DATABASE,
        table=table,
        fmt=fmt,
        partitions=fx.ORDER_PARTITIONS,
        renames=fx.ORDER_RENAMES,
    )


def event_spec(spark: SparkSession, sf_dir: str, table: str) -> TableSpec:
    return TableSpec(
        src_dir=fx.landed_events(spark, sf_dir),
        target_dir=fresh_dir(spark, table),
        database=DATABASE,
        table=table,
        src_type="file",
        renames={"event_type": "kind"},
    )


def migrate_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(migrate_table(spark, event_spec(spark, sf_dir, "events_flat")).table_name)


def migrate_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: a landed, partitioned table migrated, registered and queried."""
    result = migrate_table(spark, order_spec(spark, sf_dir, "orders_by_year"))
    return (
        spark.table(result.table_name)
        .groupBy("o_year", F.col("ziw_is_deleted").alias("is_deleted"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum(F.col("total_price").cast("decimal(18,2)")).cast("double").alias("total_price"),
            F.count_distinct("customer_id").alias("customers"),
        )
    )


def migrated_rows(fmt: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = order_spec(spark, sf_dir, f"orders_rows_{fmt}", fmt)
        return spark.table(migrate_table(spark, spec).table_name)

    return query


def append_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = order_spec(spark, sf_dir, "orders_twice")
    migrate_table(spark, spec)
    result = migrate_table(spark, replace(spec, mode="append"))
    return (
        spark.table(result.table_name)
        .groupBy("o_orderkey", "o_year")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clustered write of prepared rows, registered afterwards."""
    spec = order_spec(spark, sf_dir, "orders_registered", "orc")
    df, partition_by = prepare_table(spark, spec)
    write_table(df, spec.target_dir, "overwrite", "parquet", partition_by, cluster="rebalance")
    register_table(
        spark, DATABASE, spec.table, spec.target_dir, "parquet", df.schema.toDDL(), partition_by
    )
    return spark.sql(f"SELECT * FROM {DATABASE}.{spec.table}")


def batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three landed tables and one of an unsupported format, which alone fails."""
    orders = fx.ORDER_PARTITIONS.to_json()
    flat = PartitionSpec().to_json()
    parquet = fx.landed_orders(spark, sf_dir, "parquet")
    orc = fx.landed_orders(spark, sf_dir, "orc")
    events = fx.landed_events(spark, sf_dir)
    rows = [
        ("t1", "b_orders", "parquet", parquet, "rdbms", orders, '{"o_custkey":"customer_id"}'),
        ("t2", "b_orders_orc", "ORC", orc, "rdbms", orders, "{}"),
        ("t3", "b_events", "parquet", events, "file", flat, "{}"),
        ("t4", "b_text", "csv", events, "file", flat, "{}"),
    ]
    plan = spark.createDataFrame(
        rows,
        "table_id string, table_name string, storage_format string, src_dir string, "
        "source_type string, partition_column string, override_columns string",
    ).withColumns(
        {
            "hive_schema": F.lit(DATABASE),
            "target_dir": F.concat(F.lit(fresh_dir(spark, "batch") + "/"), "table_name"),
        }
    )
    failed = F.col("error").isNotNull().alias("failed")
    return migrate_batch(spark, plan).select(
        "table_id", "table_name", "status", "rows_written", failed
    )


def appended(wider: bool):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Two landed trees of which one lacks a column: the table has the columns of both, whichever came first."""
        name = f"orders_{'wider' if wider else 'narrower'}"
        full = replace(order_spec(spark, sf_dir, name), partitions=fx.ORDER_PARTITIONS)

        def write(path: str) -> None:
            rows = scan_landed(spark, full.src_dir, "parquet", fx.ORDER_PARTITIONS).drop("o_totalprice")
            rows.write.parquet(f"{path}/merged/parquet")

        narrow = replace(full, src_dir=fx.once(spark, sf_dir, "landed-orders-narrow", write))
        first, second = (narrow, full) if wider else (full, narrow)
        migrate_table(spark, first)
        result = migrate_table(spark, replace(second, mode="append"))
        return spark.table(result.table_name)

    return query


def swap_registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned table swapped twice: by rows of one year less and one column more, then by all."""
    spec = replace(order_spec(spark, sf_dir, "orders_swapped"), publish="swap")

    def write(path: str) -> None:
        rows = scan_landed(spark, spec.src_dir, "parquet", fx.ORDER_PARTITIONS)
        rows.where("o_year <> '1995'").withColumn("extra", F.lit(1)).write.parquet(f"{path}/merged/parquet")

    part = replace(spec, src_dir=fx.once(spark, sf_dir, "landed-orders-part", write))
    for load in (spec, part, spec):
        result = migrate_table(spark, load)
    return spark.table(result.table_name)


def migrate_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch planned from documents, broken off after half its tables and taken up again by its log.

    Rows of all migrated tables, each with its table's outcomes and state.
    """
    lake = fresh_dir(spark, "resumed")
    onprem, target = fx.region_documents(spark, sf_dir, lake)
    sources = spark.createDataFrame([("0", "regions", "supp_0", "rdbms", "oracle")], "src_id string, name string, hive_schema string, sourceType string, sourceSubtype string")
    ready, _ = resolve_targets(plan_migration(onprem, sources), target)
    ready = ready.withColumn("hive_schema", F.lit(DATABASE))
    log = f"{lake}/log"
    migrate_batch(spark, ready.where("cast(substring(table_id, 2) as int) % 2 = 0"), log=log)
    results = migrate_batch(spark, ready, log=log)
    before = target.select(
        "table_id", F.lit(False).alias("full_load_performed"), F.lit("new").alias("state"),
        *[F.lit(None).cast("string").alias(c) for c in ("last_ingested_cdc_value", "last_merged_watermark")],
        *[F.lit(True).alias(c) for c in FLAGS],
    )
    state = apply_state(before, ready, results).select(F.col("table_id").alias("target_id"), "state", "last_ingested_cdc_value")
    times = outcomes(spark, log).groupBy("table_id").agg(F.count(F.lit(1)).alias("attempts"))
    told = results.join(times, "table_id").join(ready.select("table_id", "target_id"), "table_id").join(state, "target_id")
    told = told.select("table_name", "status", "rows_written", "attempts", "target_id", "state", "last_ingested_cdc_value")
    rows = None
    for r in ready.select("table_name").collect():
        one = spark.table(f"{DATABASE}.{r[0]}").withColumn("table_name", F.lit(r[0]))
        rows = one if rows is None else rows.unionByName(one)
    return rows.join(told, "table_name")


def derived_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = [("l_shipdate", fmt, f"ship_{fmt.lower()}") for fmt in DERIVE_FORMATS.values()]
    derived = add_derived_partitions(fx.table(spark, sf_dir, "lineitem"), specs)
    return derived.groupBy(*[name for _, _, name in specs]).agg(
        F.count(F.lit(1)).alias("line_items")
    )


def derived_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range on the parent column of a table partitioned by year and month of it."""
    spec = ("l_shipdate", "yyyyMM", "ship_month")

    def write(path: str) -> None:
        lines = add_derived_partitions(fx.table(spark, sf_dir, "lineitem"), [spec])
        write_table(lines, path, "overwrite", "parquet", ["ship_month"], cluster="rebalance")

    path = fx.once(spark, sf_dir, "lineitem-by-month", write)
    fields = fx.table(spark, sf_dir, "lineitem").schema.fields
    schema = StructType([*fields, StructField("ship_month", StringType())])
    lines = spark.read.schema(schema).parquet(path)
    lo, hi = dt.datetime(1997, 3, 10), dt.datetime(1998, 2, 20)
    return (
        where_parent_between(lines, spec, lo, hi)
        .groupBy("ship_month")
        .agg(F.count(F.lit(1)).alias("line_items"), F.min("l_shipdate").alias("first_ship"))
    )


QUERIES = {
    "scan_parquet": scan("parquet", "recursive"),
    "scan_orc": scan("orc", "exact"),
    "scan_drifted": scan_drifted,
    "scan_format_case": scan_format_case,
    "cleanse_audit": cleansed_orders,
    "cleanse_file_source": cleanse_file_source,
    "rename_map": renamed(fx.ORDER_RENAMES),
    "rename_swap": renamed(fx.SWAP_RENAMES),
    "migrate_flat": migrate_flat,
    "migrate_partitioned": migrate_partitioned,
    "migrate_rows_parquet": migrated_rows("parquet"),
    "migrate_rows_orc": migrated_rows("orc"),
    "append_mode": append_mode,
    "register_table": register,
    "append_wider": appended(True),
    "append_narrower": appended(False),
    "swap_registered": swap_registered,
    "migrate_batch": batch,
    "migrate_resumed": migrate_resumed,
    "derived_partitions": derived_partitions,
    "derived_between": derived_between,
}

_DELETED = (
    "try_cast(trim(case o_orderstatus when 'F' then 'true' when 'O' then '0' else 'N' end)"
    " as boolean)"
)
_YEAR = "strftime(o_orderdate, '%Y')"
_DAY = "strftime(o_orderdate, '%Y-%m-%d')"
_SCAN = f"""
SELECT orders.*, {_YEAR} AS o_year, substring(o_orderpriority, 1, 1) AS o_prio_rx,
       cast(o_orderkey AS varchar) AS ziw_row_id, o_orderkey AS ziw_scn, o_orderkey AS ziw_offset,
       {_DAY} AS ziw_source_start_date, {_DAY} AS ziw_target_start_date,
       {_DAY} AS ziw_source_end_date, {_DAY} AS ziw_target_end_date,
       o_orderdate AS ziw_source_start_timestamp, o_orderdate AS ziw_source_end_timestamp,
       o_orderdate AS ziw_target_end_timestamp, o_orderdate AS ziw_target_start_timestamp,
       o_orderstatus <> 'F' AS ziw_active, 'I' AS ziw_status_flag,
       case o_orderstatus when 'F' then 'true' when 'O' then '0' else 'N' end AS ziw_is_deleted
FROM orders"""
_CLEANSED = f"""
{_YEAR} AS o_year, substring(o_orderpriority, 1, 1) AS o_prio_rx,
o_orderdate AS ziw_target_timestamp, {_DELETED} AS ziw_is_deleted"""
_MIGRATED = f"""
SELECT o_orderkey, o_custkey AS customer_id, o_orderstatus, o_totalprice AS total_price,
       o_orderdate, o_orderpriority, o_orderdate AS ziw_target_timestamp,
       {_DELETED} AS ziw_is_deleted, {_YEAR} AS o_year
FROM orders"""

_APPENDED = f"""
SELECT o_orderkey, customer_id, o_orderstatus, price AS total_price, o_orderdate, o_orderpriority,
       ziw_target_timestamp, ziw_is_deleted, o_year
FROM (SELECT *, total_price AS price FROM ({_MIGRATED}) UNION ALL SELECT *, NULL FROM ({_MIGRATED}))"""

ORACLES = {
    "scan_parquet": _SCAN,
    "scan_orc": _SCAN,
    "scan_format_case": f"""
SELECT o_orderkey AS "order key", o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       {_YEAR} AS "a.year", substring(o_orderpriority, 1, 1) AS o_prio_rx,
       o_orderdate AS ziw_target_timestamp, {_DELETED} AS ziw_is_deleted
FROM orders""",
    "scan_drifted": """
SELECT o_orderkey, o_custkey, if(o_orderkey % 3 = 0, NULL, o_orderstatus) AS o_orderstatus, o_totalprice,
       o_orderdate, o_orderpriority, if(o_orderkey % 3 = 2, o_custkey * 2, NULL) AS newcol
FROM orders""",
    "cleanse_audit": f"""
SELECT orders.*, {_YEAR} AS o_year, substring(o_orderpriority, 1, 1) AS o_prio_rx,
       o_orderdate AS ziw_target_timestamp, {_DELETED} AS ziw_is_deleted
FROM orders""",
    "cleanse_file_source": """
SELECT events.*, 'events_' || event_type || '.json' AS ziw_file_name, ts AS ziw_target_timestamp,
       event_id % 10 = 0 AS ziw_is_deleted, ts AS ziw_file_modified_timestamp
FROM events""",
    "rename_map": f"""
SELECT o_orderkey, o_custkey AS customer_id, o_orderstatus, o_totalprice AS total_price,
       o_orderdate, o_orderpriority, {_CLEANSED} FROM orders""",
    "rename_swap": f"""
SELECT o_orderkey AS o_custkey, o_custkey AS o_orderkey, o_orderstatus, o_totalprice, o_orderdate,
       o_orderpriority, {_CLEANSED} FROM orders""",
    "migrate_flat": """
SELECT event_id, ts, user_id, event_type AS kind, value, props,
       'events_' || event_type || '.json' AS ziw_file_name, ts AS ziw_target_timestamp,
       event_id % 10 = 0 AS ziw_is_deleted, ts AS ziw_file_modified_timestamp
FROM events""",
    "migrate_partitioned": f"""
SELECT {_YEAR} AS o_year, {_DELETED} AS is_deleted, count(*) AS orders,
       cast(sum(cast(o_totalprice AS decimal(18,2))) AS double) AS total_price,
       count(DISTINCT o_custkey) AS customers
FROM orders GROUP BY 1, 2""",
    "migrate_rows_parquet": _MIGRATED,
    "migrate_rows_orc": _MIGRATED,
    "append_mode": f"""
SELECT o_orderkey, {_YEAR} AS o_year, 2 * count(*) AS copies FROM orders GROUP BY 1, 2""",
    "register_table": _MIGRATED,
    "migrate_batch": """
SELECT 't1' AS table_id, 'b_orders' AS table_name, 'SUCCEEDED' AS status,
       count(*) AS rows_written, false AS failed FROM orders
UNION ALL SELECT 't2', 'b_orders_orc', 'SUCCEEDED', count(*), false FROM orders
UNION ALL SELECT 't3', 'b_events', 'SUCCEEDED', count(*), false FROM events
UNION ALL SELECT 't4', 'b_text', 'FAILED', NULL, true""",
    "append_wider": _APPENDED,
    "append_narrower": _APPENDED,
    "swap_registered": _MIGRATED,
    "migrate_resumed": """
SELECT c_custkey AS customer_id, c_name, n_name, timestamp '2020-01-01' AS ziw_target_timestamp,
       false AS ziw_is_deleted, 'customers_' || n_regionkey AS table_name, 'SUCCEEDED' AS status,
       count(*) OVER (PARTITION BY n_regionkey) AS rows_written, cast(1 AS bigint) AS attempts,
       'nr' || n_regionkey AS target_id, 'ready' AS state, cast(n_regionkey AS varchar) AS last_ingested_cdc_value
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "derived_partitions": """
SELECT strftime(l_shipdate, '%d') AS ship_dd, strftime(l_shipdate, '%m') AS ship_mm,
       strftime(l_shipdate, '%Y') AS ship_yyyy, strftime(l_shipdate, '%Y%m') AS ship_yyyymm,
       strftime(l_shipdate, '%m%d') AS ship_mmdd, strftime(l_shipdate, '%Y%m%d') AS ship_yyyymmdd,
       count(*) AS line_items
FROM lineitem GROUP BY 1, 2, 3, 4, 5, 6""",
    "derived_between": """
SELECT strftime(l_shipdate, '%Y%m') AS ship_month, count(*) AS line_items,
       min(l_shipdate) AS first_ship
FROM lineitem
WHERE l_shipdate BETWEEN timestamp '1997-03-10' AND timestamp '1998-02-20'
GROUP BY 1""",
}
