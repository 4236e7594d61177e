"""Migration planning, source inventory, job selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeferry.functions.columns import compose_renames, partition_spec, rename_map
from lakeferry.functions.names import quote
from lakeferry.operators import catalog
from lakeferry.session import fresh_dir
from lakeferry.sources.documents import (
    DUMP_SEPARATOR,
    LOG_SEPARATOR,
    QUOTING,
    read_plan,
    read_source_dump,
    write_job_log,
    write_plan,
    write_source_dump,
)
from lakeferry.workload import fixtures as fx


def plan_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.plan_tables(fx.table_documents(spark, sf_dir))


def plan_for_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables of all relational sources, by a relation of source ids."""
    ids = fx.source_documents(spark, sf_dir).where("sourceType = 'rdbms'").select("src_id")
    rows = catalog.plan_tables(fx.table_documents(spark, sf_dir), ids)
    return rows.select("table_id", "table_name", "source_id", "sync_type")


def plan_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.plan_migration(
        fx.table_documents(spark, sf_dir), fx.source_documents(spark, sf_dir)
    )


def plan_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan after writing and reading its delimited file, with its JSON parsed."""
    path = fresh_dir(spark, "plan")
    write_plan(plan_join(spark, sf_dir), path)
    plan = read_plan(spark, path)
    spec = F.from_json("partition_column", "struct<normal:array<string>,drop:array<string>>")
    renames = F.from_json("override_columns", "map<string,string>")
    return plan.select(
        "*",
        F.array_join(spec["normal"], ",").alias("normal_partitions"),
        F.array_join(spec["drop"], ",").alias("dropped_partitions"),
        F.try_element_at(renames, F.lit("c2")).alias("c2_name"),
        F.try_element_at(renames, F.lit("c3")).alias("c3_name"),
    )


def plan_target_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    matched = catalog.match_targets(
        plan_join(spark, sf_dir), fx.target_documents(spark, sf_dir)
    )
    columns = ["table_id", "hive_schema", "table_name", "target_id", "target_dir"]
    return matched.select(
        *columns, "override_columns", F.col("target_id").isNotNull().alias("found")
    )


def distinct_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.distinct_sources(fx.table_documents(spark, sf_dir))


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.table_counts(fx.table_documents(spark, sf_dir))


def partition_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = partition_spec(F.col("ingestion_configuration.partition_key"))
    specs = fx.table_documents(spark, sf_dir).select("table_id", spec.alias("spec"))
    kinds = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), F.col(f"spec.{kind}").alias("names"))
            for kind in ("normal", "drop")
        ]
    )
    return specs.select("table_id", F.inline(kinds)).select(
        "table_id", "kind", F.posexplode("names").alias("position", "column_name")
    )


def rename_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table_documents(spark, sf_dir).select(
        "table_id", F.explode(rename_map(F.col("columns"))).alias("orig_name", "new_name")
    )


def composed_renames(spark: SparkSession, sf_dir: str) -> DataFrame:
    onprem = fx.table_documents(spark, sf_dir).select(
        "table_id", rename_map(F.col("columns")).alias("onprem")
    )
    target = fx.target_documents(spark, sf_dir).select(
        F.substring("table_id", 2, 20).alias("table_id"), rename_map(F.col("columns")).alias("target")
    )
    composed = F.when(F.col("target").isNotNull(), compose_renames(F.col("onprem"), F.col("target")))
    return onprem.join(target, "table_id", "left").select(
        "table_id", F.explode_outer(composed).alias("landed_name", "new_name")
    )


def rename_maps_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per supplier with a rename for each of its parts, some of them given twice."""
    lines = fx.table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey")
    one = F.struct(
        "l_orderkey", "l_linenumber", F.concat(F.lit("p"), "l_partkey").alias("origName"),
        F.concat(F.lit("o"), "l_orderkey", F.lit("_"), "l_linenumber").alias("name"),
    )
    columns = F.transform(
        F.array_sort(F.collect_list(one)),
        lambda c: F.struct(c["origName"].alias("origName"), c["name"].alias("name")),
    )
    documents = lines.groupBy("l_suppkey").agg(columns.alias("columns"))
    return documents.select("l_suppkey", F.explode(rename_map(F.col("columns"))).alias("orig_name", "new_name"))


def _flat_names(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(quote(c)).alias(c.replace(".", "_")) for c in df.columns])


def _dump_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dump rows as read back from the delimited file."""

    def write(path: str) -> None:
        write_source_dump(catalog.source_dump(fx.source_documents(spark, sf_dir))[0], path)

    return read_source_dump(spark, fx.once(spark, sf_dir, "source-dump", write))


def source_dump_foreign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source file written elsewhere: other order, more columns, a credential among them."""

    def write(path: str) -> None:
        dump = catalog.source_dump(fx.source_documents(spark, sf_dir))[0]
        names = list(reversed(dump.columns))
        foreign = dump.withColumns({"connection.secret": F.lit("S3CRET"), "note": F.lit("x,y")})
        columns = [*names[:6], "connection.secret", *names[6:], "note"]
        options = {"sep": DUMP_SEPARATOR, **QUOTING}
        foreign.select(*[quote(c) for c in columns]).write.options(**options).csv(path)

    return _flat_names(read_source_dump(spark, fx.once(spark, sf_dir, "foreign-dump", write)))


def plan_target_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plan rows that must not run: no target, a target without a path, a path shared."""
    number = F.substring("table_id", 3, 20).cast("bigint")
    target = fx.target_documents(spark, sf_dir).withColumn(
        "hdfs_path",
        F.when(number % 13 == 0, None).when(number % 17 == 0, "/target/shared/").otherwise(F.col("hdfs_path")),
    )
    rejected = catalog.resolve_targets(plan_join(spark, sf_dir), target)[1]
    return rejected.select("table_id", "reason")


def source_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_names(_dump_files(spark, sf_dir))


def source_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.source_dump(fx.source_documents(spark, sf_dir))[1]


def source_descriptors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_names(catalog.source_descriptors(_dump_files(spark, sf_dir)))


def existing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = fx.source_documents(spark, sf_dir)
    target = sources.where("cast(src_id as bigint) % 5 < 4")
    return catalog.existing(sources, target, ["name"], ["src_id"]).select("src_id", "name")


def idle_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.idle_jobs(*fx.job_records(spark, sf_dir))


def find_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first source of a kind, by name."""
    sources = fx.source_documents(spark, sf_dir)
    return catalog.find_one(sources, {"sourceType": "file"}, ["name"]).select("src_id", "name")


def grant_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Access lists as arrays: missing, without the source, and with it already."""
    source = F.concat(F.lit("n"), "s_nationkey")
    granted = (
        F.when(F.col("s_suppkey") % 3 == 1, F.array(F.lit("a")))
        .when(F.col("s_suppkey") % 3 == 2, F.array(source, F.lit("a")))
    )
    lists = fx.table(spark, sf_dir, "supplier").select("s_suppkey", granted.alias("access"), source.alias("source"))
    after = catalog.grant(F.col("access"), F.col("source"))
    return lists.select("s_suppkey", F.array_join(after, ",").alias("access"))


def job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome log of the idle jobs, written and read back."""
    path = fresh_dir(spark, "job-log")
    write_job_log(idle_jobs(spark, sf_dir), path)
    options = {"sep": LOG_SEPARATOR, **QUOTING}
    return spark.read.schema("job_id bigint, status string").options(**options).csv(path)


QUERIES = {
    "plan_tables": plan_tables,
    "plan_for_sources": plan_for_sources,
    "plan_join": plan_join,
    "plan_roundtrip": plan_roundtrip,
    "plan_target_join": plan_target_join,
    "distinct_sources": distinct_sources,
    "table_counts": table_counts,
    "partition_spec": partition_specs,
    "rename_maps": rename_maps,
    "rename_maps_wide": rename_maps_wide,
    "compose_renames": composed_renames,
    "source_dump": source_dump,
    "source_dump_foreign": source_dump_foreign,
    "plan_target_rejected": plan_target_rejected,
    "source_rejected": source_rejected,
    "source_descriptors": source_descriptors,
    "existing_sources": existing_sources,
    "idle_jobs": idle_jobs,
    "job_log": job_log,
    "find_one": find_one,
    "grant_lists": grant_lists,
}

SOURCE = "if(p_partkey % 3 = 0, '0', cast(p_partkey // 16 AS varchar))"
SYNC = (
    "case p_size % 4 when 0 then 'full-load' when 1 then 'cdc-timestamp-column'"
    " when 2 then 'cdc-batch-id' else 'query-based' end"
)
SUBTYPE = "['sqlserver','teradata','oracle','netezza','db2'][s_suppkey % 5 + 1]"
_NORMAL = "case p_partkey % 4 when 1 then 'pk_a' when 2 then 'c2_ym' when 3 then 'pk_a' else '' end"
_DROP = "case p_partkey % 4 when 3 then 'c3_rx' else '' end"
_LIST = "'[' || if({0} = '', '', '\"' || {0} || '\"') || ']'"
_OVERRIDES = (
    "if(p_partkey % 2 = 0, '{\"c3\":\"c3_new\"}', '{\"c2\":\"c2_new\",\"c3\":\"c3_new\"}')"
)
_PLAN_TABLES = f"""
SELECT 't' || p_partkey AS table_id, 'tbl_' || p_partkey AS table_name,
       if(p_partkey % 2 = 0, 'parquet', 'orc') AS storage_format,
       '/lake/' || p_partkey AS src_dir, {SOURCE} AS source_id,
       if(p_size % 10 = 0, NULL, cast(p_size AS varchar)) AS last_ingested_cdc_value,
       '2020-01-01 00:00:00' AS last_merged_timestamp, {SYNC} AS sync_type,
       '{{"normal":' || {_LIST.format(_NORMAL)} || ',"drop":' || {_LIST.format(_DROP)} || '}}'
         AS partition_column,
       {_OVERRIDES} AS override_columns
FROM part WHERE p_partkey % 5 <> 0 AND p_size % 4 IN (1, 2)"""
_PLAN = f"""
SELECT p.*, s_name AS source_name, 'supp_' || s_suppkey AS hive_schema,
       if(s_suppkey % 2 = 0, 'rdbms', 'file') AS source_type, {SUBTYPE} AS "sourceSubtype"
FROM ({_PLAN_TABLES}) p JOIN supplier ON source_id = cast(s_suppkey AS varchar)"""
_VALID = """s_suppkey % 2 = 0 AND s_suppkey % 5 < 4 AND s_suppkey % 6 <> 0"""

ORACLES = {
    "plan_tables": _PLAN_TABLES,
    "plan_for_sources": f"""
SELECT table_id, table_name, source_id, sync_type FROM ({_PLAN_TABLES})
WHERE source_id IN (SELECT cast(s_suppkey AS varchar) FROM supplier WHERE s_suppkey % 2 = 0)""",
    "plan_join": _PLAN,
    "plan_roundtrip": f"""
SELECT plan.*, {_NORMAL} AS normal_partitions, {_DROP} AS dropped_partitions,
       if(p_partkey % 2 = 1, 'c2_new', NULL) AS c2_name, 'c3_new' AS c3_name
FROM ({_PLAN}) plan JOIN part ON table_id = 't' || p_partkey""",
    "plan_target_join": f"""
SELECT table_id, hive_schema, table_name,
       if(p_partkey % 11 <> 0, 'nt' || p_partkey, NULL) AS target_id,
       if(p_partkey % 11 <> 0, '/target/' || p_partkey || '/merged', NULL) AS target_dir,
       if(p_partkey % 11 <> 0, '{{"c1":"c1_t","c3_new":"c3_t"}}', override_columns)
         AS override_columns,
       p_partkey % 11 <> 0 AS found
FROM ({_PLAN}) plan JOIN part ON table_id = 't' || p_partkey""",
    "distinct_sources": f"SELECT DISTINCT {SOURCE} AS source_id FROM part",
    "table_counts": f"""
SELECT {SOURCE} AS source_id, {SYNC} AS sync_type, count(*) AS table_count
FROM part GROUP BY 1, 2""",
    "partition_spec": f"""
SELECT 't' || p_partkey AS table_id, 'normal' AS kind, cast(0 AS integer) AS position,
       {_NORMAL} AS column_name FROM part WHERE {_NORMAL} <> ''
UNION ALL
SELECT 't' || p_partkey, 'drop', cast(0 AS integer), {_DROP} FROM part WHERE {_DROP} <> ''""",
    "rename_maps": """
SELECT 't' || p_partkey AS table_id, 'c2' AS orig_name, 'c2_new' AS new_name
FROM part WHERE p_partkey % 2 = 1
UNION ALL SELECT 't' || p_partkey, 'c3', 'c3_new' FROM part""",
    "compose_renames": """
SELECT 't' || p_partkey AS table_id, landed_name, new_name
FROM part, (VALUES ('c1', 'c1_t'), ('c3_new', 'c3_t')) v(landed_name, new_name)
WHERE p_partkey % 11 <> 0
UNION ALL SELECT 't' || p_partkey, NULL, NULL FROM part WHERE p_partkey % 11 = 0""",
    "rename_maps_wide": """
SELECT l_suppkey, 'p' || l_partkey AS orig_name, 'o' || l_orderkey || '_' || l_linenumber AS new_name
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_orderkey DESC, l_linenumber DESC) = 1""",
    "source_dump": f"""
SELECT 'drv' AS connection_driver_name, 'dbo' AS connection_schema, s_name AS connection_database,
       if(s_suppkey % 4 = 0, 'jdbc', 'tpt') AS connection_connection_method,
       'jdbc:x' AS connection_connection_string, 'u' AS connection_username,
       'supp_' || s_suppkey AS hive_schema, 'rdbms' AS "sourceType",
       {SUBTYPE} AS "sourceSubtype", s_name AS name, '/src/' || s_suppkey AS hdfs_path,
       s_suppkey % 4 <> 0 AS "isPublic"
FROM supplier WHERE {_VALID}""",
    "source_rejected": """
SELECT cast(s_suppkey AS varchar) AS src_id, s_name AS name, 'missing connection field' AS reason
FROM supplier WHERE s_suppkey % 2 = 0 AND s_suppkey % 5 < 4 AND s_suppkey % 6 = 0""",
    "source_descriptors": f"""
SELECT 'drv' AS connection_driver_name, 'dbo' AS connection_schema, s_name AS connection_database,
       if(s_suppkey % 5 = 1 OR s_suppkey % 4 = 0, 'jdbc', 'tpt') AS connection_connection_method,
       'jdbc:x' AS connection_connection_string, 'u' AS connection_username,
       'supp_' || s_suppkey AS hive_schema, 'rdbms' AS "sourceType",
       {SUBTYPE} AS "sourceSubtype", s_name AS name, '/src/' || s_suppkey AS hdfs_path,
       s_suppkey % 4 <> 0 AS "isPublic",
       if(s_suppkey % 5 = 1, s_suppkey % 4 <> 0, NULL) AS connection_enable_tpt_for_source,
       if(s_suppkey % 5 = 2, false, NULL) AS configuration_oracle_logbased_cdc_enabled
FROM supplier WHERE {_VALID}""",
    "existing_sources": """
SELECT cast(s_suppkey AS varchar) AS src_id, s_name AS name FROM supplier WHERE s_suppkey % 5 < 4""",
    "idle_jobs": """
SELECT c_custkey AS job_id, 'idle' AS status FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')
ORDER BY job_id DESC""",
}

ORACLES["source_dump_foreign"] = ORACLES["source_dump"]
ORACLES["plan_target_rejected"] = f"""
SELECT table_id, reason FROM (
  SELECT table_id,
         CASE WHEN p_partkey % 11 = 0 THEN 'no target'
              WHEN p_partkey % 13 = 0 THEN 'no target path'
              WHEN p_partkey % 17 = 0 AND row_number() OVER (
                PARTITION BY p_partkey % 11 <> 0 AND p_partkey % 13 <> 0 AND p_partkey % 17 = 0
                ORDER BY table_id, source_id) > 1 THEN 'shared target' END AS reason
  FROM ({_PLAN}) plan JOIN part ON table_id = 't' || p_partkey)
WHERE reason IS NOT NULL"""
ORACLES["job_log"] = ORACLES["idle_jobs"]
ORACLES["find_one"] = """
SELECT cast(s_suppkey AS varchar) AS src_id, s_name AS name FROM supplier WHERE s_suppkey % 2 <> 0
ORDER BY s_name LIMIT 1"""
ORACLES["grant_lists"] = """
SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'n' || s_nationkey WHEN 1 THEN 'a,n' || s_nationkey
                  ELSE 'n' || s_nationkey || ',a' END AS access
FROM supplier"""
