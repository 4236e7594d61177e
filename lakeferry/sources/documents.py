"""Catalog documents, configuration envelopes and delimited plan files.

Every reader has a fixed schema: nothing is inferred and no pass over the data
is spent on inference.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakeferry.functions.documents import millis_date, typed_id
from lakeferry.functions.names import quote
from lakeferry.model import (
    CONFIG_ENVELOPE,
    JOB,
    PLAN,
    PLAN_COLUMNS,
    SOURCE_DOCUMENT,
    SOURCE_DUMP,
    SOURCE_DUMP_COLUMNS,
    TABLE_DOCUMENT,
)
from lakeferry.operators.config import document_schema

# One separator per file kind, for its writer and its reader alike.
PLAN_SEPARATOR = "|"
DUMP_SEPARATOR = ","
LOG_SEPARATOR = ","

# Quotes are doubled inside quoted values and blanks belong to the value. A null
# is an empty field, so an empty text reads back as null.
QUOTING = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_tables(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TABLE_DOCUMENT).json(path)


def read_sources(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SOURCE_DOCUMENT).json(path)


def read_envelopes(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Exported configurations: one document per file, or one per line."""
    return spark.read.schema(CONFIG_ENVELOPE).option("multiLine", multi_line).json(path)


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    """Exported job or run records, one per line; of a run only its job matters."""
    return spark.read.schema(JOB).json(path)


def source_kind() -> Column:
    """``sfdc`` for Salesforce-like sources, else the source's type."""
    kind = F.lower("source.sourceType")
    is_salesforce = F.lower("source.sourceSubtype").eqNullSafe("salesforce")
    return F.when(is_salesforce, F.lit("sfdc")).otherwise(kind)


def envelope_sources(envelopes: DataFrame) -> DataFrame:
    """The source of every envelope, its connection fields as columns."""
    return envelopes.select(
        source_kind().alias("source_type"),
        "source.hive_schema",
        "source.sourceType",
        "source.sourceSubtype",
        "source.connection.*",
    ).distinct()


def envelope_tables(envelopes: DataFrame) -> DataFrame:
    """One row per table of every envelope, with the fields of its source."""
    table = F.col("t.configuration")
    return envelopes.select("source", F.explode("tables").alias("t")).select(
        typed_id(F.col("t.entity_id")).alias("table_id"),
        table["table"].alias("table"),
        F.col("source.hive_schema").alias("hive_schema"),
        source_kind().alias("source_type"),
        F.col("source.sourceSubtype").alias("source_subtype"),
        table["ingestion_configuration"].alias("ingestion_configuration"),
    )


def envelope_groups(envelopes: DataFrame) -> DataFrame:
    """One row per table group of every envelope."""
    group = F.col("g.configuration")
    return envelopes.select("source", F.explode("table_groups").alias("g")).select(
        F.col("source.hive_schema").alias("hive_schema"),
        typed_id(F.col("g.entity_id")).alias("group_id"),
        source_kind().alias("source_type"),
        group["name"].alias("name"),
        group["max_connections"].alias("max_connections"),
        group["max_parallel_entities"].alias("max_parallel_entities"),
        F.transform(
            group["tables"],
            lambda t: F.struct(
                typed_id(t["table_id"]).alias("table_id"),
                t["connection_quota"].alias("connection_quota"),
            ),
        ).alias("tables"),
        typed_id(group["source"]).alias("source"),
    )


def envelope_exports(envelopes: DataFrame) -> DataFrame:
    return envelopes.select(
        F.col("source.hive_schema").alias("hive_schema"),
        millis_date(F.col("export.exportedAt")).alias("exported_at"),
        F.col("export.exportedBy").alias("exported_by"),
    )


def write_documents(documents: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Converted configurations, one document a line; fields without a value are left out."""
    documents.write.mode(mode).json(path)


def read_documents(spark: SparkSession, path: str, connection: Sequence[str]) -> DataFrame:
    """Converted configurations whose sources have these connection fields."""
    return spark.read.schema(document_schema(connection)).json(path)


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PLAN).options(sep=PLAN_SEPARATOR, **QUOTING).csv(path)


def write_plan(plan: DataFrame, path: str, mode: str = "errorifexists") -> None:
    (
        plan.select(*PLAN_COLUMNS)
        .write.mode(mode)
        .options(sep=PLAN_SEPARATOR, **QUOTING)
        .csv(path)
    )


def read_source_dump(spark: SparkSession, path: str) -> DataFrame:
    """The known columns of a source file, found by the names in its header.

    Other columns, a credential above all, are not read; a missing one is an error,
    and so are files of one folder whose headers differ.
    """
    reader = spark.read.options(sep=DUMP_SEPARATOR, enforceSchema="false", **QUOTING)
    written = reader.csv(path)
    wanted = T._parse_datatype_string(SOURCE_DUMP)
    missing = [f.name for f in wanted if f.name not in written.columns]
    if missing:
        raise ValueError(f"source file {path} has no column {', '.join(missing)}")
    return written.select(*[F.col(quote(f.name)).cast(f.dataType).alias(f.name) for f in wanted])


def write_source_dump(dump: DataFrame, path: str, mode: str = "errorifexists") -> None:
    (
        dump.select(*[quote(name) for name in SOURCE_DUMP_COLUMNS])
        .write.mode(mode)
        .options(sep=DUMP_SEPARATOR, **QUOTING)
        .csv(path)
    )


def write_job_log(jobs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The outcome log ``job_id,status``."""
    jobs.select("job_id", "status").write.mode(mode).options(sep=LOG_SEPARATOR, **QUOTING).csv(path)
