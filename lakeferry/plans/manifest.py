"""Which files make up a version of a partitioned base.

A version's manifest lists every file with its partition values. Partitions that a
compaction did not touch stay where they are, in the folder of the version that wrote
them: the manifest carries their entries on. Files are listed by Spark without being
opened; readers are given the folders of the manifest, and partition values keep the
types of the base.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from lakeferry.functions.names import quote
from lakeferry.operators.joins import semi_null_safe
from lakeferry.sinks import storage

LISTED = "path string, modificationTime timestamp, length bigint, content binary, version bigint"
PATH, FOLDER, BYTES, VERSION = "_path", "_folder", "_bytes", "_version"


def _place(target: str, version: int) -> str:
    return f"{target}/manifest/version={version}"


def listed(spark: SparkSession, target: str, version: int, partitions: StructType) -> DataFrame:
    """The files of one version's folder: path below ``base``, folder, bytes, version, partition values."""
    base = f"{target}/base"
    if not any("=" in name for name in storage.names(spark, f"{base}/version={version}")):
        own = f"{PATH} string, {FOLDER} string, {BYTES} bigint, {VERSION} bigint"
        return spark.createDataFrame([], StructType([*StructType.fromDDL(own).fields, *partitions.fields]))
    schema = StructType([*StructType.fromDDL(LISTED).fields, *partitions.fields])
    files = (
        spark.read.format("binaryFile").schema(schema)
        .option("basePath", base).option("pathGlobFilter", "*.parquet")
        .load(f"{base}/version={version}")
    )
    below = F.substring_index("path", "/base/", -1)
    return files.select(
        below.alias(PATH), F.regexp_replace(below, "/[^/]*$", "").alias(FOLDER), F.col("length").alias(BYTES),
        F.col("version").alias(VERSION), *[quote(f.name) for f in partitions.fields],
    )


def publish(
    spark: SparkSession,
    target: str,
    version: int,
    partitions: StructType,
    former: int | None = None,
    touched: DataFrame | None = None,
) -> None:
    """Write the manifest of ``version``: its own files, and the former version's of untouched partitions."""
    entries = listed(spark, target, version, partitions)
    if former is not None:
        kept = semi_null_safe(read(spark, target, former), touched, partitions.fieldNames(), "left_anti")
        entries = kept.unionByName(entries)
    entries.write.mode("overwrite").parquet(_place(target, version))


def read(spark: SparkSession, target: str, version: int) -> DataFrame:
    return spark.read.parquet(_place(target, version))


def folders(entries: DataFrame) -> list[str]:
    """Folders below ``base``; as many as there are partitions."""
    return sorted(r[0] for r in entries.select(FOLDER).distinct().collect())


def rows(spark: SparkSession, target: str, paths: Sequence[str], schema: StructType) -> DataFrame:
    """The rows in some folders of a base, with the columns of ``schema`` in its order."""
    if not paths:
        return spark.createDataFrame([], schema)
    base = f"{target}/base"
    found = spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{p}" for p in paths])
    return found.select(*[quote(f.name) for f in schema.fields])


def partition_rows(spark: SparkSession, values: Sequence[Row], partitions: StructType) -> DataFrame:
    return spark.createDataFrame([tuple(v) for v in values], partitions)
