"""Scan of landed Parquet and ORC trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeferry.model import LANDED_FORMATS, PartitionSpec

# Fixed value: directory levels of a landed tree below its partition levels.
TRAILING_LEVELS = 3


def landed_format(fmt: str) -> str:
    """The format in lower case; raises for anything but ORC and Parquet."""
    lowered = fmt.lower()
    if lowered not in LANDED_FORMATS:
        raise ValueError(f"unsupported landed format {fmt!r}, expected one of {LANDED_FORMATS}")
    return lowered


def landed_root(src_dir: str, fmt: str) -> str:
    return f"{src_dir.rstrip('/')}/merged/{landed_format(fmt)}"


def scan_landed(
    spark: SparkSession,
    src_dir: str,
    fmt: str,
    partitions: PartitionSpec = PartitionSpec(),
    layout: str = "recursive",
    schema: str | None = None,
) -> DataFrame:
    """The rows below ``<src_dir>/merged/<fmt>``.

    ``recursive`` takes every file at any depth. ``exact`` takes one directory
    level per partition column and three more. Neither reads values from
    directory names: landed files hold their partition columns. ``named`` is for
    trees that do not, and infers them from ``name=value`` directories.

    Without ``schema`` the columns of all files are taken together, a column that
    a file lacks being null in its rows; files that disagree on a type are an error.
    """
    root = landed_root(src_dir, fmt)
    reader = spark.read.format(landed_format(fmt))
    reader = reader.schema(schema) if schema else reader.option("mergeSchema", "true")
    if layout == "recursive":
        return reader.option("recursiveFileLookup", "true").load(root)
    if layout == "exact":
        return reader.load("/".join([root] + ["*"] * (partitions.depth + TRAILING_LEVELS)))
    if layout == "named":
        return reader.option("basePath", root).load(root)
    raise ValueError(f"unknown layout {layout!r}")
