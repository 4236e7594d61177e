"""Names below a path, their age, and their removal, by the session's own file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    """(file system, path) of Hadoop, which Spark itself reads and writes through."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``, in order; none where there is no such folder."""
    files, place = _located(spark, path)
    if not files.exists(place):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(place))


def modified_seconds(spark: SparkSession, path: str) -> float:
    files, place = _located(spark, path)
    return files.getFileStatus(place).getModificationTime() / 1000


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all below it; nothing happens where there is none."""
    files, place = _located(spark, path)
    files.delete(place, True)
