"""Partitioned writes, the overlap guard, and table registration."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from lakeferry.functions.names import folded, qualified, quote, require_columns
from lakeferry.model import WRITE_MODES, MergeSpec
from lakeferry.operators.incremental import latest_per_key, split_null_keys
from lakeferry.sinks import storage


def default_table_format(spark: SparkSession) -> str:
    """``delta`` where the session has its SQL extension, else ``parquet``."""
    extensions = spark.conf.get("spark.sql.extensions", "") or ""
    return "delta" if "DeltaSparkSessionExtension" in extensions else "parquet"


def write_mode(mode: str) -> str:
    """The mode in lower case; raises for anything but overwrite and append."""
    lowered = mode.lower()
    if lowered not in WRITE_MODES:
        raise ValueError(f"unknown write mode {mode!r}, expected one of {WRITE_MODES}")
    return lowered


def check_no_overlap(source: str, target: str) -> None:
    """Refuse a target that holds, equals or lies in its source.

    Spark empties an overwritten path before it has read it all. Two paths are told
    apart by their stores only if both name theirs: a scheme or an authority left
    out may be the other's.
    """
    (source_store, source_path), (target_store, target_path) = _located(source), _located(target)
    if any(one and other and one != other for one, other in zip(source_store, target_store)):
        return
    if source_path.startswith(target_path) or target_path.startswith(source_path):
        raise ValueError(f"source {source} and target {target} overlap")


# Schemes that lead to the same store.
SAME_STORE = {
    "s3a": "s3", "s3n": "s3", "abfss": "abfs", "wasbs": "wasb",
    "webhdfs": "hdfs", "swebhdfs": "hdfs", "viewfs": "hdfs",
}


def _located(path: str) -> tuple[tuple[str, str], str]:
    """((scheme, authority), normal path); either is empty where it is not known.

    The ports of one host's services differ, and mounted views name other hosts, so
    that of these schemes only the path is compared.
    """
    parts = urlsplit(path)
    scheme = SAME_STORE.get(parts.scheme.lower(), parts.scheme.lower())
    authority = "" if scheme == "hdfs" else parts.netloc.lower()
    return (scheme, authority), posixpath.normpath("/" + parts.path.lstrip("/")).rstrip("/") + "/"


def check_partitioning(df: DataFrame, partition_by: Sequence[str]) -> None:
    require_columns(df, partition_by)
    if partition_by and {folded(df, c) for c in df.columns} == {folded(df, c) for c in partition_by}:
        raise ValueError("a table needs a column besides its partition columns")


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    fmt: str | None = None,
    partition_by: Sequence[str] = (),
    cluster: str = "none",
    counted: Observation | None = None,
) -> None:
    """Write ``df`` below ``path``; ``append`` adds, ``overwrite`` replaces.

    With ``cluster="rebalance"`` rows are shuffled by partition value first, so
    that few files are written per partition. The rebalance hint leaves it to
    adaptive execution to split a hot partition over many tasks and to join
    small ones; ``repartition`` would send a hot partition to one task.

    ``counted`` receives ``rows`` and ``partitions`` (the partition values as text),
    observed in the writing stage itself: a shuffle stage run again after a lost
    executor cannot count rows twice.
    """
    mode = write_mode(mode)
    if cluster not in ("none", "rebalance"):
        raise ValueError(f"unknown clustering {cluster!r}")
    check_partitioning(df, partition_by)
    if cluster == "rebalance":
        df = df.hint("rebalance", *[F.col(quote(c)) for c in partition_by])
    if counted is not None:
        values = F.struct(*[F.col(quote(c)).cast("string").alias(f"v{i}") for i, c in enumerate(partition_by)] or [F.lit(0)])
        df = df.observe(counted, F.count(F.lit(1)).alias("rows"), F.collect_set(values).alias("partitions"))
    writer = df.write.format(fmt or default_table_format(df.sparkSession)).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def save_bucketed(
    df: DataFrame, database: str, table: str, path: str, keys: Sequence[str], buckets: int
) -> None:
    """Save a table bucketed and sorted by its natural keys.

    A later join or merge on these keys reads it without a shuffle, whatever the
    size of the other side, given at least as many buckets as shuffle partitions.
    Rows are brought together first, one file per bucket.
    """
    require_columns(df, keys)
    spark = df.sparkSession
    name = qualified(database, table)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(database)}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (
        df.repartition(buckets, *[F.col(quote(k)) for k in keys])
        .write.mode("overwrite")
        .format("parquet")
        .option("path", path)
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(name)
    )


def merge_statement(table: str, source: str, spec: MergeSpec) -> str:
    """The upsert of ``source`` (one row per key) into ``table``; ties favour the source."""
    on = " AND ".join(f"t.{quote(k)} = s.{quote(k)}" for k in spec.keys)
    stamp = quote(spec.watermark)
    return (
        f"MERGE INTO {table} t USING {source} s ON {on} "
        f"WHEN MATCHED AND (t.{stamp} IS NULL OR s.{stamp} >= t.{stamp}) THEN UPDATE SET * "
        "WHEN NOT MATCHED THEN INSERT *"
    )


def merge_into_table(spark: SparkSession, table: str, delta: DataFrame, spec: MergeSpec) -> None:
    """Upsert into a table whose format supports ``MERGE``, such as Delta.

    Same rule as ``merge_upsert``; rows with null keys are not merged.
    """
    valid, _ = split_null_keys(delta, spec.keys)
    view = f"merge_source_{uuid.uuid4().hex}"
    newest = latest_per_key(valid, spec.keys, spec.watermark, spec.tiebreak)
    newest.createOrReplaceTempView(view)
    try:
        spark.sql(merge_statement(table, view, spec))
    finally:
        spark.catalog.dropTempView(view)


@dataclass(frozen=True)
class Registered:
    """What the catalog knows of a table."""

    provider: str
    location: str
    schema: StructType
    partition_by: tuple[str, ...]


def registered(spark: SparkSession, database: str, table: str) -> Registered | None:
    name = qualified(database, table)
    if not spark.catalog.tableExists(name):
        return None
    told = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    partitions = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    return Registered(
        (told.get("Provider") or "").lower(), told.get("Location") or "", spark.table(name).schema, tuple(partitions)
    )


def check_append(spark: SparkSession, database: str, table: str, df: DataFrame, partition_by: Sequence[str]) -> None:
    """Refuse rows that the registered table could not hold: another type, another partitioning."""
    known = registered(spark, database, table)
    if known is None:
        return
    if [folded(df, c) for c in known.partition_by] != [folded(df, c) for c in partition_by]:
        raise ValueError(f"{table} is partitioned by {list(known.partition_by)}, not by {list(partition_by)}")
    changed = _retyped(df, known.schema, df.schema)
    if changed:
        raise ValueError(f"columns {changed} of {table} have another type")


def _retyped(df: DataFrame, before: StructType, after: StructType) -> list[str]:
    """Columns of both whose types differ."""
    kinds = {folded(df, f.name): f.dataType.simpleString() for f in before.fields}
    return [f.name for f in after.fields if kinds.get(folded(df, f.name), kind := f.dataType.simpleString()) != kind]


def register_table(
    spark: SparkSession,
    database: str,
    table: str,
    path: str,
    fmt: str,
    schema_ddl: str | None = None,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    written: Sequence[Mapping[str, str | None]] | None = None,
) -> None:
    """Point ``database.table`` at ``path``; a table that is there is altered, so that it can be read throughout.

    After an append the table has the columns it had and those that are new; after an
    overwrite those of the schema. A registered table gets a new location by ``ALTER
    TABLE … SET LOCATION``: at one stroke without partitions, else one partition after
    the other, each of which is old or new but never missing. Only where columns went
    away or changed their type, or the format or partitioning is another, is the table
    dropped and created again.

    ``written`` names the partitions of the load, as text; without it the path is listed.
    The declared schema keeps partition values as they were written (text ``'01'``
    stays text). Errors are not swallowed.
    """
    name, location = qualified(database, table), _text(path)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(database)}")
    if fmt == "delta":  # its columns and partitions are in its own log
        if spark.catalog.tableExists(name):
            spark.sql(f"ALTER TABLE {name} SET LOCATION {location}")
        else:
            spark.sql(f"CREATE TABLE {name} USING delta LOCATION {location}")
        return
    declared = StructType.fromDDL(schema_ddl) if schema_ddl else spark.read.format(fmt).load(path).schema
    known = registered(spark, database, table)
    if known is None or not _alterable(spark, known, declared, fmt, partition_by, mode):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        listed = ", ".join(quote(c) for c in partition_by)
        spark.sql(
            f"CREATE TABLE {name} ({declared.toDDL()}) USING {fmt} "
            + (f"PARTITIONED BY ({listed}) " if partition_by else "")
            + f"LOCATION {location}"
        )
        if partition_by and (written is None or mode == "append"):
            spark.sql(f"MSCK REPAIR TABLE {name}")
        elif partition_by:
            _add_partitions(spark, name, written)
        return
    present = {folded(spark.range(0), f.name) for f in known.schema.fields}
    fresh = [f for f in declared.fields if folded(spark.range(0), f.name) not in present]
    if fresh:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({StructType(fresh).toDDL()})")
    moved = _located(known.location) != _located(path)
    if moved:
        spark.sql(f"ALTER TABLE {name} SET LOCATION {location}")
    if partition_by and mode == "append" and written is not None:
        _add_partitions(spark, name, written)
    elif partition_by and mode == "append":
        spark.sql(f"MSCK REPAIR TABLE {name}")
    elif partition_by:
        _replace_partitions(spark, name, path, declared, partition_by, moved, written)
    spark.catalog.refreshTable(name)


def _alterable(
    spark: SparkSession, known: Registered, declared: StructType, fmt: str, partition_by: Sequence[str], mode: str
) -> bool:
    one = spark.range(0)
    present = {folded(one, f.name) for f in declared.fields}
    gone = [f.name for f in known.schema.fields if folded(one, f.name) not in present]
    return (
        known.provider == fmt.lower()
        and [folded(one, c) for c in known.partition_by] == [folded(one, c) for c in partition_by]
        and not _retyped(one, known.schema, declared)
        and (mode == "append" or not gone)
    )


# Fixed value: the folder of rows without a partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
PARTITIONS_AT_ONCE = 200


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spec(values: Mapping[str, str | None]) -> str:
    cells = (f"{quote(k)} = {'NULL' if v in (None, '', NO_VALUE) else _text(v)}" for k, v in values.items())
    return f"PARTITION ({', '.join(cells)})"


def _add_partitions(spark: SparkSession, name: str, written: Sequence[Mapping[str, str | None]]) -> None:
    for start in range(0, len(written), PARTITIONS_AT_ONCE):
        specs = " ".join(_spec(w) for w in written[start : start + PARTITIONS_AT_ONCE])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")


def _replace_partitions(
    spark: SparkSession, name: str, path: str, declared: StructType, partition_by: Sequence[str], moved: bool,
    written: Sequence[Mapping[str, str | None]] | None,
) -> None:
    """Make the written partitions the table's only ones, without taking any away that stays."""

    def key(values: Mapping[str, str | None]) -> tuple:
        return tuple(values[c] if values[c] not in (None, "") else NO_VALUE for c in partition_by)

    before = {}
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
        shown = dict(zip(partition_by, (unquote(cell.partition("=")[2]) for cell in row[0].split("/"))))
        before[key(shown)] = shown
    folders = {}
    if moved or written is None:
        folders = {key(values): (values, folder) for values, folder in partition_folders(spark, path, declared, partition_by)}
    now = {key(w): w for w in written} if written is not None else {k: v for k, (v, _) in folders.items()}
    if moved:
        for k in before.keys() & now.keys():
            spark.sql(f"ALTER TABLE {name} {_spec(now[k])} SET LOCATION {_text(folders[k][1])}")
    _add_partitions(spark, name, [now[k] for k in now.keys() - before.keys()])
    gone = [before[k] for k in before.keys() - now.keys()]
    for start in range(0, len(gone), PARTITIONS_AT_ONCE):
        specs = ", ".join(_spec(g) for g in gone[start : start + PARTITIONS_AT_ONCE])
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {specs}")


def partition_folders(
    spark: SparkSession, path: str, schema: StructType, partition_by: Sequence[str]
) -> list[tuple[dict[str, str | None], str]]:
    """The partitions below ``path``: values as text, folder. Files are listed, not opened."""
    if not any("=" in name for name in storage.names(spark, path)):
        return []
    listing = "path string, modificationTime timestamp, length bigint, content binary"
    kinds = StructType([*StructType.fromDDL(listing).fields, *[schema[c] for c in partition_by]])
    files = spark.read.format("binaryFile").schema(kinds).option("basePath", path).load(path)
    found = files.select(
        *[F.col(quote(c)).cast("string").alias(f"v{i}") for i, c in enumerate(partition_by)],
        F.regexp_replace("path", "/[^/]*$", "").alias("folder"),
    ).distinct()
    return [(dict(zip(partition_by, r[:-1])), r[-1]) for r in found.collect()]
