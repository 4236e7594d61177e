"""Incremental loads into a merged table kept as a base and its deltas.

A load must not rewrite a large base. Each batch is reduced to the latest row per
key and written, once, to its own directory of the target, ``delta/batch_id=<n>``;
readers merge base and deltas, and ``compact`` folds deltas into a new base
version now and then. Nothing that is being read is ever overwritten, and a
repeated batch replaces exactly its own directory. A version or batch counts only
once it is noted in the commit log (``plans.commits``). A target has one writer.

A base with ``partition_by`` is compacted by partition: only partitions that hold a
key of the deltas, or are to hold one, are written anew; a manifest per version
(``plans.manifest``) says where the files of the others are. ``clean`` removes what
no reader that began within a stated time can need.

Loads and streams share one numbering: a batch gets its number at its commit. A
micro-batch is known by its stream and epoch, never by its epoch alone, so that two
streams, or one with a new checkpoint, cannot take each other for a repetition.
Watermarks are kept with their type and zone (``operators.watermarks``).
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from lakeferry.functions.names import qualified, quote, require_columns
from lakeferry.model import MergeSpec
from lakeferry.operators.incremental import (
    has_null_key,
    incremental_filter,
    latest_per_key,
    merge_upsert,
    split_null_keys,
)
from lakeferry.operators.joins import semi_null_safe
from lakeferry.operators.watermarks import Watermark, given, reached
from lakeferry.plans import commits as log, manifest
from lakeferry.plans.commits import BASE, BATCH
from lakeferry.sinks import storage
from lakeferry.sinks.tables import save_bucketed

REJECTED, ALONE = "_rejected", "_alone"


@dataclass(frozen=True)
class LoadResult:
    batch_id: int
    rows: int
    watermark: str | None


def publish_base(
    base: DataFrame,
    target: str,
    spec: MergeSpec,
    version: int = 0,
    watermark: str | Watermark | None = None,
    unique: bool = False,
) -> None:
    """Write a base version; it holds every batch with an id below ``version``.

    A base has one row per key, its latest; rows with null keys pass through.
    ``unique`` states that ``base`` is so already. Watermark text without a zone is
    taken in the session's zone.
    """
    spark = base.sparkSession
    mark = given(spark, watermark, base.schema[spec.watermark].dataType)
    if not unique:
        keyed, keyless = split_null_keys(base, spec.keys)
        base = latest_per_key(keyed, spec.keys, spec.watermark, spec.tiebreak).unionByName(keyless)
    _write_base(base, target, spec, version)
    if spec.partition_by:
        manifest.publish(spark, target, version, _partitions(base.schema, spec))
    _commit(spark, target, BASE, version, mark, schema=base.schema.json())


def _write_base(base: DataFrame, target: str, spec: MergeSpec, version: int) -> None:
    path = _base_path(target, version)
    if spec.partition_by:
        if spec.buckets:
            raise ValueError("a base is partitioned or bucketed, not both")
        require_columns(base, spec.partition_by)
        # Few files per partition; a partition that holds most rows is cut over many tasks.
        clustered = base.hint("rebalance", *[F.col(quote(c)) for c in spec.partition_by])
        clustered.write.mode("overwrite").partitionBy(*spec.partition_by).parquet(path)
    elif spec.buckets:
        save_bucketed(
            base, spec.database, _base_table(spec, version), path, spec.keys, spec.buckets
        )
    else:
        base.write.mode("overwrite").parquet(path)


def write_batch(batch: DataFrame, target: str, spec: MergeSpec, batch_id: int) -> None:
    """Write the latest row per key of a batch, and its rows with null keys apart, in one job.

    A row with a null key gets a number of its own as a further key: it is the latest
    of its group, and such rows never meet in one task.
    """
    rejected = has_null_key(batch, spec.keys)
    marked = batch.withColumn(REJECTED, rejected).withColumn(
        ALONE, F.when(rejected, F.monotonically_increasing_id())
    )
    newest = latest_per_key(marked, [*spec.keys, ALONE], spec.watermark, spec.tiebreak).drop(ALONE)
    newest.write.mode("overwrite").partitionBy(REJECTED).parquet(f"{target}/delta/batch_id={batch_id}")


def load_increment(spark: SparkSession, feed: DataFrame, target: str, spec: MergeSpec) -> LoadResult:
    """Load the rows of ``feed`` after the last committed watermark, as the next batch.

    The highest watermark is read first, from that column alone, and bounds the load:
    a feed that grows meanwhile cannot give its parts different ends. It moves with the
    batch's commit: a load that failed midway is simply repeated. It stays when nothing
    new was found. Rows rejected for a null key move it too, else every later load
    would reject them again.
    """
    commits = log.read(spark, target)
    batch_id, last = _next_id(commits), log.last_watermark(commits)
    upto = reached(incremental_filter(feed, spec.watermark, last), spec.watermark)
    write_batch(incremental_filter(feed, spec.watermark, last, upto), target, spec, batch_id)
    mark = upto or last
    _commit(spark, target, BATCH, batch_id, mark)
    written = spark.read.schema(_stored(feed.schema)).parquet(f"{target}/delta/batch_id={batch_id}")
    return LoadResult(batch_id, written.where(~F.col(REJECTED)).count(), mark.value if mark else None)


def load_epoch(batch: DataFrame, target: str, spec: MergeSpec, stream: str, epoch: int) -> int:
    """Load a micro-batch as the next batch, unless it was committed before; the number of the stream's last batch."""
    spark = batch.sparkSession
    commits = log.read(spark, target)
    known = [c.id for c in commits if c.stream == stream and c.epoch >= epoch]
    if known:
        return known[0]
    batch_id = _next_id(commits)
    write_batch(batch, target, spec, batch_id)
    _commit(spark, target, BATCH, batch_id, None, stream, epoch)
    return batch_id


def commit_batch(spark: SparkSession, target: str, batch_id: int) -> None:
    """Note a batch as loaded; refused where the current base would hide it."""
    base, _ = log.current(log.read(spark, target))
    if batch_id < base.id:
        raise ValueError(f"batch {batch_id} comes before base version {base.id} of {target}")
    _commit(spark, target, BATCH, batch_id, None)


def _commit(
    spark: SparkSession,
    target: str,
    kind: str,
    number: int,
    watermark: Watermark | None,
    stream: str | None = None,
    epoch: int | None = None,
    schema: str | None = None,
) -> None:
    log.append(spark, target, kind, number, watermark, stream, epoch, schema)


def _next_id(commits: list) -> int:
    """The number after every committed batch, and not before the current base."""
    base, _ = log.current(commits)
    return max([base.id, *(c.id + 1 for c in commits if c.kind == BATCH)])


def read_merged(spark: SparkSession, target: str, spec: MergeSpec) -> DataFrame:
    """The base with all committed deltas applied.

    Deltas of several batches compete by watermark, and a later batch wins a tie.
    """
    current, batches = log.current(log.read(spark, target))
    base = _read_base(spark, target, spec, current)
    if not batches:
        return base
    newest = _newest(spark, target, spec, base.schema, batches)
    return merge_upsert(
        base, newest, spec.keys, spec.watermark, spec.tiebreak, base_unique=True, delta_unique=True
    )


def _newest(spark: SparkSession, target: str, spec: MergeSpec, schema: StructType, batches: list[int]) -> DataFrame:
    """The latest row per key of some batches."""
    delta = _batches(spark, target, schema, batches).where(~F.col(REJECTED)).drop(REJECTED)
    return latest_per_key(delta, spec.keys, spec.watermark, ["batch_id", *spec.tiebreak]).drop("batch_id")


def read_rejected(spark: SparkSession, target: str) -> DataFrame:
    """Rows with null keys of the batches since the current base version."""
    current, batches = log.current(log.read(spark, target))
    return _batches(spark, target, _schema(current), batches).where(REJECTED).drop(REJECTED)


def compact(spark: SparkSession, target: str, spec: MergeSpec) -> int:
    """Fold the committed deltas into a new base version; returns the version.

    With ``partition_by`` only touched partitions are read and written: those of the
    deltas' rows, and those where the base holds their keys now. The latter are looked
    up by key, reading no other column, unless the partition columns are part of the key.
    """
    commits = log.read(spark, target)
    current, batches = log.current(commits)
    if not batches:
        return current.id
    following = max(batches) + 1
    mark = log.last_watermark(commits)
    if spec.partition_by:
        _compact_partitions(spark, target, spec, current, batches, following)
        _commit(spark, target, BASE, following, mark, schema=current.schema)
    else:
        publish_base(read_merged(spark, target, spec), target, spec, following, mark, unique=True)
    if spec.keep_hours is not None:
        clean(spark, target, spec, spec.keep_hours * 3600)
    return following


def _compact_partitions(spark, target, spec, current, batches: list[int], following: int) -> None:
    schema, names = _schema(current), list(spec.partition_by)
    partitions = _partitions(schema, spec)
    newest = _newest(spark, target, spec, schema, batches)
    touched = newest.select(*[quote(c) for c in names])
    if not set(names) <= set(spec.keys):
        base = _read_base(spark, target, spec, current).select(*[quote(c) for c in {*spec.keys, *names}])
        keys = newest.select(*[quote(k) for k in spec.keys])
        touched = touched.unionByName(
            base.join(keys, list(spec.keys), "left_semi").select(*[quote(c) for c in names])
        )
    # Partition values, never rows: both halves below must see the same ones.
    values = manifest.partition_rows(spark, touched.distinct().collect(), partitions)
    entries = manifest.read(spark, target, current.id)
    held = manifest.folders(semi_null_safe(entries, values, names))
    merged = merge_upsert(
        manifest.rows(spark, target, held, schema), newest, spec.keys, spec.watermark, spec.tiebreak,
        base_unique=True, delta_unique=True,
    )
    _write_base(merged, target, spec, following)
    manifest.publish(spark, target, following, partitions, current.id, values)


def clean(spark: SparkSession, target: str, spec: MergeSpec, keep_seconds: float) -> list[str]:
    """Remove what no reader that began within the last ``keep_seconds`` can need; what was removed.

    Such a reader sees the base that was current at the time, or a later one: older
    versions go, with the files only they refer to, and the batches that base holds.
    Of the commit log a snapshot stays, and what is younger than ``keep_seconds``.
    """
    commits, before = log.read(spark, target), time.time() - keep_seconds
    bases = [c for c in commits if c.kind == BASE]
    oldest = max((b for b in bases if b.at <= before), key=lambda b: (b.id, b.seq), default=bases[0])
    if max(c.seq for c in commits) not in log.numbers(spark, target, "snapshots"):
        log.write_snapshot(spark, target, [c for c in commits if c.kind != BASE or c.id >= oldest.id])
    versions, manifests, batches = (
        [n for n in _numbered(spark, f"{target}/{kind}") if n < oldest.id] for kind in ("base", "manifest", "delta")
    )
    paths = [f"{target}/delta/batch_id={n}" for n in batches]
    if spec.partition_by:
        paths += _unused_folders(spark, target, versions, manifests, {b.id for b in bases if b.id >= oldest.id})
        paths += [f"{target}/manifest/version={v}" for v in manifests]
    else:
        paths += [_base_path(target, v) for v in versions]
    newest = max(log.numbers(spark, target, "snapshots"))
    for kind, last in (("commits", newest), ("snapshots", newest - 1)):
        old = [log.folder(target, kind, n) for n in log.numbers(spark, target, kind) if n <= last]
        paths += [path for path in old if storage.modified_seconds(spark, path) <= before]
    for path in paths:
        storage.remove(spark, path)
    if spec.buckets:
        for version in versions:
            spark.sql(f"DROP TABLE IF EXISTS {qualified(spec.database, _base_table(spec, version))}")
    return paths


def _unused_folders(
    spark: SparkSession, target: str, versions: list[int], manifests: list[int], kept: set[int]
) -> list[str]:
    """Folders of former versions that no kept version refers to; a version without any such reference as a whole."""
    needed = {f for v in kept for f in manifest.folders(manifest.read(spark, target, v))}
    former = {f for v in manifests for f in manifest.folders(manifest.read(spark, target, v))}
    whole = {f"version={v}" for v in versions} - {f.split("/")[0] for f in needed}
    single = {f for f in former - needed if f.split("/")[0] not in whole}
    return [f"{target}/base/{f}" for f in sorted(whole | single)]


def _numbered(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the folders ``<name>=<number>`` below ``path``."""
    return [int(n.partition("=")[2]) for n in storage.names(spark, path) if n.partition("=")[2].isdigit()]


def _base_path(target: str, version: int) -> str:
    return f"{target}/base/version={version}"


def _base_table(spec: MergeSpec, version: int) -> str:
    return f"{spec.table}_v{version}"


def _schema(base) -> StructType:
    return StructType.fromJson(json.loads(base.schema))


def _partitions(schema: StructType, spec: MergeSpec) -> StructType:
    return StructType([schema[c] for c in spec.partition_by])


def _read_base(spark: SparkSession, target: str, spec: MergeSpec, base) -> DataFrame:
    """The files of the manifest; the bucketed table where this session's catalog knows it; else the plain files."""
    if spec.partition_by:
        return manifest.rows(spark, target, manifest.folders(manifest.read(spark, target, base.id)), _schema(base))
    if spec.buckets:
        name = qualified(spec.database, _base_table(spec, base.id))
        if spark.catalog.tableExists(name):
            return spark.table(name)
    return spark.read.schema(_schema(base)).parquet(_base_path(target, base.id))


def _batches(
    spark: SparkSession, target: str, schema: StructType, batches: list[int]
) -> DataFrame:
    stored = _stored(schema, StructField("batch_id", LongType()))
    if not batches:
        return spark.createDataFrame([], stored)
    paths = [f"{target}/delta/batch_id={b}" for b in batches]
    return spark.read.schema(stored).option("basePath", f"{target}/delta").parquet(*paths)


def _stored(schema: StructType, *partitions: StructField) -> StructType:
    return StructType([*schema.fields, *partitions, StructField(REJECTED, BooleanType())])
