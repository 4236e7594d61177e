"""The commit log of a merged table: one small row per version or batch, and snapshots of it.

Every commit is a folder of its own, ``commits/<n>``. Every ``SNAPSHOT_EVERY`` commits
what later readers and writers still need is written once more as one file,
``snapshots/<n>``: the bases, the batches after the current one, the last watermark,
and the last epoch of every stream. A reader takes the newest snapshot and the commits
after it, so the number of files it opens does not grow with the table's age. A target
has one writer; a commit or snapshot that was broken off holds no row and counts for
nothing.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Row, SparkSession

from lakeferry.operators.watermarks import Watermark
from lakeferry.sinks import storage

BASE, BATCH = "base", "batch"
COMMIT = (
    "seq bigint, kind string, id bigint, watermark struct<type:string,value:string,zone:string>, "
    "stream string, epoch bigint, at double, schema string"
)
SNAPSHOT_EVERY = 50


def folder(target: str, kind: str, number: int | None = None) -> str:
    return f"{target}/{kind}" + ("" if number is None else f"/{number:012d}")


def numbers(spark: SparkSession, target: str, kind: str) -> list[int]:
    return [int(name) for name in storage.names(spark, folder(target, kind)) if name.isdigit()]


def append(
    spark: SparkSession,
    target: str,
    kind: str,
    number: int,
    watermark: Watermark | None = None,
    stream: str | None = None,
    epoch: int | None = None,
    schema: str | None = None,
) -> None:
    """Note a base version or a batch; a snapshot is written when it is due."""
    known, snapshots = numbers(spark, target, "commits"), numbers(spark, target, "snapshots")
    seq = max([-1, *known, *snapshots]) + 1
    mark = tuple(vars(watermark).values()) if watermark else None
    _write(spark, folder(target, "commits", seq), [(seq, kind, number, mark, stream, epoch, time.time(), schema)])
    if seq - max([-1, *snapshots]) >= SNAPSHOT_EVERY:
        write_snapshot(spark, target, read(spark, target))


def write_snapshot(spark: SparkSession, target: str, commits: Sequence[Row]) -> None:
    _write(spark, folder(target, "snapshots", max(c.seq for c in commits)), [tuple(c) for c in commits])


def _write(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    # One file: it is there as a whole, or not at all.
    spark.createDataFrame(rows, COMMIT).coalesce(1).write.mode("overwrite").parquet(path)


def read(spark: SparkSession, target: str) -> list[Row]:
    """The commits that count, oldest first."""
    rows: list[Row] = []
    seen = -1
    for number in reversed(numbers(spark, target, "snapshots")):
        rows = _read(spark, [folder(target, "snapshots", number)])
        if rows:
            seen = number
            break
    later = [folder(target, "commits", n) for n in numbers(spark, target, "commits") if n > seen]
    commits = living(rows + (_read(spark, later) if later else []))
    if not any(c.kind == BASE for c in commits):
        raise ValueError(f"no base version in {target}")
    return commits


def _read(spark: SparkSession, paths: list[str]) -> list[Row]:
    return spark.read.schema(COMMIT).parquet(*paths).collect()


def living(commits: Sequence[Row]) -> list[Row]:
    """All bases, the batches after the current one, the last watermark and the last epoch of every stream."""
    commits = sorted(commits, key=lambda c: c.seq)
    version = max((c.id for c in commits if c.kind == BASE), default=0)
    marked = [c.seq for c in commits if c.watermark]
    last = {c.stream: c.seq for c in commits if c.stream is not None}
    kept = {*marked[-1:], *last.values()}
    return [c for c in commits if c.kind == BASE or c.id >= version or c.seq in kept]


def current(commits: Sequence[Row]) -> tuple[Row, list[int]]:
    """The current base and the batches after it."""
    base = max((c for c in commits if c.kind == BASE), key=lambda c: (c.id, c.seq))
    return base, sorted({c.id for c in commits if c.kind == BATCH and c.id >= base.id})


def last_watermark(commits: Sequence[Row]) -> Watermark | None:
    """Of the last load; batches of a stream have none and leave it as it was."""
    found = next((c.watermark for c in reversed(commits) if c.watermark), None)
    return Watermark(*found) if found else None
