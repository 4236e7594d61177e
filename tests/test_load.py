"""The commit log, partitioned bases, cleaning, and typed watermarks."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from helpers import bag, rows

from lakeferry.model import MergeSpec
from lakeferry.operators.incremental import high_watermark, incremental_filter, merge_upsert
from lakeferry.operators.watermarks import Watermark, typed_watermark
from lakeferry.plans import commits, load, manifest

SCHEMA = "k int, w int, v string, p string"
SPEC = MergeSpec(("k",), "w", partition_by=("p",))


def published(spark, path, data, spec=SPEC):
    load.publish_base(spark.createDataFrame(data, SCHEMA), path, spec)
    return path


def entries(spark, path, version):
    return {(r["p"], r["_path"]) for r in manifest.read(spark, path, version).collect()}


def test_untouched_partitions_keep_their_files(spark, tmp_path):
    base = [(i, 1, "a", "xyz"[i % 3]) for i in range(30)] + [(100, 1, "n", None), (None, 1, "keyless", "x"), (101, 1, "odd", "a/b=[c] %")]
    path = published(spark, str(tmp_path / "t"), base)
    assert bag(load.read_merged(spark, path, SPEC)) == Counter(base)
    before = entries(spark, path, 0)
    # One row changes within y, one moves from x to y, one is new in w; z, the null and the odd value are not touched.
    feed = [(1, 2, "b", "y"), (3, 2, "moved", "y"), (200, 1, "new", "w")]
    load.load_epoch(spark.createDataFrame(feed, SCHEMA), path, SPEC, "s", 0)
    merged = bag(load.read_merged(spark, path, SPEC))
    assert load.compact(spark, path, SPEC) == 1
    after = entries(spark, path, 1)
    kept = {(p, f) for p, f in before if p not in ("x", "y")}
    assert {(p, f) for p, f in after if p not in ("w", "x", "y")} == kept and len(kept) == 3
    assert all(f.startswith("version=1/") for p, f in after if p in ("w", "x", "y"))
    assert {p for p, _ in after} == {"w", "x", "y", "z", None, "a/b=[c] %"}
    out = load.read_merged(spark, path, SPEC)
    assert bag(out) == merged and out.columns == ["k", "w", "v", "p"]
    assert (3, 2, "moved", "y") in merged and (None, 1, "keyless", "x") in merged
    assert not (Path(path) / "base/version=1/p=z").exists()


def test_a_key_that_holds_its_partition_needs_no_lookup(spark, tmp_path):
    spec = MergeSpec(("k", "p"), "w", partition_by=("p",))
    path = published(spark, str(tmp_path / "t"), [(1, 1, "a", "x"), (1, 1, "a", "y")], spec)
    load.load_epoch(spark.createDataFrame([(1, 2, "b", "y")], SCHEMA), path, spec, "s", 0)
    load.compact(spark, path, spec)
    assert rows(load.read_merged(spark, path, spec)) == [(1, 1, "a", "x"), (1, 2, "b", "y")]
    assert {(p, f.split("/")[0]) for p, f in entries(spark, path, 1)} == {("x", "version=0"), ("y", "version=1")}


def test_typed_partitions_and_an_empty_base(spark, tmp_path):
    schema, spec = "k int, w int, d date, n string", MergeSpec(("k",), "w", partition_by=("n", "d"))
    path = str(tmp_path / "t")
    load.publish_base(spark.createDataFrame([], schema), path, spec)
    assert load.read_merged(spark, path, spec).count() == 0
    data = spark.sql("select id k, 1 w, date'2024-01-01' + cast(id as int) d, concat('0', id) n from range(5)").selectExpr("cast(k as int) k", "w", "d", "n")
    load.load_epoch(data, path, spec, "s", 0)
    assert load.compact(spark, path, spec) == 1
    out = load.read_merged(spark, path, spec)
    assert bag(out) == bag(data) and out.schema.simpleString() == "struct<k:int,w:int,d:date,n:string>"


@pytest.mark.parametrize("seed", range(2))
def test_many_compactions_equal_one_merge(spark, tmp_path, seed):
    rng = random.Random(seed)
    some = lambda n: [(rng.randrange(60), rng.randrange(50), rng.choice("abc"), rng.choice(["x", "y", "z", None])) for _ in range(n)]
    base = {r[0]: r for r in some(40)}
    path = published(spark, str(tmp_path / "t"), list(base.values()))
    expected = spark.createDataFrame(list(base.values()), SCHEMA)
    for step in range(4):
        feed = spark.createDataFrame(some(8), SCHEMA)
        load.load_epoch(feed, path, SPEC, "s", step)
        expected = spark.createDataFrame(merge_upsert(expected, feed, ["k"], "w").collect(), SCHEMA)
        if step % 2:
            load.compact(spark, path, SPEC)
        assert bag(load.read_merged(spark, path, SPEC)) == bag(expected)
    removed = load.clean(spark, path, SPEC, 0)
    assert removed and bag(load.read_merged(spark, path, SPEC)) == bag(expected)
    assert load.clean(spark, path, SPEC, 0) == []


def test_readers_within_the_time_kept_are_not_disturbed(spark, tmp_path):
    path = published(spark, str(tmp_path / "t"), [(i, 1, "a", "xy"[i % 2]) for i in range(10)])
    reader = load.read_merged(spark, path, SPEC)
    load.load_epoch(spark.createDataFrame([(1, 2, "b", "y")], SCHEMA), path, SPEC, "s", 0)
    load.compact(spark, path, SPEC)
    assert load.clean(spark, path, SPEC, 3600) == []
    assert reader.count() == 10
    assert {p.rsplit("/t/")[-1] for p in load.clean(spark, path, SPEC, 0)} >= {"base/version=0/p=y", "delta/batch_id=0", "manifest/version=0"}
    assert load.read_merged(spark, path, SPEC).where("v = 'b'").count() == 1


def test_versions_of_a_plain_base_are_removed_by_compacting(spark, tmp_path):
    spec = MergeSpec(("k",), "w", keep_hours=0)
    path = published(spark, str(tmp_path / "t"), [(1, 1, "a", "x")], spec)
    for step in range(3):
        load.load_epoch(spark.createDataFrame([(step, 5 + step, "b", "x")], SCHEMA), path, spec, "s", step)
        load.compact(spark, path, spec)
    assert [p.name for p in (Path(path) / "base").glob("version=*")] == ["version=3"]
    assert not list((Path(path) / "delta").glob("batch_id=*"))
    assert rows(load.read_merged(spark, path, spec)) == [(0, 5, "b", "x"), (1, 6, "b", "x"), (2, 7, "b", "x")]
    # What streams have loaded is remembered.
    assert load.load_epoch(spark.createDataFrame([(9, 9, "z", "x")], SCHEMA), path, spec, "s", 2) == 2


def test_reading_a_long_log_opens_few_files(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    # 10,000 commits as their snapshots leave them, then some more by the usual way.
    mark = Watermark("int", "7")
    schema = spark.createDataFrame([], SCHEMA).schema.json()
    log = [(i, "batch", i, None, "s" if i % 2 else "t", i, float(i), None) for i in range(1, 10_000)]
    log = [(0, "base", 0, tuple(vars(mark).values()), None, None, 0.0, schema), *log, (10_000, "base", 9_990, None, None, None, 1e4, schema)]
    rows_ = spark.createDataFrame(log, commits.COMMIT).collect()
    commits.write_snapshot(spark, path, commits.living(rows_))
    opened = []
    read = commits._read
    monkeypatch.setattr(commits, "_read", lambda s, paths: opened.append(len(paths)) or read(s, paths))
    for i in range(commits.SNAPSHOT_EVERY + 5):
        commits.append(spark, path, "batch", 10_000 + i, None, "s", 10_000 + i)
    opened.clear()
    found = commits.read(spark, path)
    assert sum(opened) <= commits.SNAPSHOT_EVERY + 1 and len(commits.numbers(spark, path, "snapshots")) == 2
    base, batches = commits.current(found)
    assert base.id == 9_990 and batches == [*range(9_990, 10_000), *range(10_000, 10_055)]
    assert commits.last_watermark(found) == mark
    assert max(c.epoch for c in found if c.stream == "t") == 9_998


def test_a_broken_snapshot_counts_for_nothing(spark, tmp_path):
    path = published(spark, str(tmp_path / "t"), [(1, 1, "a", "x")])
    (Path(path) / "snapshots/000000000000").mkdir(parents=True)
    (Path(path) / "commits/000000000001").mkdir(parents=True)
    load.load_epoch(spark.createDataFrame([(2, 1, "b", "x")], SCHEMA), path, SPEC, "s", 0)
    assert load.read_merged(spark, path, SPEC).count() == 2


def test_a_batch_is_written_once_and_rejected_rows_do_not_meet(spark, tmp_path):
    path = published(spark, str(tmp_path / "t"), [(1, 1, "a", "x")])
    data = spark.createDataFrame([(None, 1, "r", "x")] * 40 + [(5, i, "k", "x") for i in range(40)], SCHEMA).repartition(8)
    load.load_epoch(data, path, SPEC, "s", 0)
    assert load.read_rejected(spark, path).count() == 40
    assert rows(load.read_merged(spark, path, SPEC)) == [(1, 1, "a", "x"), (5, 39, "k", "x")]
    assert not (Path(path) / "staging").exists()


def test_a_growing_feed_is_bounded_by_its_highest_value(spark, tmp_path, monkeypatch):
    """Rows that come in between the look at the watermark and the load belong to the next load."""
    path, spec = published(spark, str(tmp_path / "t"), [(1, 1, "a", "x")]), SPEC
    feed = str(tmp_path / "feed")
    spark.createDataFrame([(2, 5, "b", "x"), (3, None, "no mark", "x")], SCHEMA).write.parquet(feed)
    reached = load.reached

    def grown(df, column):
        found = reached(df, column)
        spark.createDataFrame([(4, 9, "late", "x")], SCHEMA).write.mode("append").parquet(feed)
        return found

    monkeypatch.setattr(load, "reached", grown)
    first = load.load_increment(spark, spark.read.schema(SCHEMA).parquet(feed), path, spec)
    assert (first.rows, first.watermark) == (2, "5")
    monkeypatch.setattr(load, "reached", reached)
    second = load.load_increment(spark, spark.read.schema(SCHEMA).parquet(feed), path, spec)
    assert (second.rows, second.watermark) == (1, "9")


ZONE = "spark.sql.session.timeZone"


def test_watermarks_mean_the_same_in_every_session(spark):
    # The second instant is shown twice in New York, the third's UTC hour does not exist there.
    instants = ["2024-01-01 10:00:00Z", "2024-11-03 06:30:00.000001Z", "2024-03-10 02:30:00Z"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(instants)], "k int, t string")
    df = df.withColumn("t", df["t"].cast("timestamp"))
    try:
        for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set(ZONE, zone)
            for i, text in ((0, "2024-01-01 10:00:00.000000Z"), (1, "2024-11-03 06:30:00.000001Z"), (2, "2024-03-10 02:30:00.000000Z")):
                found = typed_watermark(df.where(f"k = {i}"), "t").first()[0]
                assert tuple(found) == ("timestamp", text, "UTC")
                assert incremental_filter(df.where(f"k = {i}"), "t", Watermark(*found)).count() == 0
                assert incremental_filter(df.where(f"k = {i}"), "t", None, Watermark(*found)).count() == 1
            assert high_watermark(df, "t").first()[0] == "2024-11-03 06:30:00.000001Z"
    finally:
        spark.conf.set(ZONE, "UTC")


def test_watermarks_know_their_type(spark):
    values = [("int", 5, "5"), ("decimal(10,2)", Decimal("1.50"), "1.50"), ("timestamp_ntz", datetime(2024, 1, 2, 3), "2024-01-02 03:00:00"), ("string", "b", "b")]
    for kind, value, text in values:
        df = spark.createDataFrame([(value,), (None,)], f"w {kind}")
        assert tuple(typed_watermark(df, "w").first()[0]) == (kind, text, None)
        assert typed_watermark(df.limit(0), "w").first()[0] is None
        assert typed_watermark(df.limit(0), "w", text).first()[0]["value"] == text
    number = spark.createDataFrame([(5,), (10,)], "w bigint")
    assert incremental_filter(number, "w", Watermark("int", "9")).count() == 1
    for kind in ("timestamp", "timestamp_ntz", "string"):
        with pytest.raises(ValueError):
            incremental_filter(number, "w", Watermark(kind, "2024-01-01 00:00:00"))
