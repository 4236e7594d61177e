from __future__ import annotations

from collections import Counter
from dataclasses import replace

import pytest
from helpers import bag, explained, rows

from lakeferry.model import MergeSpec
from lakeferry.operators.incremental import merge_upsert
from lakeferry.plans import load
from lakeferry.streaming.merge import stream_merge

SCHEMA = "k int, w int, v string"
SPEC = MergeSpec(("k",), "w")


@pytest.fixture
def target(spark, tmp_path):
    base = spark.createDataFrame([(1, 1, "a"), (2, 5, "b"), (3, 3, "c")], SCHEMA)
    path = str(tmp_path / "target")
    load.publish_base(base, path, SPEC)
    return path


def feed(spark, tmp_path, data, name):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / name))


def run(spark, tmp_path, target):
    query = stream_merge(
        spark, str(tmp_path / "in" / "*"), target, SPEC, str(tmp_path / "checkpoint"), SCHEMA, 1
    )
    query.awaitTermination()


def test_stream_equals_batch_merge(spark, tmp_path, target):
    base = load.read_merged(spark, target, SPEC)
    one, two = [(1, 2, "a2"), (2, 4, "late"), (1, 3, "a3")], [(4, 1, "d"), (3, 3, "tie"), (None, 1, "x")]
    feed(spark, tmp_path, one, "one")
    feed(spark, tmp_path, two, "two")
    run(spark, tmp_path, target)
    expected = bag(merge_upsert(base, spark.createDataFrame(one + two, SCHEMA), ["k"], "w"))
    assert expected == Counter([(1, 3, "a3"), (2, 5, "b"), (3, 3, "tie"), (4, 1, "d")])
    assert bag(load.read_merged(spark, target, SPEC)) == expected
    assert rows(load.read_rejected(spark, target).select("v")) == [("x",)]

    # Compaction changes the files, not the result; earlier versions stay.
    version = load.compact(spark, target, SPEC)
    assert version == 2
    assert bag(load.read_merged(spark, target, SPEC)) == expected
    assert bag(spark.read.parquet(f"{target}/base/version={version}")) == expected
    assert load.compact(spark, target, SPEC) == version

    # A later run takes new files only.
    feed(spark, tmp_path, [(5, 1, "e"), (1, 1, "older")], "three")
    run(spark, tmp_path, target)
    assert bag(load.read_merged(spark, target, SPEC)) == expected + Counter([(5, 1, "e")])


def test_replayed_and_uncommitted_batches(spark, tmp_path, target):
    feed(spark, tmp_path, [(1, 2, "a2")], "one")
    run(spark, tmp_path, target)
    once = bag(load.read_merged(spark, target, SPEC))
    # A batch that was written but not committed is not read.
    load.write_batch(spark.createDataFrame([(9, 9, "z")], SCHEMA), target, SPEC, 7)
    assert bag(load.read_merged(spark, target, SPEC)) == once
    # A batch committed twice counts once.
    load.commit_batch(spark, target, 0)
    assert bag(load.read_merged(spark, target, SPEC)) == once


def test_a_replayed_batch_replaces_its_own_directory(spark, tmp_path, target):
    feed(spark, tmp_path, [(1, 2, "a2")], "one")
    run(spark, tmp_path, target)
    # The same files under a lost checkpoint arrive as batch 0 again.
    query = stream_merge(
        spark, str(tmp_path / "in" / "*"), target, SPEC, str(tmp_path / "other"), SCHEMA
    )
    query.awaitTermination()
    assert rows(load.read_merged(spark, target, SPEC)) == [(1, 2, "a2"), (2, 5, "b"), (3, 3, "c")]


def test_no_base_is_an_error(spark, tmp_path):
    path = str(tmp_path / "none")
    load._commit(spark, path, load.BATCH, 0, None)
    with pytest.raises(ValueError):
        load.read_merged(spark, path, SPEC)
    with pytest.raises(ValueError):
        load.commit_batch(spark, path, 0)


def merged_stream(spark, tmp_path, target, folder, checkpoint):
    stream_merge(
        spark, str(tmp_path / "in" / folder), target, SPEC, str(tmp_path / checkpoint), SCHEMA
    ).awaitTermination()


@pytest.mark.parametrize("compacted", [False, True])
def test_a_second_checkpoint_loses_no_rows(spark, tmp_path, target, compacted):
    feed(spark, tmp_path, [(8, 1, "first")], "one")
    feed(spark, tmp_path, [(9, 1, "second")], "two")
    merged_stream(spark, tmp_path, target, "one", "a")
    if compacted:
        load.compact(spark, target, SPEC)
    merged_stream(spark, tmp_path, target, "two", "b")
    found = rows(load.read_merged(spark, target, SPEC))
    assert found == [(1, 1, "a"), (2, 5, "b"), (3, 3, "c"), (8, 1, "first"), (9, 1, "second")]
    # A load joins the same numbering.
    more = spark.createDataFrame([(10, 99, "load")], SCHEMA)
    assert load.load_increment(spark, more, target, SPEC).batch_id == 2
    assert rows(load.read_merged(spark, target, SPEC)) == sorted([*found, (10, 99, "load")], key=repr)


def test_a_committed_epoch_is_not_loaded_again(spark, target):
    first = spark.createDataFrame([(8, 1, "x")], SCHEMA)
    assert load.load_epoch(first, target, SPEC, "s", 0) == 0
    assert load.load_epoch(first, target, SPEC, "other", 0) == 1
    load.compact(spark, target, SPEC)
    assert load.load_epoch(first, target, SPEC, "s", 0) == 0
    assert load.load_epoch(first, target, SPEC, "s", 1) == 2


def test_a_number_before_the_base_is_refused(spark, target):
    load.load_epoch(spark.createDataFrame([(8, 1, "x")], SCHEMA), target, SPEC, "s", 0)
    assert load.compact(spark, target, SPEC) == 1
    with pytest.raises(ValueError):
        load.commit_batch(spark, target, 0)


def test_watermark_keeps_its_zone(spark, tmp_path):
    path, spec, zone = str(tmp_path / "t"), MergeSpec(("k",), "w"), "spark.sql.session.timeZone"
    stamps = spark.createDataFrame([(1, "2024-01-01 10:00:00Z"), (2, "2024-01-01 12:00:00Z")], "k int, w string")
    stamps = stamps.withColumn("w", stamps["w"].cast("timestamp"))
    load.publish_base(stamps.limit(0), path, spec, watermark="2024-01-01 00:00:00")
    result = load.load_increment(spark, stamps.where("k = 1"), path, spec)
    assert result == load.LoadResult(0, 1, "2024-01-01 10:00:00.000000Z")
    try:
        spark.conf.set(zone, "America/New_York")
        assert load.load_increment(spark, stamps, path, spec).rows == 1
    finally:
        spark.conf.set(zone, "UTC")


def test_a_base_has_one_row_per_key(spark, tmp_path):
    path = str(tmp_path / "t")
    versions = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (None, 1, "x"), (None, 1, "x")], SCHEMA)
    load.publish_base(versions, path, SPEC)
    load.load_epoch(spark.createDataFrame([(1, 3, "c")], SCHEMA), path, SPEC, "s", 0)
    assert rows(load.read_merged(spark, path, SPEC)) == [(1, 3, "c"), (None, 1, "x"), (None, 1, "x")]


def test_rejected_rows_are_rejected_once(spark, tmp_path):
    path = str(tmp_path / "t")
    load.publish_base(spark.createDataFrame([(1, 1, "a")], SCHEMA), path, SPEC, watermark="1")
    feed_ = spark.createDataFrame([(None, 9, "x"), (2, 2, "b")], SCHEMA)
    assert load.load_increment(spark, feed_, path, SPEC) == load.LoadResult(0, 1, "9")
    assert load.load_increment(spark, feed_, path, SPEC) == load.LoadResult(1, 0, "9")
    assert load.read_rejected(spark, path).count() == 1


def test_load_increments(spark, tmp_path):
    path = str(tmp_path / "t")
    base = [(1, 1, "a"), (2, 5, "b")]
    load.publish_base(spark.createDataFrame(base, SCHEMA), path, SPEC, watermark="5")
    feed = base + [(1, 6, "a2"), (None, 9, "x"), (3, 10, "c")]
    result = load.load_increment(spark, spark.createDataFrame(feed, SCHEMA), path, SPEC)
    # "10" is after "9" and "5": watermarks are compared as the column's type.
    assert result == load.LoadResult(0, 2, "10")
    merged = [(1, 6, "a2"), (2, 5, "b"), (3, 10, "c")]
    assert rows(load.read_merged(spark, path, SPEC)) == merged
    # Nothing new: the watermark stays.
    result = load.load_increment(spark, spark.createDataFrame(feed, SCHEMA), path, SPEC)
    assert result == load.LoadResult(1, 0, "10")
    assert load.compact(spark, path, SPEC) == 2
    feed.append((3, 11, "c2"))
    result = load.load_increment(spark, spark.createDataFrame(feed, SCHEMA), path, SPEC)
    assert result == load.LoadResult(2, 1, "11")
    assert rows(load.read_merged(spark, path, SPEC)) == merged[:2] + [(3, 11, "c2")]


def test_interrupted_load_is_repeated(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    load.publish_base(spark.createDataFrame([(1, 1, "a")], SCHEMA), path, SPEC, watermark="1")
    feed = spark.createDataFrame([(1, 2, "a2"), (2, 3, "b")], SCHEMA)
    commit = load._commit

    def lost(*_):
        raise RuntimeError("lost before the commit")

    monkeypatch.setattr(load, "_commit", lost)
    with pytest.raises(RuntimeError):
        load.load_increment(spark, feed, path, SPEC)
    assert rows(load.read_merged(spark, path, SPEC)) == [(1, 1, "a")]
    monkeypatch.setattr(load, "_commit", commit)
    assert load.load_increment(spark, feed, path, SPEC).batch_id == 0
    assert load.read_rejected(spark, path).count() == 0
    assert rows(load.read_merged(spark, path, SPEC)) == [(1, 2, "a2"), (2, 3, "b")]


def test_reading_reduces_the_deltas_once(spark, tmp_path):
    """Base unshuffled; the shuffled deltas are used by both joins."""
    path = str(tmp_path / "t")
    base = spark.range(1000).selectExpr("cast(id as int) k", "1 w", "'a' v")
    load.publish_base(base, path, SPEC)
    load.load_increment(spark, spark.createDataFrame([(1, 2, "b"), (5000, 1, "n")], SCHEMA), path, SPEC)
    merged = load.read_merged(spark, path, SPEC)
    assert merged.count() == 1001
    assert "SortMergeJoin" not in explained(merged)


def test_bucketed_base_versions(spark, tmp_path):
    """Merged without shuffling the base; compacted into a bucketed version again."""
    path = str(tmp_path / "t")
    spec = replace(SPEC, buckets=8, database="test_load", table="facts")
    base = spark.range(1000).selectExpr("cast(id as int) k", "1 w", "'a' v")
    load.publish_base(base, path, spec)
    feed = spark.range(500, 1500).selectExpr("cast(id as int) k", "2 w", "'b' v")
    setting = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(setting, "-1")
    try:
        for _ in range(2):
            load.load_increment(spark, feed, path, spec)
            merged = load.read_merged(spark, path, spec)
            plan = explained(merged)
            assert "Bucketed: true" in plan and "SortMergeJoin" in plan
            # Deltas are shuffled; the base, whole or keys only, is not.
            plain = explained(load.read_merged(spark, path, SPEC))
            assert plan.count(") Exchange\n") < plain.count(") Exchange\n")
            assert merged.groupBy("v").count().orderBy("v").collect() == [("a", 500), ("b", 1000)]
            load.compact(spark, path, spec)
            feed = spark.range(1500, 1500).selectExpr("cast(id as int) k", "3 w", "'c' v")
    finally:
        spark.conf.unset(setting)
    # Without the table in the catalog the plain files are read.
    for version in (0, 1, 2):
        spark.sql(f"DROP TABLE IF EXISTS test_load.facts_v{version}")
    assert load.read_merged(spark, path, spec).count() == 1500
