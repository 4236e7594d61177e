from __future__ import annotations

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from helpers import bag, explained, rows
from pyspark.sql import functions as F

from lakeferry.operators import incremental as inc
from lakeferry.operators.history import (
    archive_increment,
    archive_versions,
    history_view,
    scd2_history,
    scd2_increment,
    scd2_late,
)
from lakeferry.operators.reconcile import reconcile, row_differences
from lakeferry.sinks.tables import save_bucketed

SCHEMA = "k int, w int, t int, v string"
KEYS, WM, TIE = ["k"], "w", ["t"]


def newest_first(row):
    """Sort key of recency: nulls are oldest."""
    return tuple((x is not None, x if x is not None else 0) for x in row[1:3]) + ((row[3] is not None, row[3] or ""),)


def some_rows(seed, n=200, keys=12, hot=True, nulls=True):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        k = 0 if hot and rng.random() < 0.4 else rng.randrange(keys)
        w = None if nulls and rng.random() < 0.05 else rng.randrange(30)
        out.append((k, w, rng.randrange(4), rng.choice(["a", "b", "c", None])))
    # Exact copies.
    return out + out[:5] * 3


def latest(data):
    groups = defaultdict(list)
    for row in data:
        groups[row[0]].append(row)
    return [max(g, key=newest_first) for g in groups.values()]


@pytest.mark.parametrize("seed", range(2))
def test_latest_and_archive_split_all_rows(spark, seed):
    data = some_rows(seed) + [(None, 1, 1, "x"), (None, 1, 1, "x"), (None, 2, 1, "y")]
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    current = inc.latest_per_key(df, KEYS, WM, TIE)
    archive = archive_versions(df, KEYS, WM, TIE)
    assert bag(current) == Counter(latest(data))
    assert bag(archive) == Counter(data) - Counter(latest(data))
    view = history_view(df, KEYS, WM, TIE)
    assert bag(view.drop("is_current")) == Counter(data)
    assert bag(view.where("is_current").drop("is_current")) == bag(current)


def test_history_view_of_rows_with_maps(spark):
    df = spark.createDataFrame([(1, i, {"a": i}) for i in range(10)], "k int, w int, m map<string,int>")
    view = history_view(df, ["k"], "w")
    assert [(r.w, r.m) for r in view.where("is_current").collect()] == [(9, {"a": 9})]
    assert view.count() == 10
    plan = explained(view)
    assert plan.count("Scan ExistingRDD") <= 2 * 2  # in the tree and in the details


def test_latest_does_not_depend_on_partitioning(spark):
    data = [(1, 5, 0, v) for v in "abcdefgh"]
    for parts in (1, 3, 8):
        df = spark.createDataFrame(data, SCHEMA).repartition(parts)
        assert rows(inc.latest_per_key(df, KEYS, WM, TIE)) == [(1, 5, 0, "h")]


def test_latest_cuts_keys_before_the_shuffle(spark):
    plan = explained(inc.latest_per_key(spark.createDataFrame(some_rows(1), SCHEMA), KEYS, WM, TIE))
    assert plan.count("WindowGroupLimit") >= 2
    assert "Partial" in plan


def test_latest_with_a_map_column(spark):
    df = spark.createDataFrame([(1, 1, {"a": 1}), (1, 2, {"b": 2})], "k int, w int, m map<string,int>")
    assert inc.latest_per_key(df, ["k"], "w").first().m == {"b": 2}


def merged(base, delta):
    """Brute force: base keys are unique, or not."""
    groups = defaultdict(list)
    keyless = [r for r in base if r[0] is None]
    for origin, data in ((0, base), (1, delta)):
        for row in data:
            if row[0] is not None:
                groups[row[0]].append((row, origin))
    pick = lambda pair: (newest_first(pair[0])[0], pair[1], *newest_first(pair[0])[1:])
    return [max(g, key=pick)[0] for g in groups.values()] + keyless


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("broadcast", [True, False])
def test_merge_equals_brute_force(spark, seed, broadcast):
    base = latest(some_rows(seed, keys=20, hot=False)) + [(None, 1, 1, "x"), (None, 1, 1, "x")]
    delta = some_rows(seed + 100, keys=30) + [(None, 9, 9, "rejected")]
    b, d = spark.createDataFrame(base, SCHEMA), spark.createDataFrame(delta, SCHEMA)
    setting = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(setting, "10MB" if broadcast else "-1")
    try:
        joined = inc.merge_upsert(b, d, KEYS, WM, TIE, base_unique=True)
        assert bag(joined) == Counter(merged(base, delta))
        assert bag(inc.merge_upsert(b, d, KEYS, WM, TIE)) == Counter(merged(base, delta))
        # Merging again changes nothing; an empty delta gives the base.
        again = inc.merge_upsert(joined, d, KEYS, WM, TIE, base_unique=True)
        assert bag(again) == bag(joined)
        assert bag(inc.merge_upsert(b, d.limit(0), KEYS, WM, TIE, base_unique=True)) == Counter(base)
    finally:
        spark.conf.unset(setting)


def test_results_can_be_joined_and_merged_on(spark):
    """Unions of equally partitioned inputs, read by later shuffles on the same keys."""
    base = spark.createDataFrame(latest(some_rows(1, n=400, keys=200, hot=False)), SCHEMA)
    setting = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(setting, "-1")
    try:
        table = base
        for seed in (2, 3, 4):
            delta = spark.createDataFrame(some_rows(seed, keys=250, hot=False), SCHEMA)
            table = inc.merge_upsert(table, delta, KEYS, WM, TIE, base_unique=True)
        keys = len({r.k for r in table.collect()})
        results = [
            table,
            inc.merge_upsert(table, base, KEYS, WM, TIE),
            history_view(table, KEYS, WM, TIE),
            scd2_history(table, KEYS, WM, ["v"], TIE, max_rows_per_task=1),
            scd2_history(table.union(table), KEYS, WM, ["v"], TIE),
        ]
        for result in results:
            joined = result.join(base.select("k"), "k", "left").groupBy("k").count()
            assert joined.count() == keys
    finally:
        spark.conf.unset(setting)


def test_merge_dedupes_a_base_with_repeated_keys(spark):
    base, delta = some_rows(5), some_rows(6, n=20)
    b, d = spark.createDataFrame(base, SCHEMA), spark.createDataFrame(delta, SCHEMA)
    assert bag(inc.merge_upsert(b, d, KEYS, WM, TIE)) == Counter(merged(base, delta))


def test_merge_order_of_batches_does_not_matter(spark):
    base = latest(some_rows(1, keys=20, hot=False, nulls=False))
    feed = list({(k, w): (k, w, t, v) for k, w, t, v in some_rows(2, nulls=False)}.values())
    # No ties on the watermark, neither within the feed nor with the base.
    feed = [(k, w + 100 + i, t, v) for i, (k, w, t, v) in enumerate(feed)]
    one, two = feed[::2], feed[1::2]
    frames = [spark.createDataFrame(x, SCHEMA) for x in (base, one, two)]
    merge = lambda b, d: inc.merge_upsert(b, d, KEYS, WM, TIE, base_unique=True)
    forth = merge(merge(frames[0], frames[1]), frames[2])
    back = merge(merge(frames[0], frames[2]), frames[1])
    assert bag(forth) == bag(back)


def test_merge_by_two_keys_with_other_column_order(spark):
    base = spark.createDataFrame([(1, "a", 1, "x"), (1, "b", 5, "y")], "k int, `l.l` string, w int, v string")
    changes = [("new", 2, "a", 1), ("old", 2, "b", 1), ("ins", 0, "c", 2)]
    delta = spark.createDataFrame(changes, "v string, w int, `l.l` string, k int")
    for unique in (True, False):
        out = inc.merge_upsert(base, delta, ["k", "l.l"], "w", base_unique=unique)
        assert rows(out) == [(1, "a", 2, "new"), (1, "b", 5, "y"), (2, "c", 0, "ins")]


def test_small_delta_leaves_the_base_unshuffled(spark, sf_dir):
    base = spark.read.parquet(f"{sf_dir}/orders.parquet")
    delta = base.limit(10)
    plan = explained(inc.merge_upsert(base, delta, ["o_orderkey"], "o_orderdate", base_unique=True))
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    # The second read of the base takes its key column only.
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_bucketed_base_is_not_shuffled_for_a_large_delta(spark, sf_dir, tmp_path):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    save_bucketed(orders, "test_merge", "base", str(tmp_path / "b"), ["o_orderkey"], 8)
    base = spark.table("test_merge.base")
    delta = orders.where("o_orderkey % 3 = 0").withColumn("o_orderdate", F.expr("o_orderdate + interval 1 day"))
    setting = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(setting, "-1")
    try:
        merged = inc.merge_upsert(base, delta, ["o_orderkey"], "o_orderdate", base_unique=True)
        expected = inc.merge_upsert(orders, delta, ["o_orderkey"], "o_orderdate")
        plan = explained(merged)
        assert "SortMergeJoin" in plan and "Bucketed: true" in plan
        unbucketed = inc.merge_upsert(orders, delta, ["o_orderkey"], "o_orderdate", base_unique=True)
        # Both reads of the base, the whole one and the one of its keys, go unshuffled.
        assert plan.count(") Exchange\n") == explained(unbucketed).count(") Exchange\n") - 2
        assert bag(merged) == bag(expected)
    finally:
        spark.conf.unset(setting)


def test_split_null_keys(spark):
    df = spark.createDataFrame([(1, None, 0, "a"), (None, 1, 0, "b"), (2, 2, 0, "c")], SCHEMA)
    valid, rejected = inc.split_null_keys(df, ["k", "w"])
    assert [r.v for r in valid.collect()] == ["c"]
    assert sorted(r.v for r in rejected.collect()) == ["a", "b"]


def test_total_order(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    with pytest.raises(ValueError):
        inc.require_total_order(lines, ["l_orderkey"], "l_linenumber")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    inc.require_total_order(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"])


def test_incremental_filter(spark):
    df = spark.createDataFrame([(1, 5, 0, "a"), (2, None, 0, "b"), (3, 6, 0, "c")], SCHEMA)
    assert [r.v for r in inc.incremental_filter(df, "w", "5").collect()] == ["c"]
    for nothing in (None, ""):
        assert inc.incremental_filter(df, "w", nothing).count() == 3
    with pytest.raises(Exception):
        inc.incremental_filter(df, "w", "not a number").collect()


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_incremental_filter_is_pushed(spark, sf_dir, tmp_path, fmt):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    orders.write.format(fmt).save(str(tmp_path / "o"))
    stored = spark.read.format(fmt).load(str(tmp_path / "o"))
    plan = explained(inc.incremental_filter(stored, "o_orderkey", "7500").select("o_custkey"))
    assert "GreaterThan(o_orderkey,7500)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    plan = explained(inc.incremental_filter(stored, "o_orderdate", "1998-01-01 00:00:00"))
    assert "GreaterThan(o_orderdate," in plan


def test_high_watermark(spark):
    df = spark.createDataFrame([(1, 5, 0, "a"), (2, None, 0, "b")], SCHEMA)
    assert inc.high_watermark(df, "w", "3").first()[0] == "5"
    assert inc.high_watermark(df.where("w is null"), "w", "3").first()[0] == "3"
    assert inc.high_watermark(df.limit(0), "w").first()[0] is None


def test_incremental_merge(spark):
    base = spark.createDataFrame([(1, 5, 0, "a"), (2, 9, 0, "b")], SCHEMA)
    feed = spark.createDataFrame([(1, 6, 0, "seen"), (1, 8, 0, "new"), (3, 7, 0, "seen"), (4, 10, 0, "ins")], SCHEMA)
    out, high = inc.incremental_merge(base, feed, KEYS, WM, "7", TIE, base_unique=True)
    assert rows(out) == [(1, 8, 0, "new"), (2, 9, 0, "b"), (4, 10, 0, "ins")]
    assert high.first()[0] == "10"


def test_current_view(spark):
    df = spark.createDataFrame([(1, "true"), (2, "0"), (3, None), (4, "?")], "k int, d string")
    assert [r.k for r in inc.current_view(df, "d").orderBy("k").collect()] == [2, 3, 4]
    assert inc.current_view(df.select("k", F.lit(True).alias("d")), "d").count() == 0


# --- history ------------------------------------------------------------------


def versions(data):
    """Brute force over (k, w, t, v) rows: nulls first, v last in the order; one version at most begins without a watermark."""
    groups = defaultdict(set)
    for row in data:
        groups[row[0]].add(row)
    out = []
    for k, group in groups.items():
        changes, before = [], object()
        for _, w, _, v in sorted(group, key=newest_first):
            if v != before:
                changes.append((v, w))
            before = v
        for i, (v, start) in enumerate(changes):
            last = i + 1 == len(changes)
            if not last and start is None and changes[i + 1][1] is None:
                continue  # rows without a watermark share one instant: the last of them stands for it
            out.append((k, v, start, None if last else changes[i + 1][1], last))
    return Counter(out)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("per_task", [10_000, 40, 7])
def test_history_equals_brute_force(spark, seed, per_task):
    """All keys whole; the hot key sliced; most keys sliced."""
    data = some_rows(seed, n=150, keys=6) + [(None, 3, 0, "a"), (None, 4, 0, "b")]
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    out = scd2_history(df, KEYS, WM, ["v"], TIE, max_rows_per_task=per_task)
    assert out.columns == ["k", "v", "valid_from", "valid_to", "is_current"]
    assert bag(out) == versions(data)


def test_history_slices_where_whole_slices_hold_no_change(spark):
    """A run of equal values longer than many slices is one version."""
    data = [(1, i, 0, "a" if i < 90 else "b") for i in range(100)] + [(2, 1, 0, "z")]
    df = spark.createDataFrame(data, SCHEMA)
    out = scd2_history(df, KEYS, WM, ["v"], TIE, max_rows_per_task=8)
    assert rows(out) == [(1, "a", 0, 90, False), (1, "b", 90, None, True), (2, "z", 1, None, True)]


def test_history_of_many_copies_of_one_row(spark):
    df = spark.createDataFrame([(1, 1, 1, "a")] * 500 + [(1, 2, 1, "b")], SCHEMA)
    out = scd2_history(df, KEYS, WM, ["v"], TIE, max_rows_per_task=20)
    assert rows(out) == [(1, "a", 1, 2, False), (1, "b", 2, None, True)]


def test_history_intervals_are_contiguous(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    out = scd2_history(events, ["user_id"], "ts", ["event_type"], ["event_id"])
    by_user = defaultdict(list)
    for r in out.collect():
        by_user[r.user_id].append(r)
    for history in by_user.values():
        history.sort(key=lambda r: r.valid_from)
        assert [r.valid_to for r in history[:-1]] == [r.valid_from for r in history[1:]]
        assert [r.is_current for r in history] == [False] * (len(history) - 1) + [True]


def test_history_tracks_several_columns_over_two_keys(spark):
    schema = "a int, b string, w timestamp_ntz, x int, y string"
    day = lambda n: dt.datetime(2020, 1, n)
    data = [
        (1, "p", day(1), 1, "u"), (1, "p", day(2), 1, "u"), (1, "p", day(3), 1, "v"),
        (1, "p", day(4), 2, "v"), (1, "q", day(1), None, None), (1, "q", day(2), None, None),
    ]
    out = scd2_history(spark.createDataFrame(data, schema), ["a", "b"], "w", ["x", "y"])
    assert bag(out) == Counter([
        (1, "p", 1, "u", day(1), day(3), False), (1, "p", 1, "v", day(3), day(4), False),
        (1, "p", 2, "v", day(4), None, True), (1, "q", None, None, day(1), None, True),
    ])


@pytest.mark.parametrize("seed", range(2))
def test_history_carried_on_equals_history_of_all(spark, seed):
    data = [r for r in some_rows(seed, n=150, keys=6) if r[1] is not None and r[0] is not None]
    cut = sorted(r[1] for r in data)[len(data) // 2]
    early, late = [r for r in data if r[1] <= cut], [r for r in data if r[1] > cut]
    one, other = (spark.createDataFrame(part, SCHEMA) for part in (early, late))
    before = scd2_history(one, KEYS, WM, ["v"], TIE)
    after, behind = scd2_increment(before, other, KEYS, WM, ["v"], TIE)
    assert bag(after) == versions(data) and behind.count() == 0
    archived = archive_versions(one, KEYS, WM, TIE).unionByName(
        archive_increment(inc.latest_per_key(one, KEYS, WM, TIE), other, KEYS, WM, TIE)
    )
    assert bag(archived) == Counter(data) - Counter(latest(data))


def test_a_tombstone_ends_the_current_version_and_late_rows_are_told(spark):
    history = spark.createDataFrame(
        [(1, "a", 1, 5, False), (1, "b", 5, None, True), (2, "x", 3, None, True)],
        "k int, v string, valid_from int, valid_to int, is_current boolean",
    )
    delta = spark.createDataFrame(
        [(1, 9, None, True), (2, 2, "late", False), (3, 1, "new", None)], "k int, w int, v string, gone boolean"
    )
    after, late = scd2_increment(history, delta, ["k"], "w", ["v"], deleted="gone")
    assert rows(after) == [
        (1, "a", 1, 5, False), (1, "b", 5, 9, False), (2, "x", 3, None, True), (3, "new", 1, None, True),
    ]
    assert [(r.k, r.w) for r in late.collect()] == [(2, 2)]
    # After a tombstone the key may come back.
    again = spark.createDataFrame([(1, 12, "c", False)], delta.schema)
    back = scd2_increment(after, again, ["k"], "w", ["v"], deleted="gone")[0]
    assert (1, "c", 12, None, True) in rows(back)


def test_rows_without_a_watermark_share_one_instant(spark):
    data = [(1, None, 0, "a"), (1, None, 1, "b"), (1, 5, 0, "c"), (2, None, 0, "x"), (2, None, 1, "y"), (3, None, 0, "z"), (3, 4, 0, "z")]
    df = spark.createDataFrame(data, SCHEMA)
    for per_task in (100, 1):
        out = scd2_history(df, KEYS, WM, ["v"], TIE, max_rows_per_task=per_task)
        assert rows(out) == [(1, "b", None, 5, False), (1, "c", 5, None, True), (2, "y", None, None, True), (3, "z", None, None, True)]


@pytest.mark.parametrize("seed", range(3))
def test_late_rows_give_the_history_of_all_rows(spark, seed):
    rng = random.Random(seed)
    data = [r for r in some_rows(seed, n=160, keys=8) if r[1] is not None and r[0] is not None]
    # Late rows: before, inside and after stored intervals, and new keys.
    early = [r for r in data if r[1] <= 18 and rng.random() < 0.8]
    rest = list((Counter(data) - Counter(early)).elements()) + [(99, 3, 0, "n"), (99, 1, 0, "m")]
    one, delta = (spark.createDataFrame(part, SCHEMA) for part in (early, rest))
    before = scd2_history(one, KEYS, WM, ["v"], TIE)
    archive, current = archive_versions(one, KEYS, WM, TIE), inc.latest_per_key(one, KEYS, WM, TIE)
    assert bag(scd2_late(before, archive, current, delta, KEYS, WM, ["v"], TIE)) == versions(data + rest[-2:])


def test_a_late_row_cuts_an_interval_in_two_and_leaves_other_keys_alone(spark):
    schema = "k int, w int, t int, v string, gone boolean"
    seen = [(1, 1, 0, "a", False), (1, 5, 0, "a", False), (1, 7, 0, "b", False), (2, 1, 0, "x", False)]
    one = spark.createDataFrame(seen, schema)
    before = scd2_history(one, KEYS, WM, ["v"], TIE)
    archive, current = archive_versions(one, KEYS, WM, TIE), inc.latest_per_key(one, KEYS, WM, TIE)
    delta = spark.createDataFrame([(1, 3, 0, "c", False), (2, 9, 0, None, True)], schema)
    out = scd2_late(before, archive, current, delta, KEYS, WM, ["v"], TIE, deleted="gone")
    # The row at 5 changed nothing when it came, and does now.
    assert rows(out) == [
        (1, "a", 1, 3, False), (1, "a", 5, 7, False), (1, "b", 7, None, True), (1, "c", 3, 5, False), (2, "x", 1, 9, False),
    ]


def test_a_third_of_equal_rows_is_spread_over_tasks(spark):
    """One of the equal rows is current; the others are not made, or gathered, in one task."""
    others = spark.range(0, 60_000, 1, 8).selectExpr("cast(id % 50 as int) k", "cast(id as int) w", "0 t", "'o' v")
    same = spark.range(0, 30_000, 1, 8).selectExpr("7 k", "1000000 w", "0 t", "'same' v")
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        out = history_view(others.union(same), KEYS, WM, TIE)
        assert out.count() == 90_000 and out.where("is_current").count() == 50
        copies = out.where("v = 'same'")
        assert copies.where("is_current").count() == 1
        parts = sorted(r["n"] for r in copies.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())
        assert len(parts) > 4 and parts[-1] <= 30_000 // 3
    finally:
        spark.conf.unset(setting)
    plan = explained(out)
    assert "Window" not in plan


# --- reconciliation -----------------------------------------------------------

LEFT = [(1, "a", 1.5), (2, "b", 2.5), (2, "b", 2.5), (3, None, None)]
KINDS = "k int, s string, d double"


@pytest.mark.parametrize(
    "right, broken",
    [
        (LEFT, set()),
        (
            LEFT + [(4, "b", 1.0)],
            {("*", "rows"), ("k", "max"), ("k", "sum"), ("d", "min"), ("d", "sum")}
            | {(c, "non_null") for c in "ksd"},
        ),
        ([(1, "a", 1.5), (2, "b", 2.5), (2, "b", 3.5), (3, None, None)], {("d", "max"), ("d", "sum")}),
        ([(1, "a", 1.5), (2, "b", 2.5), (2, None, 2.5), (3, None, None)], {("s", "non_null")}),
    ],
)
def test_reconcile(spark, right, broken):
    out = reconcile(spark.createDataFrame(LEFT, KINDS), spark.createDataFrame(right, KINDS))
    found = {(r.column_name, r.measure) for r in out.where("not matches").collect()}
    assert found - {("d", "bits")} == broken
    assert (("d", "bits") in found) == any(column == "d" for column, _ in broken)
    assert out.count() == 1 + 4 + 3 + 5


@pytest.mark.parametrize("left, right", [((0.0, 1e-7, 1.0), (0.0, 4e-7, 1.0)), ((0.0, 1e35, 3e35), (0.0, 2e35, 3e35))])
def test_reconcile_sees_every_digit(spark, left, right):
    one, other = (spark.createDataFrame([(v,) for v in side], "d double") for side in (left, right))
    assert reconcile(one, other).where("not matches").count() >= 1
    assert reconcile(one, one.repartition(3)).where("measure = 'bits' and not matches").count() == 0


def test_reconcile_never_takes_an_overflow_for_a_match(spark):
    wide = spark.range(30).selectExpr("cast(repeat('9', 38) as decimal(38,0)) as d")
    out = reconcile(wide, wide).where("measure = 'sum'").first()
    assert not out.matches and out.left_value != out.right_value


def test_reconcile_tables_of_other_columns_and_empty_ones(spark):
    left = spark.createDataFrame([(1, True)], "k int, only_left boolean")
    out = reconcile(left, left.drop("only_left"))
    assert {r.column_name for r in out.where("not matches").collect()} == {"only_left"}
    empty = left.limit(0)
    assert reconcile(empty, empty).where("not matches").count() == 0


def test_reconcile_sum_does_not_depend_on_row_order(spark):
    values = [(v,) for v in (1e15, 0.1, -1e15, 0.2, 0.3) * 20]
    one = spark.createDataFrame(values, "d double").repartition(1)
    other = spark.createDataFrame(values[::-1], "d double").repartition(5)
    assert reconcile(one, other).where("not matches").count() == 0


def test_row_differences_count_copies(spark):
    left = spark.createDataFrame(LEFT, KINDS)
    right = spark.createDataFrame([(1, "a", 1.5), (2, "b", 2.5), (3, None, None), (5, "n", 0.0)], KINDS)
    more = left.union(left.where("k = 1")).union(left.where("k = 1"))
    assert bag(row_differences(left, right.select("d", "k", "s"))) == Counter(
        [(2, "b", 2.5, "left", 1), (5, "n", 0.0, "right", 1)]
    )
    assert bag(row_differences(left, more)) == Counter([(1, "a", 1.5, "right", 2)])
    assert row_differences(left, left.repartition(3)).count() == 0
