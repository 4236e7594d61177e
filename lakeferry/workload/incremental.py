"""Incremental loads, history, reconciliation, split reads, the file stream."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

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
from lakeferry.operators.watermarks import reached
from lakeferry.plans.load import clean, compact, load_increment, publish_base, read_merged
from lakeferry.session import fresh_dir
from lakeferry.sources.jdbc import PeriodSplit, bound_predicates, period_predicates, quantile_bounds
from lakeferry.streaming.merge import stream_merge
from lakeferry.workload import fixtures as fx

LAST_TIME = "1998-01-01 00:00:00"
LAST_BATCH = "7500"
KEYS = list(fx.ORDER_MERGE.keys)
STAMP = fx.ORDER_MERGE.watermark
VERSION_KEY = ["user_id"]


def incremental_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.incremental_filter(fx.order_feed(spark, sf_dir), STAMP, LAST_TIME)


def incremental_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.incremental_filter(fx.order_base(spark, sf_dir), "o_orderkey", LAST_BATCH)


def high_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.high_watermark(incremental_ts(spark, sf_dir), STAMP, LAST_TIME)


def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.skewed_versions(spark, sf_dir)
    return inc.latest_per_key(rows, VERSION_KEY, "ts", ["event_id"])


def merge_upsert(base_unique: bool):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        base, feed = fx.order_base(spark, sf_dir), fx.order_feed(spark, sf_dir)
        return inc.merge_upsert(base, feed, KEYS, STAMP, base_unique=base_unique)

    return query


def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, feed = fx.order_base(spark, sf_dir), fx.order_feed(spark, sf_dir)
    return inc.incremental_merge(base, feed, KEYS, STAMP, LAST_TIME, base_unique=True)[0]


def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored base, loaded twice from one feed: the second load finds nothing new."""
    target = fresh_dir(spark, "load")
    spec = replace(fx.ORDER_MERGE, buckets=8, database="lakeferry_check", table="order_base")
    publish_base(fx.order_base(spark, sf_dir), target, spec, watermark=LAST_TIME)
    for _ in range(2):
        load_increment(spark, fx.order_feed(spark, sf_dir), target, spec)
    return read_merged(spark, target, spec)


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.event_versions(spark, sf_dir)
    return scd2_history(rows, VERSION_KEY, "ts", ["event_type"], ["event_id"])


def sliced_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One user holds a third of all events: its timeline is cut into slices."""
    rows = fx.skewed_versions(spark, sf_dir)
    return scd2_history(
        rows, VERSION_KEY, "ts", ["event_type"], ["event_id"], max_rows_per_task=task_rows(rows)
    )


def task_rows(rows: DataFrame) -> int:
    """A limit that the user with a third of all rows exceeds."""
    return max(rows.count() // 16, 1)


def archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.event_versions(spark, sf_dir)
    return archive_versions(rows, VERSION_KEY, "ts", ["event_id"])


def archive_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.skewed_versions(spark, sf_dir)
    return archive_versions(rows, VERSION_KEY, "ts", ["event_id"])


def view(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.event_versions(spark, sf_dir)
    return history_view(rows, VERSION_KEY, "ts", ["event_id"])


def view_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.skewed_versions(spark, sf_dir)
    return history_view(rows, VERSION_KEY, "ts", ["event_id"])


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events up to the middle of their time, and those after it."""
    rows = fx.event_versions(spark, sf_dir)
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = rows.agg(F.min(micros), F.max(micros)).first()
    early = micros <= F.lit((first + last) // 2)
    return rows.where(early), rows.where(~early)


def scd2_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history of the first half, carried on by the second, is the history of all."""
    early, late = _halves(spark, sf_dir)
    before = scd2_history(early, VERSION_KEY, "ts", ["event_type"], ["event_id"])
    return scd2_increment(before, late, VERSION_KEY, "ts", ["event_type"], ["event_id"])[0]


def scd2_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh event of the first half comes with the second half: the history is that of all rows."""
    early, late = _halves(spark, sf_dir)
    held, delta = early.where("event_id % 7 <> 0"), late.unionByName(early.where("event_id % 7 = 0"))
    before = scd2_history(held, VERSION_KEY, "ts", ["event_type"], ["event_id"])
    archived = archive_versions(held, VERSION_KEY, "ts", ["event_id"])
    current = inc.latest_per_key(held, VERSION_KEY, "ts", ["event_id"])
    return scd2_late(before, archived, current, delta, VERSION_KEY, "ts", ["event_type"], ["event_id"])


def scd2_unmarked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.unmarked_versions(spark, sf_dir)
    return scd2_history(rows, VERSION_KEY, "ts", ["event_type"], ["event_id"])


def view_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all rows are equal, and the latest of their user: one of them is current."""
    return history_view(fx.repeated_versions(spark, sf_dir), VERSION_KEY, "ts", ["event_id"])


def archive_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half's archive and what the second half adds to it."""
    early, late = _halves(spark, sf_dir)
    current = inc.latest_per_key(early, VERSION_KEY, "ts", ["event_id"])
    archived = archive_versions(early, VERSION_KEY, "ts", ["event_id"])
    return archived.unionByName(archive_increment(current, late, VERSION_KEY, "ts", ["event_id"]))


def current_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.current_view(merge_upsert(True)(spark, sf_dir), "is_deleted")


def reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measures that SQL has too; the hash sums of floats are left to the tests."""
    both = reconcile(fx.order_base(spark, sf_dir), merge_upsert(True)(spark, sf_dir))
    return both.where("measure <> 'bits'")


def differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_differences(fx.order_base(spark, sf_dir), merge_upsert(True)(spark, sf_dir))


def watermark_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed watermark of a zoned column and the rows after it, under sessions of two zones."""
    zone, found = "spark.sql.session.timeZone", []
    before = spark.conf.get(zone)
    stored = fresh_dir(spark, "zones")
    feed = fx.order_feed(spark, sf_dir)
    try:
        spark.conf.set(zone, "UTC")
        feed.withColumn(STAMP, F.col(STAMP).cast("timestamp")).write.parquet(stored)
        rows = spark.read.parquet(stored)
        last = reached(rows.where("o_orderkey % 2 = 0"), STAMP)
        for session in ("America/New_York", "Asia/Tokyo"):
            spark.conf.set(zone, session)
            mark = reached(rows, STAMP)
            late = inc.incremental_filter(rows, STAMP, last).count()
            upto = inc.incremental_filter(rows, STAMP, None, last).count()
            found.append((session, mark.type, mark.value, mark.zone, late, upto))
    finally:
        spark.conf.set(zone, before)
    return spark.createDataFrame(found, "session string, type string, value string, zone string, late long, upto long")


SKEWED_PARTS = 16


def split_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a skewed key by equal-height ranges: each row in one range, no range above twice the mean."""
    skewed = fx.table(spark, sf_dir, "orders").withColumn("k", F.expr("cast(pow(o_totalprice / 1000, 3) as bigint)"))
    predicates = bound_predicates(quantile_bounds(skewed, "k", SKEWED_PARTS))
    met = [F.when(F.expr(p), F.lit(i)) for i, p in enumerate(predicates)]
    rows = skewed.groupBy(F.array_compact(F.array(*met)).alias("met")).agg(F.count(F.lit(1)).alias("n"))
    return rows.agg(
        F.count(F.lit(1)).alias("ranges"), F.sum("n").alias("orders"), F.max(F.size("met")).alias("ranges_of_a_row"),
        (F.max("n") <= 2 * F.avg("n")).alias("even"),
    )


def compact_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A base partitioned by month, loaded and compacted twice; former versions are removed at the end."""
    target, month = fresh_dir(spark, "by-month"), F.date_format(STAMP, "yyyyMM")
    spec = replace(fx.ORDER_MERGE, partition_by=("o_month",))
    publish_base(fx.order_base(spark, sf_dir).withColumn("o_month", month), target, spec, watermark=LAST_TIME)
    feed = fx.order_feed(spark, sf_dir).withColumn("o_month", month)
    for rows in (feed.where(f"{STAMP} < timestamp_ntz'1998-04-01'"), feed):
        load_increment(spark, rows, target, spec)
        compact(spark, target, spec)
    clean(spark, target, spec, keep_seconds=0)
    return read_merged(spark, target, spec)


SPLIT = PeriodSplit("o_orderdate", "yyyyMM", dt.date(1996, 2, 1), dt.date(2000, 12, 31))


def split_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per predicate of a month-split read; a row must meet exactly one."""
    met = [F.when(F.expr(p), F.lit(str(i))) for i, p in enumerate(period_predicates(SPLIT))]
    return (
        fx.table(spark, sf_dir, "orders")
        .groupBy(F.concat_ws(",", *met).alias("predicates"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )


def streamed(compacted: bool):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The feed as three files, one micro-batch each, merged into the base."""
        root = fresh_dir(spark, "stream")
        feed = fx.order_feed(spark, sf_dir)
        feed.repartition(3, "o_orderkey").write.parquet(f"{root}/in")
        publish_base(fx.order_base(spark, sf_dir), f"{root}/target", fx.ORDER_MERGE)
        stream = stream_merge(
            spark,
            f"{root}/in",
            f"{root}/target",
            fx.ORDER_MERGE,
            f"{root}/checkpoint",
            feed.schema,
            max_files_per_trigger=1,
        )
        stream.awaitTermination()
        if compacted:
            compact(spark, f"{root}/target", fx.ORDER_MERGE)
        return read_merged(spark, f"{root}/target", fx.ORDER_MERGE)

    return query


def restarted(compacted: bool):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Two streams into one target, each with a checkpoint of its own: epochs repeat, batches do not."""
        root = fresh_dir(spark, "streams")
        feed = fx.order_feed(spark, sf_dir)
        publish_base(fx.order_base(spark, sf_dir), f"{root}/target", fx.ORDER_MERGE)
        for part in (0, 1):
            rows = feed.where(F.pmod(F.xxhash64("o_orderkey", STAMP), F.lit(2)) == part)
            rows.write.parquet(f"{root}/in{part}")
            stream_merge(
                spark, f"{root}/in{part}", f"{root}/target", fx.ORDER_MERGE, f"{root}/checkpoint{part}", feed.schema
            ).awaitTermination()
            if compacted:
                compact(spark, f"{root}/target", fx.ORDER_MERGE)
        return read_merged(spark, f"{root}/target", fx.ORDER_MERGE)

    return query


def load_zoned_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads under different session zones; the watermark has a zone and moves with neither."""
    target, zone = fresh_dir(spark, "zoned"), "spark.sql.session.timeZone"
    stamped = lambda df: df.withColumn(STAMP, F.col(STAMP).cast("timestamp"))
    feed, before = fx.order_feed(spark, sf_dir), spark.conf.get(zone)
    publish_base(stamped(fx.order_base(spark, sf_dir)), target, fx.ORDER_MERGE, watermark=LAST_TIME)
    stored = stamped(feed)
    stored.write.parquet(f"{target}/feed")
    feed = spark.read.schema(stored.schema).parquet(f"{target}/feed")
    early = feed.where(F.col(STAMP) <= F.lit("1998-03-01 00:00:00Z").cast("timestamp"))
    try:
        for rows, session in ((early, "UTC"), (feed, "America/New_York"), (feed, "Asia/Tokyo")):
            spark.conf.set(zone, session)
            load_increment(spark, rows, target, fx.ORDER_MERGE)
    finally:
        spark.conf.set(zone, before)
    return read_merged(spark, target, fx.ORDER_MERGE)


def load_base_with_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A base published from all versions of its rows holds one row per key."""
    target = fresh_dir(spark, "versions")
    feed = fx.order_feed(spark, sf_dir)
    publish_base(fx.order_base(spark, sf_dir).unionByName(feed), target, fx.ORDER_MERGE, watermark=LAST_TIME)
    load_increment(spark, feed, target, fx.ORDER_MERGE)
    return read_merged(spark, target, fx.ORDER_MERGE)


QUERIES = {
    "incremental_ts": incremental_ts,
    "incremental_batch": incremental_batch,
    "high_watermark": high_watermark,
    "latest_per_key": latest_per_key,
    "merge_upsert": merge_upsert(False),
    "merge_upsert_unique": merge_upsert(True),
    "incremental_merge": incremental_merge,
    "incremental_load": incremental_load,
    "scd2_history": history,
    "scd2_history_sliced": sliced_history,
    "archive_versions": archive,
    "archive_versions_skewed": archive_skewed,
    "history_view": view,
    "history_view_skewed": view_skewed,
    "scd2_incremental": scd2_incremental,
    "archive_incremental": archive_incremental,
    "current_view": current_view,
    "reconcile": reconciled,
    "row_differences": differences,
    "split_predicates": split_predicates,
    "stream_merge": streamed(False),
    "stream_compact": streamed(True),
    "stream_two_checkpoints": restarted(False),
    "stream_after_compact": restarted(True),
    "load_zoned_watermark": load_zoned_watermark,
    "load_base_with_versions": load_base_with_versions,
    "compact_partitioned": compact_partitioned,
    "scd2_late": scd2_late_rows,
    "scd2_null_watermark": scd2_unmarked,
    "history_view_repeated": view_repeated,
    "watermark_zones": watermark_zones,
    "split_bounds": split_bounds,
}

_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_BASE = f"SELECT {_COLUMNS}, false AS is_deleted FROM orders WHERE o_orderkey % 10 <> 0"
_FEED = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice,
       o_orderdate + interval 1 day AS o_orderdate, o_orderpriority,
       o_orderkey % 20 = 0 AS is_deleted
FROM orders WHERE o_orderkey % 5 = 0
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice - 1, o_orderdate - interval 1 day,
       o_orderpriority, false
FROM orders WHERE o_orderkey % 7 = 0"""


def _merged(feed: str) -> str:
    return f"""
SELECT {_COLUMNS}, is_deleted FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey
                               ORDER BY o_orderdate DESC, origin DESC) AS rn
  FROM (SELECT *, 0 AS origin FROM ({_BASE}) UNION ALL SELECT *, 1 FROM ({feed})))
WHERE rn = 1"""


_FRESH = f"SELECT * FROM ({_FEED}) WHERE o_orderdate > timestamp '{LAST_TIME}'"
_SKEWED = """
SELECT event_id, ts, if(event_id % 3 = 0, -1, user_id) AS user_id, event_type, value, props
FROM events"""


def _ranked(rows: str) -> str:
    return f"""
SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
FROM ({rows})"""


_EVENTS = "SELECT * FROM events"
_REPEATED = """
SELECT * FROM events WHERE event_id % 3 <> 0
UNION ALL
SELECT last.* FROM events, (SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 1) last
WHERE events.event_id % 3 = 0"""


def _history(rows: str) -> str:
    return f"""
SELECT user_id, event_type, ts AS valid_from,
       lead(ts) OVER w AS valid_to, lead(ts) OVER w IS NULL AS is_current
FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before
      FROM ({rows}))
WHERE event_type IS DISTINCT FROM before
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""


def _measure(column: str, measure: str, expression: str) -> str:
    left = f"(SELECT {expression} FROM ({_BASE}))"
    right = f"(SELECT {expression} FROM ({_merged(_FEED)}))"
    return f"""
SELECT '{column}' AS column_name, '{measure}' AS measure, left_value, right_value,
       left_value IS NOT DISTINCT FROM right_value AS matches
FROM (SELECT cast({left} AS varchar) AS left_value, cast({right} AS varchar) AS right_value)"""


def _reconciled() -> str:
    columns = [c.strip() for c in _COLUMNS.split(",")] + ["is_deleted"]
    numbers = {"o_orderkey", "o_custkey", "o_totalprice"}
    measures = [_measure("*", "rows", "count(*)")]
    for c in columns:
        measures.append(_measure(c, "non_null", f"count({c})"))
        measures.append(_measure(c, "min", f"min({c})"))
        measures.append(_measure(c, "max", f"max({c})"))
        if c in numbers:
            measures.append(_measure(c, "sum", f"sum(cast({c} AS decimal(38,6)))"))
    return " UNION ALL ".join(measures)


ORACLES = {
    "incremental_ts": _FRESH,
    "incremental_batch": f"SELECT * FROM ({_BASE}) WHERE o_orderkey > {LAST_BATCH}",
    "high_watermark": f"SELECT cast(max(o_orderdate) AS varchar) AS high_watermark FROM ({_FRESH})",
    "latest_per_key": f"SELECT * EXCLUDE (rn) FROM ({_ranked(_SKEWED)}) WHERE rn = 1",
    "merge_upsert": _merged(_FEED),
    "merge_upsert_unique": _merged(_FEED),
    "incremental_merge": _merged(_FRESH),
    "incremental_load": _merged(_FRESH),
    "scd2_history": _history(_EVENTS),
    "scd2_history_sliced": _history(_SKEWED),
    "archive_versions": f"SELECT * EXCLUDE (rn) FROM ({_ranked(_EVENTS)}) WHERE rn > 1",
    "archive_versions_skewed": f"SELECT * EXCLUDE (rn) FROM ({_ranked(_SKEWED)}) WHERE rn > 1",
    "history_view": f"SELECT * EXCLUDE (rn), rn = 1 AS is_current FROM ({_ranked(_EVENTS)})",
    "history_view_skewed": f"SELECT * EXCLUDE (rn), rn = 1 AS is_current FROM ({_ranked(_SKEWED)})",
    "scd2_incremental": _history(_EVENTS),
    "archive_incremental": f"SELECT * EXCLUDE (rn) FROM ({_ranked(_EVENTS)}) WHERE rn > 1",
    "current_view": f"SELECT * FROM ({_merged(_FEED)}) WHERE NOT is_deleted",
    "reconcile": _reconciled(),
    "row_differences": f"""
SELECT *, count(*) AS copies FROM (
  SELECT *, 'left' AS side FROM (({_BASE}) EXCEPT ALL ({_merged(_FEED)}))
  UNION ALL
  SELECT *, 'right' FROM (({_merged(_FEED)}) EXCEPT ALL ({_BASE})))
GROUP BY ALL""",
    "split_predicates": """
SELECT cast(CASE WHEN o_orderdate < timestamp '1996-02-01' THEN 0
                 WHEN o_orderdate >= timestamp '2001-01-01' THEN 60
                 ELSE (year(o_orderdate) - 1996) * 12 + month(o_orderdate) - 1 END
            AS varchar) AS predicates,
       count(*) AS orders
FROM orders GROUP BY 1""",
    "stream_merge": _merged(_FEED),
    "stream_compact": _merged(_FEED),
    "stream_two_checkpoints": _merged(_FEED),
    "stream_after_compact": _merged(_FEED),
    "load_zoned_watermark": _merged(_FRESH),
    "load_base_with_versions": _merged(_FEED),
    "compact_partitioned": f"SELECT *, strftime(o_orderdate, '%Y%m') AS o_month FROM ({_merged(_FRESH)})",
    "scd2_late": _history(_EVENTS),
    "scd2_null_watermark": f"""
SELECT * FROM (
  SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER w AS valid_to, lead(event_id) OVER w IS NULL AS is_current
  FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id) AS before
        FROM (SELECT * REPLACE (if(event_id % 11 = 0, NULL, ts) AS ts) FROM events))
  WHERE event_type IS DISTINCT FROM before
  WINDOW w AS (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id))
WHERE is_current OR valid_from IS NOT NULL OR valid_to IS NOT NULL""",
    "history_view_repeated": f"SELECT * EXCLUDE (rn), rn = 1 AS is_current FROM ({_ranked(_REPEATED)})",
    "watermark_zones": f"""
SELECT session, 'timestamp' AS type, strftime(top, '%Y-%m-%d %H:%M:%S.%f') || 'Z' AS value, 'UTC' AS zone, late, upto
FROM (VALUES ('America/New_York'), ('Asia/Tokyo')) s(session),
     (SELECT max(o_orderdate) AS top, count(*) FILTER (o_orderdate > last) AS late,
             count(*) FILTER (o_orderdate <= last) AS upto
      FROM ({_FEED}), (SELECT max(o_orderdate) AS last FROM ({_FEED}) WHERE o_orderkey % 2 = 0))""",
    "split_bounds": f"""
SELECT cast({SKEWED_PARTS} AS bigint) AS ranges, count(*) AS orders, cast(1 AS integer) AS ranges_of_a_row, true AS even
FROM orders""",
}
