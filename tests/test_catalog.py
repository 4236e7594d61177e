from __future__ import annotations

import pytest
from helpers import bag, explained, rows
from pyspark.sql import functions as F

from lakeferry.functions.names import quote
from lakeferry.model import PLAN, PLAN_COLUMNS, SOURCE_DOCUMENT, TABLE_DOCUMENT
from lakeferry.operators import catalog, joins
from lakeferry.operators.state import STATE, apply_state
from lakeferry.sources.documents import (
    read_plan,
    read_source_dump,
    read_sources,
    read_tables,
    write_job_log,
    write_plan,
    write_source_dump,
)

TABLE_FIELDS = 10


def table(table_id, source="s1", state="ready", sync="cdc-batch-id", **over):
    """A table document; ``over`` sets ingestion fields."""
    ingestion = {"sync_type": sync, "storage_format": "parquet", **over.pop("ingestion", {})}
    names = [
        "sync_type", "storage_format", "hive_table_name", "natural_key", "is_scd2_table",
        "is_archive_enabled", "generate_history_view", "timestamp_column_update",
        "batch_id_cdc_column", "fetch_mechanism", "pk_chunking_enabled", "split_by_key",
        "split_by_key_extract_from_col", "split_by_key_derive_function",
        "split_by_key_derive_column", "partition_key",
    ]
    return (
        table_id,
        source,
        over.get("table", f"tbl_{table_id}"),
        over.get("hive_schema", "h"),
        state,
        over.get("path", f"/p/{table_id}"),
        over.get("cdc", "007"),
        over.get("merged", "2020-01-01 00:00:00"),
        over.get("columns", [("a", "a"), ("b", "b2")]),
        tuple(ingestion.get(n) for n in names),
    )


def tables(spark, *documents):
    return spark.createDataFrame(list(documents), TABLE_DOCUMENT)


def source(src_id, subtype="oracle", kind="rdbms", **over):
    connection = {
        "driver_name": "d", "schema": "s", "database": "db", "connection_method": "jdbc",
        "connection_string": "c", "username": "u", **over,
    }
    return (src_id, f"name_{src_id}", "h", kind, subtype, f"/s/{src_id}", True, tuple(connection.values()))


def sources(spark, *documents):
    return spark.createDataFrame(list(documents), SOURCE_DOCUMENT)


def test_plan_keeps_ready_incremental_tables(spark):
    df = tables(
        spark,
        table("t1"),
        table("t2", state="new"),
        table("t3", sync="full-load"),
        table("t4", sync="cdc-timestamp-column", cdc=None, merged=None),
    )
    plan = {r.table_id: r for r in catalog.plan_tables(df).collect()}
    assert plan.keys() == {"t1", "t4"}
    assert plan["t1"].last_ingested_cdc_value == "007"
    assert plan["t1"].override_columns == '{"b":"b2"}'
    assert plan["t1"].partition_column == '{"normal":[],"drop":[]}'
    assert plan["t4"].last_ingested_cdc_value is None
    assert plan["t4"].last_merged_timestamp is None


def test_source_ids_as_list_text_relation_and_long_list(spark):
    df = tables(spark, table("t1"), table("t2", "s2"), table("t3", "s3"))
    ids = catalog.parse_ids("s1, s3,,")
    assert ids == ["s1", "s3"]
    long = ids + [f"x{i}" for i in range(catalog.MAX_LISTED_IDS)]
    relation = spark.createDataFrame([("s1",), ("s3",), ("s1",)], "id string")
    for given in (ids, long, relation):
        assert [r.table_id for r in catalog.plan_tables(df, given).orderBy("table_id").collect()] == [
            "t1",
            "t3",
        ]
    assert catalog.plan_tables(df, []).count() == 0


def test_plan_of_unknown_source_drops_out(spark):
    df = tables(spark, table("t1"), table("t2", "gone"), table("t3", None))
    plan = catalog.plan_migration(df, sources(spark, source("s1"), source("s9")))
    assert plan.columns == list(PLAN_COLUMNS)
    assert [r.table_id for r in plan.collect()] == ["t1"]


@pytest.mark.parametrize("how", joins.LOOKUP_JOINS)
def test_salted_lookup_equals_broadcast_lookup(spark, how):
    facts = spark.range(0, 5000).selectExpr("id", "if(id % 3 = 0, 0, id % 700) as k", "id * 2 as v")
    lookup = spark.range(0, 500).selectExpr("id as k", "concat('n', id) as name")
    small = joins.join_lookup(facts, lookup, {"k": "k"}, ["id"], how)
    large = joins.join_lookup(
        facts, lookup, {"k": "k"}, ["id"], how, salts=4, broadcast_bytes=0
    )
    looked_up = ["name"] if how in ("inner", "left") else []
    assert small.columns == large.columns == ["id", "k", "v", *looked_up]
    assert bag(small) == bag(large)
    assert "BroadcastHashJoin" in explained(small)
    assert "SortMergeJoin" in explained(large) and "Broadcast" not in explained(large)
    with pytest.raises(ValueError):
        joins.join_lookup(facts, lookup, {"k": "k"}, ["id"], "right")


@pytest.mark.parametrize("broadcast_bytes", [0, None])
def test_null_safe_lookup(spark, broadcast_bytes):
    facts = spark.createDataFrame([(1, None), (2, 5), (3, 6)], "id int, k int")
    lookup = spark.createDataFrame([(None,), (5,)], "k int")
    found = {
        (safe, how): [
            r.id
            for r in joins.join_lookup(
                facts, lookup, {"k": "k"}, ["id"], how,
                broadcast_bytes=broadcast_bytes, null_safe=safe,
            ).orderBy("id").collect()
        ]
        for safe in (True, False)
        for how in ("left_semi", "left_anti")
    }
    assert found[True, "left_semi"] == [1, 2] and found[True, "left_anti"] == [3]
    assert found[False, "left_semi"] == [2] and found[False, "left_anti"] == [1, 3]


def test_salt_spreads_a_hot_key(spark):
    facts = spark.range(0, 4000).selectExpr("id", "0 as k")
    lookup = spark.range(0, 50).selectExpr("id as k", "id as name")
    joined = joins.join_lookup(facts, lookup, {"k": "k"}, ["id"], salts=16, broadcast_bytes=0)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        per_task = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset(setting)
    assert len(per_task) > 3
    assert max(r["count"] for r in per_task) < 2500


def test_null_safe_join(spark):
    left = spark.createDataFrame([(1, None, "a"), (None, None, "b"), (2, 2, "c")], "x int, y int, v string")
    right = left.where("v <> 'c'").select("x", "y", F.lit(1).alias("hit"))
    out = joins.join_null_safe(left, right, ["x", "y"])
    assert {(r.v, r.hit) for r in out.collect()} == {("a", 1), ("b", 1), ("c", None)}
    assert "SortMergeJoin" in explained(out) or "HashJoin" in explained(out)


def test_plan_file_keeps_awkward_text(spark, tmp_path):
    texts = ["a|b", 'q"uo"te', "line\nbreak", "{}", "[x]", '{"k":"v|w"}', "007", " blank ", "\\", "naïve"]
    plan = spark.createDataFrame(
        [tuple(f"{t}" if i % 2 else f"{i}{t}" for i in range(len(PLAN_COLUMNS))) for t in texts], PLAN
    )
    write_plan(plan, str(tmp_path / "plan"))
    assert bag(read_plan(spark, str(tmp_path / "plan"))) == bag(plan)


def test_plan_file_reads_empty_text_as_null(spark, tmp_path):
    plan = spark.createDataFrame([tuple([None, ""] * 7)], PLAN)
    write_plan(plan, str(tmp_path / "plan"))
    assert rows(read_plan(spark, str(tmp_path / "plan"))) == [(None,) * 14]


def test_resolve_targets(spark):
    plan = catalog.plan_migration(
        tables(
            spark,
            table("t1", table="x", columns=[("a", "a1"), ("b", "b1")]),
            table("t2", table="missing"),
        ),
        sources(spark, source("s1")),
    )
    target = tables(
        spark,
        table("n2", table="x", path="/new2", columns=[]),
        table("n1", table="x", path="/new1/", columns=[("a", "A"), ("b", "b"), ("c", "C")]),
        table("n3", table="x", hive_schema="other"),
    )
    found, missing = catalog.resolve_targets(plan, target)
    (row,) = found.collect()
    # The first document by id wins; b, renamed on-prem only, has no entry.
    assert (row.target_id, row.target_dir) == ("n1", "/new1/merged")
    assert row.override_columns == '{"a1":"A","c":"C"}'
    assert missing.columns == [*plan.columns, "reason"]
    assert [(r.table_id, r.reason) for r in missing.collect()] == [("t2", "no target")]


def test_targets_without_a_path_or_of_one_path(spark):
    """A null path would give one folder, ``merged``, to all such tables."""
    plan = catalog.plan_migration(
        tables(spark, *[table(f"t{i}", table=f"x{i}") for i in range(5)]), sources(spark, source("s1"))
    )
    paths = [None, "  ", "/l", "/l/", "/own"]
    target = tables(spark, *[table(f"n{i}", table=f"x{i}", path=p) for i, p in enumerate(paths)])
    ready, rejected = catalog.resolve_targets(plan, target)
    assert sorted((r.table_id, r.target_dir) for r in ready.collect()) == [("t2", "/l/merged"), ("t4", "/own/merged")]
    assert sorted((r.table_id, r.reason) for r in rejected.collect()) == [
        ("t0", "no target path"), ("t1", "no target path"), ("t3", "shared target"),
    ]


def test_lookups_run_no_job_while_planned(spark):
    facts, lookup = spark.range(10).selectExpr("id", "id as k"), spark.range(5).selectExpr("id as k")
    spark.sparkContext.setJobGroup("planning", "planning")
    joined = joins.join_lookup(facts, lookup, {"k": "k"}, ["id"])
    assert "SinglePartition" not in explained(joined)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_foreign_source_file_is_read_by_its_header(spark, tmp_path):
    """Thirteen columns in another order, a credential seventh."""
    names = [n for n in catalog.SOURCE_DUMP_COLUMNS]
    header = [*names[6:], *names[:3], "connection.secret", *names[3:6]]
    cells = ["true" if n == "isPublic" else "SECRET" if n == "connection.secret" else f"v {n}" for n in header]
    (tmp_path / "f.csv").write_text(",".join(header) + "\n" + ",".join(cells) + "\n")
    (row,) = read_source_dump(spark, str(tmp_path / "f.csv")).collect()
    assert row.asDict() == {n: True if n == "isPublic" else f"v {n}" for n in names}
    (tmp_path / "g.csv").write_text(",".join(header[1:]) + "\n" + ",".join(cells[1:]) + "\n")
    with pytest.raises(ValueError, match=header[0]):
        read_source_dump(spark, str(tmp_path / "g.csv"))


def test_source_dump_filters_and_rejects(spark):
    df = sources(
        spark,
        source("1"),
        source("2", "db2"),
        source("3", kind="file"),
        source("4", username=None),
        source("5", "teradata", connection_method="tpt"),
        (*source("6")[:-1], None),
    )
    valid, rejected = catalog.source_dump(df)
    assert sorted(r["name"] for r in valid.collect()) == ["name_1", "name_5"]
    assert sorted(r["src_id"] for r in rejected.collect()) == ["4", "6"]
    assert valid.columns[0] == "connection.driver_name" and "password" not in str(valid.columns)


def test_source_dump_file_and_descriptors(spark, tmp_path):
    df = sources(
        spark,
        source("1", "teradata", connection_method="tpt"),
        source("2", "teradata"),
        source("3", "oracle", driver_name='a,"b"', schema=" x "),
        source("4", "sqlserver", connection_method="native"),
    )
    valid, _ = catalog.source_dump(df)
    write_source_dump(valid, str(tmp_path / "dump"))
    dump = read_source_dump(spark, str(tmp_path / "dump"))
    assert bag(dump) == bag(valid)
    described = {r["name"]: r for r in catalog.source_descriptors(dump).collect()}
    tpt = "connection.enable_tpt_for_source"
    method = "connection.connection_method"
    log = "configuration.oracle_logbased_cdc_enabled"
    assert (described["name_1"][tpt], described["name_1"][method]) == (True, "jdbc")
    assert (described["name_2"][tpt], described["name_2"][method]) == (False, "jdbc")
    assert (described["name_3"][tpt], described["name_3"][log]) == (None, False)
    assert described["name_3"]["connection.driver_name"] == 'a,"b"'
    assert (described["name_4"][method], described["name_4"][log]) == ("native", None)


def test_descriptor_defaults(spark):
    valid, _ = catalog.source_dump(sources(spark, source("1")))
    bare = valid.withColumns(
        {quote(c)[1:-1]: F.lit(None).cast("string") for c in ("hdfs_path",)}
    ).withColumn("isPublic", F.lit(None).cast("boolean"))
    row = catalog.source_descriptors(bare).first()
    assert (row["hdfs_path"], row["isPublic"]) == ("", True)


def test_documents_are_read_with_a_fixed_schema(spark, tmp_path):
    """D7: a missing key and a null are alike; digits stay text; extra keys are ignored."""
    (tmp_path / "t.json").write_text(
        '{"table_id": "0012", "last_ingested_cdc_value": null, "other": 1}\n'
        '{"table_id": "3"}\n'
    )
    df = read_tables(spark, str(tmp_path / "t.json"))
    assert [(r.table_id, r.last_ingested_cdc_value) for r in df.collect()] == [("0012", None), ("3", None)]
    (tmp_path / "s.json").write_text('{"src_id": "1", "connection": {"username": "u", "password": "p"}}')
    assert "password" not in read_sources(spark, str(tmp_path / "s.json")).schema.simpleString()


def test_idle_jobs(spark, tmp_path):
    jobs = spark.createDataFrame([(3,), (1,), (2,), (4,)], "job_id bigint")
    runs = spark.createDataFrame([(2,), (2,), (9,), (None,)], "job_id bigint")
    idle = catalog.idle_jobs(jobs, runs)
    assert [r.job_id for r in idle.collect()] == [4, 3, 1]
    write_job_log(idle, str(tmp_path / "log"))
    lines = sorted(spark.read.text(str(tmp_path / "log")).distinct().collect())
    assert [r.value for r in lines] == ["1,idle", "3,idle", "4,idle", "job_id,status"]


def test_existing(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), (None, 4)], "k string, v int")
    right = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(catalog.existing(left, right, ["k"])) == [("a", 1), ("a", 3)]


def test_find_one(spark):
    df = spark.createDataFrame([("a", 2, 1), ("a", 1, 2), ("b", 0, 3)], "k string, n int, v int")
    assert rows(catalog.find_one(df, {"k": "a"}, ["n"])) == [("a", 1, 2)]
    assert catalog.find_one(df, {"k": "a", "n": 9}, ["n"]).count() == 0


def test_update_where(spark):
    df = spark.createDataFrame([("a", 1, 1), (None, 2, 2), ("b", 3, 3)], "k string, v bigint, w int")
    out = catalog.update_where(df, F.col("k") == "a", {"v": F.col("w") + 10, "w": F.col("v") + 20})
    # Assignments see the old row; an unknown condition keeps it; types stay.
    assert rows(out) == [("a", 11, 21), ("b", 3, 3), (None, 2, 2)]
    assert out.schema == df.schema
    with pytest.raises(ValueError):
        catalog.update_where(df, F.lit(True), {"nope": 1})


def test_grant_sources(spark):
    access = spark.createDataFrame([("t", "a"), ("t", "b")], "template_id string, source_id string")
    grants = spark.createDataFrame([("b", "t"), ("c", "t")], "source_id string, template_id string")
    assert rows(catalog.grant_sources(access, grants)) == [("t", "a"), ("t", "b"), ("t", "c")]


def test_state_moves_on_success_only(spark):
    """D5."""
    before = (False, "new", None, None, True, True, True, True)
    state = spark.createDataFrame([(f"t{i}", *before) for i in range(4)], STATE)
    plan = tables(spark, *[table(f"t{i}", cdc=None if i == 1 else "9") for i in range(3)])
    results = spark.createDataFrame(
        [("t0", "SUCCEEDED"), ("t0", "SUCCEEDED"), ("t1", "SUCCEEDED"), ("t2", "FAILED")],
        "table_id string, status string",
    )
    after = {r.table_id: tuple(r)[1:] for r in apply_state(state, plan, results).collect()}
    done = ("ready", "9", "2020-01-01 00:00:00", False, False, False, False)
    assert after["t0"] == (True, *done)
    assert after["t1"][1:3] == ("ready", None)
    assert after["t2"] == after["t3"] == before
    assert len(after) == 4


def test_state_moves_in_the_target_document(spark):
    before = (False, "new", None, None, True, True, True, True)
    state = spark.createDataFrame([(i, *before) for i in ("t0", "n0", "n1")], STATE)
    plan = spark.createDataFrame(
        [("t0", "n0", "5", "2020"), ("t0", "n0", "7", "2021"), ("t1", "n1", "1", "2020")],
        "table_id string, target_id string, last_ingested_cdc_value string, last_merged_timestamp string",
    )
    results = spark.createDataFrame([("t0", "SUCCEEDED"), ("t1", "FAILED")], "table_id string, status string")
    after = rows(apply_state(state, plan, results))
    assert after == [("n0", True, "ready", "7", "2021", *[False] * 4), ("n1", *before), ("t0", *before)]


def test_plan_tables_is_shuffle_free(spark):
    assert "Exchange" not in explained(catalog.plan_tables(tables(spark, table("t1"))))


def test_rows_without_a_path_do_not_meet_in_one_window_group(spark):
    plan = catalog.plan_migration(tables(spark, *[table(f"t{i}") for i in range(8)]), sources(spark, source("s1")))
    target = tables(spark, table("n1", table="other"))
    ready, rejected = catalog.resolve_targets(plan, target)
    assert ready.count() == 0 and {r.reason for r in rejected.collect()} == {"no target"}
    assert "CASE WHEN isnull(target_dir" in explained(rejected)
