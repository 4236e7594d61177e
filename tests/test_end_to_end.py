"""Documents to plan to migrated tables to state, in one go."""

from __future__ import annotations

import json

from helpers import rows
from pyspark.sql import functions as F
from test_catalog import source, sources, table, tables
from test_lake import LANDED, landed_rows

from lakeferry.operators.catalog import plan_migration, resolve_targets
from lakeferry.operators.state import STATE, apply_state
from lakeferry.plans.migrate import migrate_batch
from lakeferry.sources.documents import read_plan, read_tables, write_plan


def land(spark, root, fmt):
    df = spark.createDataFrame(landed_rows(), LANDED)
    levels = {"p1": F.col("region"), "p2": F.col("rx"), **{k: F.lit(0) for k in "xyz"}}
    df.withColumns(levels).write.partitionBy(*levels).format(fmt).save(f"{root}/merged/{fmt}")


def test_documents_to_migrated_tables(spark, tmp_path):
    for name, fmt in (("one", "parquet"), ("two", "orc")):
        land(spark, tmp_path / name, fmt)
    keys = [
        ("region", False, None, None),
        ("name", True, "regex", "rx"),
    ]
    onprem = tables(
        spark,
        table("t1", table="one", path=str(tmp_path / "one"), columns=[("name", "name"), ("id", "id")],
              ingestion={"partition_key": keys}),
        table("t2", table="two", path=str(tmp_path / "two"), columns=[("label", "name")],
              ingestion={"partition_key": keys, "storage_format": "orc"}),
        table("t3", table="lost", path=str(tmp_path / "lost")),
        table("t4", table="no_target"),
        table("t5", table="full", sync="full-load"),
    )
    # The documents and the plan go through their files.
    onprem.write.json(str(tmp_path / "documents"))
    documents = read_tables(spark, str(tmp_path / "documents"))
    plan = plan_migration(documents, sources(spark, source("s1", kind="file")))
    write_plan(plan, str(tmp_path / "plan"))
    plan = read_plan(spark, str(tmp_path / "plan"))

    target = tables(
        spark,
        *[
            table(f"n{i}", table=name, hive_schema="h", path=str(tmp_path / "lake" / name), columns=renames)
            for i, (name, renames) in enumerate(
                [
                    ("one", [("id", "order_id"), ("region", "area")]),
                    # Renamed on-prem (label -> name) and here (label -> caption).
                    ("two", [("label", "caption")]),
                    ("lost", []),
                ]
            )
        ],
    )
    found, missing = resolve_targets(plan, target)
    assert [r.table_id for r in missing.collect()] == ["t4"]
    results = migrate_batch(spark, found)
    assert rows(results.select("table_id", "status", "rows_written")) == [
        ("t1", "SUCCEEDED", 12), ("t2", "SUCCEEDED", 12), ("t3", "FAILED", None),
    ]

    one, two = spark.table("h.one"), spark.table("h.two")
    assert set(one.columns) == {
        "order_id", "name", "area", "ziw_target_timestamp", "ziw_is_deleted", "ziw_file_name",
        "ziw_file_modified_timestamp",
    }
    assert one.where("area = '01'").count() == 4
    assert "caption" in two.columns and "name" not in two.columns
    assert (tmp_path / "lake" / "one" / "merged" / "area=00").exists()

    before = (False, "new", None, None, True, True, True, True)
    state = spark.createDataFrame([(f"t{i}", *before) for i in range(1, 6)], STATE)
    after = {r.table_id: r for r in apply_state(state, plan, results).collect()}
    assert [after[f"t{i}"].state for i in range(1, 6)] == ["ready", "ready", "new", "new", "new"]
    assert after["t1"].last_ingested_cdc_value == "007"
    assert json.loads(plan.where("table_id = 't1'").first().partition_column) == {
        "normal": ["region"], "drop": ["rx"],
    }
