from __future__ import annotations

import datetime as dt
from dataclasses import replace
from pathlib import Path

import pytest
from helpers import bag, explained, rows
from hypothesis import given, strategies as st
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F

from lakeferry.functions.dates import add_derived_partitions, where_parent_between
from lakeferry.model import AuditProfile, MergeSpec, PartitionSpec, TableSpec
from lakeferry.operators.cleanse import apply_partition_spec, cleanse_audit, rename_columns
from lakeferry.plans.migrate import migrate_batch, migrate_table, prepare_table
from lakeferry.sinks.tables import (
    check_append,
    check_no_overlap,
    default_table_format,
    merge_into_table,
    merge_statement,
    register_table,
    write_table,
)
from lakeferry.sources.landed import scan_landed

LANDED = (
    "id bigint, name string, region string, rx string, ziw_row_id string, ziw_active boolean, "
    "ziw_target_start_timestamp timestamp_ntz, ziw_is_deleted string, ziw_filename string"
)
T0 = dt.datetime(2020, 1, 1)


def landed_rows(n=12):
    return [
        (i, f"n{i}", f"0{i % 3}", f"r{i % 2}", str(i), i % 4 != 0, T0, "yN2"[i % 3], f"f{i}.csv")
        for i in range(n)
    ]


@pytest.fixture
def landed(spark, tmp_path):
    """A landed tree with the region and regex columns inside its files."""
    df = spark.createDataFrame(landed_rows(), LANDED)
    for fmt in ("parquet", "orc"):
        df.withColumns(
            {"p1": F.col("region"), "p2": F.col("rx"), **{k: F.lit(0) for k in "xyz"}}
        ).write.partitionBy("p1", "p2", "x", "y", "z").format(fmt).save(
            str(tmp_path / "src" / "merged" / fmt)
        )
    return tmp_path / "src"


@pytest.fixture
def spec(landed, tmp_path):
    return TableSpec(
        src_dir=str(landed),
        target_dir=str(tmp_path / "target"),
        database="test_lake",
        table="t",
        partitions=PartitionSpec(("region",), ("rx",)),
    )


def test_orc_and_parquet_in_both_layouts_agree(spark, landed):
    parts = PartitionSpec(("region",), ("rx",))
    scans = [
        scan_landed(spark, str(landed), fmt, parts, layout)
        for fmt in ("parquet", "ORC")
        for layout in ("recursive", "exact")
    ]
    bags = [bag(df) for df in scans]
    assert sum(bags[0].values()) == 12
    assert all(b == bags[0] for b in bags)
    assert all(df.columns == scans[0].columns for df in scans)


def test_named_layout_reads_directory_values(spark, landed):
    named = scan_landed(spark, str(landed), "parquet", layout="named")
    assert {"p1", "p2", "x"} <= set(named.columns)
    assert {r.p1 for r in named.select("p1").distinct().collect()} == {"00", "01", "02"}


def test_unknown_layout(spark, landed):
    with pytest.raises(ValueError):
        scan_landed(spark, str(landed), "parquet", layout="flat")


def test_unsupported_format_is_refused_before_the_target_is_touched(spark, spec):
    """D2."""
    kept = Path(spec.target_dir) / "kept"
    kept.mkdir(parents=True)
    for bad in ({"fmt": "csv"}, {"mode": "upsert"}, {"cluster": "never"}):
        with pytest.raises(ValueError):
            migrate_table(spark, replace(spec, **bad))
    assert kept.exists()


def test_overlap_is_refused(spark, spec):
    """D3."""
    for target in (spec.src_dir, spec.src_dir + "/merged", spec.src_dir + "/merged/parquet/x"):
        with pytest.raises(ValueError):
            migrate_table(spark, replace(spec, target_dir=target))
    assert scan_landed(spark, spec.src_dir, "parquet").count() == 12


def test_overlap_paths():
    check_no_overlap("/a/b", "/a/bc")
    check_no_overlap("s3a://one/a", "s3a://two/a")
    for source, target in [
        ("/a/b", "/a/b/"),
        ("/a/b", "/a/./b/c/../c"),
        ("file:/a", "file:///a/b"),
        ("file:/a/b", "/a"),
        ("abfss://c@x/a/b", "abfss://c@x/a"),
        ("/a", "/"),
        ("s3a://b/t/merged/parquet", "s3://b/t/merged"),
        ("s3n://b/t", "s3a://b/t/x"),
        ("hdfs:///t/x", "hdfs://nn/t"),
        ("hdfs://nn:8020/t", "webhdfs://nn:9870/t/x"),
        ("viewfs://c/t", "hdfs://nn/t"),
        ("abfss://c@x/a", "abfs://c@x/a"),
    ]:
        with pytest.raises(ValueError):
            check_no_overlap(source, target)


@given(st.lists(st.sampled_from("abc"), min_size=1, max_size=4), st.lists(st.sampled_from("abc"), max_size=4))
def test_a_path_overlaps_all_below_it(path, below):
    top = "/" + "/".join(path)
    with pytest.raises(ValueError):
        check_no_overlap(top, "/".join([top, *below]))


def test_scan_takes_the_columns_of_all_files(spark, tmp_path):
    top = tmp_path / "merged" / "parquet"
    spark.createDataFrame([(1, "a")], "k int, old string").write.parquet(str(top / "x"))
    spark.createDataFrame([(2, 5)], "k int, newcol int").write.parquet(str(top / "y"))
    landed = scan_landed(spark, str(tmp_path), "parquet")
    assert {c: t for c, t in landed.dtypes} == {"k": "int", "old": "string", "newcol": "int"}
    assert sorted((r.k, r.old, r.newcol) for r in landed.collect()) == [(1, "a", None), (2, None, 5)]
    spark.createDataFrame([("text",)], "newcol string").write.parquet(str(top / "z"))
    with pytest.raises(Exception, match="(?i)merge"):
        scan_landed(spark, str(tmp_path), "parquet").count()


def test_parents_with_dots(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 9),)], ["a.b"])
    out = add_derived_partitions(df, [("a.b", "yyyyMM", "p.q")])
    assert [tuple(r) for r in out.collect()] == [(dt.date(2024, 3, 9), "202403")]
    day = dt.datetime(2024, 3, 9)
    assert where_parent_between(out, ("a.b", "yyyyMM", "p.q"), day, day).count() == 1


def test_cleanse_drops_renames_and_casts(spark):
    df = spark.createDataFrame(landed_rows(3), LANDED)
    out = cleanse_audit(df)
    assert out.columns == [
        "id", "name", "region", "rx", "ziw_target_timestamp", "ziw_is_deleted", "ziw_filename",
    ]
    assert [r.ziw_is_deleted for r in out.orderBy("id").collect()] == [True, False, None]


def test_cleanse_file_source(spark):
    out = cleanse_audit(spark.createDataFrame(landed_rows(1), LANDED), src_type="FILE")
    row = out.first()
    assert row.ziw_file_name == "f0.csv"
    assert row.ziw_file_modified_timestamp == row.ziw_target_timestamp == T0
    assert "ziw_filename" not in out.columns


def test_cleanse_is_case_insensitive_and_needs_the_deleted_flag(spark):
    df = spark.createDataFrame([(1, "1", "x")], "id int, ZIW_IS_DELETED string, Ziw_Row_Id string")
    assert [c.lower() for c in cleanse_audit(df).columns] == ["id", "ziw_is_deleted"]
    with pytest.raises(ValueError):
        cleanse_audit(df.drop("ZIW_IS_DELETED"))


def test_other_audit_prefix(spark):
    df = spark.createDataFrame([(1, "1", "x")], "id int, au_is_deleted string, au_scn string")
    assert cleanse_audit(df, AuditProfile("au_")).columns == ["id", "au_is_deleted"]


def test_rename_swap_collision_case_and_empty(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, `c.d` int")
    swapped = rename_columns(df, {"a": "b", "b": "a"})
    assert (swapped.columns, tuple(swapped.first())) == (["b", "a", "c.d"], (1, 2, 3))
    assert rename_columns(df, {"A": "x", "a": "", "zz": "y"}).columns == df.columns
    assert rename_columns(df, {"c.d": "e`f"}).columns == ["a", "b", "e`f"]
    for collision in ({"a": "b"}, {"a": "B"}):
        with pytest.raises(ValueError):
            rename_columns(df, collision)


def test_regex_columns_are_always_dropped(spark):
    """D4."""
    df = spark.createDataFrame([(1, 2, 3)], "a int, p int, rx int")
    only_drop = PartitionSpec((), ("rx",))
    assert apply_partition_spec(df, only_drop)[0].columns == ["a", "p"]
    kept, normal = apply_partition_spec(df, only_drop, strict_reference=True)
    assert (kept.columns, normal) == (["a", "p", "rx"], [])
    both = PartitionSpec(("p",), ("rx",))
    for strict in (False, True):
        out, normal = apply_partition_spec(df, both, strict_reference=strict)
        assert (out.columns, normal) == (["a", "p"], ["p"])


def test_partition_names_follow_renames(spark):
    """D8."""
    df = rename_columns(spark.createDataFrame([(1, 2, 3)], "a int, p int, rx int"), {"p": "q", "rx": "s"})
    out, normal = apply_partition_spec(df, PartitionSpec(("p",), ("rx",)), {"p": "q", "rx": "s"})
    assert (out.columns, normal) == (["a", "q"], ["q"])


def test_bad_partitioning_is_refused(spark, tmp_path):
    df = spark.createDataFrame([(1, 2)], "a int, p int")
    with pytest.raises(ValueError):
        apply_partition_spec(df, PartitionSpec(("missing",), ()))
    with pytest.raises(ValueError):
        apply_partition_spec(df, PartitionSpec(("p",), ("p",)))
    with pytest.raises(ValueError):
        write_table(df, str(tmp_path / "x"), partition_by=["p", "A"])


def test_migrate_partitioned(spark, spec):
    result = migrate_table(spark, replace(spec, renames={"region": "area", "name": "label"}))
    assert result.rows_written == 12
    assert result.partition_by == ("area",)
    table = spark.table(result.table_name)
    assert set(table.columns) == set(result.columns)
    # '01' stays text.
    assert {r.area for r in table.select("area").distinct().collect()} == {"00", "01", "02"}
    assert {p.name for p in Path(spec.target_dir).glob("area=*")} == {"area=00", "area=01", "area=02"}


def test_overwrite_replaces_and_append_adds(spark, spec):
    """D1."""
    migrate_table(spark, spec)
    name = migrate_table(spark, replace(spec, mode="Overwrite")).table_name
    assert spark.table(name).count() == 12
    migrate_table(spark, replace(spec, mode="append"))
    assert spark.table(name).groupBy("id").count().where("count = 2").count() == 12


def test_swap_keeps_the_former_table_when_a_load_fails(spark, spec):
    swap = replace(spec, publish="swap")
    first = migrate_table(spark, swap)
    second = migrate_table(spark, swap)
    assert first.target_dir != second.target_dir
    assert spark.table(second.table_name).count() == 12
    assert Path(first.target_dir).exists()
    # An unreadable landed file ends the load in the middle of its write.
    (Path(spec.src_dir) / "merged" / "parquet" / "zz.parquet").write_bytes(b"PAR1 broken PAR1")
    with pytest.raises(Exception):
        migrate_table(spark, swap)
    assert spark.table(second.table_name).count() == 12
    for bad in ({"mode": "append"}, {"register": False}, {"publish": "later"}):
        with pytest.raises(ValueError):
            migrate_table(spark, replace(swap, **bad))


def test_active_only_is_pushed_to_the_scan(spark, spec):
    """D9."""
    assert prepare_table(spark, spec)[0].count() == 12
    df, _ = prepare_table(spark, replace(spec, active_only=True))
    assert df.count() == 9
    assert "PushedFilters: [IsNotNull(ziw_active), EqualTo(ziw_active,true)]" in explained(df)


def test_migration_is_one_narrow_stage_with_pruned_columns(spark, spec):
    plan = explained(prepare_table(spark, spec)[0])
    assert "Exchange" not in plan
    assert "ziw_row_id" not in plan.split("ReadSchema")[1]


def test_hot_partition_is_split_over_files(spark, tmp_path):
    """Most rows in one partition value: rebalancing must not write it in one task."""
    df = spark.range(0, 300_000, 1, 8).selectExpr(
        "id", "uuid() as pad", "if(id % 10 < 8, 'hot', cast(id % 10 as string)) as p"
    )
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "1MB")
    try:
        write_table(df, str(tmp_path / "t"), "overwrite", "parquet", ["p"], cluster="rebalance")
    finally:
        spark.conf.unset(setting)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "t").glob("p=*")}
    assert files["p=hot"] > 4
    assert files["p=8"] <= 2
    assert spark.read.parquet(str(tmp_path / "t")).count() == 300_000


def test_register_again_and_errors_propagate(spark, tmp_path):
    """D6."""
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "01"), (2, "02")], "id int, `p q` string")
    write_table(df, path, "overwrite", "parquet", ["p q"])
    for _ in range(2):
        register_table(spark, "test_lake", "odd_name", path, "parquet", df.schema.toDDL(), ["p q"])
    assert rows(spark.table("test_lake.odd_name")) == [(1, "01"), (2, "02")]
    with pytest.raises(Exception):
        register_table(spark, "test_lake", "bad", str(tmp_path / "none"), "parquet")


def test_merge_statement_needs_a_format_with_merge(spark, tmp_path):
    spec = MergeSpec(("id", "k 2"), "w")
    assert merge_statement("d.t", "v", spec) == (
        "MERGE INTO d.t t USING v s ON t.`id` = s.`id` AND t.`k 2` = s.`k 2` "
        "WHEN MATCHED AND (t.`w` IS NULL OR s.`w` >= t.`w`) THEN UPDATE SET * "
        "WHEN NOT MATCHED THEN INSERT *"
    )
    df = spark.createDataFrame([(1, 1, 1)], "id int, `k 2` int, w int")
    write_table(df, str(tmp_path / "t"), "overwrite", "parquet")
    register_table(spark, "test_lake", "no_merge", str(tmp_path / "t"), "parquet")
    views = len(spark.catalog.listTables())
    # The statement is understood; Parquet tables have no MERGE.
    with pytest.raises(UnsupportedOperationException, match="MERGE"):
        merge_into_table(spark, "test_lake.no_merge", df, spec)
    assert len(spark.catalog.listTables()) == views


def test_default_table_format(spark):
    assert default_table_format(spark) == "parquet"


def test_batch_reports_each_table(spark, spec, tmp_path):
    """D5."""
    columns = (
        "table_id string, table_name string, storage_format string, src_dir string, "
        "source_type string, partition_column string, override_columns string, "
        "hive_schema string, target_dir string"
    )
    normal = spec.partitions.to_json()
    plan = spark.createDataFrame(
        [
            (f"t{i}", f"b{i}", fmt, src, "rdbms", parts, "{}", "test_lake", str(tmp_path / f"b{i}"))
            for i, (fmt, src, parts) in enumerate(
                [
                    ("csv", spec.src_dir, normal),
                    ("parquet", str(tmp_path / "nowhere"), normal),
                    ("parquet", spec.src_dir, "not json"),
                    ("parquet", spec.src_dir, normal),
                    ("orc", spec.src_dir, normal),
                ]
            )
        ],
        columns,
    )
    results = {r.table_id: r for r in migrate_batch(spark, plan).collect()}
    assert [results[f"t{i}"].status for i in range(5)] == ["FAILED"] * 3 + ["SUCCEEDED"] * 2
    assert results["t3"].rows_written == results["t4"].rows_written == 12
    assert results["t0"].error and results["t3"].error is None
    assert spark.table("test_lake.b4").count() == 12


def test_partition_spec_json_round_trip():
    spec = PartitionSpec(("a", "b"), ("c",))
    assert PartitionSpec.from_json(spec.to_json()) == spec
    assert PartitionSpec.from_json('{"normal": [], "drop": []}').depth == 0


def columns_of(spark, name):
    return {c.name: c.dataType for c in spark.catalog.listColumns(name)}


@pytest.mark.parametrize("partition_by", [[], ["p"]])
def test_append_keeps_all_columns_and_refuses_other_types(spark, tmp_path, partition_by):
    path = str(tmp_path / "t")

    def load(ddl, values, mode):
        df = spark.createDataFrame([values], ddl)
        check_append(spark, "test_lake", f"append_{len(partition_by)}", df, partition_by)
        write_table(df, path, mode, "parquet", partition_by)
        written = [{"p": values[-1]}] if partition_by else []
        register_table(spark, "test_lake", f"append_{len(partition_by)}", path, "parquet", df.schema.toDDL(), partition_by, mode, written)

    name = f"test_lake.append_{len(partition_by)}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    load("id int, keep string, p string", (1, "k", "01"), "overwrite")
    load("id int, p string", (2, "02"), "append")
    load("id int, more double, p string", (3, 0.5, "01"), "append")
    assert rows(spark.table(name).select("id", "keep", "more", "p")) == [(1, "k", None, "01"), (2, None, None, "02"), (3, None, 0.5, "01")]
    for bad in ("id string, p string", "id int, keep int, p string"):
        with pytest.raises(ValueError):
            check_append(spark, "test_lake", f"append_{len(partition_by)}", spark.createDataFrame([], bad), partition_by)
    with pytest.raises(ValueError):
        check_append(spark, "test_lake", f"append_{len(partition_by)}", spark.createDataFrame([], "id int, q string"), ["q"])


def test_a_swap_never_drops_the_table(spark, tmp_path, monkeypatch):
    """Statements of a swap: locations change, written partitions come, others go; the table stays."""
    import lakeferry.sinks.tables as module

    name = "test_lake.swapped"
    spark.sql(f"DROP TABLE IF EXISTS {name}")

    def load(folder, data, written):
        df = spark.createDataFrame(data, "id int, p string")
        path = str(tmp_path / folder)
        write_table(df, path, "overwrite", "parquet", ["p"])
        register_table(spark, "test_lake", "swapped", path, "parquet", df.schema.toDDL(), ["p"], written=written)

    odd = "a/b='c' [%]"
    load("one", [(1, "x"), (2, "y"), (3, None), (4, odd)], None)
    assert rows(spark.table(name)) == rows(spark.createDataFrame([(1, "x"), (2, "y"), (3, None), (4, odd)], "id int, p string"))
    said = []
    sql = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: said.append(text) or sql(self, text, *a, **k))
    load("two", [(11, "x"), (13, None), (14, odd), (15, "new")], [{"p": v} for v in ("x", None, odd, "new")])
    assert not any(s.startswith(("DROP", "CREATE TABLE", "MSCK")) for s in said)
    assert sum("SET LOCATION" in s for s in said) == 1 + 3
    assert rows(spark.table(name)) == rows(spark.createDataFrame([(11, "x"), (13, None), (14, odd), (15, "new")], "id int, p string"))
    # Registered again without a list of what was written: the folder is listed.
    load("three", [(21, "z")], None)
    assert rows(spark.table(name)) == [(21, "z")]
    assert module.registered(spark, "test_lake", "swapped").location.endswith("three")


def test_an_overwrite_may_lose_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    for ddl, values in (("id int, extra string", (1, "e")), ("id int", (2,)), ("id string", ("3",))):
        df = spark.createDataFrame([values], ddl)
        write_table(df, path, "overwrite", "parquet")
        register_table(spark, "test_lake", "narrowed", path, "parquet", df.schema.toDDL())
        assert rows(spark.table("test_lake.narrowed")) == [values]


def test_a_partitioned_write_is_clustered_by_default(spark, spec):
    from lakeferry.plans.migrate import clustering

    assert clustering(spec, ["region"]) == "rebalance" and clustering(spec, []) == "none"
    assert clustering(replace(spec, cluster="none"), ["region"]) == "none"
    migrate_table(spark, spec)
    assert {len(list(d.glob("*.parquet"))) for d in Path(spec.target_dir).glob("region=*")} == {1}


def test_a_batch_goes_on_where_it_was_broken_off(spark, spec, tmp_path, monkeypatch):
    import lakeferry.plans.migrate as module

    columns = (
        "table_id string, table_name string, storage_format string, src_dir string, "
        "source_type string, partition_column string, override_columns string, "
        "hive_schema string, target_dir string"
    )
    row = lambda i, src: (f"t{i}", f"r{i}", "parquet", src, "rdbms", spec.partitions.to_json(), "{}", "test_lake", str(tmp_path / f"r{i}"))
    plan = spark.createDataFrame([row(i, spec.src_dir if i != 2 else str(tmp_path / "later")) for i in range(6)], columns).coalesce(1)
    log, done = str(tmp_path / "log"), []
    migrate = module.migrate_table

    def broken(spark_, one):
        if len(done) >= 3:
            raise KeyboardInterrupt
        done.append(one.table)
        return migrate(spark_, one)

    monkeypatch.setattr(module, "migrate_table", broken)
    with pytest.raises(KeyboardInterrupt):
        migrate_batch(spark, plan, concurrency=1, log=log)
    assert done == ["r0", "r1", "r2"]
    assert {(r.table_id, r.status) for r in module.outcomes(spark, log).collect()} == {("t0", "SUCCEEDED"), ("t1", "SUCCEEDED"), ("t2", "FAILED")}
    # The missing tree has landed meanwhile.
    spark.read.parquet(str(Path(spec.src_dir) / "merged" / "parquet")).write.parquet(str(tmp_path / "later" / "merged" / "parquet"))
    again = []
    monkeypatch.setattr(module, "migrate_table", lambda s, one: again.append(one.table) or migrate(s, one))
    results = migrate_batch(spark, plan, concurrency=2, log=log)
    assert sorted(again) == ["r2", "r3", "r4", "r5"]
    assert {(r.table_id, r.status, r.rows_written) for r in results.collect()} == {(f"t{i}", "SUCCEEDED", 12) for i in range(6)}
    assert migrate_batch(spark, plan, log=log).count() == 6 and len(again) == 4
