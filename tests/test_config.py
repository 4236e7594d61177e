from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lakeferry.operators import config
from lakeferry.operators.config import bind_clusters, config_documents, convert_groups, convert_sources, convert_tables
from lakeferry.sources.documents import (
    envelope_exports,
    envelope_groups,
    envelope_sources,
    envelope_tables,
    read_documents,
    read_envelopes,
    write_documents,
)

DERIVED = {
    "partition_key_column": "c",
    "partition_key_extract_from_col": True,
    "partition_key_derive_function": "year-month",
    "partition_key_derive_column": "c_ym",
}


def envelope(tables, source_type="rdbms", subtype="netezza", groups=()):
    return {
        "entity": {"entity_type": "source"},
        "source": {"hive_schema": "h", "sourceType": source_type, "sourceSubtype": subtype},
        "tables": [
            {
                "entity_type": "table",
                "entity_id": {"$type": "oid", "$value": f"t{i}"},
                "configuration": {
                    "table": f"tbl{i}",
                    "ingestion_configuration": {"sync_type": "full-load", "hive_table_name": "x", **t},
                },
            }
            for i, t in enumerate(tables)
        ],
        "table_groups": [
            {
                "entity_type": "table_group",
                "entity_id": {"$type": "oid", "$value": f"g{i}"},
                "configuration": g,
            }
            for i, g in enumerate(groups)
        ],
        "export": {"exportedAt": {"$date": 1700000000123}, "exportedBy": "admin"},
    }


@pytest.fixture
def load(spark, tmp_path):
    def load(*documents):
        for i, document in enumerate(documents):
            (tmp_path / f"e{i}.json").write_text(json.dumps(document, indent=2))
        return read_envelopes(spark, str(tmp_path))

    return load


def convert(load, *tables, **source):
    configs, rejected = convert_tables(envelope_tables(load(envelope(tables, **source))))
    return (
        {r.table_id: r for r in configs.collect()},
        {r.table_id: r.reason for r in rejected.collect()},
    )


def test_full_load_defaults(load):
    configs, rejected = convert(load, {}, {"is_scd2_table": True, "natural_key": ["a", "b"]})
    assert not rejected
    row = configs["t0"]
    assert (row.sync_type, row.storage_format, row.natural_keys) == ("full-load", "read", [])
    assert (row.is_scd2_table, row.update_strategy, row.watermark_column) == (False, None, None)
    assert row.read_supported_engines == row.write_supported_engines == ["SPARK"]
    assert (row.target_schema_name, row.target_table_name) == ("h", "x")
    assert (row.partition_keys, row.split_by_key) == ([], None)
    assert (configs["t1"].is_scd2_table, configs["t1"].natural_keys) == (True, ["a", "b"])


def test_watermark_choice(load):
    batch, stamp = {"batch_id_cdc_column": "b"}, {"timestamp_column_update": "t"}
    sync = {"sync_type": "cdc-batch-id"}
    configs, _ = convert(
        load,
        {**sync, **batch, **stamp},
        {**sync, **stamp},
        {**sync, **stamp, "batch_id_cdc_column": ""},
        {**sync},
        {**batch},
    )
    assert [configs[f"t{i}"].watermark_column for i in range(5)] == ["b", "t", "t", None, None]
    assert [configs[f"t{i}"].sync_type for i in range(4)] == ["incremental"] * 4
    assert configs["t0"].update_strategy == "merge"


def test_sfdc(load):
    fields = {"fetch_mechanism": "rest", "pk_chunking_enabled": True}
    configs, _ = convert(
        load,
        fields,
        {**fields, "sync_type": "cdc-timestamp-column", "timestamp_column_update": "t"},
        source_type="crm",
        subtype="Salesforce",
    )
    for row in configs.values():
        assert row.watermark_column == "SystemModstamp"
        assert (row.fetch_mechanism, row.enable_pk_chunk) == ("rest", True)
        assert row.exclude_legacy_audit_columns is None


@pytest.mark.parametrize(
    "subtype, expected",
    [
        ("teradata", (None, "bulk", False, True)),
        ("oracle", (None, "bulk", None, True)),
        ("sqlserver", (False, None, None, None)),
        ("netezza", (None, None, None, None)),
        (None, (None, None, None, None)),
    ],
)
def test_subtype_rules(load, subtype, expected):
    configs, _ = convert(load, {"sync_type": "cdc-batch-id"}, {}, subtype=subtype)
    fields = ("use_capture_table", "fetch_mechanism", "use_jdbc", "exclude_legacy_audit_columns")
    assert tuple(configs["t0"][f] for f in fields) == expected
    assert configs["t1"].use_capture_table is None


def test_partition_keys(load):
    plain = {"partition_key_column": "p", "partition_key_extract_from_col": False}
    regex = {**DERIVED, "partition_key_derive_function": "regex"}
    configs, _ = convert(load, {"partition_key": [plain, regex, DERIVED]}, {"partition_key": None})
    first, second = configs["t0"].partition_keys
    assert tuple(first) == (None, None, None, False, "p")
    assert tuple(second) == ("c", "year month", "yyyyMM", True, "c_ym")
    assert configs["t1"].partition_keys == []


def test_split_keys(load):
    derived = {
        "split_by_key": "c",
        "split_by_key_extract_from_col": True,
        "split_by_key_derive_function": "month-day",
        "split_by_key_derive_column": "c_md",
    }
    configs, _ = convert(load, derived, {"split_by_key": "c"}, {"split_by_key": ""})
    assert tuple(configs["t0"].split_by_key) == ("c", "month day", "MMdd", True, "c_md")
    assert tuple(configs["t1"].split_by_key) == (None, None, None, False, "c")
    assert configs["t2"].split_by_key is None


def test_rejections_do_not_stop_the_others(load):
    bad_split = {"split_by_key_extract_from_col": True, "split_by_key_derive_function": "week"}
    configs, rejected = convert(
        load,
        {"sync_type": "query-based"},
        {"sync_type": None},
        {"partition_key": [{**DERIVED, "partition_key_derive_function": "week"}]},
        {"partition_key": [{**DERIVED, "partition_key_derive_function": None}]},
        bad_split,
        {},
    )
    assert configs.keys() == {"t5"}
    assert rejected == {
        "t0": "unsupported sync type: query-based",
        "t1": "unsupported sync type: none",
        "t2": "unknown partition derive function",
        "t3": "unknown partition derive function",
        "t4": "unknown split derive function",
    }


def test_groups(load):
    group = {
        "name": "g",
        "max_connections": 5,
        "tables": [{"table_id": {"$type": "oid", "$value": "t"}, "connection_quota": 100}],
        "source": {"$type": "oid", "$value": "s"},
    }
    loaded = load(envelope([], groups=[group, {}]), envelope([], "sfdc", "x", groups=[group]))
    converted = convert_groups(envelope_groups(loaded), "c1").orderBy("job_name", "group_id")
    plain, empty, sfdc = converted.collect()
    assert (plain["name"], plain.max_connections, plain.max_parallel_entities) == ("g", 5, 1)
    assert (plain.cluster_id, plain.source, plain.job_name) == ("c1", "s", None)
    assert [tuple(t) for t in plain.tables] == [("t", 100)]
    assert (empty["name"], empty.max_connections) == ("tg1", 1)
    assert (sfdc.job_name, sfdc.is_table_group_job) == ("g", True)


def test_export_stamp(load):
    (row,) = envelope_exports(load(envelope([{}]))).withColumn(
        "exported_at", F.col("exported_at").cast("string")
    ).collect()
    assert tuple(row) == ("h", "2023-11-14 22:13:20.123", "admin")


def test_strict_overlay(load):
    rdbms = ("driver_name", "schema", "database", "connection_method", "connection_string", "username")
    sfdc = ("fileType", "api_version", "connection_string", "environment", "fetch_mechanism", "username")
    documents = []
    for kind, subtype, fields in [
        ("RDBMS", "oracle", rdbms),
        ("rdbms", "oracle", rdbms[1:-1]),
        ("crm", "salesforce", sfdc),
        ("crm", "salesforce", sfdc[2:]),
        ("file", "csv", rdbms),
    ]:
        document = envelope([], kind, subtype)
        document["source"]["connection"] = {f: "x" for f in fields} | {"password": "p"}
        document["source"]["hive_schema"] = f"h{len(documents)}"
        documents.append(document)
    complete, incomplete = convert_sources(envelope_sources(load(*documents)))
    assert sorted(r.hive_schema for r in complete.collect()) == ["h0", "h2"]
    assert {(r.hive_schema, r.missing) for r in incomplete.collect()} == {
        ("h1", "driver_name,username"),
        ("h3", "fileType,api_version"),
        ("h4", "supported source type"),
    }
    assert "password" not in complete.columns


def test_unknown_source_types_are_rejected(load):
    _, rejected = convert(load, {}, source_type="file")
    assert rejected == {"t0": "unsupported source type: file"}


def test_clusters_by_name(spark):
    groups = spark.createDataFrame([(f"g{i}", f"n{i}", name) for i, name in enumerate(["a", "b", "a", "c", None])], "group_id string, name string, cluster_name string")
    templates = spark.createDataFrame([("a", "2"), ("a", "1"), ("b", "7"), (None, "9")], "cluster_name string, cluster_id string")
    bound, missed = bind_clusters(groups, templates)
    assert sorted((r.group_id, r.cluster_id) for r in bound.collect()) == [("g0", "1"), ("g1", "7"), ("g2", "1")]
    assert sorted((r.group_id, r.reason) for r in missed.collect()) == [
        ("g3", "unknown cluster template: c"), ("g4", "unknown cluster template: none"),
    ]


@pytest.mark.parametrize("size", [3, 1_000])
def test_documents_come_in_pieces_and_read_back(spark, load, tmp_path, size, monkeypatch):
    monkeypatch.setattr(config, "PIECES_PER_TASK", 2)  # numbered in several parts
    group = {"name": "g", "max_connections": 3, "source": {"$type": "oid", "$value": "s"}, "tables": [{"table_id": {"$type": "oid", "$value": "t0"}, "connection_quota": 50}]}
    connection = {c: "v" for c in ("driver_name", "schema", "database", "connection_method", "connection_string", "username")}
    big = envelope([{"partition_key": [DERIVED]}] * 20, groups=[group] * 5)
    alone = envelope([])
    for e, name in ((big, "h"), (alone, "lonely")):
        e["source"] |= {"hive_schema": name, "connection": connection}
    envelopes = load(big, alone)
    sources, _ = convert_sources(envelope_sources(envelopes))
    configs, _ = convert_tables(envelope_tables(envelopes))
    groups = convert_groups(envelope_groups(envelopes), "c1", carried=["hive_schema"])
    documents = config_documents(sources, configs, groups, size)
    write_documents(documents, str(tmp_path / "out"))
    fields = [f.name for f in documents.schema["source"].dataType["connection"].dataType.fields]
    read = read_documents(spark, str(tmp_path / "out"), fields)
    key = lambda r: json.dumps(r.asDict(recursive=True), sort_keys=True)
    assert sorted(map(key, read.collect())) == sorted(map(key, documents.select(*read.columns).collect()))
    sizes = [(r.source.hive_schema, len(r.tables), len(r.table_groups)) for r in read.collect()]
    assert max(t + g for _, t, g in sizes) <= size and ("lonely", 0, 0) in sizes and len({s for s in sizes if s[0] == "lonely"}) == 1
    ids = sorted(t.entity_id["$value"] for r in read.collect() for t in r.tables)
    assert ids == sorted(f"t{i}" for i in range(20))
    first = next(r for r in read.collect() if r.table_groups)
    assert first.table_groups[0].configuration.cluster_template.cluster_id == "c1"
    assert first.table_groups[0].configuration.tables[0].connection_quota == 50
    table = next(r for r in read.collect() if r.tables).tables[0].configuration
    assert table.configuration.partition_keys[0].derive_format == "yyyyMM" and table.configuration.target_schema_name == "h"


def test_an_array_of_pieces_is_one_for_a_small_source(spark, load):
    sources = envelope([{}] * 4)
    sources["source"] |= {"hive_schema": "h", "connection": {c: "v" for c in ("driver_name", "schema", "database", "connection_method", "connection_string", "username")}}
    envelopes = load(sources)
    done = config_documents(
        convert_sources(envelope_sources(envelopes))[0], convert_tables(envelope_tables(envelopes))[0],
        convert_groups(envelope_groups(envelopes), "c", carried=["hive_schema"]),
    )
    assert [len(r.tables) for r in done.collect()] == [4]
