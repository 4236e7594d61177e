from __future__ import annotations

import datetime as dt

import pytest
from helpers import explained, rows
from pyspark.sql import functions as F

from lakeferry.functions.columns import (
    PARTITION_KEYS,
    compose_renames,
    map_last_wins,
    partition_spec,
    rename_map,
    to_boolean,
)
from lakeferry.functions.dates import (
    DERIVE_FORMATS,
    add_derived_partitions,
    derive_format,
    derived_value,
    where_parent_between,
)
from lakeferry.functions.documents import millis_date, typed_id
from lakeferry.operators.catalog import grant
from lakeferry.sinks.tables import write_table


def one(spark, column, text, kind):
    df = spark.createDataFrame([(text,)], f"v {kind}")
    return df.select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "word, value",
    [
        *[(w, True) for w in ("true", "T", "yes", "y", "1", "TRUE ")],
        *[(w, False) for w in ("false", "F", "no", "n", "0")],
        *[(w, None) for w in ("2", "", "on", None)],
    ],
)
def test_boolean_words(spark, word, value):
    assert one(spark, to_boolean, word, "string") is value


def test_boolean_numbers(spark):
    assert one(spark, to_boolean, 1, "int") is True
    assert one(spark, to_boolean, 0, "int") is False


COLUMNS = "array<struct<origName:string,name:string>>"


def test_rename_map_keeps_changed_names_only(spark):
    assert one(spark, rename_map, [("a", "a"), ("b", "c")], COLUMNS) == {"b": "c"}
    assert one(spark, rename_map, [("A", "a")], COLUMNS) == {"A": "a"}
    assert one(spark, rename_map, [], COLUMNS) == {}
    assert one(spark, rename_map, None, COLUMNS) == {}


def test_repeated_column_takes_its_last_name(spark):
    assert one(spark, rename_map, [("a", "x"), ("a", "y"), ("b", "z")], COLUMNS) == {
        "a": "y",
        "b": "z",
    }


def test_map_last_wins_of_null_is_empty(spark):
    assert one(spark, map_last_wins, None, "array<struct<key:string,value:string>>") == {}


def test_compose_renames_three_cases(spark):
    df = spark.createDataFrame(
        [({"c3": "c3_new", "c2": "c2_new"}, {"c1": "c1_t", "c3": "c3_t"})],
        "onprem map<string,string>, target map<string,string>",
    )
    composed = df.select(compose_renames(F.col("onprem"), F.col("target"))).first()[0]
    assert composed == {"c1": "c1_t", "c3_new": "c3_t"}


def test_compose_renames_that_meet_keep_the_last(spark):
    df = spark.createDataFrame(
        [({"a": "b"}, {"a": "x", "b": "y"})],
        "onprem map<string,string>, target map<string,string>",
    )
    assert df.select(compose_renames(F.col("onprem"), F.col("target"))).first()[0] == {"b": "y"}


def test_partition_spec_keeps_order(spark):
    keys = [
        ("p1", False, None, None),
        ("d", True, "year", "d_y"),
        ("s", True, "regex", "s_rx"),
        ("p2", None, None, None),
        ("u", True, None, "u_x"),
    ]
    spec = one(spark, partition_spec, keys, PARTITION_KEYS)
    assert spec.normal == ["p1", "d_y", "p2", "u_x"]
    assert spec["drop"] == ["s_rx"]
    empty = one(spark, partition_spec, None, PARTITION_KEYS)
    assert (empty.normal, empty["drop"]) == ([], [])


def test_partition_spec_json(spark):
    json = lambda c: F.to_json(partition_spec(c))
    assert one(spark, json, [], PARTITION_KEYS) == '{"normal":[],"drop":[]}'


@pytest.mark.parametrize("function, fmt", DERIVE_FORMATS.items())
def test_derive_formats(spark, function, fmt):
    assert one(spark, derive_format, function, "string") == fmt
    assert one(spark, derive_format, " " + function.replace(" ", "-") + " ", "string") == fmt


def test_unknown_derive_function(spark):
    assert one(spark, derive_format, "week", "string") is None
    assert one(spark, derive_format, None, "string") is None


def test_derived_values(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2021, 3, 7, 23, 59),), (None,)], "t timestamp_ntz"
    )
    formats = list(DERIVE_FORMATS.values())
    derived = add_derived_partitions(df, [("t", f, f"p_{f}") for f in formats])
    values = {r["t"]: r for r in derived.collect()}
    assert [values[None][f"p_{f}"] for f in formats] == [None] * 6
    got = [values[dt.datetime(2021, 3, 7, 23, 59)][f"p_{f}"] for f in formats]
    assert got == ["07", "03", "2021", "202103", "0307", "20210307"]
    with pytest.raises(ValueError):
        derived_value(df, "t", "ww")


def test_derived_value_in_a_daylight_saving_gap(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        df = spark.createDataFrame([(dt.datetime(2017, 10, 15, 0, 30),)], "t timestamp_ntz")
        assert df.select(derived_value(df, "t", "yyyyMMdd")).first()[0] == "20171015"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("fmt, prunes", [("yyyyMM", True), ("yyyy", True), ("MM", False)])
def test_parent_range_prunes_ordered_patterns_only(spark, tmp_path, fmt, prunes):
    days = spark.range(0, 800).selectExpr(
        "timestamp_ntz'2019-01-15 12:00:00' + make_dt_interval(cast(id as int)) as t", "id"
    )
    write_table(
        add_derived_partitions(days, [("t", fmt, "p")]), str(tmp_path / "t"), "overwrite",
        "parquet", ["p"], cluster="rebalance",
    )
    stored = spark.read.schema("t timestamp_ntz, id bigint, p string").parquet(str(tmp_path / "t"))
    lo, hi = dt.datetime(2019, 12, 20), dt.datetime(2020, 2, 10, 12)
    found = where_parent_between(stored, ("t", fmt, "p"), lo, hi)
    expected = days.where(
        "t between timestamp_ntz'2019-12-20' and timestamp_ntz'2020-02-10 12:00:00'"
    )
    assert rows(found.select("id")) == rows(expected.select("id"))
    assert ("PartitionFilters: [isnotnull(p" in explained(found)) is prunes
    assert "PushedFilters: [IsNotNull(t), GreaterThanOrEqual(t" in explained(found)


def test_extended_json(spark, tmp_path):
    (tmp_path / "d.json").write_text(
        '{"entity_id": {"$type": "oid", "$value": "abc"}, "at": {"$date": 1700000000123}}'
    )
    df = spark.read.schema(
        "entity_id struct<`$type`:string,`$value`:string>, at struct<`$date`:bigint>"
    ).json(str(tmp_path / "d.json"))
    row = df.select(typed_id(F.col("entity_id")), millis_date(F.col("at")).cast("string")).first()
    assert tuple(row) == ("abc", "2023-11-14 22:13:20.123")


def test_grant_is_idempotent(spark):
    df = spark.createDataFrame([(["a"],), (None,)], "l array<string>")
    granted = df.select(grant(grant(F.col("l"), F.lit("b")), F.lit("b")).alias("l"))
    assert [r.l for r in granted.collect()] == [["a", "b"], ["b"]]


def test_thousands_of_renames_in_one_document(spark):
    """Time grows about as the number of renames does."""
    import time

    def seconds(n):
        entries = [(f"o{i % (n - 10)}", f"n{i}") for i in range(n)]
        doc = spark.createDataFrame([(entries,)], "columns array<struct<origName:string,name:string>>")
        first, other = rename_map(F.col("columns")), F.transform_keys(rename_map(F.col("columns")), lambda k, v: F.concat(k, F.lit("")))
        start = time.perf_counter()
        found, composed = doc.select(first, compose_renames(first, other)).first()
        spent = time.perf_counter() - start
        assert len(found) == n - 10 and found["o3"] == f"n{n - 10 + 3}" and found["o11"] == "n11"
        assert composed == {found[k]: v for k, v in found.items()}
        return spent

    seconds(2_000)  # code is compiled
    small, large = min(seconds(2_000) for _ in range(2)), min(seconds(16_000) for _ in range(2))
    assert large < 40 * small  # a quadratic fold takes 64 times as long, and much longer at all


def test_composing_takes_the_last_of_equal_new_names(spark):
    maps = spark.sql("select map('a', 'x', 'b', 'y') as onprem, map('x', '1', 'a', '2', 'c', '3') as target")
    assert maps.select(compose_renames(F.col("onprem"), F.col("target"))).first()[0] == {"x": "2", "c": "3"}
    empty = spark.sql("select cast(map() as map<string,string>) as e, map('a', '1') as t, cast(null as map<string,string>) as n")
    assert empty.select(compose_renames(F.col("e"), F.col("t"))).first()[0] == {"a": "1"}
    assert empty.select(compose_renames(F.col("n"), F.col("t")), compose_renames(F.col("t"), F.col("n"))).first()[1] == {}
