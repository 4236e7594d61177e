"""Split predicates; the read itself needs a database and is not run here."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeferry.sources import jdbc
from lakeferry.sources.jdbc import PeriodSplit, RangeSplit, period_predicates, read_jdbc_split


@pytest.mark.parametrize("fmt", ["yyyy", "yyyyMM", "yyyyMMdd", "MM", "dd", "MMdd"])
def test_predicates_take_every_row_once(spark, fmt):
    days = spark.range(0, 1200).selectExpr(
        "if(id = 7, null, timestamp_ntz'2019-06-01 13:30:00' + make_dt_interval(cast(id as int))) as t"
    )
    split = PeriodSplit("t", fmt, dt.date(2020, 2, 10), dt.date(2020, 4, 2))
    met = [F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in period_predicates(split)]
    hits = sum(met[1:], met[0])
    assert days.where(hits != 1).count() == 0


@pytest.mark.parametrize("fmt, parts", [("yyyy", 3), ("yyyyMM", 5), ("yyyyMMdd", 55), ("MM", 13), ("dd", 32), ("MMdd", 367)])
def test_number_of_predicates(fmt, parts):
    split = PeriodSplit("t", fmt, dt.date(2020, 2, 10), dt.date(2020, 4, 2))
    assert len(period_predicates(split)) == parts


def test_bad_splits():
    with pytest.raises(ValueError):
        period_predicates(PeriodSplit("t", "ww", dt.date(2020, 1, 1), dt.date(2020, 1, 2)))
    with pytest.raises(ValueError):
        period_predicates(PeriodSplit("t", "yyyy", dt.date(2020, 1, 2), dt.date(2020, 1, 1)))


class Reader:
    """Records what a read would be asked for."""

    def __init__(self):
        self.read = self
        self.asked = {}

    def format(self, name):
        self.asked["format"] = name
        return self

    def options(self, **options):
        self.asked.update(options)
        return self

    def option(self, key, value):
        self.asked[key] = value
        return self

    def load(self):
        return self.asked

    def jdbc(self, url, table, predicates, properties):
        return {"url": url, "table": table, "predicates": predicates, "properties": properties}


def test_read_requests():
    options = {"url": "jdbc:x", "dbtable": "t", "driver": "d"}
    asked = read_jdbc_split(Reader(), options, RangeSplit("id", "0", "100", 4))
    assert asked == {
        "format": "jdbc", **options, "partitionColumn": "id", "lowerBound": "0",
        "upperBound": "100", "numPartitions": 4,
    }
    split = PeriodSplit("d", "yyyy", dt.date(2020, 1, 1), dt.date(2020, 1, 1))
    asked = read_jdbc_split(Reader(), options, split)
    assert (asked["url"], asked["table"], asked["properties"]) == ("jdbc:x", "t", {"driver": "d"})
    assert asked["predicates"] == jdbc.period_predicates(split)


def test_sql_server_has_its_own_words():
    month = PeriodSplit("d", "MM", dt.date(2020, 1, 1), dt.date(2020, 1, 1))
    day = PeriodSplit("d", "MMdd", dt.date(2020, 1, 1), dt.date(2020, 1, 1))
    year = PeriodSplit("d", "yyyy", dt.date(2020, 1, 1), dt.date(2020, 1, 1))
    assert period_predicates(month, jdbc.SQL_SERVER)[0] == "MONTH(d) = 1"
    assert period_predicates(day, jdbc.SQL_SERVER)[0] == "MONTH(d) = 1 AND DAY(d) = 1"
    assert period_predicates(year, jdbc.SQL_SERVER) == [
        "d < CAST('2020-01-01T00:00:00' AS datetime2) OR d IS NULL",
        "d >= CAST('2020-01-01T00:00:00' AS datetime2) AND d < CAST('2021-01-01T00:00:00' AS datetime2)",
        "d >= CAST('2021-01-01T00:00:00' AS datetime2)",
    ]
    asked = read_jdbc_split(Reader(), {"url": "jdbc:sqlserver://h", "dbtable": "t"}, year)
    assert asked["predicates"] == period_predicates(year, jdbc.SQL_SERVER)
    assert "EXTRACT" in read_jdbc_split(Reader(), {"url": "jdbc:oracle:x", "dbtable": "t"}, month)["predicates"][0]


@pytest.mark.parametrize("kind", ["bigint", "double", "date", "timestamp_ntz"])
def test_quantile_bounds_are_even_on_a_skewed_key(spark, kind):
    value = {
        "bigint": "cast(pow(id, 3) as bigint)", "double": "pow(1.01, id % 1500)", "date": "date'2000-01-01' + cast(sqrt(id) as int)",
        "timestamp_ntz": "timestamp_ntz'2000-01-01' + make_dt_interval(0, 0, 0, cast(sqrt(id) * 1000 as decimal(18,6)))",
    }[kind]
    df = spark.range(0, 6_000).selectExpr(f"if(id % 400 = 0, null, {value}) as c")
    split = jdbc.quantile_bounds(df, "c", 10)
    met = [F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in jdbc.bound_predicates(split)]
    assert len(met) == 10 and df.where(sum(met[1:], met[0]) != 1).count() == 0
    sizes = df.select(*[F.sum(m) for m in met]).first()
    assert max(sizes) <= 2 * 600


def test_bounds_of_few_or_no_values(spark):
    df = spark.createDataFrame([(5,), (5,), (None,)], "c int")
    assert jdbc.quantile_bounds(df, "c", 4) == jdbc.BoundSplit("c", ("5",))
    assert jdbc.bound_predicates(jdbc.quantile_bounds(df.limit(0), "c", 4)) == ["1 = 1"]
    assert jdbc.quantile_bounds(df, "c", 1).bounds == ()
