"""Every registered query against its SQL."""

from __future__ import annotations

import pytest
from check import compare, connect
from helpers import explained

from lakeferry.workload import all_oracles, all_queries

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    plan = explained(df)
    for forbidden in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoop"):
        assert forbidden not in plan
    assert compare(df, duck, ORACLES[name]) is None


def test_entry(spark):
    import __spark_entry__ as entry_module

    assert entry_module.entry(spark).count() > 0
