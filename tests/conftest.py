from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from lakeferry.session import build_session, checkpoint_root  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.driver.memory": "4g",
            # Long chains of predicates are analysed recursively, deepest while code is interpreted.
            "spark.driver.extraJavaOptions": "-Xss8m",
            "spark.ui.showConsoleProgress": "false",
            # Spark's own default, harder than the recommended setting.
            "spark.sql.unionOutputPartitioning": "true",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    checkpoint_root(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
