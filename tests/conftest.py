from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from statledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "statledger-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def workdir():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def evaluate(spark):
    """Apply a column function to literal argument rows and return the values."""

    def run(function, rows):
        rows = [row if isinstance(row, tuple) else (row,) for row in rows]
        names = [f"a{i}" for i in range(len(rows[0]))]
        schema = "n int, " + ", ".join(f"{name} string" for name in names)
        df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], schema)
        out = df.select("n", function(*names).alias("v")).orderBy("n").collect()
        return [row.v for row in out]

    return run
