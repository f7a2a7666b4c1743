"""Every registered query against its SQL."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as spark_entry  # noqa: E402
from oracle import compare, connect  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


# Queries that SQL cannot express are compared with brute force where their operators are tested.
@pytest.mark.parametrize("name", sorted(spark_entry.oracle_sql()))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(con, spark_entry.queries()[name](spark, SF_DIR), spark_entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert spark_entry.entry(spark).limit(1).count() == 1
