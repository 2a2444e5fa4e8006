"""Registered queries with SQL against it, on the smallest data."""

import os

import pytest

from compare import connect, difference
from stmtscope.llm.queries import oracle_sql, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
@pytest.mark.parametrize("name", list(oracle_sql()))
def test_sql(spark, name):
    assert difference(queries()[name](spark, SF_DIR), connect(SF_DIR), oracle_sql()[name]) is None
