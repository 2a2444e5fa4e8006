"""Every registered query against its SQL, on the smallest data."""

import os

import pytest

import __spark_entry__ as contract
from compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(contract.trace_queries()) == set(contract.trace_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@needs_data
@pytest.mark.parametrize("name", list(contract.trace_queries()))
def test_query(spark, con, name):
    result = contract.queries()[name](spark, SF_DIR)
    assert difference(result, con, contract.oracle_sql()[name]) is None
    assert result.count() > 0


@needs_data
def test_entry(spark):
    assert contract.entry(spark).count() > 0
