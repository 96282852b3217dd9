"""Every query of the catalog against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from catalog import QUERIES, SQL
from tests.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    problem, rows, _ = compare(spark, con, SF_DIR, QUERIES[name], SQL[name])
    assert problem is None
    assert rows > 0


def test_every_query_has_an_expected_result():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
