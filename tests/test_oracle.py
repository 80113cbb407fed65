"""Every query against its SQL."""

import pytest
from oracle_check import connect, differences

import __spark_entry__ as entry
from lexitally import oracle, queries


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_sql():
    assert set(queries.QUERIES) == set(oracle.SQL)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query(spark, con, sf, name):
    assert differences(spark, con, sf, name) == []


def test_entry(spark):
    assert [r.which for r in entry.entry(spark).collect()] == ["MIN", "MAX"]
