"""Every query that has SQL against it, and how the queries are registered."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from oracle_check import connect, differences  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from lexitally.llm import oracle, queries  # noqa: E402


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())
    assert set(oracle.SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", oracle.SQL)
def test_sql(spark, con, sf, name):
    assert differences(spark, con, sf, name) == []
