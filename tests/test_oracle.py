"""Every registered plan equals its reference SQL (DuckDB) at sf0.001."""

import os

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck_connection

from tapflow.plans.registry import all_oracle_sql, all_queries

QUERIES = all_queries()
SQL = all_oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_SMALL)


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="test data missing")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_reference(spark, duck, name):
    ok, n, _, detail = compare(spark, duck, name, QUERIES[name], SQL[name], SF_SMALL)
    assert ok, detail


def test_entry_flagship(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns[:3] == ["trip_id", "card_id", "bus_id"]
    assert df.count() == 176   # FIXTURES.md §3
