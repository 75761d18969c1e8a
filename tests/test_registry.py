"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as registry
from checks.compare import differences, duckdb_views
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
# At this scale no row qualifies.
EMPTY_HERE = {"most_unusual_incomes"}


@pytest.fixture(scope="module")
def duck():
    return duckdb_views(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    query, sql = registry.queries()[name], registry.oracle_sql().get(name)
    problem = differences(spark, duck, name, query, sql, SF)
    assert not problem or (problem == "both empty" and name in EMPTY_HERE)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES) <= set(registry.queries())


def test_entry(spark):
    assert registry.entry(spark).count() > 0
