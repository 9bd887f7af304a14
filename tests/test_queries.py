"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as contract
from checks.compare import connect, difference
from checks.oracle import ORACLE
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf, name):
    assert difference(spark, duck, name, sf) is None


def test_registries_match():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql())


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns == [
        "company_id", "company_name", "branch_id", "branch_name", "events", "watch_time",
        "grouping_level", "avg_watch_time",
    ]
    assert rows.count() > 0
