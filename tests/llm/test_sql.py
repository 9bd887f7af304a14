"""Queries that SQL can express, next to their SQL."""

import pytest

from checks.compare import connect, difference
from tallystar.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf, name):
    assert difference(spark, connect(sf), name, sf, QUERIES, ORACLE) is None
