"""Queries and their SQL side by side; every query is registered."""

import pytest
from checks.compare import connect, difference

from augury.llm import oracles, queries

from .conftest import SMALL


@pytest.mark.parametrize("name", sorted(oracles.oracles()))
def test_query_equals_its_sql(spark, name):
    assert difference(spark, connect(SMALL), SMALL, queries.registry()[name], oracles.oracles()[name]) is None


def test_all_queries_are_registered():
    assert [n.split("_")[0] for n in queries.registry()] == [f"op{i}" for i in range(1, 14)]
    assert set(oracles.oracles()) <= set(queries.registry())
