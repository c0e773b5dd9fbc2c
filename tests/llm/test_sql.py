"""Queries that SQL can state, against that SQL."""

import pytest

from hazardmarts.llm import queries
from tests.oracle import compare, connect


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, name, sf):
    folder = f"/root/testdata/{sf}"
    problem, rows = compare(spark, connect(folder), queries.QUERIES[name], queries.SQL[name], folder)
    assert problem is None and rows > 0


def test_each_operator_has_a_query():
    assert [sum(q.startswith(f"op{n}_") for q in queries.QUERIES) for n in range(1, 14)] == [1] * 13
