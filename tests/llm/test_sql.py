"""Queries that SQL can express against it, on given tables."""

import pytest

import compare
from spendloom.llm import queries


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name, sf):
    folder = f"/root/testdata/{sf}"
    df = queries.queries()[name](spark, folder)
    assert compare.difference(df, compare.duck(folder), queries.oracle_sql()[name]) is None


def test_a_query_for_each_operator():
    numbers = {int(name[2:].split("_")[0]) for name in queries.queries()}
    assert numbers == set(range(1, 14)) and set(queries.oracle_sql()) <= set(queries.queries())
