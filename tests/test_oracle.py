"""Every registered query against its SQL, row by row, and against its declared types."""

import os

import pytest

import __spark_entry__ as entry
import compare

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = entry.oracle_sql()
# The operations for training data have their own tests.
OWN = {"pipeline", *(entry.training_data.queries() if entry.training_data else ())}
QUERIES = {name: query for name, query in entry.queries().items() if name not in OWN}
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    return compare.duck(SF_DIR)


def test_every_query_has_sql_and_the_other_way_round():
    assert set(QUERIES) == set(SQL) - OWN


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    assert compare.difference(df, duck, SQL[name]) is None
    want = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {SQL[name]}").fetchall()}
    got = {n: TYPES[t] for n, t in df.dtypes}
    assert got == want


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "pacing_vs_plan" in df.columns
