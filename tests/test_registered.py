"""Every registered query against its checking SQL on the smallest data."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from hostelry.queries import queries

SMALL = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "part", "orders", "lineitem", "events", "documents", "labels"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def test_every_query_has_a_check():
    assert set(queries()) <= set(entry.queries())
    assert set(queries()) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() == 1


@pytest.mark.parametrize("name", sorted(queries()))
def test_statement_can_be_stored_as_a_view(duck, name):
    duck.execute(f"CREATE OR REPLACE TEMP VIEW stored AS {entry.oracle_sql()[name]}")


@pytest.mark.parametrize("name", sorted(queries()))
def test_same_answer(spark, duck, name):
    df = entry.queries()[name](spark, SMALL)
    # No rows pass through Python and no join compares all pairs.
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|ArrowEval|NestedLoop|CartesianProduct", plan)
    names = sorted(df.columns)
    result = duck.execute(entry.oracle_sql()[name])
    position = {c[0]: i for i, c in enumerate(result.description)}
    assert sorted(position) == names
    expected = [tuple(r[position[c]] for c in names) for r in result.fetchall()]
    actual = [tuple(r[c] for c in names) for r in df.collect()]
    assert sorted(map(repr, actual)) == sorted(map(repr, expected))
