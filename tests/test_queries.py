"""Every registered query against its SQL, and the shape of its plan."""

import duckdb
import pytest

import __spark_entry__ as entry
from benchloom.plans import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
PYTHON_QUERIES = {
    "parse_definitions", "definition_contexts", "duplicate_sources", "definition_errors",
}  # collect_tasks parses in a job of its own and reads the stored definitions


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def cell(value):
    return "%.9g" % value if isinstance(value, float) else str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(cell(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    physical = df._jdf.queryExecution().executedPlan().toString()
    found = table(df.columns, df.collect())
    result = duck.execute(SQL[name])
    assert found == table([c[0] for c in result.description], result.fetchall())
    assert "CartesianProduct" not in physical and "BroadcastNestedLoopJoin" not in physical
    assert "Join Cross" not in plan
    assert ("InPandas" in plan) == (name in PYTHON_QUERIES) and "PythonUDF" not in plan


def test_entry(spark):
    assert entry.entry(spark).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
