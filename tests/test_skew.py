"""The queries on tables in which one key holds a third of all rows."""

import duckdb
import pytest

from benchloom.plans import QUERIES, SQL
from tests.test_queries import FOLDER, TABLES, table

HOT = {
    "lineitem": "* REPLACE (CASE WHEN l_extendedprice::BIGINT % 3 = 0 THEN 1 ELSE l_orderkey END AS l_orderkey, "
    "CASE WHEN l_extendedprice::BIGINT % 3 = 1 THEN 2 ELSE l_partkey END AS l_partkey, "
    "CASE WHEN l_extendedprice::BIGINT % 3 = 0 THEN 20 ELSE l_suppkey END AS l_suppkey)",
    "orders": "* REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey)",
    "events": "* REPLACE (CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id)",
    "documents": "* REPLACE (CASE WHEN doc_id % 3 = 0 THEN (SELECT text FROM documents WHERE doc_id = 5) ELSE text END AS text, "
    "CASE WHEN doc_id % 3 = 0 THEN 'hot' ELSE source END AS source)",
}
UNTOUCHED = {"fenced_code", "prepare_java_tasks", "git_metadata", "instance_ids"}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    for name in TABLES:
        con.execute(f"COPY (SELECT {HOT.get(name, '*')} FROM {name}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    hot = duckdb.connect()
    for name in TABLES:
        hot.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return str(folder), hot


@pytest.mark.parametrize("name", sorted(set(QUERIES) - UNTOUCHED))
def test_query_on_skewed_tables(spark, skewed, name):
    folder, duck = skewed
    df = QUERIES[name](spark, folder)
    result = duck.execute(SQL[name])
    assert table(df.columns, df.collect()) == table([c[0] for c in result.description], result.fetchall())
