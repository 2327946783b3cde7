import duckdb
import pytest

from benchloom.llm import quality
from tests.llm.odd import LONG, ROWS, table


def by_text(frame):
    return {r["n_words"]: r for r in frame.collect()}


def test_same_as_sql_on_odd_rows(spark):
    found = quality.judge(table(spark), ["doc_id", "text"])
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    for n, row in enumerate(ROWS):
        con.execute("INSERT INTO documents VALUES (?, ?)", [n, row[1]])
    con.execute(f"CREATE VIEW judged AS {quality.sql()}")
    names = [*quality.FIGURES, "base_failed", "kept"]
    want = con.execute(f"SELECT {', '.join(names)} FROM judged ORDER BY ALL").fetchall()
    assert sorted(tuple(r[n] for n in names) for r in found.collect()) == want


@pytest.mark.parametrize(
    "text, repeated",
    [("a b c d e", 0), ("a b c d e f a b c d e", 10), ("x x x x x x", 6), ("x x x x x", 0), ("a b c d e a b c d e f g a", 10)],
)
def test_repeated_windows(spark, text, repeated):
    row = quality.judge(spark.createDataFrame([(1, text)], "doc_id long, text string"), ["doc_id"]).first()
    assert row["n_repeat_words"] == repeated


def test_keep_good(spark):
    rows = table(spark)
    kept = quality.keep_good(rows)
    assert kept.columns == rows.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, None, 7}
    assert quality.judge(rows.limit(0), ["doc_id"]).count() == 0
    assert quality.judge(rows.where("doc_id = 5"), ["doc_id"]).first()["n_words"] == len(LONG.split())
