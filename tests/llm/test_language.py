import zlib

from pyspark.sql import functions as F

from benchloom.llm import language_kernel
from benchloom.llm.queries import QUERIES
from tests.llm.odd import table

FOLDER = "/root/testdata/sf0.01"


def test_op3_accuracy(spark):
    found = QUERIES["op3_language_kernel"](spark, FOLDER)
    rows = found.join(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    away = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in away) > 0.98 * len(away)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_kernel_is_shared_grams_over_sizes():
    own = language_kernel.Presence()
    a, b = (set(own.grams(x).tolist()) for x in ("Le chat noir", "le CHAT  blanc!"))
    model = language_kernel.fit([own.grams("Le chat noir"), own.grams("the dog")], ["fr", "en"])
    value = model.kernel([own.grams("le CHAT  blanc!")])[0]
    assert abs(value[1] - len(a & b) / (len(a) * len(b)) ** 0.5) < 1e-6  # landmarks in order of their languages


def test_odd_rows(spark):
    rows = table(spark)
    model = language_kernel.train(rows.where("doc_id IS NULL OR doc_id < 3"))
    found = {(r["doc_id"], r["lang_pred"]) for r in language_kernel.predict(rows, model).collect()}
    assert {(2, "und"), (3, "und"), (4, "und"), (6, "und"), (1, "en"), (7, "en"), (None, "es")} <= found
    kept = language_kernel.keep_known(rows, model)
    assert kept.columns == rows.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, None, 5, 7}
    assert language_kernel.predict(rows.limit(0), model).count() == 0


def test_nothing_to_learn(spark):
    rows = table(spark)
    model = language_kernel.train(rows.where("lang IS NULL"))
    assert model is None
    assert {(r["lang_pred"], r["score"]) for r in language_kernel.predict(rows, model).collect()} == {("und", 0.0)}


def test_null_key_is_not_held_out(spark):
    away = language_kernel.held_out(F.col("doc_id"), 4)
    assert table(spark).where(F.col("doc_id").isNull()).select(away.alias("a")).first()["a"] is False
