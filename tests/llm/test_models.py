"""Nearest neighbours and language-model scores."""

import math
import re
import zlib
from collections import Counter

import numpy as np

from benchloom.llm import pitman_yor, projection_forest
from benchloom.llm.language_kernel import held_out
from benchloom.llm.queries import QUERIES
from pyspark.sql import functions as F
from tests.llm.odd import table

FOLDER = "/root/testdata/sf0.01"


def test_op8_recall(spark):
    folder = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    found = {}
    for r in QUERIES["op8_projection_forest"](spark, folder).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == {int(x) for x in ids if x % 20 == 0}
    hits = 0
    for i in np.flatnonzero(ids % 20 == 0):
        scores = (vectors * vectors[i]).sum(axis=1)
        own = sorted(found[int(ids[i])])
        assert [r for r, _, _ in own] == list(range(1, 21))
        assert [(-s, v) for _, v, s in own] == sorted((-s, v) for _, v, s in own)
        assert all(s == scores[np.flatnonzero(ids == v)[0]] and v != ids[i] for _, v, s in own)
        scores[i] = -np.inf
        hits += len({v for _, v, _ in own} & set(ids[np.lexsort((ids, -scores))[:20]].tolist()))
    assert hits >= 0.9 * 20 * len(found)


def test_search_visits_near_leaves_first():
    draw = np.random.default_rng(0)
    vectors = draw.standard_normal((3000, 8))
    forest = projection_forest.fit(vectors, float(np.linalg.norm(vectors, axis=1).max()), trees=6, leaf=10)
    leaves = forest.leaves(vectors)
    sizes = np.bincount(leaves.ravel(), minlength=len(forest.children))
    assert sizes.sum() == 6 * len(vectors)
    visited = forest.search(vectors[0], sizes, 1500)
    assert sizes[visited].sum() >= 1500
    near = np.argsort(-vectors @ vectors[0])[:20]
    assert np.isin(leaves[near], visited).any(axis=1).mean() > 0.8


def test_odd_vectors(spark):
    rows = [
        (1, [1.0, 0.0]), (2, [1.0, 0.0]), (20, [2.0, 0.0]), (40, None), (60, [0.0, 0.0]), (80, [float("nan"), 1.0]), (None, [1.0, 1.0]),
        (3, [None, 1.0]), (4, [1.0, 2.0, 3.0]), (2, [5.0, 0.0]), (0, [-1.0, 1.0]), (5, [float("inf"), 1.0]),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "2 as v", "3 as leaf")
    found = projection_forest.nearest(vectors, vectors.where("vec_id % 20 = 0")).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found) == [
        (0, 1, 1, -1.0), (0, 2, 2, -1.0), (0, 3, 20, -2.0), (20, 1, 2, 10.0), (20, 2, 1, 2.0), (20, 3, 0, -2.0),
    ]
    assert projection_forest.nearest(vectors.limit(0), vectors).count() == 0


def test_copies_of_one_vector(spark):
    vectors = spark.range(2000).selectExpr("id as vec_id", "array(1.0D, 2.0D) as embedding")
    found = projection_forest.nearest(vectors, vectors.where("vec_id % 20 = 0"), shard=100)
    assert [r["vec_id"] for r in found.where("query_id = 40").orderBy("rank").collect()] == list(range(20))


# --- scores


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), ""]


def test_op7(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    words = {r["doc_id"]: tokens(r["text"]) for r in rows}
    away = {key: zlib.crc32(str(key).encode()) % 7 == 2 for key in words}
    counts = Counter(w for key, own in words.items() if not away[key] for w in own)
    total, different = sum(counts.values()), len(counts)
    found = QUERIES["op7_pitman_yor"](spark, FOLDER).collect()
    assert len(found) == len(rows)
    for r in found:
        own = words[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (away[r["doc_id"]], len(own), total)
        assert r["n_known"] == sum(counts[w] > 0 for w in own)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / (total + different + 1)) for w in own), rel_tol=1e-9)
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_probabilities_sum_to_one(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = pitman_yor.train(documents.where(~held_out(F.col("doc_id"), 7)))
    sums = pitman_yor.word_scores(model).agg(*[F.sum(F.pow(F.lit(10.0), f"s{k}")) for k in range(pitman_yor.KINDS)]).first()
    assert np.allclose(np.array(sums) + 10 ** pitman_yor.unknown_scores(model.states), 1)
    again = pitman_yor.train(documents.where(~held_out(F.col("doc_id"), 7)))
    for a, b in zip(model.states, again.states):
        assert (a.customers == b.customers).all()
    for state in model.states:
        assert (state.tables <= state.customers).all() and state.all_words == state.tables.sum() >= state.all_tables >= model.different


def test_seating_of_one_word():
    random = np.random.default_rng(1)
    tables = pitman_yor.seat(np.array([0, 1, 2, 100_000]), np.array([1.0, 1e-9, 1e9, 1.0]), 0.5, random)
    assert tables[:3].tolist() == [0, 1, 2] and 1 <= tables[3] < 100_000


def test_odd_texts(spark):
    rows = table(spark)
    model = pitman_yor.train(rows.where("doc_id < 4"))
    found = {}
    for r in pitman_yor.score(rows, model).collect():
        found.setdefault(r["doc_id"], []).append(r)
    assert len(found[1]) == 2 and found[1][0]["score"] == found[1][1]["score"]
    assert [found[k][0]["n_tokens"] for k in (2, 3, 6)] == [1, 1, 1]
    assert found[5][0]["n_tokens"] == 24_001 and found[5][0]["n_known"] == 1
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for own in found.values() for r in own)
    nothing = pitman_yor.train(rows.limit(0))
    assert {r["score"] for r in pitman_yor.score(rows, nothing).collect()} == {0.0}
    assert pitman_yor.score(rows.limit(0), model).count() == 0
