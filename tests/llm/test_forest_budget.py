"""The budget of the forest search follows the table."""

import numpy as np

from benchloom.llm import projection_forest


def test_recall_where_the_least_budget_is_small(spark, monkeypatch):
    monkeypatch.setattr(projection_forest, "CANDIDATES", 1000)
    draw = np.random.default_rng(3)
    vectors = draw.standard_normal((12_000, 32))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = {}
    for r in projection_forest.nearest(rows, rows.where("vec_id % 60 = 7")).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q, own in found.items():
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        hits += len(own & set(np.argsort(-scores)[:20].tolist()))
    assert len(found) == 200 and hits >= 0.9 * 20 * len(found)


def test_copies_in_a_third_of_the_rows():
    draw = np.random.default_rng(4)
    vectors = draw.standard_normal((3000, 16))
    vectors[::3] = vectors[0]
    copy = np.arange(3000) % 3 == 0
    for seed in range(6):
        forest = projection_forest.fit(vectors, float(np.linalg.norm(vectors, axis=1).max()), seed=seed)
        leaves = forest.leaves(vectors)
        sizes = np.bincount(leaves.ravel(), minlength=len(forest.children))
        large = np.flatnonzero(sizes > projection_forest.LEAF)
        assert len(large) == len(forest.roots)  # one leaf of copies in each tree
        assert all(copy[(leaves == x).any(axis=1)].all() for x in large)
        # the copies leave the budget to others
        visited = forest.search(vectors[0], sizes, 2000)
        assert np.isin(leaves[~copy], visited).any(axis=1).sum() > 500
