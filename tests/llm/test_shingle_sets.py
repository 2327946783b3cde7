"""Groups of documents by the Jaccard similarity of their shingles, against brute force."""

import random

import pytest

import corpus_pipeline
from benchloom.llm import shingle_sets
from benchloom.llm.simhash_trees import fingerprint
from tests.llm.test_near_duplicates import Groups


def brute_set(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / max(1, len(a | b))


def near_copies(groups, members, seed=5):
    """Texts of 20 to 400 words, and copies of them with a run of words replaced here and there."""
    draw, out = random.Random(seed), []
    word = lambda: f"w{draw.randrange(20_000)}"
    for _ in range(groups):
        base = [word() for _ in range(draw.randint(20, 400))]
        out.append(base)
        for _ in range(members - 1):
            copy = list(base)
            for _ in range(draw.randint(1, 1 + len(base) // 40)):
                copy[draw.randrange(len(copy))] = word()
            out.append(copy)
    return [" ".join(x) for x in out]


@pytest.mark.parametrize("unit, groups, members", [(256, 60, 4), (4, 6, 30)])
def test_near_dedup_keeps_one_of_each_group(spark, monkeypatch, unit, groups, members):
    monkeypatch.setattr(shingle_sets, "UNIT", unit)
    texts = near_copies(groups, members)
    sets, want = [brute_set(x) for x in texts], Groups(len(texts))
    for i in range(len(texts)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= 0.8:
                want.join(i, j)
    docs = spark.createDataFrame([(i, x, "en", "s", len(x)) for i, x in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    near_dedup = dict(corpus_pipeline.STAGES)["near_dedup"]
    kept = {r["doc_id"] for r in near_dedup(spark, docs, "").collect()}
    assert kept == {want.root(i) for i in range(len(texts))}
    assert len(kept) < len(texts)


def test_bands_find_pairs_at_the_border():
    draw, met, pairs = random.Random(8), 0, 400
    for _ in range(pairs):
        both = [draw.getrandbits(64) for _ in range(160)]
        a, b = (shingle_sets.np.array(sorted(both + [draw.getrandbits(64) for _ in range(20)]), "u8") for _ in range(2))
        assert shingle_sets.similar(a, b)
        met += bool((shingle_sets.bands_of(a) == shingle_sets.bands_of(b)).any())
    assert met == pairs


def test_near_dedup_searches_the_simhash_trees(spark, monkeypatch):
    """Copies without a common MinHash band are found by the trees, and compared exactly."""
    draw = random.Random(3)
    texts = []
    for _ in range(30):
        base = [f"w{draw.randrange(20_000)}" for _ in range(600)]
        texts += [" ".join(base), " ".join(base[:-1] + ["other"])]
    # the same SimHash of repeated shingles, but no similar sets
    texts += ["b " * 50 + "x y z", "b " * 50 + "u v w p q"]
    near = {i for i in range(1, 60, 2) if (fingerprint(texts[i - 1]) ^ fingerprint(texts[i])).bit_count() <= 2}
    assert len(near) > 10 and (fingerprint(texts[-1]) ^ fingerprint(texts[-2])).bit_count() <= 2
    draws = shingle_sets.np.random.default_rng(4)
    monkeypatch.setattr(shingle_sets, "bands_of", lambda hashes: draws.integers(0, 1 << 63, 24, "u8"))
    docs = spark.createDataFrame([(i, x, "en", "s", len(x)) for i, x in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    near_dedup = dict(corpus_pipeline.STAGES)["near_dedup"]
    kept = {r["doc_id"] for r in near_dedup(spark, docs.coalesce(1), "").collect()}
    assert kept == set(range(len(texts))) - near
