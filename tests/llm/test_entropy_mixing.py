import math
import re
from collections import defaultdict

import pytest

from benchloom.llm import entropy_mixing, queries

from .odd import table

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shared_out(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by resharing, source by source."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while True:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total > most * sizes[s]}
        if not above:
            return target | {s: left * weight[s] / total for s in open_}
        for s in above:
            target[s] = most * sizes[s]
            left -= most * sizes[s]
        open_ -= above
        if not open_:
            return target


def tilted(sizes, target, most=2):
    """Rates by halving the bracket of the tilt, size by size."""
    if target >= most * sum(sizes):
        return [most] * len(sizes)
    low, high = -1e3, 1e3
    for _ in range(300):
        tilt = (low + high) / 2
        got = sum(n * (most if tilt * n > math.log(most) else math.exp(tilt * n)) for n in sizes)
        low, high = (tilt, high) if got < target else (low, tilt)
    return [most if tilt * n > math.log(most) else math.exp(tilt * n) for n in sizes]


def check(rows, source_of, size_of):
    own = defaultdict(list)
    for r in rows:
        own[source_of[r.doc_id]].append(r)
        assert r["size"] == size_of[r.doc_id] and r.taken <= 2 * r["size"] and r.taken == r.copies * r["size"]
    sizes = {s: sum(r["size"] for r in x) for s, x in own.items()}
    want = shared_out(sizes)
    for s, x in own.items():
        assert all(r.source_size == sizes[s] and r.target == pytest.approx(want[s]) for r in x)
        there = [r for r in x if r["size"]]
        for r, rate in zip(there, tilted([r["size"] for r in there], want[s])):
            assert r.rate == pytest.approx(rate, rel=1e-5)
            assert math.floor(rate - 1e-6) <= r.copies <= math.ceil(rate + 1e-6) or len({q["size"] for q in there}) > 1
        least = min((r["size"] for r in there), default=0)
        assert abs(sum(r.taken for r in x) - want[s]) <= 0.003 * want[s] + least


def test_rates_and_targets_equal_brute_force(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source", "text").collect()
    size = {r.doc_id: len(WORDS.findall(r.text or "")) for r in documents}
    rows = queries.QUERIES["op11_entropy_mixing"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(documents)
    check(rows, {r.doc_id: r.source for r in documents}, size)


def test_uneven_sources(spark):
    """A source above its room, one with one size only, one without words, and a null source with most rows."""
    made = [(i, None, "w " * (1 + i % 9)) for i in range(600)]
    made += [(1000 + i, "a", "w " * 3) for i in range(40)] + [(2000 + i, "b", "w " * (i + 1)) for i in range(60)]
    made += [(3000, "empty", ""), (3001, "empty", None), (4000, "ü", "one"), (4001, "z", "w " * 5000)]
    df = spark.createDataFrame(made, "doc_id long, source string, text string")
    size = {i: len(WORDS.findall(t or "")) for i, _, t in made}
    rows = entropy_mixing.mix(df).collect()
    targets = {r.doc_id: r.target for r in rows}
    want = shared_out({s: sum(size[i] for i, t, _ in made if t == s) for s in {t for _, t, _ in made}})
    assert all(targets[i] == pytest.approx(want[s]) for i, s, _ in made)
    taken = defaultdict(int)
    for r in rows:
        taken[{i: s for i, s, _ in made}[r.doc_id]] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in (None, "b")) and taken["empty"] == 0
    # one size: the nearest multiple; one document: the nearest copies
    assert abs(taken["a"] - want["a"]) <= 1.5 and abs(taken["z"] - want["z"]) <= 2500


def test_reruns_and_partitions_agree(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    first = {(r.doc_id, r.taken) for r in entropy_mixing.mix(df).collect()}
    assert first == {(r.doc_id, r.taken) for r in entropy_mixing.mix(df.repartition(7)).collect()}


def test_odd_rows(spark):
    df = table(spark).selectExpr("*", "lang as source", "1 as tag", "2 as mark", "3 as each", "4 as rate")
    rows = entropy_mixing.mix(df).collect()
    assert len(rows) == df.count()
    assert all(r.taken <= 2 * r["size"] for r in rows) and sum(r["size"] for r in rows) > 24_000
    assert entropy_mixing.mix(df.limit(0)).count() == 0


def test_mixed_rows(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], "w " * (i + 1), 9) for i in range(30)], "doc_id long, source string, text string, copies int")
    copies = {r.doc_id: r.copies for r in entropy_mixing.mix(df).collect()}
    rows = entropy_mixing.mixed(df).collect()
    assert len(rows) == sum(copies.values()) and {r.copies for r in rows} == {9}
    assert all(1 <= r["copy"] <= copies[r.doc_id] for r in rows)
