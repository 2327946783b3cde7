import random
from collections import Counter

import pytest

from benchloom.llm import bin_packing
from benchloom.llm.queries import QUERIES
from tests.llm.odd import table

FOLDER = "/root/testdata/sf0.01"


def brute(items, opened):
    bins, left = [], Counter(items)
    for length in sorted(items, reverse=True):
        fitting = [b for b in bins if b[0] - sum(b[1]) >= length]
        if not fitting:
            bins.append((opened(length, left[length]), []))
        (min(fitting, key=lambda b: b[0] - sum(b[1])) if fitting else bins[-1])[1].append(length)
        left[length] -= 1
    return bins


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_best_fit(seed):
    draw, sizes, cost = random.Random(seed), (8, 16, 40), lambda c: c + 3
    items = [draw.randint(1, 40) for _ in range(draw.randint(0, 60))]
    found, made = bin_packing.plan(Counter(items), sizes, cost)
    rules = [lambda length, _, p=p: p if length <= p else min(c for c in sizes if c >= length) for p in sizes]
    rules.append(lambda length, left: min((c for c in sizes if c >= length), key=lambda c: (cost(c) / (length * min(c // length, left)), c)))
    want = min(sum(cost(min(s for s in sizes if s >= sum(b[1]))) for b in brute(items, rule)) for rule in rules)
    assert found == want
    held = Counter()
    for capacity, bins in made:
        size = sum(length * n for length, n in bins.contents)
        assert size <= capacity and not any(s >= size for s in sizes if s < capacity)
        held.update({length: n * bins.count for length, n in bins.contents for _ in (0,)} if len(dict(bins.contents)) == len(bins.contents) else {})
    assert sum(n * b.count for _, b in made for _, n in b.contents) == len(items)


def check(rows, lengths, largest):
    """Every row whole, in pieces without gaps; no bin overfull or larger than needed."""
    by_key, by_bin = {}, {}
    for r in rows:
        by_key.setdefault(r["doc_id"], []).append((r["piece"], r["length"]))
        by_bin.setdefault(r["bin_id"], []).append((r["offset"], r["length"], r["capacity"]))
    assert {k: sum(x for _, x in v) for k, v in by_key.items()} == lengths
    for pieces in by_key.values():
        assert [p for p, _ in sorted(pieces)] == list(range(len(pieces)))
        assert all(x == largest for _, x in sorted(pieces)[:-1])
    for placed in by_bin.values():
        end = 0
        for offset, length, _ in sorted(placed):
            assert offset == end
            end += length
        assert placed[0][2] == min(c for c in bin_packing.LENGTHS if c >= end)


def test_op6(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op6_best_fit_packing"](spark, FOLDER).collect()
    check(found, {r["doc_id"]: len(r["text"].split()) + 1 for r in rows}, 4096)
    histogram = Counter(r["length"] for r in found)
    cost = bin_packing.plan(histogram)[0]
    bins = {r["bin_id"]: r["capacity"] for r in found}
    assert sum(map(bin_packing.sequence_cost, bins.values())) == pytest.approx(cost)


def test_odd_rows(spark):
    found = bin_packing.pack_documents(table(spark)).collect()
    assert Counter(r["doc_id"] for r in found) == Counter({1: 2, 2: 1, 3: 1, None: 1, 4: 1, 5: 6, 6: 1, 7: 1})
    assert sum(r["length"] for r in found) == sum(len((r["text"] or "").encode().split()) + 1 for r in table(spark).collect())
    sizes = spark.createDataFrame([(1, None), (2, 0), (None, 5), (3, 9000), (4, -1)], "doc_id long, n long")
    placed = {r["doc_id"]: r["bin_id"] for r in bin_packing.pack(sizes, "n").where("piece = 0").collect()}
    assert {k for k, v in placed.items() if v is None} == {1, 2, 4}
    assert bin_packing.pack_documents(table(spark).limit(0)).count() == 0
