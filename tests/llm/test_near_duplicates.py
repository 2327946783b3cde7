"""SimHash trees and line dedup against brute force."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from xxhash import xxh64_intdigest

from benchloom.llm import line_dedup, simhash_trees
from benchloom.llm.components import components
from benchloom.llm.queries import QUERIES
from tests.llm.odd import table

FOLDER = "/root/testdata/sf0.01"


class Groups:
    def __init__(self, n):
        self.parents = list(range(n))

    def root(self, i):
        while self.parents[i] != i:
            i = self.parents[i]
        return i

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parents[max(a, b)] = min(a, b)


def near_pairs(prints, radius):
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[:i] ^ prints[i]) <= radius):
            yield i, int(j)


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    ones = [0] * 64
    for x in shingles:
        h = xxh64_intdigest(x, 42)
        for bit in range(64):
            ones[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * ones[bit] > len(shingles))


def test_op9(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in rows}
    different = np.array(sorted(set(prints.values())), np.uint64)
    groups, place = Groups(len(different)), {int(x): i for i, x in enumerate(different)}
    for i, j in near_pairs(different, 2):
        groups.join(i, j)
    least = {}
    for key, x in prints.items():
        g = groups.root(place[x])
        least[g] = min(least.get(g, key), key)
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op9_simhash_trees"](spark, FOLDER).collect()}
    assert found == {key: (f"{x:016x}", least[groups.root(place[x])]) for key, x in prints.items()}


@pytest.mark.parametrize("crowded", [4096, 5])
def test_trees_connect_all_near_prints(spark, crowded):
    draw, values = random.Random(3), set()
    for _ in range(20):
        x = draw.getrandbits(64)
        for _ in range(50):
            values.add(x)
            y = x
            for _ in range(draw.randint(1, 4)):
                y ^= 1 << draw.randrange(64)
            values.add(y)
            x = y if draw.random() < 0.3 else x
    prints = np.array(sorted(values), np.uint64)
    table_of = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long")
    found, want, place = Groups(len(prints)), Groups(len(prints)), {int(x): i for i, x in enumerate(prints.view(np.int64))}
    for row in simhash_trees.link(table_of, crowded=crowded).collect():
        found.join(place[row["a"]], place[row["b"]])
    for i, j in near_pairs(prints, 2):
        want.join(i, j)
    assert [found.root(i) for i in range(len(prints))] == [want.root(i) for i in range(len(prints))]


def test_tree_search():
    draw = random.Random(1)
    values = [draw.getrandbits(12) for _ in range(300)]
    tree = simhash_trees.BKTree()
    for x in values:
        tree.add(x)
    for q in (0, 77, values[5]):
        assert sorted(tree.within(q, 2)) == [i for i, x in enumerate(values) if (x ^ q).bit_count() <= 2]


def test_components(spark):
    draw = random.Random(2)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)]
    groups = Groups(500)
    for a, b in links:
        groups.join(a, b)
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {x: groups.root(x) for pair in links for x in pair if pair[0] != pair[1] or x in found}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_of_odd_rows(spark):
    rows = table(spark)
    found = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash_trees.near_duplicates(rows).collect()]
    empty = {x for x in found if x[1] == "0" * 16}
    assert empty == {(2, "0" * 16, 2), (3, "0" * 16, 2), (6, "0" * 16, 2)}
    assert (None, f"{brute_fingerprint(rows.where('doc_id IS NULL').first()['text']):016x}", None) in found
    kept = simhash_trees.keep_one(rows)
    assert kept.columns == rows.columns
    assert len(kept.collect()) == len({x[1] for x in found} - {"0" * 16}) - _linked(found) + 1
    assert simhash_trees.near_duplicates(rows.limit(0)).count() == 0
    assert simhash_trees.keep_one(rows.limit(0)).count() == 0


def _linked(found):
    """Different fingerprints that share a component with another one."""
    by_group = {}
    for _, x, g in found:
        if x != "0" * 16:
            by_group.setdefault(g if g is not None else x, set()).add(x)
    return sum(len(x) - 1 for x in by_group.values())


# --- lines


def test_edit_distance():
    draw = random.Random(4)
    for _ in range(1500):
        a, b = ("".join(draw.choice("abc") for _ in range(draw.randint(0, 20))) for _ in range(2))
        b = a[:5] + b[:3] + a[6:] if draw.random() < 0.5 else b
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        assert line_dedup.edit_distance(a, b) == row[-1]
        assert line_dedup.similar(a, b, 0.8) == (row[-1] <= 0.2 * max(len(a), len(b)) + 1e-9)


def sharing_pairs(lines):
    """Lines with an equal value in some block."""
    keys, there = line_dedup.block_keys(pa.array(lines, pa.large_string()))
    met = {}
    for i in range(len(lines)):
        for b in np.flatnonzero(there[i]).tolist():
            met.setdefault((b, int(keys[i, b])), []).append(i)
    return sorted({pair for own in met.values() for pair in combinations(own, 2)})


def brute_lines(rows):
    found = [(key, line) for key, text in sorted(rows) for line in text.split("\n")]
    plain = line_dedup.normalised(pa.array([x for _, x in found], pa.large_string())).to_pylist()
    different = sorted(set(plain) - {""})
    groups, place = Groups(len(different)), {x: i for i, x in enumerate(different)}
    for i, j in sharing_pairs(different):
        if line_dedup.similar(different[i], different[j]):
            groups.join(i, j)
    seen, out = set(), {key: [] for key, _ in rows}
    for (key, line), x in zip(found, plain):
        g = groups.root(place[x]) if x else None
        if g is None or g not in seen:
            out[key].append(line)
        seen.add(g)
    return {key: "\n".join(x) for key, x in out.items()}


@pytest.mark.parametrize("unit", [1024, 4])
def test_op1(spark, monkeypatch, unit):
    monkeypatch.setattr(line_dedup, "UNIT", unit)
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: r["text"] for r in QUERIES["op1_line_dedup"](spark, FOLDER).collect()}
    assert found == brute_lines([tuple(r) for r in rows])


def test_near_equal_lines(spark):
    base = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120))
    rows = [(1, f"{base}\nown line"), (2, f"{base} more!\n\nother"), (3, base.upper()), (4, " ".join(reversed(base.split())))]
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["text"] for r in found} == {1: rows[0][1], 2: "\nother", 3: "", 4: rows[3][1]}


def test_line_dedup_of_odd_rows(spark):
    found = line_dedup.dedup_lines(table(spark))
    assert found.columns == [x for x in table(spark).columns if x != "n_lines"] + ["n_lines", "n_dropped"]
    rows = {}
    for r in found.collect():
        rows.setdefault(r["doc_id"], []).append((r["text"], r["n_lines"], r["n_dropped"]))
    line = table(spark).where("doc_id = 1").first()["text"]
    assert rows[1] == [(line, 1, 0)] * 2  # rows that repeat key and text are one document
    assert rows[2] == [(None, 0, 0)] and rows[3] == [("", 0, 0)] and rows[7] == [("", 1, 1)]
    assert line_dedup.dedup_lines(table(spark).limit(0)).count() == 0


@pytest.mark.parametrize("n", [2, 6, 20, 200])
@pytest.mark.parametrize("cross", [False, True])
def test_links_of_small_and_large_units(n, cross):
    draw = random.Random(n)
    words = ["".join(draw.choice("abc") for _ in range(40)) for _ in range(4)]
    lines = []
    for _ in range(n):
        line = list(words[draw.randrange(4)])
        for _ in range(draw.randint(0, 9)):
            line[draw.randrange(40)] = draw.choice("abc")
        lines.append("".join(line[: draw.randint(34, 40)]))
    roots = [i if draw.random() < 0.7 else draw.randrange(i + 1) for i in range(n)]
    roots = [roots[r] for r in roots]
    blocks = [draw.randrange(3) for _ in range(n)] if cross else None
    want, found = Groups(n), Groups(n)
    for i in range(n):
        want.join(i, next(j for j in range(n) if roots[j] == roots[i]))
        found.join(i, next(j for j in range(n) if roots[j] == roots[i]))
    for i, j in combinations(range(n), 2):
        if (blocks is None or blocks[i] != blocks[j]) and line_dedup.similar(lines[i], lines[j]):
            want.join(i, j)
    links = line_dedup.links_of(list(range(n)), roots, lines, blocks, 0.8)
    for a, b in links:
        assert line_dedup.similar(lines[a], lines[b])
        found.join(a, b)
    assert len(links) < n
    assert [found.root(i) for i in range(n)] == [want.root(i) for i in range(n)]


def test_blocks_of_a_line():
    base = [f"{chr(97 + i)}{'xyz' * (1 + i % 3)}word" for i in range(24)]
    other = base[:5] + ["replaced"] + base[6:]
    lines = pa.array([" ".join(base), " ".join(other), "tiny", "ab cd ef"], pa.large_string())
    prints, letters = line_dedup.simhashes(lines)
    assert (prints[0] != prints[1]).sum() <= 2 and (letters[0] != letters[1]).sum() <= 2
    told = [sum(max(1, len(x) - line_dedup.COMMON) for x in set(line.split())) for line in lines.to_pylist()]
    assert letters.sum(axis=1).tolist() == told
    # by hand: a word votes once, in the block of its hash
    word = xxh64_intdigest(b"tiny", line_dedup.SEED)
    block = (word >> 32) % line_dedup.BLOCKS
    assert prints[2, block] == word & 0xFFFFFFFF and letters[2, block] == 1 and prints[2].astype(bool).sum() == 1
    keys, there = line_dedup.block_keys(lines)
    assert there.sum(axis=1).tolist()[2:] == [1, 1]
    heavy = (letters >= line_dedup.LETTERS) & there
    assert (keys[heavy] == prints[heavy]).all()


@pytest.mark.parametrize("letters", ["ab", "abcdefgh "])
def test_bounds_of_the_edit_distance(letters):
    """The band and the counts of pairs never contradict the distance; long lines that differ are left early."""
    draw = random.Random(3)
    for _ in range(2000):
        a = [draw.choice(letters) for _ in range(draw.randint(1, 60))]
        b = list(a)
        for _ in range(draw.randint(0, len(a) // 2)):
            at = draw.randrange(len(b) + 1)
            b[at : at + draw.randint(0, 1)] = draw.choice(["", draw.choice(letters)])
        a, b = sorted(("".join(a), "".join(b)), key=len, reverse=True)
        distance = line_dedup.edit_distance(a, b)
        assert line_dedup._edits_at_least(*(line_dedup._pair_counts(x) for x in (a, b))) <= distance
        for allowed in (0, 1, 3, 8):
            if len(a) - len(b) <= allowed < len(b):
                assert line_dedup._within(a, b, allowed) == (distance <= allowed)


def test_lines_are_normalised_as_by_hand():
    given = ["  A--b  00 1234x", "", "٣٤12 Ⅷ½ x", "a—b…c 日本語、テ", "0 0  0", "é́ ß", "...", "0", "00"]
    want = ["a b 0 0x", "", "0 0 x", "a b c 日本語 テ", "0 0 0", "é ß", "", "0", "0"]
    for lines in (pa.array(given, pa.large_string()), pa.array(["00", *given], pa.large_string())[1:]):
        assert line_dedup.normalised(lines).to_pylist() == want
