import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from benchloom.llm import queries, spelling_variants

from .odd import table

RUNS = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}


def counted(rows):
    found = Counter()
    for key, text in rows:
        for word in RUNS.findall(text or ""):
            word = word.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= 7:
                found[word] += 1
    return {w: n for w, n in found.items() if n >= 2}


def one_edit(a, b):
    """Straight from the definition: equal before one place, and behind it."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    near = defaultdict(set)
    names = sorted(words)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            if abs(len(a) - len(b)) < 2 and one_edit(a, b):
                near[a].add(b)
                near[b].add(a)
    return judged(words, near)


def judged(words, near):
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    rows = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return rows


def deletions(words):
    """Near words of a larger vocabulary: two words that are one edit apart share a string with a letter left out."""
    shared = defaultdict(set)
    for w in words:
        for s in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            shared[s].add(w)
    near = defaultdict(set)
    for group in shared.values():
        for a in group:
            near[a] |= {b for b in group if a != b and one_edit(a, b)}
    return judged(words, near)


def test_query_equals_brute_force(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    want = deletions(counted([tuple(r) for r in documents]))
    got = queries.QUERIES["op13_spelling_variants"](spark, "/root/testdata/sf0.01")
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == want and len(want) > 1000


@pytest.mark.parametrize("symbols", [2, 5, 26])
def test_any_number_of_symbols(spark, symbols):
    letters = np.random.default_rng(3).choice(list("abcdéÿ÷"), (150, 8))
    words = {"".join(x)[: 7 + i % 2]: int(2 + i % 60) for i, x in enumerate(letters)}
    words |= {"aaaaaaa": 500, "aaaaaaaa": 40, "aaaaaaab": 4, "x" * 3000: 90, "x" * 2999: 9, "x" * 2998 + "y": 2}
    held = spark.createDataFrame([*words.items()], "word string, n long")
    assert {tuple(r) for r in spelling_variants.variants(held, symbols=symbols).collect()} == brute(words)


def test_long_words(spark):
    """A run of letters has as many neighbours as letters and more: they are not spelled, nor do they carry it."""
    rng = np.random.default_rng(5)
    letters = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzéü"), 40_000))
    edges = [letters[: spelling_variants.CARRIED + i] for i in range(-2, 3)]
    words = {letters: 90, letters[:20_000] + letters[20_001:]: 9, letters[:-1] + "é": 2, letters[1:] + "aa": 4}
    words |= {x: 2 + 30 * i for i, x in enumerate(edges)} | {edges[2][:-1] + "ü": 5, edges[4][:-1] + "ü": 3, "ab" * 5000: 70, "ab" * 5000 + "a": 7}
    held = spark.createDataFrame([*words.items()], "word string, n long")
    assert {tuple(r) for r in spelling_variants.variants(held).collect()} == brute(words)


def test_codes_of_neighbours():
    """A code of a neighbour is the code of the word that it is."""
    words = np.random.default_rng(7).integers(0, 3, (5, 6))
    code = lambda x: int((spelling_variants.VALUES[list(x)] * spelling_variants._places(len(x))[0]).sum(dtype=np.uint64).view(np.int64))
    for word, own, codes in zip(words.tolist(), *spelling_variants.near_codes(words.astype(np.uint8), 3)):
        near = {tuple(word)} | {(*word[:i], *word[i + 1 :]) for i in range(6)}
        near |= {(*word[:i], s, *word[i + 1 :]) for i in range(6) for s in range(word[i] + 1, 3)}
        assert own == code(word) and set(codes.tolist()) == {code(x) for x in near}


def test_ties_and_chains(spark):
    words = {"colored": 2, "coloured": 25, "colouredx": 260, "colouredy": 260, "colouredxx": 30_000, "lonelyword": 7}
    rows = {r.word: r for r in spelling_variants.variants(spark.createDataFrame([*words.items()], "word string, n long")).collect()}
    assert rows["coloured"].form == "colouredx" and rows["colored"].root == "colouredxx"
    assert rows["lonelyword"].form is None and rows["lonelyword"].root == "lonelyword" and rows["lonelyword"].n_near == 0


def test_runs_at_the_borders_of_texts(spark):
    """Letters of two bytes at the ends of texts, capitals outside A-Z, runs that meet only across texts."""
    rows = [(1, "ÀÉÿabcdÉ"), (2, "ÀÉÿabcdÉ"), (3, "abcd"), (4, "efgh"), (5, "wörterbuch×÷ WÖRTERBUCH"), (6, "wÖrterbuch ŒUVRES œuvresĀ"), (None, "nullkeys nullkeys")]
    rows += [(i, "z" * 200 + " " + "Long" * 40) for i in range(10, 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.word: r.n for r in spelling_variants.vocabulary(df).collect()} == counted(rows)


def test_odd_rows(spark):
    df = table(spark)
    want = counted([(r.doc_id, r.text) for r in df.collect()])
    assert {tuple(r) for r in spelling_variants.group_variants(df).collect()} == brute(want)
    assert spelling_variants.group_variants(df.limit(0)).count() == 0
