import hashlib
import re
import zlib
from collections import defaultdict

import pytest

from benchloom.llm import burst_trie, queries

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """The nodes of all rebuilt conversations, by listing the members of every prefix."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {c: [x for _, x in sorted(turns, key=lambda t: t[0])] for c, turns in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
    members, below = defaultdict(list), defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    for prefix in members:
        if prefix:
            below[prefix[:-1]].append(prefix)
    nodes = {}
    for prefix in sorted(members, key=len, reverse=True):
        convs = members[prefix]
        words = len(WORDS.findall(prefix[-1][1])) if prefix else 0
        leaves = sum(nodes[x][5] for x in below[prefix]) or 1
        saved = (len(convs) - 1) * words + sum(nodes[x][6] for x in below[prefix])
        ends = ",".join(str(c) for c in convs if len(built[c]) == len(prefix))
        parent = members[prefix[:-1]][0] if prefix else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        nodes[prefix] = (convs[0], len(prefix), parent, len(convs), len(below[prefix]), leaves, saved, digest)
    return sorted(nodes.values(), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("limit", [burst_trie.LIMIT, 6])
def test_nodes_equal_brute_force(spark, limit):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    want = brute([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
    assert rows_of(burst_trie.conversation_trie(table, limit)) == want


def test_query_equals_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    want = brute([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
    got = queries.QUERIES["op12_burst_trie"](spark, "/root/testdata/sf0.001")
    assert got.columns == [x.split()[0] for x in burst_trie.NODE.split(", ")]
    assert rows_of(got) == want


@pytest.mark.parametrize("limit", [1, 4, 1000])
def test_odd_conversations(spark, limit):
    """Long shared beginnings, copies, prefixes of each other, missing firsts, nulls, ties, turnless ones, other columns."""
    chain = [(c, t, "user", f"turn {t}") for c in (20, 21, 22, 23, 40, 41) for t in range(40)]
    split = [(c, t, "user", "same" if t < 30 else f"{c} own") for c in range(60, 80) for t in range(35)]
    odd = [
        (3, None, "user", "first of all"), (3, 2, None, "b"), (3, 1, "user", None), (5, 0, "user", "only"), (6, 0, "user", "only"),
        (105, 0, "user", "x"), (105, 0, "user", "x"), (107, 7, "", ""), (-3, 0, "user", "negative"), (None, 0, "user", "nobody"),
        (205, 0, "user", "long " * 50_000),
    ]
    rows = chain + split + odd
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "1 as conv", "2 as key", "'x' as words", "3 as depth", "4 as size")
    assert rows_of(burst_trie.conversation_trie(df, limit)) == brute(rows)


def test_long_shared_runs_take_few_rounds(spark):
    """300 shared turns burst in rounds of 8, 16, 32, ... turns; a container never holds more than its limit."""
    rows = [(c, t, "user", "same" if t < 300 else f"{c}") for c in range(0, 200, 20) for t in range(301)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    held = burst_trie._with_keys(burst_trie.sequences(df))
    heads, passed = burst_trie._burst(held, 10)
    assert heads.count() == 301 and {r.passed for r in passed.collect()} == {301}
    assert rows_of(burst_trie.conversation_trie(df, 10)) == brute(rows)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert burst_trie.conversation_trie(empty).count() == 0
