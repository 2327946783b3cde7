import math
import random

import pytest
from pyspark.sql import functions as F

from benchloom.operators import coverage, jobs

SOURCE = '''import os

def documented(x):
    """Say
    so."""
    return x

class Box:
    size = 1

    def put(self):
        @staticmethod
        def inner():
            pass
        return inner

    async def skip(self):
        pass

if True:
    def hidden():
        pass

def one_line(): return 1
'''


def parsed(spark, source):
    df = spark.createDataFrame([("a.py", source)], "path STRING, source STRING")
    return {r.intent: r for r in coverage.parse_definitions(df).collect()}


def test_definitions(spark):
    got = parsed(spark, SOURCE)
    where = {k: (r.l, r.r) for k, r in got.items()}
    assert where == {
        "documented[function]": (5, 6), "Box[class]": (8, 18), "put[function]": (12, 15), "inner[function]": (13, 14),
        "one_line[function]": (23, 24)}
    doc = got["documented[function]"]
    assert doc.doc == "'Say\\n    so.'" and doc.gt == "    return x\n"
    files = spark.createDataFrame([("a.py", SOURCE)], "path STRING, source STRING")
    whole = coverage.definition_contexts(coverage.parse_definitions(files), files).where("intent_name = 'documented'").first()
    assert whole.left_context + whole.gt + whole.right_context == SOURCE + "\n"
    assert doc.source == "a.py:documented[function]" and got["Box[class]"].doc is None


def test_syntax_error_gives_no_rows(spark):
    assert parsed(spark, "from {{x}} import y") == {}
    assert parsed(spark, "") == {}


def definitions(spark, *intervals):
    rows = [("f", l, r, i) for i, (l, r) in enumerate(intervals)]
    return spark.createDataFrame(rows, "fn STRING, l INT, r INT, seq INT")


def hits(spark, lines, intervals, **kw):
    df = spark.createDataFrame([("f", x) for x in lines], "fn STRING, line INT")
    found = coverage.line_intervals(df, definitions(spark, *intervals), **kw).collect()
    return sorted((r.line, r.l, r.r) for r in found)


def test_lookup_stops_at_the_first_interval_without_the_line(spark):
    assert hits(spark, [8], [(1, 20), (2, 5), (7, 10)]) == [(8, 7, 10)]
    assert hits(spark, [8], [(1, 20), (2, 5), (7, 10)], strict=True) == [(8, 1, 20), (8, 7, 10)]
    assert hits(spark, [3], [(1, 20), (2, 5), (7, 10)]) == [(3, 1, 20), (3, 2, 5)]


@pytest.mark.parametrize("seed", range(4))
def test_lookup_against_brute_force(spark, seed):
    rng = random.Random(seed)
    intervals = sorted({(l, l + rng.randrange(600)) for l in (rng.randrange(3000) for _ in range(60))})
    lines = rng.sample(range(3700), 150)
    walked, plain = [], []
    for x in lines:
        candidates = [i for i in intervals if i[0] <= x]
        plain += [(x, *i) for i in candidates if x <= i[1]]
        while candidates and x <= candidates[-1][1]:
            walked.append((x, *candidates.pop()))
    assert hits(spark, lines, intervals) == sorted(walked)
    assert hits(spark, lines, intervals, strict=True) == sorted(plain)
    assert hits(spark, lines, intervals, block=7) == sorted(walked)


def test_last_definition_of_an_interval_wins(spark):
    got = coverage.latest_definitions(definitions(spark, (1, 5), (1, 5), (2, 3))).collect()
    assert sorted((r.l, r.r, r.seq) for r in got) == [(1, 5, 1), (2, 3, 2)]


def test_tests_of_a_definition(spark):
    ctx = spark.createDataFrame(
        [("f", 3, "t::a[1]|run"), ("f", 4, "t::a[2]|run"), ("f", 4, "t::b|run"), ("f", 4, ""), ("f", 90, "t::c"), ("g", 3, "t::d")],
        "fn STRING, line INT, context STRING")
    tests = coverage.definition_tests(ctx, definitions(spark, (1, 9)))
    assert sorted(r.test for r in tests.collect()) == ["t::a", "t::b|run"]
    outcomes = spark.createDataFrame([("t::a", "failed"), ("t::b", "passed"), ("t::c", "passed")], "nodeid STRING, outcome STRING")
    got = coverage.definition_outcomes(tests, outcomes).collect()
    assert sorted((r.list, r.nodeid) for r in got) == [("FAIL_TO_PASS", "t::a"), ("PASS_TO_PASS", "t::b")]
    table = definitions(spark, (1, 9), (50, 60)).withColumn("doc", F.lit("d")).withColumn("intent_type", F.lit("function"))
    assert tuple(coverage.good_candidates(coverage.problem_table(table, tests, outcomes)).first()) == (1, 2)


def test_coverage_rate_rounds_half_to_even(spark):
    lines = spark.createDataFrame([("f", 1), ("f", 1), ("f", 2), ("f", 100)], "fn STRING, line INT")
    got = {(r.l, r.r): r.coverage_rate for r in coverage.coverage_rate(lines, definitions(spark, (1, 32), (1, 3), (50, 60), (2, 33))).collect()}
    assert got == {(1, 32): 6.25, (1, 3): 66.67, (50, 60): 0.0, (2, 33): 3.12}


def test_rebase_and_duplicates(spark):
    df = spark.createDataFrame([("/h/runs/x1/src/a.py",), ("/other/a.py",)], "p STRING")
    got = [r[0] for r in df.select(coverage.rebase_path(F.col("p"), "/h/runs/")).collect()]
    assert got == ["/run_dir/src/a.py", "/other/a.py"]
    names = spark.createDataFrame([("a",), ("a",), ("b",)], "source STRING")
    assert [(r.source, r.n) for r in coverage.duplicate_sources(names).collect()] == [("a", 2)]


def test_runs_do_not_mix(spark):
    """Two runs share a path and a test name; a file repeats in both."""
    files = spark.createDataFrame([(1, "a.py", "def f():\n    x = 1\n"), (2, "a.py", "def g():\n    x = 1\n")], "run INT, path STRING, source STRING")
    found = coverage.parse_definitions(files, keys=["run"])
    assert sorted((r.run, r.intent_name) for r in coverage.latest_definitions(found, ["run"]).collect()) == [(1, "f"), (2, "g")]
    assert coverage.definition_contexts(found, files, keys=["run"]).count() == 2
    lines = spark.createDataFrame([(1, "a.py", 2, "t|run"), (2, "a.py", 2, "t|run")], "run INT, fn STRING, line INT, context STRING")
    outcomes = spark.createDataFrame([(1, "t", "passed"), (2, "t", "failed"), (2, "u", "passed"), (2, "u", "failed")], "run INT, nodeid STRING, outcome STRING")
    table = jobs.collect_tasks(files, lines, outcomes, keys=["run"])
    got = sorted((r.run, r.intent_name, r.n_tests, r.n_pass_to_pass, r.n_fail_to_pass, r.coverage_rate) for r in table.collect())
    assert got == [(1, "f", 1, 1, 0, 50.0), (2, "g", 1, 0, 1, 50.0)]
    assert [tuple(r) for r in coverage.duplicate_outcomes(outcomes, ["run"]).collect()] == [(2, "u", 2)]


def test_deep_expression_is_reported(spark):
    files = spark.createDataFrame([("deep.py", "x = " + "+".join(["1"] * 200_000)), ("bad.py", "def ("), ("ok.py", "def f(): pass")], "path STRING, source STRING")
    got = {r.fn: r.parse_error for r in coverage.parse_definitions(files, errors=True).collect()}
    assert got["bad.py"] == "syntax" and got["ok.py"] is None and got.get("deep.py") in (None, "too_deep")
    assert [r.fn for r in coverage.parse_definitions(files).collect()] == ["ok.py"]


def test_intervals_become_few_nodes(spark):
    """A file of a million lines: an interval has at most six nodes per level, and a line meets each interval once."""
    rng = random.Random(5)
    n = 1_000_000
    intervals = sorted({tuple(sorted((rng.randrange(n), rng.randrange(n)))) for _ in range(40)} | {(0, n - 1), (0, 0), (1, n - 1), (63, 64), (n - 1, n - 1)})
    block = lambda name: F.floor(F.col(name) / 64) + 1
    df = definitions(spark, *intervals)
    sizes = df.select(F.size(coverage.tree_nodes(block("l"), block("r"))).alias("n")).agg(F.max("n")).first()[0]
    assert sizes <= 6 * math.ceil(math.log(n / 64, 4))
    lines = [*range(0, n, 997), 1, 62, 63, 64, 65, n - 1]
    want = sorted((x, *i) for x in lines for i in intervals if i[0] <= x <= i[1])
    assert hits(spark, lines, intervals, strict=True) == want


def test_nodes_are_the_blocks(spark):
    rows = [(a, b) for a in range(1, 12) for b in (*range(a, 34), 1000)]
    df = spark.createDataFrame(rows, "a LONG, b LONG").select("a", "b", coverage.tree_nodes(F.col("a"), F.col("b")).alias("n"))
    for r in df.collect():
        assert sorted(b for k, i in r.n for b in range(i << 2 * k, (i + 1) << 2 * k)) == list(range(r.a, r.b + 1))


def snapshots(spark, runs):
    sources = {"a.py": "def f():\n    pass\n", "b.py": "class C:\n    def m(self):\n        pass\n", "copy_of_a.py": "def f():\n    pass\n", "bad.py": "def (", "none.py": None, "empty.py": ""}
    rows = [(run, path, source) for run in runs for path, source in sources.items()]
    return spark.createDataFrame(rows, "run INT, path STRING, source STRING")


def test_equal_sources_are_parsed_once(spark, tmp_path):
    rows_of = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    five = snapshots(spark, range(5))
    for errors in (False, True):
        want = rows_of(coverage.parse_definitions(five, keys=["run"], errors=errors))
        assert rows_of(coverage.parse_distinct(five, keys=["run"], errors=errors)) == want
        assert rows_of(coverage.parse_distinct(five, keys=["run"], errors=errors, cache=str(tmp_path / "cache"))) == want
    # 4 different texts in 25 files; the second call had nothing to parse
    calls = sorted(spark.read.parquet(str(p)).count() for p in (tmp_path / "cache" / "texts").iterdir())
    assert calls == [0, 4]
    more = snapshots(spark, [7]).unionByName(spark.createDataFrame([(7, "new.py", "def g(): pass")], "run INT, path STRING, source STRING"))
    got = coverage.parse_distinct(more, keys=["run"], cache=str(tmp_path / "cache"))
    assert rows_of(got) == rows_of(coverage.parse_definitions(more, keys=["run"]))
    assert sorted(spark.read.parquet(str(p)).count() for p in (tmp_path / "cache" / "texts").iterdir()) == [0, 1, 4]


def test_sources_are_computed_once(spark, tmp_path):
    """a source that an expression makes was made again for each filter and each use."""
    calls = spark.sparkContext.accumulator(0)

    def body(n):
        calls.add(1)
        return f"def f_{n}(x):\n    return x\n"

    files = spark.range(6).select(F.col("id").alias("run"), F.lit("a.py").alias("path"), F.udf(body, "string")(F.col("id") % 2).alias("source"))
    lines = spark.createDataFrame([(1, "a.py", 2, "t|run")], "run LONG, fn STRING, line INT, context STRING")
    outcomes = spark.createDataFrame([(1, "t", "passed")], "run LONG, nodeid STRING, outcome STRING")
    got = jobs.collect_tasks(files, lines, outcomes, keys=["run"], folder=str(tmp_path / "definitions")).collect()
    assert sorted((r.run, r.intent_name, r.n_pass_to_pass) for r in got) == [(i, f"f_{i % 2}", int(i == 1)) for i in range(6)]
    assert calls.value == 6
    assert [p.name for p in tmp_path.iterdir()] == ["definitions"]
