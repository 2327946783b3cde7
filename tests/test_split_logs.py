"""Split files against one cell per log, cut at sizes from a few bytes to the whole file."""

import json
from pathlib import Path

import pytest

from benchloom.operators import patches, reports, split_logs, stdout_logs
from benchloom.sources import files


def event(**fields):
    return json.dumps(fields)


GO = [event(Action="run", Package="p", Test="A"), event(Action="output", Package="p", Test="A", Output="first\n"), "{broken",
      event(Action="fail", Package="p", Test="A", Elapsed=1.5), "", event(Action="output", Package="p", Test="A", Output="late\n"),
      event(Action="pass", Package="p", Test="B/ü"), event(Action="pass", Package="p", Test="A", Elapsed=2.5), event(Action="fail", Package="q")]
RUST = [event(type="test", event="ok", name="a"), event(type="suite", event="ok", passed=3, failed=1, ignored=0), "not json",
        event(type="test", event="failed", name="b"), event(type="suite", event="started"), event(type="suite", event="failed", passed=5, failed=2),
        event(type="test", event="ok", name="c"), event(type="test", event="ignored", name="d"), ""]
SBT = ["[info] compiling", "[SUCCESS] x", "[info] - a test", "[info] -", "[error] Failed: Total 4, Failed: 7", "[error] Failed: nothing",
       "[info] All tests passed."]
MAVEN = ["[INFO]  T E S T S", "[ERROR] /src/T.java:[3,4] cannot find symbol", "[INFO] Tests run: 3, Failures: 0", "[INFO] Tests run: 12, Failures: 0",
         "[ERROR] other", "[INFO] BUILD SUCCESS"]
PYTEST = ["plugins", "=== test session starts ===", "FAILED a.py::t", "1 passed, 2 failed", "= short test summary info =", "4 passed, 1 error, 3 warnings"]
DIFF = ["preamble", "diff --git a/x.py b/x.py", "@@ -1 +1 @@", "+1", "diff --git broken", "+lost", "diff --git a/y.py b/y.py", "+2", "",
        "diff --git a/x.py b/x.py", "+3"]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(params=[16, 64, 1 << 20])
def cut(spark, request):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = {name: spark.conf.get(name) for name in names}
    for name in names:
        spark.conf.set(name, str(request.param))
    yield request.param
    for name, value in old.items():
        spark.conf.set(name, value)


def both(spark, folder, logs):
    """The logs as files and as cells; one of them repeated so that it spans many splits."""
    logs = {**logs, "many": [line for lines in [*logs.values()] * 5 for line in lines]}
    for name, lines in logs.items():
        Path(folder, f"{name}.log").write_bytes("\n".join(lines).encode())
    cells = spark.createDataFrame([(name, "\n".join(lines)) for name, lines in logs.items()], "path string, text string")
    from pyspark.sql import functions as F

    name = F.regexp_extract("_metadata.file_path", r"([^/]*)\.log$", 1)
    return files.read_log_lines(spark, str(folder), "*.log", name), cells


def test_go(spark, tmp_path, cut):
    lines, cells = both(spark, tmp_path, {"a": GO, "b": GO[::-1]})
    events = split_logs.go_events(lines)
    keys = ("path",)
    assert rows_of(reports.go_tests_of(events, keys)) == rows_of(reports.go_tests(cells, keys=keys))
    assert rows_of(reports.go_packages_of(events, keys)) == rows_of(reports.go_packages(cells, keys=keys))
    assert rows_of(reports.go_summary_of(events, keys)) == rows_of(reports.go_summary(cells, keys=keys))


def test_rust(spark, tmp_path, cut):
    lines, cells = both(spark, tmp_path, {"a": RUST, "b": RUST[::-1], "tests": RUST[:1], "none": ["", "x"]})
    assert rows_of(split_logs.rust_summary(lines)) == rows_of(reports.rust_summary(cells, keys=("path",)))


def test_sbt_maven_pytest(spark, tmp_path, cut):
    lines, cells = both(spark, tmp_path, {"s": SBT, "t": SBT[::-1], "m": MAVEN, "n": MAVEN[::-1], "p": PYTEST, "q": PYTEST[::-1]})
    keys = ("path",)
    assert rows_of(split_logs.sbt_summary(lines)) == rows_of(stdout_logs.sbt_summary(cells, "text", keys))
    assert rows_of(split_logs.maven_summary(lines)) == rows_of(stdout_logs.maven_summary(cells, "text", keys))
    counters = ["path", *stdout_logs.PYTEST_COUNTERS, "total", "status"]
    assert rows_of(split_logs.pytest_summary(lines)) == rows_of(stdout_logs.pytest_summary(cells, "text", keys).select(*counters))
    # an operator over single lines takes the rows as they are
    found = stdout_logs.pytest_tests(lines, "line", ("path", "at")).select("path", "name", "status")
    assert rows_of(found) == rows_of(stdout_logs.pytest_tests(cells, "text", keys).select("path", "name", "status"))
    out = {r.path: r.out for r in stdout_logs.pytest_sections(cells, "text", keys).collect()}
    session = {}
    for r in split_logs.pytest_session(lines).orderBy("path", "at").collect():
        session.setdefault(r.path, []).append(r.line)
    assert {k: "\n".join(v) for k, v in session.items()} == {k: v for k, v in out.items() if v}


def test_named_path_forces_no_compile(spark, tmp_path, cut):
    from pyspark.sql import functions as F

    lines, cells = both(spark, tmp_path, {"m": MAVEN})
    with_path = lambda df: df.withColumn("full_path", F.lit("/src/T.java"))
    got = split_logs.maven_summary(with_path(lines), ("path", "full_path"), "full_path").drop("full_path")
    assert rows_of(got) == rows_of(stdout_logs.maven_summary(with_path(cells), "text", ("path",), "full_path"))


def test_diff_sections_across_splits(spark, tmp_path, cut):
    lines, cells = both(spark, tmp_path, {"d": DIFF, "e": DIFF[3:], "none": ["no header"]})
    assert rows_of(split_logs.diff_files(lines)) == rows_of(patches.diff_files(cells, "text").select("path", "position", "file", "diff"))


def test_line_numbers(spark, tmp_path, cut):
    lines, cells = both(spark, tmp_path, {"a": [str(i) for i in range(500)], "b": ["", "é\r", ""], "c": []})
    numbered = files.with_line_numbers(lines)
    want = {(r.path, i, line) for r in cells.collect() for i, line in enumerate(r.text.split("\n")[: -1 if r.text.endswith("\n") else None]) if r.text}
    assert {(r.path, r.line_no, r.line) for r in numbered.collect()} == want


def test_files_are_split(spark, tmp_path, cut):
    lines, _ = both(spark, tmp_path, {"a": GO * 20})
    splits = lines.select("at.path", "at.start").distinct().count()
    assert splits == 2 if cut == 1 << 20 else splits > 50


def test_places_of_diffs_are_counted_without_their_texts(spark):
    rows = [("l", ("p", 0, i), x) for i, x in enumerate(["diff --git a/x b/x", "+1", "diff --git a/y b/y", "+2", "diff --git a/x b/x", "+3"])]
    lines = spark.createDataFrame(rows, "path string, at struct<path: string, start: long, id: long>, line string")
    found = split_logs.diff_files(lines)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("Window [row_number")
    want = [(0, "x", "diff --git a/x b/x\n+3"), (1, "y", "diff --git a/y b/y\n+2")]
    assert sorted(map(tuple, found.select("position", "file", "diff").collect())) == want
