import pytest

from benchloom.operators import stdout_logs as logs
from benchloom.operators import evaluate
from pyspark.sql import functions as F


def named(df):
    return [(r.name, r.status) for r in df.orderBy("pos").collect()]


PYTEST = """header
===== test session starts =====
t.py::test_a PASSED
__________ test_b __________
E  boom
____________ test_c ____________
= short test summary info =
FAILED t.py::test_b[x] - assert
ERROR  pkg/t.py::ñandú
XPASSED t.py::test_d
== 1 failed, 2 passed, 3 skipped, 2 warnings in 0.1s ==
== 4 passed, 1 xpassed ==
"""


def run(one, text):
    return one(run_id="r", stdout=text)


def test_pytest(one):
    df = run(one, PYTEST)
    assert named(logs.pytest_tests(df)) == [
        ("t.py::test_b", "FAILED"), ("pkg/t.py::ñandú", "ERROR"), ("t.py::test_d", "PASSED")]
    s = logs.pytest_summary(df).first()
    assert (s.passed, s.failed, s.error, s.skipped, s.warning, s.xpassed, s.xfailed) == (4, 1, 0, 3, 2, 1, 0)
    assert s.total == 5 and s.status == "unknown"
    assert s.list_skipped == ["3 skipped"] and s.list_xfailed == []
    parts = logs.pytest_sections(df).first()
    assert parts.out == PYTEST[len("header\n"):]
    assert parts.summary_raw.startswith("= short test summary info =\nFAILED")
    assert parts.failures == ["test_b", "test_c"]


@pytest.mark.parametrize("line, status", [
    ("2 passed", "passed"), ("1 xpassed", "passed"), ("", "failed"), ("1 failed", "failed"),
    ("1 passed, 1 xfailed", "unknown"), ("3 passed, 1 error", "unknown"),
])
def test_pytest_state(one, line, status):
    assert logs.pytest_summary(run(one, line)).first().status == status


MOCHA = "  suite\n    ✓ works (3ms)\n    1) breaks\n    ✓ again\n\n  2 passing (9ms)\n  1 failing\n  3 pending\n\n  1) suite\n  breaks:\n  Error\n"


def test_mocha(one):
    df = run(one, MOCHA)
    assert named(logs.mocha_tests(df)) == [
        ("works (3ms)", "PASSED"), ("again", "PASSED"), ("breaks", "FAILED"), ("suite", "FAILED")]
    s = logs.mocha_summary(df).first()
    assert (s.passed, s.failed, s.skipped, s.total, s.status) == (2, 1, 3, 3, "unknown")
    assert len(s.failures) == 1 and s.summary_raw.startswith("\n    1) breaks")


JEST = "PASS src/a.test.js\nFAIL src/b.test.tsx\n  ● b > breaks\n    expected\n  ● b > too\nTests:       1 failed, 2 skipped, 3 passed, 6 total\nSnapshots:   0 total\nTime:        1.2 s\n"


def test_jest(one):
    df = run(one, JEST)
    assert named(logs.jest_tests(df)) == [("src/a.test.js", "PASS"), ("src/b.test.tsx", "FAIL")]
    s = logs.jest_summary(df).first()
    assert (s.passed, s.failed, s.skipped, s.total, s.status) == (3, 1, 2, 6, "unknown")
    assert s.failures == ["● b > breaks\n    expected", "● b > too"]
    assert s.summary_raw == "Tests:       1 failed, 2 skipped, 3 passed, 6 total"


def test_jest_without_totals(one):
    s = logs.jest_summary(run(one, "PASS a.test.js")).first()
    assert s.parse_error == "no_summary" and s.passed is None and s.status is None


def test_framework(one):
    kind = lambda text: run(one, text).select(logs.detect_framework(F.col("stdout"))).first()[0]
    assert (kind(MOCHA), kind(JEST), kind("nothing"), kind("PASS x\n1 passing")) == ("mocha", "jest", "unknown", "unknown")
    zero = logs.javascript_summary(run(one, "nothing")).first()
    assert (zero.framework, zero.total, zero.status) == ("unknown", 0, "unknown")
    assert logs.javascript_summary(run(one, JEST)).first().total == 6
    assert len(named(logs.javascript_tests(run(one, MOCHA)))) == 4
    assert named(logs.javascript_tests(run(one, "nothing"))) == []


@pytest.mark.parametrize("text, total, failed, status", [
    ("[info] - adds up\n[info] - x", 1, 0, "passed"),
    ("[info] All tests passed.\n[info] - adds up", 2, 0, "passed"),
    ("[info] - adds up\n[Success] done", 1, 0, "passed"),
    ("[success] a\n[success] b", 1, 0, "passed"),
    ("[info] - adds up\n[error] Failed: Total 3, Failed: 2\n[error] Failed: 1", 1, 1, "failed"),
    ("[error] Failed: 2", 0, 2, "unknown"),
])
def test_sbt(one, text, total, failed, status):
    s = logs.sbt_summary(run(one, text)).first()
    assert (s.total, s.failed, s.status) == (total, failed, status)


def test_sbt_empty_and_names(one):
    assert logs.sbt_summary(run(one, "")).count() == 0
    assert named(logs.sbt_tests(run(one, "[info] [info] - adds up \n[info] -"))) == [("- adds up", "passed")]


MAVEN = "\n".join([
    "[INFO]  T E S T S",
    "[INFO] Tests run: 3, Failures: 0",
    "[ERROR] /src/A.java:[1,2] error: cannot find symbol",
    "[ERROR]   symbol:   class Foo of the package",
    "[ERROR] /src/A.java:[3,4] something new",
    "[ERROR] short",
    "x.AssertionFailedError: expected 1",
    "\tat com.a.T.check(T.java:3)",
    "java.lang.IllegalStateException: bad",
    "\tat nowhere",
    "[INFO] Tests run: 7, Failures: 1",
    "[INFO] BUILD SUCCESS",
])


def test_maven(one):
    df = run(one, MAVEN).withColumn("path", F.lit("/src/A.java")).withColumn("other", F.lit("/src/B.java"))
    s = logs.maven_summary(df).first()
    assert (s.success, s.compiled, s.tests, s.n_errors, s.parse_error) == (True, True, 7, 2, None)
    assert logs.maven_summary(df, path="path").first().compiled is False
    assert logs.maven_summary(df, path="other").first().compiled is True
    errors = logs.maven_errors(df).orderBy("pos").collect()
    assert [e.type for e in errors] == ["symbol_not_found", "something new"]
    assert errors[0].full_text == errors[0].message + "\n" + errors[0].message
    found = logs.maven_compile_errors(df, "path").orderBy("pos").collect()
    assert [(e.type, e.details) for e in found] == [
        ("error: cannot find symbol", "symbol:   class Foo of the package"), ("something new", None)]
    stack = logs.maven_stack_errors(df).orderBy("pos").collect()
    assert [(e.kind, e.text, e.method) for e in stack] == [
        ("assertion", " expected 1", "check"), ("runtime", " bad", None)]


@pytest.mark.parametrize("message, kind", logs.MAVEN_KINDS)
def test_maven_kinds(one, message, kind):
    assert logs.maven_errors(run(one, f"[ERROR] x:[1,2] a {message} b")).first().type == kind


def test_maven_first_kind_wins(one):
    line = "[ERROR] x:[1,2] cannot find symbol, has private access in Y"
    assert logs.maven_errors(run(one, line)).first().type == "private_access"


def test_maven_bad_count(one):
    s = logs.maven_summary(run(one, "[INFO] Tests run: many")).first()
    assert s.tests is None and s.parse_error == "bad_test_count"


def test_testgen_score(one):
    builds = logs.maven_summary(run(one, MAVEN)).withColumn("success", F.lit(None).cast("boolean"))
    row = evaluate.testgen_score(builds).first()
    assert row["pass@1"] == 0.0 and row["compile@1"] == 1.0
