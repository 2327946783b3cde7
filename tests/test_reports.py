import json

import pytest
from pyspark.sql import functions as F

from benchloom.operators import reports


def rep(one, text):
    return one(run_id="r", text=text)


CASES = (
    '<testcase name="ok" classname="c" time="1.5"/>'
    '<testcase name="bad"><failure message="m &amp; n">why</failure><error/></testcase>'
    '<testcase name="err"><error/></testcase>'
    '<testcase name="skip"><skipped/></testcase>'
)
SUITE = f'<testsuite name="s" tests="4" failures="1" errors="1" skipped="1">{CASES}</testsuite>'


def cases(df):
    return [(r.name, r.status, r.message, r.details) for r in df.collect()]


@pytest.mark.parametrize("text", [SUITE, f"<testsuites>{SUITE}</testsuites>", f'<?xml version="1.0"?>\n<testsuites>\n{SUITE}\n</testsuites>'])
def test_junit(one, text):
    assert cases(reports.junit_cases(rep(one, text))) == [
        ("ok", "passed", None, None), ("bad", "failed", "m & n", "why"), ("err", "error", "", ""), ("skip", "skipped", "", None)]
    s = reports.junit_summary(rep(one, text)).first()
    assert (s.total, s.passed, s.failed, s.errors, s.skipped, s.status) == (4, 1, 1, 1, 1, "failed")


def test_junit_nested_suites_sum_every_level_and_lose_root_cases(one):
    nested = f'<testsuite tests="9"><testcase name="lost"/><testsuite tests="4"><testcase name="mid"/>{SUITE}</testsuite></testsuite>'
    assert [c[0] for c in cases(reports.junit_cases(rep(one, nested)))] == ["mid", "ok", "bad", "err", "skip"]
    assert reports.junit_summary(rep(one, nested)).first().total == 8


def test_junit_malformed(one):
    s = reports.junit_summary(rep(one, "<testsuite")).first()
    assert s.parse_error == "malformed" and s.status is None and s.total is None
    assert cases(reports.junit_cases(rep(one, "<testsuite"))) == []


def test_junit_empty_report(one):
    empty = '<testsuite tests="0"/>'
    assert reports.junit_summary(rep(one, empty)).first().status == "passed"
    assert reports.junit_summary(rep(one, empty), need_tests=True).first().status == "failed"


def test_junit_php_class(one):
    text = '<testsuite tests="1"><testcase name="a" class="K" classname="N"/></testsuite>'
    assert reports.junit_cases(rep(one, text), class_attribute="class").first().classname == "K"


@pytest.mark.parametrize("body, status, message", [
    ("", "passed", None),
    ('<failure message="f" type="T">x</failure>', "failure", "f"),
    ('<failure message="f"/><system-err>e</system-err>', "system-error", "f"),
    ('<system-err>e</system-err><failure message="f"/>', "failure", "f"),
    ('<flakyFailure message="f"><system-err>e</system-err></flakyFailure>', "system-error", "f"),
    ('<error message="e"/><skipped message="s"/>', "skipped", "s"),
    ('<rerunError message="1 &gt; 0"/>', "error", "1 > 0"),
    ("<system-out><![CDATA[<error message='x'/>]]></system-out><!-- <skipped/> -->", "passed", None),
    ("<failure/>", "failure", None),
])
def test_surefire_state_is_that_of_the_last_tag(one, body, status, message):
    text = f'<testsuite name="com.A" tests="2"><testcase name="a &lt; b>c" classname="K">{body}</testcase><testcase name="n/" classname="K"/></testsuite>'
    got = reports.surefire_cases(rep(one, text)).orderBy("pos").collect()
    assert [(r.name, r.status) for r in got] == [("a < b>c", status), ("n/", "passed")]
    assert got[0].message == message


def test_surefire_suite_ids_and_lists(one):
    text = ('<testsuite name="com.A" tests="3" failures="1"><testcase name="a" classname="K"/>'
            '<testcase name="b" classname="K"><failure/></testcase><testcase name="c" classname="K"><skipped/></testcase></testsuite>')
    s = reports.surefire_suite(rep(one, text)).first()
    assert (s.name, s.tests, s.failures, s.errors, s.skipped) == ("com.A", 3, 1, 0, 0)
    got = reports.surefire_cases(rep(one, text))
    ids = [(r.nodeid, r.outcome) for r in reports.surefire_ids(got).orderBy("pos").collect()]
    assert ids == [("com.A a", "passed"), ("com.A b", "failed")]
    wide = reports.status_pivot(got, ["run_id", "suite"]).first()
    assert (wide["passed"], wide["failure"], wide["skipped"]) == (["a"], ["b"], ["c"])
    assert reports.status_lists(got, ["classname"]).count() == 3


@pytest.mark.parametrize("text", ["<testsuites><testsuite name='a'/></testsuites>", "<testsuite name='a'><testcase name='b'/>", ""])
def test_surefire_wrong_root_or_cut_off(one, text):
    assert reports.surefire_suite(rep(one, text)).first().parse_error == "malformed"
    assert reports.surefire_cases(rep(one, text)).count() == 0


@pytest.mark.parametrize("text", ['<testsuite tests="many"/>', '<testsuite tests="1"><testcase name="a" time="1,5"/></testsuite>'])
def test_junit_bad_number_voids_the_report(one, text):
    s = reports.junit_summary(rep(one, text)).first()
    assert (s.parse_error, s.total, s.status) == ("bad_number", None, None)
    assert reports.junit_cases(rep(one, text)).count() == 0


def test_ctest(one):
    text = ("<Site><Testing><TestList><Test>./x</Test></TestList>"
            "<Test><Status>passed</Status><Name>a</Name><Path>.</Path></Test>"
            '<Test Status="passed"><Name>b</Name><Results><Measurement>out</Measurement></Results></Test>'
            "<Test><Status>failed</Status><Path>.</Path></Test></Testing></Site>")
    got = [(r.name, r.classname, r.status, r.message) for r in reports.ctest_cases(rep(one, text)).collect()]
    assert got == [("a", ".", "passed", None), ("b", "", "failed", "out")]


def test_gtest(one):
    doc = {"tests": 2, "testsuites": [{"name": "S", "testsuite": [
        {"name": "a", "status": "RUN", "time": "0.5s", "failures": [{"failure": "f"}]},
        {"name": "b", "status": "NOTRUN", "time": "0s", "failures": [{"failure": "g"}]}]}]}
    get = lambda **kw: [(r.name, r.time, r.status, r.message) for r in reports.gtest_cases(rep(one, json.dumps(doc)), **kw).collect()]
    assert get() == [("a", 0.5, "passed", None), ("b", 0.0, "failed", "g")]
    assert get(strict=True)[0][2:] == ("failed", "f")
    s = reports.count_states(reports.gtest_cases(rep(one, json.dumps(doc)))).first()
    assert (s.total, s.passed, s.failed, s.status) == (2, 1, 1, "failed")


def test_rspec(one):
    doc = {"summary": {"example_count": 3, "failure_count": 1, "pending_count": 1}, "examples": [
        {"description": "d", "full_description": "f d", "status": "failed", "run_time": 0.5, "exception": {"message": "m", "backtrace": ["x"]}}]}
    s = reports.rspec_summary(rep(one, json.dumps(doc))).first()
    assert (s.total, s.passed, s.failed, s.skipped, s.status) == (3, 1, 1, 1, "failed")
    t = reports.rspec_tests(rep(one, json.dumps(doc))).first()
    assert (t.name, t.classname, t.status, t.message) == ("d", "f d", "failed", "m")
    assert reports.rspec_summary(rep(one, "{}")).first().status == "unknown"


def test_mocha_and_jest_dialects(one):
    text = '<testsuites tests="10" failures="2" errors="1" skipped="3"><testsuite/></testsuites>'
    js, ts = (reports.mocha_xml(rep(one, text), dialect=d).first() for d in ("javascript", "typescript"))
    assert (js.passed, js.errors, ts.passed, ts.errors, ts.skipped) == (8, None, 4, 1, 3)
    doc = json.dumps({"numTotalTests": 9, "numPassedTests": 4, "numFailedTests": 1, "numPendingTests": 2, "numTodoTests": 2})
    js, ts = (reports.jest_json(rep(one, doc), dialect=d).first() for d in ("javascript", "typescript"))
    assert (js.failed, js.skipped, ts.failed, ts.skipped) == (5, None, 1, 4)
    assert reports.jest_json(rep(one, "{}")).first().parse_error == "malformed"


def test_pytest_report(one):
    doc = {"tests": [{"nodeid": "a", "outcome": "passed"}, {"nodeid": "a", "outcome": "xfailed"}, {"nodeid": "b", "outcome": "passed"}]}
    got = reports.pytest_outcomes(rep(one, json.dumps(doc)))
    assert sorted((r.nodeid, r.outcome) for r in got.collect()) == [("a", "failed"), ("a", "passed"), ("b", "passed")]
    assert [(r.nodeid, r.n, r.n_passed) for r in reports.duplicate_tests(got).collect()] == [("a", 2, 1)]
    assert reports.pytest_outcomes(rep(one, "{bad")).count() == 0


def go(*events):
    keys = {"a": "Action", "p": "Package", "t": "Test", "e": "Elapsed", "o": "Output"}
    return "\n".join(e if isinstance(e, str) else json.dumps({keys[k]: v for k, v in e.items()}) for e in events)


def test_go_counts_events_and_keeps_the_last_state(one):
    text = go({"a": "run", "p": "p", "t": "T"}, {"a": "output", "p": "p", "t": "T", "o": "one\n"}, "{bad", "[1]",
              {"a": "fail", "p": "p", "t": "T", "e": 0.5}, {"a": "output", "p": "p", "t": "T", "o": "two"},
              {"a": "pass", "p": "p", "t": "T", "e": 0.25}, {"a": "run", "p": "p", "t": "U"}, {"a": "fail", "p": "p"})
    s = reports.go_summary(rep(one, text)).first()
    assert (s.total, s.passed, s.failed, s.skipped, s.status, s.bad_lines) == (2, 1, 1, 0, "failed", 2)
    got = {r.name: (r.status, r.time, r.message) for r in reports.go_tests(rep(one, text)).collect()}
    assert got == {"T": ("passed", 0.25, "one\ntwo"), "U": ("unknown", 0.0, None)}
    p = reports.go_packages(rep(one, text)).first()
    assert (p.name, p.status) == ("p", "failed")


def test_go_without_tests_falls_back_to_packages(one):
    text = go({"a": "start", "p": "a"}, {"a": "pass", "p": "b", "e": 1.0}, {"a": "fail", "p": "c"})
    s = reports.go_summary(rep(one, text)).first()
    assert (s.total, s.passed, s.failed, s.status) == (3, 1, 1, "unknown")
    assert reports.go_summary(rep(one, "")).first().total == 0


def rust(*events):
    return "\n".join(e if isinstance(e, str) else json.dumps(e) for e in events)


def test_rust_suite_event_overrides_and_later_tests_add(one):
    test = lambda event: {"type": "test", "event": event, "name": event, "stdout": "out"}
    suite = {"type": "suite", "event": "failed", "passed": 5, "failed": 1, "ignored": 2}
    s = reports.rust_summary(rep(one, rust(test("ok"), suite, test("ok"), test("ignored"), "junk"))).first()
    assert (s.total, s.passed, s.failed, s.skipped, s.status, s.bad_lines) == (8, 6, 1, 3, "failed", 1)
    s = reports.rust_summary(rep(one, rust(test("ok"), test("started")))).first()
    assert (s.total, s.passed, s.status) == (1, 1, "passed")
    t = reports.rust_tests(rep(one, rust(test("failed"), test("ok")))).orderBy("pos").collect()
    assert [(r.status, r.message) for r in t] == [("failed", "out"), ("passed", None)]


def summaries(spark, *rows):
    return spark.createDataFrame(rows, "run_id STRING, total INT, passed INT, failed INT, skipped INT, errors INT, status STRING, seq INT")


def test_merge_drops_empty_reports(spark):
    df = summaries(spark, ("r", 2, 1, 0, 1, 0, "passed", 1), ("r", 0, 0, 0, 0, 9, "failed", 2), ("r", 3, 3, 0, 0, 0, "passed", 3), ("q", 0, 0, 0, 0, 0, "passed", 1))
    got = reports.merge_reports(df).collect()
    assert [(r.run_id, r.total, r.passed, r.status) for r in got] == [("r", 5, 4, "passed")]
    first = reports.first_report(df, "seq").where("run_id = 'r'").first()
    assert first.total == 2


def test_merge_keeps_the_tests_of_counted_reports(one, spark):
    empty = '<testsuite tests="0"><testcase name="x"/></testsuite>'
    both = rep(one, SUITE).withColumn("path", F.lit("a")).unionByName(rep(one, empty).withColumn("path", F.lit("b")))
    keys = ["run_id", "path"]
    total = reports.junit_summary(both, keys=keys)
    kept = reports.merge_tests(reports.junit_cases(both, keys=keys), total, keys)
    assert sorted(r.name for r in kept.collect()) == ["bad", "err", "ok", "skip"]
    assert reports.junit_cases(both, keys=keys, skip_empty=True).count() == 4


def test_choose_js_report(spark):
    side = lambda *ids: spark.createDataFrame([(i, n) for i, n in ids], "run_id STRING, total INT")
    mocha, jest = side(("a", 1), ("b", 2)), side(("b", 3), ("c", 4))
    get = lambda d: sorted(tuple(r) for r in reports.choose_js_report(mocha, jest, dialect=d).collect())
    assert get("typescript") == [("a", "mocha", 1), ("b", "jest", 3), ("c", "jest", 4)]
    assert get("javascript") == [("a", "mocha", 1), ("b", "jest", 3), ("b", "mocha", 2), ("c", "jest", 4)]


def test_envelope(spark):
    runs = spark.createDataFrame([("a", 1, "", False), ("b", 1, "", False), ("c", 0, "", True)], "run_id STRING, returncode INT, stderr STRING, late BOOLEAN")
    ddl = "run_id STRING, total INT, passed INT, failed INT, skipped INT, status STRING"
    report = spark.createDataFrame([("a", 2, 2, 0, 0, "passed")], ddl)
    parsed = spark.createDataFrame([("a", 9, 9, 0, 0, "x"), ("b", 3, 1, 2, 0, "unknown")], ddl)
    big = lambda df: df.select(*[F.col(c).cast("bigint").alias(c) if t == "int" else F.col(c) for c, t in df.dtypes])
    got = {r.run_id: r for r in reports.run_envelope(runs, big(report), big(parsed), timed_out="late").collect()}
    assert (got["a"].returncode, got["a"].total, got["a"].has_report) == (0, 2, True)
    assert (got["b"].returncode, got["b"].total) == (1, 3)
    assert (got["c"].returncode, got["c"].stderr, got["c"].total, got["c"].status) == (2, "Timeout exception", 0, "unknown")
    both = {r.run_id: r for r in reports.run_envelope(runs, big(report), big(parsed), prefer_report=False).collect()}
    assert both["a"].total == 9 and both["a"].has_report


def test_jacoco(spark):
    cov = spark.createDataFrame([("A", 3, 1, 1), ("A", 0, 9, 2), ("B", 0, 0, 3)], "CLASS STRING, INSTRUCTION_COVERED INT, INSTRUCTION_MISSED INT, row_no INT")
    wanted = spark.createDataFrame([("A",), ("B",), ("C",)], "class_name STRING")
    got = {r.class_name: r.coverage for r in reports.jacoco_ratio(cov, wanted).collect()}
    assert got == {"A": 0.75, "B": 0.0, "C": None}


def test_format(one):
    kind = lambda s: one(t=s).select(reports.report_format(F.col("t"))).first()[0]
    assert (kind(" \n{"), kind("[1]"), kind("<x/>"), kind("")) == ("json", "json", "xml", "xml")


@pytest.mark.parametrize("depth", [1, 3, 12, 13, 50, 200])
def test_junit_at_any_depth(one, depth):
    text = "<testsuites>" + '<testsuite tests="1">' * depth + '<testcase name="a"/>' + "</testsuite>" * depth + "</testsuites>"
    df = one(run_id="r", text=text)
    assert reports.junit_summary(df).first()["total"] == depth
    assert [r.name for r in reports.junit_cases(df).collect()] == ["a"]


def test_junit_shallow_suites_beside_deep_ones(one):
    """Cases of every level are found once, comments and CDATA with tags in them change nothing."""
    deep = '<testsuite tests="1"><testcase name="d"/>' * 40 + "</testsuite>" * 40
    text = ('<testsuite tests="7"><testcase name="lost"/><!-- <testsuite tests="5"> --><testsuite tests="2"/>' + deep +
            '<testcase name="lost"/><testsuite name="a>b" tests="1"><properties><testcase name="no"/></properties><testcase name="e">'
            '<failure message="m"><![CDATA[</testsuite> <testsuite tests="9">]]></failure></testcase></testsuite><testcase name="lost"/></testsuite>')
    assert reports.junit_summary(rep(one, text)).first()["total"] == 43
    got = cases(reports.junit_cases(rep(one, text)))
    assert [c[0] for c in got] == ["d"] * 40 + ["e"] and got[-1][3] == '</testsuite> <testsuite tests="9">'


SYNTAX_ERRORS = {
    "open tag": "<testsuite name='s'><b></testsuite>", "crossed tags": "<testsuite name='s'><a><b></a></b></testsuite>",
    "cut off": "<testsuite name='s'><testcase name='a' classname='c'/>", "attribute twice": "<testsuite name='s' x='1' x='2'/>",
    "no quotes": "<testsuite name='s' x=1/>", "no value": "<testsuite name='s' x/>", "< in a value": "<testsuite name='s' x='<'/>",
    "unknown entity": "<testsuite name='s'>&foo;</testsuite>", "bare ampersand": "<testsuite name='s'>a & b</testsuite>",
    "ampersand in a value": "<testsuite name='&'/>", "character 0": "<testsuite name='s'>&#0;</testsuite>", "control character": "<testsuite name='s'>\x01</testsuite>",
    "two roots": "<testsuite name='s'/><testsuite name='t'/>", "two long roots": "<testsuite name='s'></testsuite><testsuite name='t'></testsuite>",
    "another root": "<testsuite name='s'></testsuite><b/>", "text behind": "<testsuite name='s'/>x", "text before": "x<testsuite name='s'/>",
    "no root": "<!-- c -->", "bad name": "<testsuite name='s'><1a/></testsuite>", "-- in a comment": "<testsuite name='s'><!-- a -- b --></testsuite>",
    "open CDATA": "<testsuite name='s'><![CDATA[x</testsuite>", "]]> in text": "<testsuite name='s'>]]></testsuite>",
    "late declaration": "<testsuite name='s'/><?xml version='1.0'?>", "open comment": "<testsuite name='s'/><!-- x", "open instruction": "<testsuite name='s'><?pi x</testsuite>",
    "attribute in an end tag": "<testsuite name='s'></testsuite x='1'>", "space before a name": "< testsuite name='s'/>", "no space": "<testsuite name='s'x='2'/>",
    "noncharacter": "<testsuite name='s'>\uffff</testsuite>", "prefix": "<testsuite name='s'><p:a/></testsuite>",
}


def test_no_rows_of_text_that_is_not_well_formed(spark):
    whole = lambda text: text.replace("'/>", "'><testcase name='a' classname='c'/></testsuite>")
    rows = [(what, whole(text) if what in ("text behind", "late declaration") else text) for what, text in SYNTAX_ERRORS.items()]
    df = spark.createDataFrame(rows, "run_id STRING, text STRING")
    for found in (reports.surefire_suite(df), reports.junit_summary(df)):
        assert {r.run_id: r.parse_error for r in found.collect()} == dict.fromkeys(SYNTAX_ERRORS, "malformed")
    assert reports.surefire_cases(df).count() == 0 and reports.junit_cases(df).count() == 0


@pytest.mark.parametrize("text", [
    '\ufeff<testsuite name="s" tests="1"/>'[1:], "<?xml version='1.0' encoding='UTF-8'?>\n<!DOCTYPE testsuite>\n<!-- </testsuite> --><testsuite name='s' tests='1'>\n</testsuite>\n<!-- end -->\n<?pi x?>\n",
    "<testsuite name='a > b' tests='1'>&#65;&#x42;&amp;<testsuite-x/><ns:a xmlns:ns='u'/></testsuite>", "<testsuite name='s' tests='1'><b><testsuitex/></b><![CDATA[ ]] > ]]></testsuite>",
])
def test_well_formed_texts_are_read(one, text):
    assert reports.surefire_suite(rep(one, text)).first().tests == 1
    assert reports.junit_summary(rep(one, text)).first()["total"] == 1


def test_surefire_error_bodies(one):
    text = ('<testsuite name="s" tests="4">'
            '<testcase name="a" classname="c"><failure type="T" message="m"><![CDATA[at <init> & co]]> &lt;more&gt;<!-- no --> end<b/>not this</failure>'
            '<system-err>first</system-err><system-err><![CDATA[boom]]></system-err></testcase>'
            '<testcase name="b" classname="c"><failure>one</failure><rerunError type="E">two &#x263A;</rerunError></testcase>'
            '<testcase name="d" classname="c"><error type="E"/><skipped>because</skipped></testcase><testcase name="e" classname="c"/></testsuite>')
    got = [(r.name, r.status, r.error_type, r.full_error, r.system_error) for r in reports.surefire_cases(rep(one, text)).orderBy("pos").collect()]
    assert got == [("a", "system-error", "T", "at <init> & co <more> end", "boom"), ("b", "error", "E", "two ☺", None), ("d", "skipped", "E", None, None), ("e", "passed", None, None, None)]
    lists = reports.surefire_lists(rep(one, text)).first()
    assert (lists["system-error"], lists["error"], lists["skipped"], lists["passed"], lists["failure"]) == (["a"], ["b"], ["d"], ["e"], [])


def test_envelope_of_errors(spark):
    runs = spark.createDataFrame([("a", 1, ""), ("b", 1, "")], "run_id STRING, returncode INT, stderr STRING")
    report = spark.createDataFrame([("a", 3, 2, 0, 0, 1, 5, "failed"), ("b", 2, 2, 0, 0, 0, 2, "passed")],
                                   "run_id STRING, total LONG, passed LONG, failed LONG, skipped LONG, errors LONG, collected LONG, status STRING")
    got = lambda **options: {r.run_id: (r.returncode, r.errors, r.collected) for r in reports.run_envelope(runs, report, **options).collect()}
    assert got() == {"a": (0, 1, 5), "b": (0, 0, 2)} and got(errors_fail=True) == {"a": (1, 1, 5), "b": (0, 0, 2)}


def test_go_reports_of_one_run_keep_their_lines_together(one, spark):
    log = lambda *texts: "\n".join(json.dumps({"Action": "output", "Package": "p", "Test": "T", "Output": t}) for t in texts)
    df = spark.createDataFrame([("r", log("a1 ", "a2 ", "a3 ")), ("r", log("b1 ", "b2 "))], "run_id STRING, text STRING").coalesce(1)
    assert reports.go_tests(df).first().message == "a1 a2 a3 b1 b2 "


@pytest.mark.parametrize("text", ['<testsuites tests="3" failures="1"/>', '<foo tests="4"><testcase name="x"/></foo>'])
def test_root_that_is_no_suite_counts_nothing(one, text):
    df = one(run_id="r", text=text)
    row = reports.junit_summary(df).first()
    assert (row["total"], row["failed"], row["parse_error"]) == (0, 0, None)
    assert reports.junit_cases(df).count() == 0


def test_merging_parses_reports_once(spark):
    from benchloom.plans import QUERIES

    found = QUERIES["merge_reports"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    single = QUERIES["junit_cases"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert found.count("from_xml") == single.count("from_xml") > 0


def test_counted_cases_are_the_test_rows(spark):
    texts = ['<testsuite tests="2"><testcase name="a"/><testcase name="b"/></testsuite>', '<testsuite tests="0"><testcase name="a"/></testsuite>', "<testsuite>", None, '<testsuite tests="3"/>']
    df = spark.createDataFrame(list(enumerate(texts)), "run_id long, text string")
    rows = reports.junit_summary(df, count_cases=True).where("total > 0").agg({"n_tests": "sum"}).first()[0]
    assert rows == reports.junit_cases(df, skip_empty=True).count() == 2


def test_an_attribute_is_searched_once(spark):
    from benchloom.functions import xml

    df = spark.createDataFrame([('<t name="a &amp; b">',), ("<t>",), ('<t name="">',), (None,)], "s string").select(xml.attribute(F.col("s"), "name").alias("v"))
    assert df._jdf.queryExecution().analyzed().toString().count("regexp_extract(") == 1
    assert [r["v"] for r in df.collect()] == ["a & b", None, "", None]
