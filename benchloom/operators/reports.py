"""Report files of test runners: XML and JSON documents, and event logs.

One report is one text cell.  Documents are parsed once per row with ``from_xml``
or ``from_json``; test rows come from exploding the parsed arrays.  Counters of a
report are computed inside its row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas
from ..functions.text import (
    WHITESPACE, all_matches, compute_once, count_where, explode_rows, last, let, lines, strip,
)
from ..functions.xml import (
    ATTRIBUTES, attribute, masked, own_text, prefix_sums, root_name, tag_steps, unmasked, well_formed,
)

Keys = Sequence[str]
COUNTERS = ("total", "passed", "failed", "skipped", "errors")
XML_OPTIONS = {"ignoreSurroundingSpaces": "false", "columnNameOfCorruptRecord": "_corrupt_record"}
JSON_OPTIONS = {"columnNameOfCorruptRecord": "_corrupt_record"}


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def report_format(text: Column) -> Column:
    """``json`` when the text starts with a brace or bracket, else ``xml``."""
    return F.when(strip(text).rlike(r"^[\{\[]"), "json").otherwise("xml")


def _json(col: Column, ddl: str) -> Column:
    return F.from_json(col, f"{ddl}, _corrupt_record STRING", JSON_OPTIONS)


def _parse_error(parsed: str) -> Column:
    bad = F.col(parsed).isNull() | F.col(f"{parsed}._corrupt_record").isNotNull()
    return F.when(bad, "malformed")


def event_of(line: Column, ddl: str) -> Column:
    """One parsed line of an NDJSON text; one that is no object is marked corrupt."""
    return _json(line, ddl)


def _events(text: Column, ddl: str) -> Column:
    """The parsed lines of an NDJSON text."""
    filled = F.filter(lines(strip(text)), lambda line: strip(line) != "")
    return F.transform(filled, lambda line: event_of(line, ddl))


def _good(event: Column) -> Column:
    return event["_corrupt_record"].isNull()


# --- JUnit, for all ecosystems ----------------------------------------------------


SUITE_TAG = rf"<(?:/testsuite\s*|testsuite(?=[\s/>]){ATTRIBUTES})>"


def _flat_suites(mask: Column) -> Column:
    """A JUnit document with all suites beside each other, however deep they nest.

    A suite becomes an empty element ``s`` with its attributes, in front of what it held; the text is cut at the tags
    of suites, and running sums over these tags say how deep each piece lies.  Whatever lies outside of suites goes,
    and so does the root's own part if the root is a suite that holds suites.
    """

    def flat(tags: Column) -> Column:
        opened = lambda tag: ~tag.startswith("</")
        several = F.size(F.filter(tags, opened)) > 1
        least = F.when((root_name(mask) == "testsuite") & several, 2).otherwise(1)

        def part(tag: Column, depth: Column, behind: Column) -> Column:
            alone = tag.endswith("/>")
            attributes = F.substring(tag, F.lit(11), F.length(tag) - F.when(alone, 12).otherwise(11))
            inside = depth + F.when(alone, 1).otherwise(0) >= least
            head = F.when(opened(tag) & inside, F.concat(F.lit("<s"), attributes, F.lit("/>"))).otherwise("")
            return F.concat(head, F.when(depth >= least, behind).otherwise(""))

        pieces = F.split(mask, SUITE_TAG, -1)
        steps = F.arrays_zip(tags.alias("tag"), prefix_sums(tag_steps(tags)).alias("depth"))
        joined = F.zip_with(steps, F.slice(pieces, F.lit(2), F.size(pieces)), lambda at, behind: part(at["tag"], at["depth"], behind))
        return F.concat(F.lit("<r>"), F.array_join(F.filter(joined, lambda x: x.isNotNull()), ""), F.lit("</r>"))

    return unmasked(let(all_matches(mask, SUITE_TAG), flat))


def parse_junit(reports: DataFrame, text: str = "text", keys: Keys = ("run_id",)) -> DataFrame:
    """Add ``_suites``, ``_cases`` and ``parse_error``; suites may nest at any depth.

    A text that is not well-formed is void, and so is one in which a count or time is no number.
    """
    xml = F.col(text)
    facts = let(masked(xml), lambda mask: F.struct(well_formed(xml, mask).alias("good"), mask.alias("mask")))
    parsed = compute_once(reports, keys, facts, "_facts")
    doc = F.from_xml(F.when(F.col("_facts.good"), _flat_suites(F.col("_facts.mask"))), F.lit(schemas.JUNIT), XML_OPTIONS)
    parsed = compute_once(parsed, keys, doc, "_doc")
    bad = lambda value, kind: value.isNotNull() & strip(value).try_cast(kind).isNull()
    counters = ("_tests", "_failures", "_errors", "_skipped")
    bad_count = lambda s: F.greatest(*[F.coalesce(bad(s[name], "bigint"), F.lit(False)) for name in counters])
    any_of = lambda array, test: F.coalesce(F.exists(array, test), F.lit(False))
    wrong = any_of("_doc.s", bad_count) | any_of("_doc.testcase", lambda c: bad(c["_time"], "double"))
    error = F.coalesce(_parse_error("_doc"), F.when(wrong, "bad_number"))
    checked = compute_once(parsed, [*keys, "_doc"], error, "parse_error")
    good = lambda value: F.when(F.col("parse_error").isNull(), value)
    return checked.select(*keys, "parse_error", good(F.coalesce("_doc.s", F.array())).alias("_suites"), good(F.col("_doc.testcase")).alias("_cases"))


def _junit_total(name: str) -> Column:
    number = lambda s: F.coalesce(strip(s[name]).try_cast("bigint"), _zero())
    return F.aggregate(F.col("_suites"), _zero(), lambda acc, s: acc + number(s))


def junit_cases(
    reports: DataFrame,
    text: str = "text",
    keys: Keys = ("run_id",),
    class_attribute: str = "classname",
    skip_empty: bool = False,
) -> DataFrame:
    """Test rows of JUnit reports.  Precedence: failure, error, skipped, passed.

    PHP reports name the class in ``class`` instead of ``classname``.  ``skip_empty``
    leaves out reports that count no test, as ``merge_reports`` does.
    """
    case = F.col("_case")
    first = lambda tag, field: F.get(case[tag], F.lit(0))[field]
    has = lambda tag: case[tag].isNotNull()
    pick = lambda field, tags: F.coalesce(
        *[F.when(has(t), F.coalesce(first(t, field), F.lit(""))) for t in tags]
    )
    kept = F.col("_cases")
    if skip_empty:
        kept = F.when(_junit_total("_tests") > 0, kept)
    return (
        explode_rows(parse_junit(reports, text, keys), keys, kept, value="_case")
        .select(
            *keys,
            case["_name"].alias("name"),
            case[f"_{class_attribute}"].alias("classname"),
            F.coalesce(strip(case["_time"]).try_cast("double"), F.lit(0.0)).alias("time"),
            F.when(has("failure"), "failed")
            .when(has("error"), "error")
            .when(has("skipped"), "skipped")
            .otherwise("passed")
            .alias("status"),
            pick("_message", ("failure", "error", "skipped")).alias("message"),
            F.when(has("failure") | has("error"), pick("_VALUE", ("failure", "error"))).alias("details"),
        )
    )


def junit_summary(
    reports: DataFrame,
    text: str = "text",
    keys: Keys = ("run_id",),
    need_tests: bool = False,
    count_cases: bool = False,
) -> DataFrame:
    """Counters from the suite attributes, summed over all levels.

    ``need_tests`` (C++ reports): a report without tests has failed.  ``count_cases`` adds ``n_tests``, the
    test rows that :func:`junit_cases` has of the report, without a second parse.
    """
    n = F.col
    cases = F.coalesce(F.size("_cases"), F.lit(0)).cast("bigint").alias("n_tests")
    more = [cases] if count_cases else []
    good = n("failed") + n("errors") == 0
    if need_tests:
        good = good & (n("total") > 0)
    return (
        parse_junit(reports, text, keys)
        .select(
            *keys,
            "parse_error",
            _junit_total("_tests").alias("total"),
            _junit_total("_failures").alias("failed"),
            _junit_total("_errors").alias("errors"),
            _junit_total("_skipped").alias("skipped"),
            *more,
        )
        .withColumn("passed", n("total") - n("failed") - n("errors") - n("skipped"))
        .select(
            *keys,
            *COUNTERS,
            n("total").alias("collected"),
            F.when(good, "passed").when(n("parse_error").isNull(), "failed").alias("status"),
            "parse_error",
            *(["n_tests"] if count_cases else []),
        )
    )


# --- Surefire ---------------------------------------------------------------------

# The states of a Surefire test case, and the tags that decide it.
STATES = ("passed", "failure", "error", "skipped", "system-error")
SUREFIRE_STATE = {
    "failure": "failure", "rerunFailure": "failure", "flakyFailure": "failure",
    "error": "error", "rerunError": "error", "flakyError": "error",
    "skipped": "skipped", "system-err": "system-error",
}


def _surefire_root(reports: DataFrame, text: str, keys: Keys) -> DataFrame:
    """``_xml``, the masked text, its ``_root`` tag and ``parse_error``.

    The text must be well-formed, the root a ``testsuite`` with a name, and every case named.
    """
    n = F.col
    xml = F.col(text)
    facts = let(masked(xml), lambda mask: F.struct(mask.alias("xml"), well_formed(xml, mask).alias("good")))
    parsed = compute_once(reports, keys, facts, "_facts").select(*keys, n("_facts.xml").alias("_xml"), n("_facts.good").alias("_good"))
    root = F.regexp_extract(n("_xml"), rf"<[\p{{L}}_]{ATTRIBUTES}>", 0)
    named = n("_root").rlike(r"\sname\s*=")
    good = n("_good") & n("_root").rlike(r"^<testsuite[\s/>]") & named
    rows = compute_once(parsed, [*keys, "_xml", "_good"], root, "_root")
    return rows.withColumn("parse_error", F.when(~F.coalesce(good, F.lit(False)), "malformed")).drop("_good")


def surefire_suite(reports: DataFrame, text: str = "text", keys: Keys = ("run_id",)) -> DataFrame:
    """Name and counters in the root tag of a Surefire report."""
    root = F.when(F.col("parse_error").isNull(), F.col("_root"))
    count = lambda name: F.coalesce(attribute(root, name).try_cast("bigint"), F.when(root.isNotNull(), _zero()))
    return _surefire_root(reports, text, keys).select(
        *keys,
        attribute(root, "name").alias("name"),
        *[count(name).alias(name) for name in ("tests", "skipped", "failures", "errors")],
        "parse_error",
    )


# The tags of a fault, whose text is the full error.
SUREFIRE_FAULTS = tuple(tag for tag in SUREFIRE_STATE if tag not in ("skipped", "system-err"))
CASE_HEAD = rf"<testcase(?=[\s/>]){ATTRIBUTES}"


def _surefire_texts(xml: Column) -> Column:
    """The test cases of a masked report, each as text."""
    return all_matches(xml, rf"(?s){CASE_HEAD}(?:(?<=/)>|>.*?</testcase\s*>)")


def _surefire_tags(case: Column) -> Column:
    """The deciding start tags of a case, each with the text behind it, the case's own first."""
    return all_matches(case, rf"<(?:testcase|{'|'.join(SUREFIRE_STATE)})(?=[\s/>]){ATTRIBUTES}>[^<]*")


def _surefire_state(tags: Column) -> Column:
    def state_of(last_name: Column) -> Column:
        state = F.lit("passed")
        for tag, name in SUREFIRE_STATE.items():
            state = F.when(last_name == tag, name).otherwise(state)
        return state

    return let(F.regexp_extract(last(tags), r"^<([\w-]+)", 1), state_of)


def surefire_cases(reports: DataFrame, text: str = "text", keys: Keys = ("run_id",)) -> DataFrame:
    """Test rows of Surefire reports, with the name of their suite.

    The state is that of the **last** deciding tag in document order, however deep; ``error_type`` and ``full_error``
    (the text of the element before any child) are those of the last fault, ``system_error`` the text of the last
    ``system-err``.  A tag name inside a comment or CDATA section is no tag.
    """
    n = F.col
    name_of = lambda tag: F.regexp_extract(tag, r"^<([\w-]+)", 1)
    start_of = lambda tag: F.regexp_extract(tag, rf"^<{ATTRIBUTES}>", 0)
    newest = lambda names: last(F.filter("_tags", lambda tag: name_of(tag).isin(*names)))

    def text_of(tag: Column) -> Column:
        behind = lambda start: F.when(~start.endswith("/>"), F.substring(tag, F.length(start) + 1, F.length(tag)))
        told = let(let(start_of(tag), behind), own_text)
        return let(told, lambda x: F.when(x != "", x))

    good = _surefire_root(reports, text, keys).where(n("parse_error").isNull())
    good = good.withColumn("suite", attribute(n("_root"), "name"))
    rows = explode_rows(good, [*keys, "suite"], _surefire_texts(n("_xml")), value="_case")
    tagged = compute_once(rows, [*keys, "suite", "pos"], _surefire_tags(n("_case")), "_tags")
    found = F.struct(
        F.get("_tags", F.lit(0)).alias("_head"), _surefire_state(n("_tags")).alias("status"),
        newest(SUREFIRE_FAULTS).alias("_fault"), newest((*SUREFIRE_FAULTS, "skipped")).alias("_told"), newest(("system-err",)).alias("_system"),
    )
    chosen = compute_once(tagged, [*keys, "suite", "pos"], found, "_found").select(*keys, "suite", "pos", "_found.*")
    return chosen.select(
        *keys, "suite", "pos",
        attribute(start_of(n("_head")), "name").alias("name"),
        attribute(start_of(n("_head")), "classname").alias("classname"),
        "status",
        attribute(start_of(n("_told")), "message").alias("message"),
        attribute(start_of(n("_fault")), "type").alias("error_type"),
        text_of(n("_fault")).alias("full_error"),
        text_of(n("_system")).alias("system_error"),
    )


def surefire_lists(reports: DataFrame, text: str = "text", keys: Keys = ("run_id",)) -> DataFrame:
    """``keys, suite`` and one list of test names per state, in document order, made inside the row of the report."""
    good = _surefire_root(reports, text, keys).where(F.col("parse_error").isNull()).withColumn("suite", attribute(F.col("_root"), "name"))
    test = lambda tags: F.struct(attribute(F.get(tags, F.lit(0)), "name").alias("name"), _surefire_state(tags).alias("status"))
    tests = F.transform(_surefire_texts(F.col("_xml")), lambda case: let(_surefire_tags(case), test))
    listed = lambda state: F.transform(F.filter("_tests", lambda x: x["status"] == state), lambda x: x["name"]).alias(state)
    return compute_once(good, [*keys, "suite"], tests, "_tests").select(*keys, "suite", *[listed(state) for state in STATES])


def surefire_ids(cases: DataFrame) -> DataFrame:
    """``"suite test"`` ids with an outcome; skipped tests are left out.

    A report describes one class, so the name of the suite stands for the class.
    """
    outcome = F.when(F.col("status") == "passed", "passed").when(F.col("status") != "skipped", "failed")
    rows = cases.withColumn("nodeid", F.concat_ws(" ", "suite", "name")).withColumn("outcome", outcome)
    return rows.where(F.col("outcome").isNotNull())


def status_lists(cases: DataFrame, group: Sequence[str], order: str = "pos") -> DataFrame:
    """Names per state in long form: ``group, status, position, name``.

    One row per name, so a class of any size is never gathered in one cell; the
    wide forms are ``surefire_lists``, inside the row of a report, and ``status_pivot``.
    """
    return cases.select(*group, "status", F.col(order).alias("position"), "name")


def status_pivot(cases: DataFrame, group: Sequence[str], order: str = "pos") -> DataFrame:
    """One row per report and suite with one sorted name list per state.

    ``group`` must hold the report key: a list is then never longer than its report.
    """
    listed = F.transform(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("p"), F.col("name").alias("n")))),
        lambda e: e["n"],
    )
    return cases.groupBy(*group).pivot("status", list(STATES)).agg(listed)


# --- CTest, gtest, mocha, jest, rspec ---------------------------------------------

CTEST = """STRUCT<Testing: ARRAY<STRUCT<Test: ARRAY<STRUCT<
  Name: STRING, Path: STRING, Status: STRING,
  Results: STRUCT<Measurement: ARRAY<STRUCT<Value: STRING, _VALUE: STRING>>>>>>>,
  _corrupt_record: STRING>"""


def ctest_cases(reports: DataFrame, text: str = "text", keys: Keys = ("run_id",)) -> DataFrame:
    """Tests of a CTest ``Site`` document; whatever is not ``passed`` has failed.

    The ``Status`` child is what counts.  The message is the text of the first
    measurement, as far as it has text of its own.
    """
    doc = F.from_xml(F.col(text), F.lit(CTEST), {**XML_OPTIONS, "attributePrefix": "_a_"})
    test = F.col("_t")
    ok = test["Status"] == "passed"
    note = F.get(test["Results"]["Measurement"], F.lit(0))
    told = F.when(~F.coalesce(ok, F.lit(False)) & note.isNotNull(), F.coalesce(note["_VALUE"], F.lit("")))
    tests = F.flatten(F.transform(doc["Testing"], lambda t: t["Test"]))
    return (
        explode_rows(reports, keys, tests, value="_t")
        .where(test["Name"].isNotNull())
        .select(
            *keys,
            "pos",
            test["Name"].alias("name"),
            F.coalesce(test["Path"], F.lit("")).alias("classname"),
            F.when(ok, "passed").otherwise("failed").alias("status"),
            told.alias("message"),
            told.alias("details"),
        )
    )


def _state_summary(parsed: DataFrame, keys: Keys, states: Column, error: Column, without_tests: str) -> DataFrame:
    """Counters of the states in the row of a report; a report without tests has zeros.

    A malformed report has a ``parse_error`` and no counters.
    """
    n = F.col
    rows = compute_once(parsed.withColumn("parse_error", error), [*keys, "parse_error"], F.coalesce(states, F.array()), "_states")
    state = lambda *names: F.when(n("parse_error").isNull(), count_where("_states", lambda x: x.isin(*names)))
    total = F.when(n("parse_error").isNull(), F.size("_states").cast("bigint"))
    counted = rows.select(
        *keys,
        total.alias("total"),
        state("passed").alias("passed"),
        state("failed").alias("failed"),
        state("skipped").alias("skipped"),
        state("error").alias("errors"),
        total.alias("collected"),
        "parse_error",
    )
    bad = n("failed") + n("errors") > 0
    status = F.when(n("total") == 0, without_tests).when(bad, "failed").when(n("total") > 0, "passed")
    return counted.select(*keys, *COUNTERS, "collected", status.alias("status"), "parse_error")


def ctest_summary(reports: DataFrame, text: str = "text", keys: Keys = ("run_id",)) -> DataFrame:
    """Counters of CTest documents; one without tests has failed."""
    doc = F.from_xml(F.col(text), F.lit(CTEST), {**XML_OPTIONS, "attributePrefix": "_a_"})
    tests = F.filter(F.flatten(F.transform(F.col("_doc.Testing"), lambda t: t["Test"])), lambda t: t["Name"].isNotNull())
    states = F.transform(tests, lambda t: F.when(t["Status"] == "passed", "passed").otherwise("failed"))
    return _state_summary(compute_once(reports, keys, doc, "_doc"), keys, states, _parse_error("_doc"), "failed")


def gtest_summary(reports: DataFrame, text: str = "text", keys: Keys = ("run_id",)) -> DataFrame:
    """Counters of gtest JSON reports, or of their generic form; one without tests is ``unknown``."""
    ran = lambda c: F.when(F.coalesce(c["status"], F.lit("RUN")) == "RUN", "passed").otherwise("failed")
    suites = F.transform(F.col("_doc.testsuites"), lambda s: F.transform(F.coalesce(s["testsuite"], F.array()), ran))
    generic = F.transform(F.col("_doc.tests"), lambda t: F.coalesce(t["status"], F.lit("unknown")))
    states = F.when(F.col("_doc.testsuites").isNotNull(), F.flatten(suites)).otherwise(generic)
    # a field of another type, such as the number of tests, is no error: only text that is no JSON is
    unread = F.col("_doc.testsuites").isNull() & F.col("_doc.tests").isNull()
    error = F.when(unread & F.get_json_object("_doc._corrupt_record", "$").isNull(), _parse_error("_doc"))
    parsed = compute_once(reports, keys, _json(F.col(text), schemas.GTEST), "_doc")
    return _state_summary(parsed, keys, states, error, "unknown")


def count_states(tests: DataFrame, keys: Keys = ("run_id",)) -> DataFrame:
    """A summary counted from test rows (partial counts are summed before the exchange)."""
    n = F.col
    state = lambda name: F.count_if(n("status") == name)
    return (
        tests.groupBy(*keys)
        .agg(
            F.count("*").alias("total"),
            state("passed").alias("passed"),
            state("failed").alias("failed"),
            state("skipped").alias("skipped"),
            state("error").alias("errors"),
        )
        .withColumn("collected", n("total"))
        .withColumn("status", F.when(n("failed") + n("errors") == 0, "passed").otherwise("failed"))
    )


def gtest_cases(
    reports: DataFrame, text: str = "text", keys: Keys = ("run_id",), strict: bool = False
) -> DataFrame:
    """Tests of a gtest JSON report, or of its generic ``tests`` form.

    ``RUN`` means passed, even with failures listed; ``strict`` looks at them.
    """
    suite, case = F.col("_s"), F.col("_c")
    ok = F.coalesce(case["status"], F.lit("RUN")) == "RUN"
    if strict:
        ok = ok & (F.coalesce(F.size(case["failures"]), F.lit(0)) <= 0)
    told = F.when(~ok & (F.size(case["failures"]) > 0), F.get(case["failures"], F.lit(0))["failure"])
    parsed = compute_once(reports, keys, _json(F.col(text), schemas.GTEST), "_doc")
    suites = explode_rows(parsed, keys, F.col("_doc.testsuites"), value="_s")
    suites = (
        explode_rows(suites, [*keys, "_s"], F.col("_s.testsuite"), "_p", "_c")
        .select(
            *keys,
            F.coalesce(case["name"], F.lit("")).alias("name"),
            F.coalesce(suite["name"], F.lit("")).alias("classname"),
            F.rtrim(F.coalesce(case["time"], F.lit("0")), F.lit("s")).try_cast("double").alias("time"),
            F.when(ok, "passed").otherwise("failed").alias("status"),
            told.alias("message"),
            told.alias("details"),
        )
    )
    bare = F.when(F.col("_doc.testsuites").isNull(), F.col("_doc.tests"))
    generic = (
        explode_rows(parsed, keys, bare, "_p", "_c")
        .select(
            *keys,
            case["name"].alias("name"),
            case["classname"].alias("classname"),
            case["time"].alias("time"),
            F.coalesce(case["status"], F.lit("unknown")).alias("status"),
            F.lit(None).cast("string").alias("message"),
            F.lit(None).cast("string").alias("details"),
        )
    )
    return suites.unionByName(generic)


def rspec_tests(reports: DataFrame, text: str = "text", keys: Keys = ("run_id",)) -> DataFrame:
    example = F.col("_e")
    return (
        explode_rows(reports, keys, _json(F.col(text), schemas.RSPEC)["examples"], value="_e")
        .select(
            *keys,
            "pos",
            F.coalesce(example["description"], F.lit("")).alias("name"),
            F.coalesce(example["full_description"], F.lit("")).alias("classname"),
            F.coalesce(example["run_time"], F.lit(0.0)).alias("time"),
            F.coalesce(example["status"], F.lit("unknown")).alias("status"),
            F.when(
                example["exception"].isNotNull(), F.coalesce(example["exception"]["message"], F.lit(""))
            ).alias("message"),
            F.when(
                example["exception"].isNotNull(), F.coalesce(example["exception"]["backtrace"], F.lit(""))
            ).alias("details"),
        )
    )


def failed_first(failed: Column, total: Column) -> Column:
    return (
        F.when((failed == 0) & (total > 0), "passed").when(failed > 0, "failed").otherwise("unknown")
    )


def rspec_summary(reports: DataFrame, text: str = "text", keys: Keys = ("run_id",)) -> DataFrame:
    n = F.col
    count = lambda name: F.coalesce(F.col(f"_doc.summary.{name}"), _zero())
    return (
        compute_once(reports, keys, _json(F.col(text), schemas.RSPEC), "_doc")
        .select(
            *keys,
            _parse_error("_doc").alias("parse_error"),
            count("example_count").alias("total"),
            count("failure_count").alias("failed"),
            count("pending_count").alias("skipped"),
        )
        .withColumn("passed", n("total") - n("failed") - n("skipped"))
        .withColumn("errors", _zero())
        .select(*keys, *COUNTERS, failed_first(n("failed"), n("total")).alias("status"), "parse_error")
    )


def mocha_xml(
    reports: DataFrame, text: str = "text", keys: Keys = ("run_id",), dialect: str = "typescript"
) -> DataFrame:
    """Totals in the root of a mocha report.

    The ``javascript`` dialect knows passed and failed only; ``typescript`` also takes
    errors and skipped tests off the passed ones.
    """
    ddl = f"STRUCT<{schemas.MOCHA.replace(' STRING', ': STRING')}, _corrupt_record: STRING>"
    doc = F.from_xml(F.col(text), F.lit(ddl), XML_OPTIONS)
    n = F.col
    count = lambda name: F.coalesce(F.col(f"_doc.{name}").try_cast("bigint"), _zero())
    rows = compute_once(reports, keys, doc, "_doc").select(
        *keys,
        F.col("_doc._tests").try_cast("bigint").alias("total"),
        F.col("_doc._failures").try_cast("bigint").alias("failed"),
        (count("_errors") if dialect == "typescript" else F.lit(None).cast("bigint")).alias("errors"),
        (count("_skipped") if dialect == "typescript" else F.lit(None).cast("bigint")).alias("skipped"),
    )
    passed = n("total") - n("failed")
    if dialect == "typescript":
        passed = passed - n("errors") - n("skipped")
    missing = n("total").isNull() | n("failed").isNull()
    return rows.withColumn("passed", passed).select(
        *keys, *COUNTERS, n("total").alias("collected"), F.when(missing, "malformed").alias("parse_error")
    )


def jest_json(
    reports: DataFrame, text: str = "text", keys: Keys = ("run_id",), dialect: str = "typescript"
) -> DataFrame:
    """Totals of a jest report; pending and todo tests have failed in the ``javascript``
    dialect and are skipped in ``typescript``."""
    doc = F.col("_doc")
    open_tests = lambda default: default(doc["numPendingTests"]) + default(doc["numTodoTests"])
    if dialect == "typescript":
        lenient = lambda c: F.coalesce(c, _zero())
        failed, skipped, errors = doc["numFailedTests"], open_tests(lenient), _zero()
    else:
        failed = doc["numFailedTests"] + open_tests(lambda c: c)
        skipped = errors = F.lit(None).cast("bigint")
    n = F.col
    missing = n("total").isNull() | n("passed").isNull() | n("failed").isNull()
    return (
        compute_once(reports, keys, _json(F.col(text), schemas.JEST), "_doc")
        .select(
            *keys,
            doc["numTotalTests"].alias("total"),
            doc["numPassedTests"].alias("passed"),
            failed.alias("failed"),
            skipped.alias("skipped"),
            errors.alias("errors"),
        )
        .select(
            *keys, *COUNTERS, n("total").alias("collected"), F.when(missing, "malformed").alias("parse_error")
        )
    )


def pytest_outcomes(reports: DataFrame, text: str = "text", keys: Keys = ("run_id",)) -> DataFrame:
    """Node ids of a pytest JSON report; whatever is not ``passed`` has failed."""
    test = F.col("_t")
    return (
        explode_rows(reports, keys, _json(F.col(text), schemas.PYTEST_REPORT)["tests"], value="_t")
        .select(
            *keys,
            test["nodeid"].alias("nodeid"),
            F.when(test["outcome"] == "passed", "passed").otherwise("failed").alias("outcome"),
        )
    )


def duplicate_tests(outcomes: DataFrame, keys: Keys = ("run_id",)) -> DataFrame:
    """Node ids that a run reports more than once, which makes its report invalid."""
    seen = outcomes.groupBy(*keys, "nodeid").agg(
        F.count("*").alias("n"), F.count_if(F.col("outcome") == "passed").alias("n_passed")
    )
    return seen.where(F.col("n") > 1)


# --- event logs -------------------------------------------------------------------

# The actions that end a Go test.
GO_STATUS = {"pass": "passed", "fail": "failed", "skip": "skipped"}


def _go_status(action: Column) -> Column:
    status = F.lit(None).cast("string")
    for name, value in GO_STATUS.items():
        status = F.when(action == name, value).otherwise(status)
    return status


def _go_rows(reports: DataFrame, text: str, keys: Keys, every: bool = False) -> DataFrame:
    """The events of the logs; with ``every`` also bad lines and logs without a line."""
    events = _events(F.col(text), schemas.GO_EVENT)
    # a run may have several reports: the rows of one stay together, in the order of the table
    numbered = reports.withColumn("_report", F.monotonically_increasing_id())
    if every:
        rows = numbered.select(*keys, "_report", F.posexplode_outer(events).alias("pos", "_e"))
    else:
        rows = explode_rows(numbered, [*keys, "_report"], events, value="_e").where(_good(F.col("_e")))
    return go_event_rows(rows.withColumn("pos", F.struct("_report", "pos")), keys)


def go_event_rows(rows: DataFrame, keys: Keys) -> DataFrame:
    """Event rows of parsed lines ``keys, pos, _e``; ``pos`` is of any type that orders the lines of a log."""
    text_of = lambda name: F.coalesce(F.col(f"_e.{name}"), F.lit(""))
    return rows.select(
        *keys,
        "pos",
        text_of("Action").alias("action"),
        text_of("Package").alias("package"),
        text_of("Test").alias("test"),
        F.coalesce("_e.Elapsed", F.lit(0.0)).alias("elapsed"),
        F.col("_e.Output").alias("output"),
        F.col("_e._corrupt_record").isNotNull().alias("bad"),
    )


def go_tests(reports: DataFrame, text: str = "text", keys: Keys = ("run_id",)) -> DataFrame:
    """Last state and time of every Go test, with its output in order.

    Tests are told apart by ``package/test``.  The output of one test of one report
    is all that is ever gathered in a cell.
    """
    return go_tests_of(_go_rows(reports, text, keys), keys)


def go_tests_of(events: DataFrame, keys: Keys = ("run_id",)) -> DataFrame:
    """:func:`go_tests` of event rows."""
    status = _go_status(F.col("action"))
    ended = F.when(status.isNotNull(), F.col("pos"))
    piece = F.when(
        (F.col("action") == "output") & F.col("output").isNotNull(), F.struct("pos", "output")
    )
    output = F.transform(F.array_sort(F.collect_list(piece)), lambda p: p["output"])
    grouped = (
        events.where((F.col("test") != "") & ~F.col("bad"))
        .groupBy(*keys, F.concat_ws("/", "package", "test").alias("test_key"))
        .agg(
            F.min_by("test", "pos").alias("name"),
            F.min_by("package", "pos").alias("classname"),
            F.max_by("elapsed", ended).alias("_time"),
            F.max_by(status, ended).alias("_status"),
            output.alias("_output"),
        )
    )
    told = F.when(F.size("_output") > 0, F.array_join("_output", ""))
    return grouped.select(
        *keys,
        "name",
        "classname",
        F.coalesce("_time", F.lit(0.0)).alias("time"),
        F.coalesce("_status", F.lit("unknown")).alias("status"),
        told.alias("message"),
        told.alias("details"),
    )


def go_packages(reports: DataFrame, text: str = "text", keys: Keys = ("run_id",)) -> DataFrame:
    """Last state of every Go package (events without a test name)."""
    return go_packages_of(_go_rows(reports, text, keys), keys)


def go_packages_of(events: DataFrame, keys: Keys = ("run_id",)) -> DataFrame:
    """:func:`go_packages` of event rows."""
    status = _go_status(F.col("action"))
    ended = F.when(status.isNotNull(), F.col("pos"))
    return (
        events.where((F.col("test") == "") & (F.col("package") != "") & ~F.col("bad"))
        .groupBy(*keys, F.col("package").alias("name"))
        .agg(
            F.max_by(status, ended).alias("status"),
            F.coalesce(F.max_by("elapsed", ended), F.lit(0.0)).alias("elapsed"),
        )
    )


def merge_packages(packages: DataFrame, keys: Keys, order: str = "run_id") -> DataFrame:
    """The packages of several reports as one list per run: of a repeated package the last counts."""
    row = F.struct("status", "elapsed")
    merged = packages.groupBy(*keys, "name").agg(F.max_by(row, order).alias("_p"))
    return merged.select(*keys, "name", "_p.*")


def go_summary(reports: DataFrame, text: str = "text", keys: Keys = ("run_id",)) -> DataFrame:
    """Counters of a Go event log: end events of tests, or package states without any.

    Two aggregations over one exploded log: per package, then per report.  Lines that
    are no events are counted in ``bad_lines``.
    """
    return go_summary_of(_go_rows(reports, text, keys, every=True), keys)


def go_summary_of(events: DataFrame, keys: Keys = ("run_id",)) -> DataFrame:
    """:func:`go_summary` of event rows, bad lines among them."""
    n = F.col
    status = _go_status(n("action"))
    ended = F.when(status.isNotNull(), n("pos"))
    per_package = (
        events.groupBy(*keys, "package", (n("test") != "").alias("is_test"))
        .agg(
            *[F.count_if(status == s).alias(f"n_{s}") for s in GO_STATUS.values()],
            F.max_by(status, ended).alias("last_status"),
            F.count_if("bad").alias("n_bad"),
        )
    )
    listed = ~n("is_test") & (n("package") != "")
    event = lambda s: F.sum(F.when(n("is_test"), n(f"n_{s}")).otherwise(_zero()))
    package = lambda s: F.count_if(listed & (n("last_status") == s))
    summed = per_package.groupBy(*keys).agg(
        *[event(s).alias(f"t_{s}") for s in GO_STATUS.values()],
        *[package(s).alias(f"p_{s}") for s in GO_STATUS.values()],
        F.count_if(listed).alias("n_packages"),
        F.sum("n_bad").alias("bad_lines"),
    )
    n_events = sum((n(f"t_{s}") for s in GO_STATUS.values()), _zero())
    has_tests = n("n_events") > 0
    total = F.when(has_tests, n("n_events")).otherwise(n("n_packages"))
    return summed.withColumn("n_events", n_events).select(
        *keys,
        total.alias("total"),
        *[F.when(has_tests, n(f"t_{s}")).otherwise(n(f"p_{s}")).alias(s) for s in GO_STATUS.values()],
        _zero().alias("errors"),
        total.alias("collected"),
        F.when(~has_tests, "unknown")
        .when(n("t_failed") == 0, "passed")
        .otherwise("failed")
        .alias("status"),
        "bad_lines",
    )


# The end events of a cargo test.
RUST_STATUS = {"ok": "passed", "failed": "failed", "ignored": "skipped"}


def _rust_status(event: Column) -> Column:
    status = F.lit(None).cast("string")
    for name, value in RUST_STATUS.items():
        status = F.when(event == name, value).otherwise(status)
    return status


def rust_tests(reports: DataFrame, text: str = "text", keys: Keys = ("run_id",)) -> DataFrame:
    event = F.col("_e")
    told = F.when(event["event"] == "failed", event["stdout"])
    return (
        explode_rows(reports, keys, _events(F.col(text), schemas.RUST_EVENT), value="_e")
        .where((event["type"] == "test") & event["event"].isin(list(RUST_STATUS)))
        .select(
            *keys,
            "pos",
            F.coalesce(event["name"], F.lit("")).alias("name"),
            F.lit("").alias("classname"),
            F.coalesce(event["exec_time"], F.lit(0.0)).alias("time"),
            _rust_status(event["event"]).alias("status"),
            told.alias("message"),
        )
    )


def rust_summary(reports: DataFrame, text: str = "text", keys: Keys = ("run_id",)) -> DataFrame:
    """Counters of a cargo log.

    A ``suite`` event sets the counters and later tests add to them, so the result
    is the last suite event plus the tests behind it: all within the row.
    """
    n = F.col
    events = n("_events")
    is_suite = lambda e: (e["type"] == "suite") & e["event"].isin("ok", "failed")
    at = F.array_max(F.transform(events, lambda e, i: F.when(is_suite(e), i)))
    suite = lambda field: F.coalesce(n("_suite")[field], _zero())
    behind = lambda kind: count_where(
        events, lambda e, i: (e["type"] == "test") & (e["event"] == kind) & (i > n("_at"))
    )
    n_tests = count_where(events, lambda e: (e["type"] == "test") & e["event"].isin(list(RUST_STATUS)))
    suite_total = suite("passed") + suite("failed") + suite("ignored")
    return (
        compute_once(reports, keys, _events(F.col(text), schemas.RUST_EVENT), "_events")
        .withColumn("_at", F.coalesce(at, F.lit(-1)))
        .withColumn("_suite", F.when(n("_at") >= 0, F.get(events, n("_at"))))
        .select(
            *keys,
            F.when(suite_total > 0, suite_total).otherwise(n_tests).alias("total"),
            (suite("passed") + behind("ok")).alias("passed"),
            (suite("failed") + behind("failed")).alias("failed"),
            (suite("ignored") + behind("ignored")).alias("skipped"),
            _zero().alias("errors"),
            count_where(events, lambda e: ~_good(e)).alias("bad_lines"),
        )
        .select(*keys, *COUNTERS, failed_first(n("failed"), n("total")).alias("status"), "bad_lines")
    )


# --- putting reports together -----------------------------------------------------


def merge_reports(summaries: DataFrame, keys: Keys = ("run_id",)) -> DataFrame:
    """One summary per run: reports without tests are dropped, counters are summed."""
    n = F.col
    names = [c for c in (*COUNTERS, "collected", "n_tests") if c in summaries.columns]
    good = (n("failed") + n("errors") == 0) & (n("total") > 0)
    return (
        summaries.where(n("total") > 0)
        .groupBy(*keys)
        .agg(*[F.sum(name).alias(name) for name in names])
        .withColumn("status", F.when(good, "passed").otherwise("failed"))
    )


def merge_tests(tests: DataFrame, summaries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The test rows of the reports that ``merge_reports`` keeps, for any kind of report."""
    kept = summaries.where(F.col("total") > 0).select(*keys).distinct()
    return tests.join(kept, list(keys), "left_semi")


def first_report(summaries: DataFrame, order: str, keys: Keys = ("run_id",)) -> DataFrame:
    """Rust: the first report of a run that could be read, nothing is merged."""
    usable = summaries.where(F.col("status").isNotNull())
    row = F.struct(*[c for c in summaries.columns if c not in keys])
    return usable.groupBy(*keys).agg(F.min_by(row, F.col(order)).alias("_r")).select(*keys, "_r.*")


def choose_js_report(
    mocha: DataFrame, jest: DataFrame, keys: Keys = ("run_id",), dialect: str = "typescript"
) -> DataFrame:
    """Pair the mocha and jest totals of a run.

    ``typescript`` takes jest when both exist; ``javascript`` returns both, so a run
    has up to two rows.  The columns of the totals are kept, plus ``source``.
    """
    names = [c for c in mocha.columns if c not in keys]
    one = lambda df, side: df.select(*keys, F.struct(*names).alias(side))
    paired = one(mocha, "mocha").join(one(jest, "jest"), list(keys), "full_outer")
    if dialect == "typescript":
        source = F.when(F.col("jest").isNotNull(), "jest").otherwise("mocha")
        return paired.select(
            *keys, source.alias("source"), F.coalesce("jest", "mocha").alias("_r")
        ).select(*keys, "source", "_r.*")
    sides = F.explode(
        F.array(*[F.struct(F.lit(s).alias("source"), F.col(s).alias("r")) for s in ("mocha", "jest")])
    )
    return (
        paired.select(*keys, sides.alias("_s"))
        .where(F.col("_s.r").isNotNull())
        .select(*keys, "_s.source", "_s.r.*")
    )


def run_envelope(
    runs: DataFrame,
    reports: DataFrame,
    stdout_summaries: DataFrame | None = None,
    keys: Keys = ("run_id",),
    prefer_report: bool = True,
    zero_returncode: bool = True,
    timed_out: str | None = None,
    errors_fail: bool = False,
) -> DataFrame:
    """The result row of a run, with the counts of errors and collected tests of its report.

    ``prefer_report``: the report, else the parsed console text, else zeros; without
    it the parsed console text is the parser result (the report stays beside it).
    ``zero_returncode``: a run whose tests all passed returns 0; with ``errors_fail`` (C++) tests
    with errors have not passed.  A run that ran into its time limit (a boolean column) has code 2 and a
    fixed error text.  A summary without ``errors`` has none, one without ``collected`` has collected its total.
    """
    names = ["total", "passed", "failed", "skipped", "errors", "collected"]

    def side(df: DataFrame, alias: str) -> DataFrame:
        absent = {"errors": _zero(), "collected": F.col("total")}
        counts = [F.col(name) if name in df.columns else absent[name].alias(name) for name in names]
        return df.select(*keys, F.struct(*counts, "status").alias(alias))

    rows = runs.join(side(reports, "_report"), list(keys), "left")
    if stdout_summaries is not None:
        rows = rows.join(side(stdout_summaries, "_parsed"), list(keys), "left")
    else:
        rows = rows.withColumn("_parsed", F.col("_report"))
    nothing = F.struct(*[_zero().alias(c) for c in names], F.lit("unknown").alias("status"))
    order = ["_report", "_parsed"] if prefer_report else ["_parsed"]
    rows = rows.withColumn("_r", F.coalesce(*order, nothing))
    code = F.col("returncode")
    if timed_out is not None:
        late = F.col(timed_out)
        code = F.when(late, 2).otherwise(code)
        rows = rows.withColumn(
            "stderr", F.when(late, "Timeout exception").otherwise(F.col("stderr"))
        )
    if zero_returncode:
        bad = F.col("_report.failed") + (F.col("_report.errors") if errors_fail else _zero())
        all_passed = (F.col("_report.total") > 0) & (bad == 0)
        code = F.when(all_passed, 0).otherwise(code)
    return rows.withColumn("returncode", code.cast("int")).select(
        *runs.columns, F.col("_report").isNotNull().alias("has_report"), "_r.*"
    )


def jacoco_ratio(
    coverage: DataFrame, wanted: DataFrame, class_name: str = "class_name", order: str = "row_no"
) -> DataFrame:
    """Share of covered instructions per wanted class; 0 without instructions, NULL if absent."""
    row = F.struct("INSTRUCTION_COVERED", "INSTRUCTION_MISSED")
    first = coverage.groupBy("CLASS").agg(F.min_by(row, order).alias("_c"))
    covered = F.col("_c.INSTRUCTION_COVERED").cast("double")
    everything = covered + F.col("_c.INSTRUCTION_MISSED")
    ratio = F.when(everything == 0, F.lit(0.0)).otherwise(F.try_divide(covered, everything))
    return wanted.join(first, wanted[class_name] == first["CLASS"], "left").select(
        *[wanted[c] for c in wanted.columns], ratio.alias("coverage")
    )


def jacoco_class(file_name: Column) -> Column:
    return F.replace(file_name, F.lit(".java"), F.lit(""))
