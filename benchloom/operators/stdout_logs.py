"""Console logs of test runners: pytest, mocha, jest, sbt and maven.

A log is one text cell.  Test rows come from an explode of its lines, which is a
narrow step; counters and states are computed inside the row from the line array.
No operator in this module shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import (
    FLAGS, SPACE, WORD, after, all_matches, compute_once, count_where, explode_rows, first_group,
    first_int, from_line_with, let,
    last, lines, strip, with_next,
)

Keys = Sequence[str]


def _state(passed: Column, failed: Column) -> Column:
    return (
        F.when((passed > 0) & (failed == 0), "passed").when(passed == 0, "failed").otherwise("unknown")
    )


# --- pytest -----------------------------------------------------------------------

# The words of a result line and the counters of the last line.
PYTEST_RESULT = rf"{FLAGS}(FAILED|PASSED|SKIPPED|ERROR|XFAIL|XPASS){SPACE}+([{WORD}/.:]+)"
PYTEST_COUNTERS = ("passed", "error", "failed", "warning", "skipped", "xfailed", "xpassed")
PYTEST_LISTED = ("warning", "skipped", "xfailed", "xpassed")
PYTEST_TITLE = rf"(?Uds)_{{10,}}{SPACE}+(.*?){SPACE}+_{{10,}}"


def pytest_tests(logs: DataFrame, text: str = "stdout", keys: Keys = ("run_id",)) -> DataFrame:
    """The first result word of every line with the test name behind it."""
    rows = explode_rows(logs, keys, lines(F.col(text)), value="line")
    return (
        rows.withColumn("status", F.regexp_extract("line", PYTEST_RESULT, 1))
        .where(F.col("status") != "")
        .select(*keys, "pos", F.regexp_extract("line", PYTEST_RESULT, 2).alias("name"), "status")
    )


def pytest_summary(logs: DataFrame, text: str = "stdout", keys: Keys = ("run_id",)) -> DataFrame:
    """The last count per counter, the total of passed, error and failed, and the state."""
    log = F.col(text)
    found = all_matches(log, rf"\d+ (?:{'|'.join(PYTEST_COUNTERS)})")
    listed = lambda key: F.filter("_all", lambda m: m.endswith(f" {key}")).alias(f"list_{key}")
    number = lambda key: F.coalesce(
        F.substring_index(last(F.col(f"list_{key}")), " ", 1).try_cast("bigint"), F.lit(0).cast("bigint")
    )
    one_pass = compute_once(logs, keys, found, "_all")
    counted = one_pass.select(*keys, *[listed(key) for key in PYTEST_COUNTERS]).select(
        *keys,
        *[number(key).alias(key) for key in PYTEST_COUNTERS],
        *[f"list_{key}" for key in PYTEST_LISTED],
    )
    return with_pytest_state(counted)


def with_pytest_state(counted: DataFrame) -> DataFrame:
    n = F.col
    return counted.withColumn("total", n("passed") + n("error") + n("failed")).withColumn(
        "status", _state(n("passed") + n("xpassed"), n("error") + n("failed") + n("xfailed"))
    )


def pytest_sections(logs: DataFrame, text: str = "stdout", keys: Keys = ("run_id",)) -> DataFrame:
    """The session output, the short summary and the titles of the failure blocks."""
    log = F.col(text)
    return logs.select(
        *keys,
        from_line_with(log, "test session starts").alias("out"),
        from_line_with(log, "short test summary info").alias("summary_raw"),
        all_matches(log, PYTEST_TITLE, 1).alias("failures"),
    )


# --- mocha and jest ---------------------------------------------------------------

# What the two runners print.
MOCHA_PASS = rf"(?Udm)^{SPACE}*✓{SPACE}+(.+)$"
MOCHA_FAIL = rf"(?Udm)^{SPACE}*[0-9]+\){SPACE}+(.+)$"
MOCHA_BLOCK = rf"(?Uds)\n{SPACE}*[0-9]+\).+?(?=\n{SPACE}*[0-9]+\)|$)"
JEST_FILE = rf"(?Ud)(PASS|FAIL){SPACE}+(.+\.test\.[{WORD}]+)"
JEST_TOTALS = rf"(?Ud)Tests:{SPACE}+.+"
JEST_FAILURE = r"(?Uds)●.+?(?=●|Tests:|$)"
JEST_SIGNS = (
    rf"PASS{SPACE}", rf"FAIL{SPACE}", rf"Tests:{SPACE}+[0-9]", rf"Snapshots:{SPACE}+[0-9]",
    rf"Time:{SPACE}+[0-9.]+{SPACE}*s", "Ran all test suites",
)
MOCHA_SIGNS = (
    rf"[0-9]{SPACE}+passing", rf"[0-9]{SPACE}+failing", rf"[0-9]{SPACE}+pending",
    rf"^{SPACE}*✓{SPACE}", rf"^{SPACE}*[0-9]+\){SPACE}",
)


def _named(names: Column, status: str) -> Column:
    return F.transform(names, lambda name: F.struct(strip(name).alias("name"), F.lit(status).alias("status")))


def _mocha_tests(log: Column) -> Column:
    return F.concat(
        _named(all_matches(log, MOCHA_PASS, 1), "PASSED"), _named(all_matches(log, MOCHA_FAIL, 1), "FAILED")
    )


def _jest_tests(log: Column) -> Column:
    pairs = F.arrays_zip(
        all_matches(log, JEST_FILE, 1).alias("status"), all_matches(log, JEST_FILE, 2).alias("name")
    )
    return F.transform(
        pairs, lambda p: F.struct(strip(p["name"]).alias("name"), p["status"].alias("status"))
    )


def _mocha_totals(log: Column) -> Column:
    count = lambda word: first_int(log, rf"(?Ud)([0-9]+){SPACE}+{word}")
    return F.struct(
        count("passing").alias("passed"),
        count("failing").alias("failed"),
        count("pending").alias("skipped"),
        F.lit(None).cast("bigint").alias("total"),
        F.regexp_extract(log, MOCHA_BLOCK, 0).alias("summary_raw"),
        F.array().cast("array<string>").alias("failures"),
    )


def _jest_totals(log: Column) -> Column:
    count = lambda line, word: F.when(
        line != "", first_int(line, rf"(?Ud)([0-9]+){SPACE}+{word}")
    )
    return let(
        F.regexp_extract(log, JEST_TOTALS, 0),
        lambda line: F.struct(
            count(line, "passed").alias("passed"),
            count(line, "failed").alias("failed"),
            count(line, "skipped").alias("skipped"),
            count(line, "total").alias("total"),
            line.alias("summary_raw"),
            F.transform(all_matches(log, JEST_FAILURE), strip).alias("failures"),
        ),
    )


def _js_summary(logs: DataFrame, keys: Keys, framework: Column, totals: Column) -> DataFrame:
    """Summary columns from the totals read out of a log; what follows from them is derived."""
    n = F.col
    mocha, jest = framework == "mocha", framework == "jest"
    zero = F.lit(0).cast("bigint")
    missing = jest & n("_s.passed").isNull()
    number = lambda name: F.when(mocha | jest, n(f"_s.{name}")).otherwise(zero).alias(name)
    block = n("_s.summary_raw")
    return compute_once(logs, keys, totals, "_s").select(
        *keys,
        number("passed"),
        number("failed"),
        F.when(~missing, zero).alias("error"),
        number("skipped"),
        F.when(mocha, n("_s.passed") + n("_s.failed")).when(jest, n("_s.total")).otherwise(zero).alias("total"),
        F.coalesce(block, F.lit("")).alias("summary_raw"),
        F.when(mocha & (block != ""), F.array(block))
        .otherwise(F.coalesce(n("_s.failures"), F.array().cast("array<string>")))
        .alias("failures"),
        F.when(~mocha & ~jest, "unknown")
        .when(~missing, _state(n("_s.passed"), n("_s.failed")))
        .alias("status"),
        F.when(missing, "no_summary").alias("parse_error"),
    )


def detect_framework(log: Column) -> Column:
    """``jest`` or ``mocha``, whichever has more signs in the log; a tie is ``unknown``."""
    score = lambda signs: sum((log.rlike(f"(?Udm){sign}").cast("int") for sign in signs), F.lit(0))
    jest, mocha = score(JEST_SIGNS), score(MOCHA_SIGNS)
    return F.when(jest > mocha, "jest").when(mocha > jest, "mocha").otherwise("unknown")


def _tests(logs: DataFrame, tests: Column, keys: Keys) -> DataFrame:
    return explode_rows(logs, keys, tests, value="_t").select(
        *keys, "pos", F.col("_t.name").alias("name"), F.col("_t.status").alias("status")
    )


def mocha_tests(logs: DataFrame, text: str = "stdout", keys: Keys = ("run_id",)) -> DataFrame:
    """All passed tests of a log, then all failed ones."""
    return _tests(logs, _mocha_tests(F.col(text)), keys)


def mocha_summary(logs: DataFrame, text: str = "stdout", keys: Keys = ("run_id",)) -> DataFrame:
    return _js_summary(logs, keys, F.lit("mocha"), _mocha_totals(F.col(text)))


def jest_tests(logs: DataFrame, text: str = "stdout", keys: Keys = ("run_id",)) -> DataFrame:
    return _tests(logs, _jest_tests(F.col(text)), keys)


def jest_summary(logs: DataFrame, text: str = "stdout", keys: Keys = ("run_id",)) -> DataFrame:
    """Counters of the first ``Tests:`` line; a log without one gets ``parse_error``."""
    return _js_summary(logs, keys, F.lit("jest"), _jest_totals(F.col(text)))


def javascript_tests(logs: DataFrame, text: str = "stdout", keys: Keys = ("run_id",)) -> DataFrame:
    """Test rows by the detected framework; none when it is unknown."""
    log, kind = F.col(text), F.col("framework")
    routed = compute_once(logs, [*keys, text], detect_framework(log), "framework")
    tests = F.when(kind == "jest", _jest_tests(log)).when(kind == "mocha", _mocha_tests(log))
    return _tests(routed, tests, keys)


def javascript_summary(logs: DataFrame, text: str = "stdout", keys: Keys = ("run_id",)) -> DataFrame:
    """The summary by the detected framework; zeros when it is unknown."""
    log, kind = F.col(text), F.col("framework")
    totals = F.when(kind == "jest", _jest_totals(log)).when(kind == "mocha", _mocha_totals(log))
    routed = compute_once(logs, [*keys, text], detect_framework(log), "framework")
    return _js_summary(routed, [*keys, "framework"], kind, totals)


# --- sbt --------------------------------------------------------------------------


def _sbt_kind(line: Column) -> Column:
    test = F.contains(line, F.lit("[info] -")) | F.contains(line, F.lit("[info] ScalaTest"))
    failure = F.contains(line, F.lit("[error]")) & F.contains(line, F.lit("Failed:"))
    marker = F.contains(line, F.lit("[info] All tests passed")) | F.contains(
        F.lower(line), F.lit("[success]")
    )
    return F.when(test, "test").when(failure, "failed").when(marker, "marker")


def sbt_kind(line: Column) -> Column:
    """The kind of a line; a test needs a name of more than three characters."""
    return let(_sbt_kind(line), lambda k: F.when((k != "test") | (F.length(_sbt_name(line)) > 3), k))


def sbt_failures(line: Column) -> Column:
    """The number of failures that a line tells."""
    number = first_group(line, rf"(?U)Failed:{SPACE}*(\d+)").try_cast("bigint")
    return F.when(_sbt_kind(line) == "failed", number)


def sbt_status() -> Column:
    n = F.col
    return F.when(n("passed") == 0, "unknown").when(n("failed") == 0, "passed").otherwise("failed")


def _sbt_name(line: Column) -> Column:
    return strip(F.substring_index(line, "[info]", -1))


def sbt_tests(logs: DataFrame, text: str = "stdout", keys: Keys = ("run_id",)) -> DataFrame:
    """Every ``[info] -`` line with a name longer than three characters, as passed."""
    rows = explode_rows(logs, keys, lines(F.col(text)), value="line")
    return (
        rows.where(_sbt_kind(F.col("line")) == "test")
        .select(*keys, "pos", _sbt_name(F.col("line")).alias("name"), F.lit("passed").alias("status"))
        .where(F.length("name") > 3)
    )


def sbt_summary(logs: DataFrame, text: str = "stdout", keys: Keys = ("run_id",)) -> DataFrame:
    """Counters of the sbt log; an empty log has no row.

    A success marker counts as one passed test when it comes before any test.
    """
    log_lines = F.col("_lines")
    kinds = F.transform(log_lines, sbt_kind)
    failures = F.filter(
        F.transform(
            F.filter(log_lines, lambda line: _sbt_kind(line) == "failed"),
            lambda line: first_group(line, rf"(?U)Failed:{SPACE}*(\d+)").try_cast("bigint"),
        ),
        lambda n: n.isNotNull(),
    )
    zero = F.lit(0).cast("bigint")
    first_test = F.array_position("_kinds", F.lit("test"))
    first_marker = F.array_position("_kinds", F.lit("marker"))
    filled = logs.where(F.length(text) > 0)
    bonus = (first_marker > 0) & ((first_test == 0) | (first_marker < first_test))
    n = F.col
    return (
        compute_once(compute_once(filled, keys, lines(F.col(text)), "_lines"), [*keys, "_lines"], kinds, "_kinds")
        .select(*keys, "_kinds", F.coalesce(last(failures), zero).alias("failed"))
        .withColumn("passed", count_where(n("_kinds"), lambda k: k == "test") + bonus.cast("bigint"))
        .select(
            *keys,
            n("passed").alias("total"),
            "passed",
            "failed",
            zero.alias("skipped"),
            zero.alias("errors"),
            sbt_status().alias("status"),
        )
    )


# --- maven ------------------------------------------------------------------------

# The position mark of a compiler message and the names of its kinds,
# tried in this order.
MAVEN_MESSAGE = rf"(?Ud)\[\d+,\d+\]{SPACE}+(.+)"
MAVEN_METHOD = r"\.([a-zA-Z_][a-zA-Z0-9_]*)\("
MAVEN_KINDS = (
    ("has private access in", "private_access"),
    ("cannot find symbol", "symbol_not_found"),
    ("class, interface, enum", "class_interface_enum (repeatance of package declaration)"),
    ("should be declared in a file named", "file_name"),
    ("reached end of file while parsing", "end_of_file"),
    ("unclosed string literal", "end_of_file"),
    ("cannot be instantiated", "cannot_instantiate_abstract_class"),
    ("reference to with is ambiguous", "ambiguous_reference"),
    ("';' expected", "semicolon_expected"),
)


def maven_test_count(line: Column) -> Column:
    """The number of tests in a line that counts them."""
    part = last(F.filter(F.split(line, ",", -1), lambda p: F.contains(p, F.lit("Tests run"))))
    return strip(F.get(F.split(part, ":", -1), F.lit(1))).try_cast("bigint")


def positioned_error(line: Column) -> Column:
    return line.startswith("[ERROR]") & line.rlike(MAVEN_MESSAGE)


def maven_summary(logs: DataFrame, text: str = "stdout", keys: Keys = ("run_id",), path: str | None = None) -> DataFrame:
    """``success, compiled, tests, n_errors`` of a build.

    With ``path`` (a column), an error that names the path forces ``compiled`` to false.
    A count that is no number gives NULL and ``parse_error``.
    """
    log_lines = lines(F.col(text))
    some = lambda prefix: F.exists(F.col("_lines"), lambda line: line.startswith(prefix))
    counted = last(F.filter("_lines", lambda line: line.startswith("[INFO] Tests run:")))
    tests = maven_test_count(counted)
    compiled = some("[INFO]  T E S T S")
    if path is not None:
        named = F.exists(
            "_lines", lambda line: line.startswith("[ERROR]") & F.contains(line, F.col(path))
        )
        compiled = compiled & ~named
    kept = [*keys] + ([path] if path is not None else [])
    return compute_once(logs, kept, log_lines, "_lines").select(
        *keys,
        some("[INFO] BUILD SUCCESS").alias("success"),
        compiled.alias("compiled"),
        F.when(counted.isNull(), F.lit(0)).otherwise(tests).cast("bigint").alias("tests"),
        count_where(F.col("_lines"), positioned_error).alias("n_errors"),
        F.when(counted.isNotNull() & tests.isNull(), "bad_test_count").alias("parse_error"),
    )


def maven_errors(logs: DataFrame, text: str = "stdout", keys: Keys = ("run_id",)) -> DataFrame:
    """Positioned compiler errors with their kind; an unlisted kind keeps its text."""
    rows = explode_rows(logs, keys, lines(F.col(text)), value="message")
    body = F.regexp_extract("message", MAVEN_MESSAGE, 1)
    kind = F.when(F.lit(False), "")
    for sign, name in MAVEN_KINDS:
        kind = kind.when(F.contains(body, F.lit(sign)), name)
    return rows.where(positioned_error(F.col("message"))).select(
        *keys,
        "pos",
        kind.otherwise(body).alias("type"),
        "message",
        F.concat_ws("\n", "message", "message").alias("full_text"),
    )


def _line_pairs(logs: DataFrame, text: str, keys: Keys) -> DataFrame:
    pairs = explode_rows(logs, keys, with_next(lines(F.col(text))), value="_p")
    return pairs.select(*keys, "pos", "_p.line", "_p.next")


def maven_stack_errors(logs: DataFrame, text: str = "stdout", keys: Keys = ("run_id",)) -> DataFrame:
    """Assertion and runtime errors with the method of the stack line below them."""
    line = F.col("line")
    method = F.when(F.col("next").startswith("\tat "), first_group(F.col("next"), MAVEN_METHOD))
    kind = lambda test, name, marker: F.when(
        test, F.struct(F.lit(name).alias("kind"), after(line, marker).alias("text"))
    )
    assertion = kind(
        F.contains(line, F.lit("AssertionFailedError:")), "assertion", "AssertionFailedError:"
    )
    runtime = kind(
        F.contains(line, F.lit("Exception:")) & line.startswith("java."), "runtime", "Exception:"
    )
    return (
        _line_pairs(logs, text, keys)
        .select(*keys, "pos", method.alias("method"), F.explode_outer(F.array(assertion, runtime)).alias("_e"))
        .where(F.col("_e").isNotNull())
        .select(*keys, "pos", F.col("_e.kind").alias("kind"), F.col("_e.text").alias("text"), "method")
    )


def maven_compile_errors(
    logs: DataFrame, path: str, text: str = "stdout", keys: Keys = ("run_id",)
) -> DataFrame:
    """Errors that name ``path`` (a column), with the detail line that may follow."""
    line, following = F.col("line"), F.col("next")
    is_detail = (
        following.startswith("[ERROR]") & (F.length(following) > 20) & ~following.rlike(MAVEN_MESSAGE)
    )
    detail = strip(F.substring(following, F.lit(9), F.length(following)))
    return (
        _line_pairs(logs, text, [*keys, path])
        .where(line.startswith("[ERROR]") & F.contains(line, F.col(path)))
        .select(
            *keys,
            "pos",
            F.coalesce(first_group(line, MAVEN_MESSAGE), F.lit("unknown")).alias("type"),
            F.when(is_detail, detail).alias("details"),
        )
    )
