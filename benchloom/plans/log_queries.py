"""Queries over console logs.

Every document becomes the log of one run inside its row: each of its lines turns
into a log line whose kind follows from the line's length, with the line itself as
message.  The SQL computes the expected rows from the lines directly.
"""

from pyspark.sql import DataFrame, functions as F

from ..operators import evaluate, stdout_logs as logs
from .patch_queries import LINES
from .registry import Tables, query

RUNS = LINES.replace("doc_id, i, ln", "doc_id AS run_id, i, ln")


def rendered(t: Tables, line: str, before: str = "''", after: str = "''") -> DataFrame:
    """``run_id, stdout``: one rendered line per document line (``ln``, ``i``, ``n``).

    ``before`` and ``after`` may use ``ls``, the array of all lines.
    """
    rows = t.documents.selectExpr("doc_id AS run_id", "split(text, '\\n') AS ls")
    body = f"array_join(transform(ls, (ln, i) -> {line.replace('{n}', 'length(ln)')}), '\\n')"
    return rows.selectExpr("run_id", f"concat({before}, {body}, {after}) AS stdout")


def n_lines(test: str) -> str:
    return f"size(filter(ls, (ln, i) -> {test.replace('{n}', 'length(ln)')}))"


def pick(number: str, *values: str) -> str:
    cases = " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(values[:-1]))
    return f"CASE {number} {cases} ELSE {values[-1]} END"


# --- pytest -----------------------------------------------------------------------

PYTEST_WORDS = ("PASSED", "FAILED", "SKIPPED", "ERROR", "XFAIL", "XPASS")


def pytest_logs(t: Tables) -> DataFrame:
    word = pick("{n} % 6", *[f"'{w}'" for w in PYTEST_WORDS])
    line = f"""concat(if({{n}} % 6 = 1, concat('____________ test_', i, ' ____________\\nE  assert\\n'), ''),
        {word}, ' tests/mod_', i % 3, '.py::test_ñ', i, ' - ', ln)"""
    counted = lambda k, name: f"if({n_lines('{n} % 6 = ' + str(k))} > 0, concat({n_lines('{n} % 6 = ' + str(k))}, ' {name}, '), '')"
    after = "concat('\\n=== ', " + ", ".join(
        counted(k, name) for k, name in enumerate(("passed", "failed", "skipped", "error", "xfailed", "xpassed"))
    ) + ", size(ls), ' warnings in 0.5s ===\\n')"
    before = "'plugins: x\\n===== test session starts =====\\n= short test summary info =\\n'"
    return rendered(t, line, before, after)


PYTEST_NAME = "'tests/mod_' || (i % 3) || '.py::test_ñ' || i"


@query(f"""
WITH {RUNS}
SELECT run_id, {PYTEST_NAME} AS name,
       {pick('n % 6', *[f"'{w}'" for w in PYTEST_WORDS])} AS status FROM dl
""")
def pytest_tests(t: Tables):
    return logs.pytest_tests(pytest_logs(t)).select("run_id", "name", "status")


@query(f"""
WITH {RUNS},
c AS (SELECT run_id, count(*) FILTER (WHERE n % 6 = 0) AS passed, count(*) FILTER (WHERE n % 6 = 1) AS failed,
  count(*) FILTER (WHERE n % 6 = 2) AS skipped, count(*) FILTER (WHERE n % 6 = 3) AS error,
  count(*) FILTER (WHERE n % 6 = 4) AS xfailed, count(*) FILTER (WHERE n % 6 = 5) AS xpassed,
  count(*) AS warning FROM dl GROUP BY 1)
SELECT *, passed + error + failed AS total,
  CASE WHEN skipped > 0 THEN skipped || ' skipped' ELSE '' END AS list_skipped,
  CASE WHEN passed + xpassed > 0 AND error + failed + xfailed = 0 THEN 'passed'
       WHEN passed + xpassed = 0 THEN 'failed' ELSE 'unknown' END AS status FROM c
""")
def pytest_summary(t: Tables):
    return logs.pytest_summary(pytest_logs(t)).select(
        "run_id", *logs.PYTEST_COUNTERS, "total", F.array_join("list_skipped", ";").alias("list_skipped"),
        "status",
    )


@query(f"""
WITH {RUNS}
SELECT run_id, '===== test session starts =====' AS first_line, '= short test summary info =' AS first_summary_line,
       string_agg(CASE WHEN n % 6 = 1 THEN 'test_' || i END, ';' ORDER BY i) AS titles FROM dl GROUP BY 1
""")
def pytest_sections(t: Tables):
    return logs.pytest_sections(pytest_logs(t)).select(
        "run_id",
        F.substring_index("out", "\n", 1).alias("first_line"),
        F.substring_index("summary_raw", "\n", 1).alias("first_summary_line"),
        F.when(F.size("failures") > 0, F.array_join("failures", ";")).alias("titles"),
    )


# --- mocha and jest ---------------------------------------------------------------


def mocha_logs(t: Tables) -> DataFrame:
    line = pick(
        "{n} % 3", "concat('    ✓ works with ', ln)", "concat('    ', i + 1, ') fails on ', ln, '  ')",
        "concat('    - pending ', ln)",
    )
    counted = lambda k, word: f"concat('  ', {n_lines('{n} % 3 = ' + str(k))}, ' {word}\\n')"
    after = f"concat('\\n\\n', {counted(0, 'passing (3ms)')}, {counted(1, 'failing')}, {counted(2, 'pending')})"
    return rendered(t, line, "'  suite\\n'", after)


def jest_logs(t: Tables) -> DataFrame:
    line = pick(
        "{n} % 2", "concat('PASS src/a', i, '.test.js')",
        "concat('FAIL src/b', i, '.test.tsx (5 s)\\n  ● fails on ', ln)",
    )
    counted = lambda k, word: f"if({n_lines('{n} % 2 = ' + str(k))} > 0, concat({n_lines('{n} % 2 = ' + str(k))}, ' {word}, '), '')"
    tail = """concat('\\nTests:       ', {f}, {p}, size(ls), ' total\\nSnapshots:   0 total\\nTime:        1.2 s\\n',
        'Ran all test suites.\\n')""".format(f=counted(1, "failed"), p=counted(0, "passed"))
    return rendered(t, line, "''", f"if(run_id % 11 = 0, '\\nkilled\\n', {tail})")


@query(f"""
WITH {RUNS}
SELECT run_id, CASE n % 3 WHEN 0 THEN 'works with ' || ln ELSE 'fails on ' || ln END AS name,
  CASE n % 3 WHEN 0 THEN 'PASSED' ELSE 'FAILED' END AS status,
  CAST(row_number() OVER (PARTITION BY run_id ORDER BY n % 3, i) - 1 AS BIGINT) AS pos
FROM dl WHERE n % 3 < 2
""")
def mocha_tests(t: Tables):
    tests = logs.mocha_tests(mocha_logs(t))
    return tests.select("run_id", "name", "status", F.col("pos").cast("bigint").alias("pos"))


@query(f"""
WITH {RUNS},
c AS (SELECT run_id, count(*) FILTER (WHERE n % 3 = 0) AS passed, count(*) FILTER (WHERE n % 3 = 1) AS failed,
             count(*) FILTER (WHERE n % 3 = 2) AS skipped, min(i) FILTER (WHERE n % 3 = 1) AS f FROM dl GROUP BY 1)
SELECT run_id, passed, failed, skipped, passed + failed AS total,
  CASE WHEN passed > 0 AND failed = 0 THEN 'passed' WHEN passed = 0 THEN 'failed' ELSE 'unknown' END AS status,
  coalesce(chr(10) || '    ' || (f + 1) || ') fails on', '') AS block_start FROM c
""")
def mocha_parse(t: Tables):
    return logs.mocha_summary(mocha_logs(t)).select(
        "run_id", "passed", "failed", "skipped", "total", "status",
        F.regexp_extract("summary_raw", r"^\n *\d+\) fails on", 0).alias("block_start"),
    )


@query(f"""
WITH {RUNS}
SELECT run_id, CAST(i AS BIGINT) AS pos, CASE n % 2 WHEN 0 THEN 'src/a' || i || '.test.js' ELSE 'src/b' || i || '.test.tsx' END AS name,
       CASE n % 2 WHEN 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM dl
""")
def jest_tests(t: Tables):
    tests = logs.jest_tests(jest_logs(t))
    return tests.select("run_id", "name", "status", F.col("pos").cast("bigint").alias("pos"))


@query(f"""
WITH {RUNS},
c AS (SELECT run_id, run_id % 11 <> 0 AS ok, count(*) AS total, count(*) FILTER (WHERE n % 2 = 0) AS passed,
             count(*) FILTER (WHERE n % 2 = 1) AS failed FROM dl GROUP BY 1)
SELECT run_id, CASE WHEN ok THEN passed END AS passed, CASE WHEN ok THEN failed END AS failed,
  CASE WHEN ok THEN total END AS total, failed AS n_failures,
  CASE WHEN ok THEN CASE WHEN passed > 0 AND failed = 0 THEN 'passed' WHEN passed = 0 THEN 'failed' ELSE 'unknown' END END AS status,
  CASE WHEN NOT ok THEN 'no_summary' END AS parse_error FROM c
""")
def jest_parse(t: Tables):
    return logs.jest_summary(jest_logs(t)).select(
        "run_id", "passed", "failed", "total", F.size("failures").cast("bigint").alias("n_failures"),
        "status", "parse_error",
    )


def javascript_logs(t: Tables) -> DataFrame:
    """Mocha logs, jest logs and plain texts by the run number."""
    kinds = [
        mocha_logs(t).where("run_id % 3 = 0"),
        jest_logs(t).where("run_id % 3 = 1"),
        t.documents.selectExpr("doc_id AS run_id", "text AS stdout").where("run_id % 3 = 2"),
    ]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2])


@query(f"""
WITH {RUNS},
c AS (SELECT run_id, count(*) AS n_lines, count(*) FILTER (WHERE n % 3 = 0) AS mp, count(*) FILTER (WHERE n % 3 = 1) AS mf,
        count(*) FILTER (WHERE n % 3 = 2) AS ms,
        count(*) FILTER (WHERE n % 2 = 0) AS jp, count(*) FILTER (WHERE n % 2 = 1) AS jf, run_id % 11 = 0 AS killed FROM dl GROUP BY 1),
x AS (SELECT run_id, CASE run_id % 3 WHEN 0 THEN 'mocha' WHEN 1 THEN 'jest' ELSE 'unknown' END AS framework,
  CASE run_id % 3 WHEN 0 THEN mp WHEN 1 THEN CASE WHEN NOT killed THEN jp END ELSE 0 END AS passed,
  CASE run_id % 3 WHEN 0 THEN mf WHEN 1 THEN CASE WHEN NOT killed THEN jf END ELSE 0 END AS failed,
  CASE run_id % 3 WHEN 0 THEN mp + mf WHEN 1 THEN CASE WHEN NOT killed THEN n_lines END ELSE 0 END AS total FROM c)
SELECT *, CASE WHEN framework = 'unknown' THEN 'unknown' WHEN passed > 0 AND failed = 0 THEN 'passed'
               WHEN passed = 0 THEN 'failed' WHEN passed > 0 THEN 'unknown' END AS status FROM x
""")
def framework_detect(t: Tables):
    return logs.javascript_summary(javascript_logs(t)).select(
        "run_id", "framework", "passed", "failed", "total", "status"
    )


@query(f"""
WITH {RUNS}
SELECT CASE run_id % 3 WHEN 0 THEN 'mocha' ELSE 'jest' END AS framework, status, count(*) AS n FROM (
  SELECT run_id, CASE WHEN run_id % 3 = 0 THEN CASE n % 3 WHEN 0 THEN 'PASSED' WHEN 1 THEN 'FAILED' END
                      WHEN run_id % 3 = 1 THEN CASE n % 2 WHEN 0 THEN 'PASS' ELSE 'FAIL' END END AS status FROM dl)
WHERE status IS NOT NULL GROUP BY ALL
""")
def javascript_tests(t: Tables):
    tests = logs.javascript_tests(javascript_logs(t))
    framework = F.when(F.col("run_id") % 3 == 0, "mocha").otherwise("jest").alias("framework")
    return tests.groupBy(framework, "status").agg(F.count("*").alias("n"))


# --- sbt --------------------------------------------------------------------------


def sbt_logs(t: Tables) -> DataFrame:
    line = pick(
        "{n} % 8", "concat('[info] - handles ', ln)", "concat('[error] Failed: Total 9, Failed: ', i)",
        "concat('[SUCCESS] ', ln)", "concat('[info] compiling ', ln)", "'[info] -'",
        "'[info] All tests passed.'", "concat('[error] ', ln)", "concat('[info] ScalaTest ', i)",
    )
    return rendered(t, line)


@query(f"""
WITH {RUNS}
SELECT run_id, CASE n % 8 WHEN 0 THEN '- handles ' || ln ELSE 'ScalaTest ' || i END AS name, 'passed' AS status
FROM dl WHERE n % 8 IN (0, 7)
""")
def sbt_tests(t: Tables):
    return logs.sbt_tests(sbt_logs(t)).select("run_id", "name", "status")


@query(f"""
WITH {RUNS},
c AS (SELECT run_id, count(*) FILTER (WHERE n % 8 IN (0, 7)) AS tests, min(i) FILTER (WHERE n % 8 IN (0, 7)) AS ft,
        min(i) FILTER (WHERE n % 8 IN (2, 5)) AS fm, max(i) FILTER (WHERE n % 8 = 1) AS lf FROM dl GROUP BY 1),
x AS (SELECT run_id, tests + CASE WHEN fm IS NOT NULL AND (ft IS NULL OR fm < ft) THEN 1 ELSE 0 END AS passed,
             CAST(coalesce(CASE WHEN lf IS NOT NULL THEN lf END, 0) AS BIGINT) AS failed FROM c)
SELECT run_id, passed AS total, passed, failed,
       CASE WHEN passed = 0 THEN 'unknown' WHEN failed = 0 THEN 'passed' ELSE 'failed' END AS status FROM x
""")
def sbt_stdout(t: Tables):
    return logs.sbt_summary(sbt_logs(t)).select("run_id", "total", "passed", "failed", "status")


# --- maven ------------------------------------------------------------------------


def maven_logs(t: Tables) -> DataFrame:
    line = pick(
        "{n} % 9",
        "concat('[ERROR] /src/T', i % 4, '.java:[', i, ',7] error: cannot find symbol ', ln)",
        "concat('[ERROR] /src/T', i % 4, '.java:[1,2]  x has private access in Y, class, interface, enum')",
        "concat('[ERROR] /src/T', i % 4, '.java:[3,4] ', ln)",
        "concat('[INFO] Tests run: ', i, ', Failures: 0, Errors: 1')",
        "concat('org.x.AssertionFailedError: expected ', ln, '\\n\\tat com.x.T.check', i, '(T.java:3)')",
        "concat('java.lang.IllegalStateException: bad ', ln)",
        "'[INFO]  T E S T S'",
        "concat('[ERROR] /src/T', i % 4, '.java failed\\n[ERROR]   detail ', i, ' of the failed run')",
        "concat('[INFO] ', ln)",
    )
    logs_ = rendered(t, line, "''", "if(run_id % 2 = 0, '\\n[INFO] BUILD SUCCESS\\n', '\\n[INFO] BUILD FAILURE')")
    return logs_.withColumn("full_path", F.concat(F.lit("/src/T"), (F.col("run_id") % 4).cast("string"), F.lit(".java")))


@query(f"""
WITH {RUNS},
c AS (SELECT run_id, run_id % 2 = 0 AS success, bool_or(n % 9 = 6) AND NOT bool_or(n % 9 IN (0, 1, 2, 7) AND i % 4 = run_id % 4) AS compiled,
        CAST(coalesce(max(i) FILTER (WHERE n % 9 = 3), 0) AS BIGINT) AS tests,
        count(*) FILTER (WHERE n % 9 IN (0, 1, 2)) AS n_errors FROM dl GROUP BY 1)
SELECT * FROM c
""")
def maven_summary(t: Tables):
    return logs.maven_summary(maven_logs(t), path="full_path").select(
        "run_id", "success", "compiled", "tests", "n_errors"
    )


@query(f"""
WITH {RUNS},
e AS (SELECT run_id, CASE n % 9 WHEN 0 THEN 'symbol_not_found' WHEN 1 THEN 'private_access' ELSE ln END AS type,
  '[ERROR] /src/T' || (i % 4) || '.java:' || CASE n % 9 WHEN 0 THEN '[' || i || ',7] error: cannot find symbol ' || ln
    WHEN 1 THEN '[1,2]  x has private access in Y, class, interface, enum' ELSE '[3,4] ' || ln END AS message
  FROM dl WHERE n % 9 < 3)
SELECT run_id, type, message, message || chr(10) || message AS full_text FROM e
""")
def maven_errors(t: Tables):
    return logs.maven_errors(maven_logs(t)).select("run_id", "type", "message", "full_text")


@query(f"""
WITH {RUNS}
SELECT run_id, CASE n % 9 WHEN 4 THEN 'assertion' ELSE 'runtime' END AS kind,
       CASE n % 9 WHEN 4 THEN ' expected ' || ln ELSE ' bad ' || ln END AS text,
       CASE n % 9 WHEN 4 THEN 'check' || i END AS method FROM dl WHERE n % 9 IN (4, 5)
""")
def maven_stack_errors(t: Tables):
    return logs.maven_stack_errors(maven_logs(t)).select("run_id", "kind", "text", "method")


@query(f"""
WITH {RUNS},
x AS (SELECT *, lead(n) OVER (PARTITION BY run_id ORDER BY i) AS next_n FROM dl)
SELECT run_id, CASE n % 9 WHEN 0 THEN 'error: cannot find symbol ' || ln WHEN 1 THEN 'x has private access in Y, class, interface, enum'
       WHEN 2 THEN ln ELSE 'unknown' END AS type,
       CASE WHEN n % 9 = 7 THEN 'detail ' || i || ' of the failed run'
            WHEN next_n % 9 = 7 THEN '/src/T' || ((i + 1) % 4) || '.java failed' END AS details
FROM x WHERE n % 9 IN (0, 1, 2, 7) AND i % 4 = run_id % 4
""")
def maven_compile_errors(t: Tables):
    return logs.maven_compile_errors(maven_logs(t), "full_path").select("run_id", "type", "details")


@query(f"""
WITH {RUNS},
c AS (SELECT run_id, run_id % 2 = 0 AS success, bool_or(n % 9 = 6) AS compiled FROM dl GROUP BY 1)
SELECT run_id, CASE WHEN success AND run_id % 13 <> 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "pass@1",
       CASE WHEN compiled AND run_id % 13 <> 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "compile@1" FROM c
""")
def testgen_score(t: Tables):
    builds = logs.maven_summary(maven_logs(t))
    ran = F.col("run_id") % 13 != 0  # the other runs ended in an error and have no result
    builds = builds.select(
        "run_id", F.when(ran, F.col("success")).alias("success"), F.when(ran, F.col("compiled")).alias("compiled")
    )
    return evaluate.testgen_score(builds).select("run_id", "pass@1", "compile@1")
