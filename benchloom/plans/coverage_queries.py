"""Queries that map covered lines onto definitions.

Forty parts share a path and each part is one definition in it; lineitems are covered
lines of the file of their part, with the order as test.  Five runs share all paths and
test names; the part and the order say which run a row belongs to.
"""

from pyspark.sql import DataFrame, functions as F

from ..operators import coverage
from .log_queries import RUNS
from .registry import Tables, query

RUN = ("run",)


def definitions(t: Tables) -> DataFrame:
    return t.part.selectExpr(
        "p_partkey % 5 AS run",
        "concat('f', cast(floor(p_partkey / 40) AS BIGINT)) AS fn",
        "cast(p_partkey * 37 % 1900 AS INT) AS l",
        "cast(p_partkey * 37 % 1900 + p_size AS INT) AS r",
        "cast(p_partkey AS INT) AS seq",
        "p_name AS intent_name",
        "if(p_partkey % 4 = 0, 'class', 'function') AS intent_type",
        "if(p_partkey % 3 = 0, NULL, p_name) AS doc",
    )


def contexts(t: Tables) -> DataFrame:
    return t.lineitem.selectExpr(
        "l_partkey % 5 AS run",
        "concat('f', cast(floor(l_partkey / 40) AS BIGINT)) AS fn",
        "cast((l_orderkey * 7 + l_linenumber) % 1950 AS INT) AS line",
        "if(l_suppkey % 9 = 0, '', concat('t.py::test_', l_orderkey % 50, if(l_suppkey % 2 = 0, '[a|b]|run', '|run'))) AS context",
    )


DEFS = """
d AS (SELECT DISTINCT ON (run, fn, l, r) * FROM (
        SELECT p_partkey % 5 AS run, 'f' || (p_partkey // 40) AS fn, CAST(p_partkey * 37 % 1900 AS INTEGER) AS l,
               CAST(p_partkey * 37 % 1900 + p_size AS INTEGER) AS r, CAST(p_partkey AS INTEGER) AS seq, p_name AS intent_name,
               CASE WHEN p_partkey % 4 = 0 THEN 'class' ELSE 'function' END AS intent_type,
               CASE WHEN p_partkey % 3 <> 0 THEN p_name END AS doc FROM part) ORDER BY run, fn, l, r, seq DESC),
ctx AS (SELECT l_partkey % 5 AS run, 'f' || (l_partkey // 40) AS fn, CAST((l_orderkey * 7 + l_linenumber) % 1950 AS INTEGER) AS line,
               CASE WHEN l_suppkey % 9 = 0 THEN '' ELSE 't.py::test_' || (l_orderkey % 50) ||
                    CASE WHEN l_suppkey % 2 = 0 THEN '' ELSE '|run' END END AS test FROM lineitem),
lines AS (SELECT DISTINCT run, fn, line FROM ctx),
hits AS (
  SELECT lines.run, lines.fn, lines.line, l, r, seq,
         min(CASE WHEN line <= r THEN 1 ELSE 0 END) OVER (PARTITION BY lines.run, lines.fn, lines.line ORDER BY l DESC, r DESC
             ROWS UNBOUNDED PRECEDING) = 1 AS found
  FROM lines JOIN d ON d.run = lines.run AND d.fn = lines.fn AND l <= line),
tests AS (SELECT DISTINCT ctx.run, ctx.fn, l, r, test FROM ctx
          JOIN hits ON hits.run = ctx.run AND hits.fn = ctx.fn AND hits.line = ctx.line AND found WHERE test <> '')
"""


@query(f"WITH {DEFS} SELECT run, fn, line, l, r, seq FROM hits WHERE found")
def line_intervals(t: Tables):
    lines = contexts(t).select("run", "fn", "line").distinct()
    return coverage.line_intervals(lines, definitions(t).select("run", "fn", "l", "r", "seq"), keys=RUN)


@query(f"WITH {DEFS} SELECT run, fn, l, r, test FROM tests")
def definition_tests(t: Tables):
    return coverage.definition_tests(contexts(t), definitions(t), keys=RUN)


OUTCOME = """
one AS (SELECT DISTINCT o_orderkey % 5 AS run, o_orderkey // 5 % 60 AS n FROM orders),
twice AS (SELECT run, n FROM one UNION ALL SELECT run, n FROM one WHERE (n + run) % 11 = 5),
oc AS (SELECT run, 't.py::test_' || n AS nodeid, CASE WHEN any_value(n + run) % 3 = 0 THEN 'failed' ELSE 'passed' END AS outcome
       FROM twice GROUP BY run, n HAVING count(*) = 1),
lists AS (SELECT run, fn, l, r, CASE outcome WHEN 'passed' THEN 'PASS_TO_PASS' ELSE 'FAIL_TO_PASS' END AS list, nodeid
          FROM (SELECT *, split_part(test, '|', 1) AS nodeid FROM tests) JOIN oc USING (run, nodeid))
"""


def test_outcomes(t: Tables) -> DataFrame:
    """The reports of five runs; every eleventh test is listed twice, once with each outcome."""
    tests = t.orders.selectExpr("o_orderkey % 5 AS run", "cast(floor(o_orderkey / 5) AS BIGINT) % 60 AS n").distinct()
    outcome = "if((n + run) % 3 = 0, 'failed', 'passed')"
    other = "if((n + run) % 3 = 0, 'passed', 'failed')"
    listed = f"explode(if((n + run) % 11 = 5, array({outcome}, {other}), array({outcome}))) AS outcome"
    return tests.selectExpr("run", "concat('t.py::test_', n) AS nodeid", listed)


@query(f"WITH {DEFS}, {OUTCOME} SELECT run, fn, l, r, list, nodeid FROM lists")
def definition_outcomes(t: Tables):
    tests = coverage.definition_tests(contexts(t), definitions(t), keys=RUN)
    return coverage.definition_outcomes(tests, test_outcomes(t), RUN)


@query(f"WITH {DEFS}, {OUTCOME} SELECT run, 't.py::test_' || n AS nodeid, count(*) AS n FROM twice GROUP BY twice.run, twice.n HAVING count(*) > 1")
def duplicate_outcomes(t: Tables):
    return coverage.duplicate_outcomes(test_outcomes(t), RUN)


@query(f"""
WITH {DEFS}, {OUTCOME},
np AS (SELECT run, fn, l, r, count(*) AS np FROM lists WHERE list = 'PASS_TO_PASS' GROUP BY ALL)
SELECT run, count(*) FILTER (WHERE np > 0 AND doc IS NOT NULL AND intent_type = 'function') AS n_good, count(*) AS n_all
FROM d LEFT JOIN np USING (run, fn, l, r) GROUP BY run
""")
def good_candidates(t: Tables):
    defs = definitions(t)
    tests = coverage.definition_tests(contexts(t), defs, keys=RUN)
    return coverage.good_candidates(coverage.problem_table(defs, tests, test_outcomes(t), keys=RUN), RUN)


@query(f"""
WITH {DEFS},
c AS (SELECT d.run, d.fn, l, r, count(line) AS n_covered
      FROM d LEFT JOIN lines ON lines.run = d.run AND lines.fn = d.fn AND line BETWEEN l AND r GROUP BY ALL)
SELECT run, fn, l, r, n_covered, round_even(100.0::DOUBLE * n_covered / (r - l + 1), 2) AS coverage_rate FROM c
""")
def coverage_rate(t: Tables):
    rate = coverage.coverage_rate(contexts(t), definitions(t), keys=RUN)
    return rate.select("run", "fn", "l", "r", "n_covered", "coverage_rate")


# --- definitions of Python files --------------------------------------------------


def python_files(t: Tables) -> DataFrame:
    """A Python file per document: three lines of code per line of text; some are broken.

    The document is the run: paths repeat every seventh document.
    """
    word = "regexp_replace(ln, '[^A-Za-z0-9 ]', '')"
    code = f"""CASE length(ln) % 3
        WHEN 0 THEN concat('def f_', i, '(x):\\n    "', {word}, '"\\n    return x')
        WHEN 1 THEN concat('def g_', i, '(x):\\n    y = x\\n    return y')
        ELSE concat('class C_', i, ':\\n    def m(self):\\n        pass') END"""
    return t.documents.selectExpr(
        "doc_id AS run",
        "concat('/runs/r', doc_id % 9, '/src/d', doc_id % 7, '.py') AS path",
        f"""concat('import os\\n', array_join(transform(split(text, '\\n'), (ln, i) -> {code}), '\\n'),
            if(doc_id % 10 = 9, '\\nfrom {{{{x}}}} import y', '')) AS source""",
    )


@query(f"""
WITH {RUNS},
x AS (SELECT run_id AS run, '/run_dir/src/d' || (run_id % 7) || '.py' AS fn, i, n, CAST(1 + 3 * i AS INTEGER) AS s,
             regexp_replace(ln, '[^A-Za-z0-9 ]', '', 'g') AS word FROM dl WHERE run_id % 10 <> 9),
y AS (SELECT run, fn, CASE n % 3 WHEN 2 THEN 'class' ELSE 'function' END AS intent_type,
        CASE n % 3 WHEN 0 THEN 'f_' WHEN 1 THEN 'g_' ELSE 'C_' END || i AS intent_name,
        CASE n % 3 WHEN 0 THEN s + 2 ELSE s + 1 END AS l, s + 3 AS r,
        CASE n % 3 WHEN 0 THEN '    return x' WHEN 1 THEN '    y = x' || chr(10) || '    return y'
             ELSE '    def m(self):' || chr(10) || '        pass' END || chr(10) AS gt,
        CASE n % 3 WHEN 0 THEN '''' || word || '''' END AS doc FROM x
      UNION ALL SELECT run, fn, 'function', 'm', s + 2, s + 3, '        pass' || chr(10), NULL FROM x WHERE n % 3 = 2)
SELECT run, fn, intent_type, intent_name, l, r, gt, doc FROM y
""")
def parse_definitions(t: Tables):
    found = coverage.parse_definitions(python_files(t), keys=RUN)
    return found.select(
        "run", coverage.rebase_path(F.col("fn"), "/runs/").alias("fn"), "intent_type", "intent_name", "l", "r", "gt", "doc"
    )


@query(f"""
WITH {RUNS},
x AS (SELECT run_id AS run, i, n, max(i) OVER (PARTITION BY run_id) AS last_i, regexp_replace(ln, '[^A-Za-z0-9 ]', '', 'g') AS word FROM dl WHERE run_id % 10 <> 9),
code AS (SELECT *, CASE n % 3
    WHEN 0 THEN 'def f_' || i || '(x):' || chr(10) || '    "' || word || '"' || chr(10) || '    return x'
    WHEN 1 THEN 'def g_' || i || '(x):' || chr(10) || '    y = x' || chr(10) || '    return y'
    ELSE 'class C_' || i || ':' || chr(10) || '    def m(self):' || chr(10) || '        pass' END AS c FROM x),
file AS (SELECT run, string_split('import os' || chr(10) || string_agg(c, chr(10) ORDER BY i), chr(10)) AS f FROM code GROUP BY run),
y AS (SELECT run, n, CASE n % 3 WHEN 2 THEN 'class' ELSE 'function' END AS intent_type, 1 + 3 * i + CASE n % 3 WHEN 0 THEN 2 ELSE 1 END AS l, 1 + 3 * i + 3 AS r FROM x
      UNION ALL SELECT run, n, 'function', 1 + 3 * i + 2, 1 + 3 * i + 3 FROM x WHERE n % 3 = 2)
SELECT run, intent_type, CAST(l AS INTEGER) AS l, CAST(r AS INTEGER) AS r, md5(array_to_string(f[1:l], chr(10)) || chr(10)) AS left_md5,
       md5(array_to_string(f[r+1:], chr(10)) || chr(10)) AS right_md5 FROM y JOIN file USING (run)
""")
def definition_contexts(t: Tables):
    files = python_files(t)
    found = coverage.parse_definitions(files, keys=RUN)
    whole = coverage.definition_contexts(found, files, keys=RUN)
    return whole.select("run", "intent_type", "l", "r", F.md5("left_context").alias("left_md5"), F.md5("right_context").alias("right_md5"))


@query(f"""
WITH {RUNS}
SELECT run_id AS run, '/runs/r' || (run_id % 9) || '/src/d' || (run_id % 7) || '.py:m[function]' AS source, count(*) AS n
FROM dl WHERE run_id % 10 <> 9 AND n % 3 = 2 GROUP BY run_id HAVING count(*) > 1
""")
def duplicate_sources(t: Tables):
    return coverage.duplicate_sources(coverage.parse_definitions(python_files(t), keys=RUN), RUN)


@query("SELECT doc_id AS run, 'syntax' AS parse_error FROM documents WHERE doc_id % 10 = 9")
def definition_errors(t: Tables):
    found = coverage.parse_definitions(python_files(t), keys=RUN, errors=True)
    return found.where("parse_error IS NOT NULL").select("run", "parse_error")
