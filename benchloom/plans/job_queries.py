"""Queries that run whole jobs over the tables."""

from pyspark.sql import functions as F

from ..operators import collect, jobs
from . import collect_queries as c, coverage_queries as d, log_queries as lg, patch_queries as p, report_queries as r
from ..sources.files import scratch_folder
from .registry import Tables, query


@query(f"""
WITH {c.REPOS}, {c.WINDOWS},
x AS (SELECT "nameWithOwner", stars, CAST(l AS VARCHAR) || ':' || CAST(r AS VARCHAR) AS _period
      FROM repos JOIN windows ON created BETWEEN l AND r WHERE forks >= 10 AND l >= DATE '1996-01-01')
SELECT _period, "nameWithOwner", n AS "repositoryCount", 10 AS forks_min
FROM (SELECT *, count(*) OVER (PARTITION BY _period) AS n FROM x)
""")
def collect_repos(t: Tables):
    found = c.repos(t)
    done = collect.assign_windows(found, "1995-01-01", "2001-08-01", 7).where(F.col("_period") < "1996-01-01")
    rows = jobs.collect_repos(
        found, "1995-01-01", "2001-08-01", 7, processed=done, min_forks=10
    )
    return rows.select("_period", "nameWithOwner", "repositoryCount", "_search_params.forks_min")


@query(f"""
WITH {c.MAPPINGS.replace("l_suppkey\n  FROM lineitem)", "l_suppkey, l_orderkey * 1000000000 + CAST(round(l_extendedprice * 100) AS BIGINT) * 10 + l_linenumber AS place FROM lineitem)")},
e AS (SELECT *, repo_name || '#' || pr_number || '#' || issue_number AS item_id,
  CASE WHEN NOT (map_issue_pr_ok AND base_commit IS NOT NULL AND merge_commit IS NOT NULL) THEN 'skipped_invalid'
       WHEN issue_number % 23 = 0 THEN 'clone_failed' WHEN pr_number % 13 = 0 THEN 'fetch_failed'
       WHEN issue_number % 19 = 0 THEN 'diff_failed' WHEN issue_number % 29 = 0 THEN 'exception' ELSE 'success' END AS st FROM v),
f AS (SELECT item_id, min(place) FILTER (WHERE st = 'skipped_invalid') AS inv, min(place) FILTER (WHERE st IN ('success', 'exception')) AS don
      FROM e GROUP BY 1)
SELECT e.item_id, st AS patch_extraction_status,
  CASE WHEN st = 'success' THEN CASE WHEN issue_number % 7 < 3 THEN 'diff --git a/tests/t.py b/tests/t.py' || chr(10) || '+' || issue_number ELSE '' END END AS test_patch,
  CASE WHEN st = 'success' THEN 'diff --git a/src/s.py b/src/s.py' || chr(10) || '+' || pr_number END AS patch
FROM e JOIN f USING (item_id) WHERE CASE WHEN inv IS NOT NULL THEN place = inv ELSE coalesce(place <= don, TRUE) END
""")
def extract_patches(t: Tables):
    rows = t.lineitem.selectExpr(
        "concat('org/r', l_suppkey % 20) AS repo_name", "l_orderkey AS issue_number", "l_partkey AS pr_number",
        "if(l_returnflag = 'A', 'linked', 'referenced') AS type",
        "if(l_linenumber = 7, NULL, concat('b', l_partkey)) AS base_commit",
        "if(l_quantity > 45, NULL, concat('m', l_partkey)) AS merge_commit",
        "l_orderkey * 1000000000 + cast(round(l_extendedprice * 100) AS BIGINT) * 10 + l_linenumber AS place",
    )
    source = "concat('diff --git a/src/s.py b/src/s.py\\n+', pr_number)"
    test = "concat('\\ndiff --git a/tests/t.py b/tests/t.py\\n+', issue_number)"
    git = rows.select("repo_name", "pr_number", "issue_number").distinct().select(
        collect.item_key("repo_name", "pr_number", "issue_number").alias("item_id"),
        F.expr("issue_number % 23 <> 0").alias("cloned"),
        F.expr("pr_number % 13 <> 0").alias("fetched"),
        F.expr(f"if(issue_number % 19 <> 0, concat({source}, if(issue_number % 7 < 3, {test}, '')), NULL)").alias("full_patch"),
        F.expr("if(issue_number % 29 = 0, 'bad', NULL)").alias("error"),
    )
    out = jobs.extract_patches(collect.validate_mappings(rows), git, "place")
    return out.select("item_id", "patch_extraction_status", "test_patch", "patch")


@query(r.PYTEST + """
, dup AS (SELECT DISTINCT run_id FROM (SELECT run_id, nodeid FROM o GROUP BY 1, 2 HAVING count(*) > 1)),
e AS (SELECT doc_id, unnest(['tests/t0.py::test_0', 'tests/t1.py::test_1', 'tests/t2.py::test_2'][1:CAST(doc_id % 4 AS INTEGER)]) AS nodeid FROM documents),
miss AS (SELECT DISTINCT doc_id FROM e WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.run_id = e.doc_id AND o.nodeid = e.nodeid AND outcome = 'passed'))
SELECT doc_id AS instance_id, source AS repo,
  CASE doc_id % 4 WHEN 0 THEN '[]' WHEN 1 THEN '["tests/t0.py::test_0"]' WHEN 2 THEN '["tests/t0.py::test_0","tests/t1.py::test_1"]'
       ELSE '["tests/t0.py::test_0","tests/t1.py::test_1","tests/t2.py::test_2"]' END AS "PASS_TO_PASS",
  CASE WHEN doc_id % 5 = 4 OR doc_id IN (SELECT run_id FROM dup) THEN NULL
       WHEN doc_id IN (SELECT doc_id FROM miss) THEN 0 ELSE 1 END AS solved
FROM documents
""")
def score_benchmark(t: Tables):
    tasks = t.documents.selectExpr(
        "doc_id AS instance_id", "source AS repo",
        "slice(array('tests/t0.py::test_0', 'tests/t1.py::test_1', 'tests/t2.py::test_2'), 1, cast(doc_id % 4 AS INT)) AS PASS_TO_PASS",
        "cast(array() AS array<string>) AS FAIL_TO_PASS",
    )
    runs = r.pytest_reports(t).withColumnRenamed("run_id", "instance_id").where("instance_id % 5 <> 4")  # those broke down
    return jobs.score_benchmark(tasks, runs).select("instance_id", "repo", "PASS_TO_PASS", "solved")


@query(f"""
WITH {lg.RUNS},
x AS (SELECT run_id, run_id % 13 <> 0 AS ran, bool_or(n % 9 = 6) AS compiled FROM dl GROUP BY 1)
SELECT run_id AS doc_id, CASE WHEN ran AND run_id % 2 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "pass@1",
  CASE WHEN ran AND compiled THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "compile@1",
  CASE WHEN ran THEN '' ELSE 'no result' END AS error, CASE WHEN ran THEN 1 ELSE 0 END AS status FROM x
""")
def score_test_generation(t: Tables):
    logs = lg.maven_logs(t).withColumnRenamed("run_id", "doc_id").where("doc_id % 13 <> 0")  # those broke down
    return jobs.score_test_generation(t.documents.select("doc_id"), logs)


@query("""
WITH f AS (SELECT c_custkey AS id, c_nationkey AS repo, c_mktsegment AS gt FROM customer),
o AS (SELECT user_id AS id, event_id % 3 AS run, (event_id // 3) % 4 AS nodeid, bool_or(event_type <> 'error') AS ok, count(*) AS n FROM events GROUP BY 1, 2, 3),
twice AS (SELECT DISTINCT id FROM o WHERE n > 1),
x AS (SELECT id, nodeid, bool_or(run = 0 AND ok) AS b, bool_or(run = 1 AND ok) AS a, bool_or(run = 2 AND ok) AS g FROM o GROUP BY 1, 2),
v AS (SELECT id, CAST(bool_or(b) AS INTEGER) AS d, CAST(NOT bool_or(b AND NOT a) AND bool_or(a) AS INTEGER) AS gen,
             CAST(NOT bool_or(b AND NOT g) AND bool_or(g) AS INTEGER) AS gt FROM x GROUP BY 1)
SELECT f.id, CASE WHEN twice.id IS NULL THEN coalesce(v.gen, 0) ELSE 0 END AS "pass@1",
  CASE WHEN twice.id IS NULL THEN coalesce(v.gt, 0) ELSE 0 END AS "pass_oracle@1",
  CASE WHEN twice.id IS NULL THEN coalesce(v.d, 0) ELSE 0 END AS "pass_dry_run@1",
  CASE WHEN twice.id IS NULL AND (v.id IS NOT NULL OR f.id % 2 = 0) THEN 1 ELSE 0 END AS execution_success, 1 AS num_samples
FROM f LEFT JOIN v ON v.id = f.id LEFT JOIN twice ON twice.id = f.id WHERE repo IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)
""")
def score_variants(t: Tables):
    tasks = t.customer.selectExpr("c_custkey AS id", "c_nationkey AS repo", "'code' AS gen", "c_mktsegment AS gt", "c_custkey % 2 = 0 AS ran")
    builds = t.nation.selectExpr("n_nationkey AS repo", "if(n_regionkey < 3, 1, 0) AS success")
    outcomes = t.events.selectExpr(
        "user_id AS id", "element_at(array('dry_run', 'gen', 'gt'), cast(event_id % 3 AS INT) + 1) AS run",
        "cast(floor(event_id / 3) AS BIGINT) % 4 AS nodeid", "if(event_type <> 'error', 'passed', 'failed') AS outcome",
    )
    return jobs.score_variants(tasks, builds, outcomes, ["gen", "gt"], "id", ["repo"], evaluated="ran").drop("ran")


@query(f"""
WITH {lg.RUNS},
x AS (SELECT '/runs/r' || (run_id % 9) || '/src/d' || (run_id % 7) || '.py' AS fn, run_id, i, n, CAST(1 + 3 * i AS INTEGER) AS s FROM dl WHERE run_id % 10 <> 9),
defs AS (SELECT fn, run_id, i, CASE n % 3 WHEN 0 THEN s + 2 ELSE s + 1 END AS l, s + 3 AS r, CASE n % 3 WHEN 0 THEN 'f' WHEN 1 THEN 'g' ELSE 'C' END AS k FROM x
         UNION ALL SELECT fn, run_id, i, s + 2, s + 3, 'm' FROM x WHERE n % 3 = 2)
SELECT run_id AS run, fn, l, r, k AS kind, CAST(CASE WHEN i % 4 = 0 THEN 1 ELSE 0 END AS BIGINT) AS n_pass_to_pass,
  CAST(CASE WHEN i % 4 = 2 THEN 1 ELSE 0 END AS BIGINT) AS n_fail_to_pass, round_even(CASE WHEN i % 2 = 0 THEN 100.0::DOUBLE / (r - l + 1) ELSE 0.0 END, 2) AS coverage_rate
FROM defs
""")
def collect_tasks(t: Tables):
    files = d.python_files(t)
    # the last line of every other definition is covered by a test of its own
    spots = t.documents.selectExpr(
        "doc_id AS run", "concat('/runs/r', doc_id % 9, '/src/d', doc_id % 7, '.py') AS fn", "posexplode(split(text, '\\n')) AS (i, ln)"
    ).where("i % 2 = 0")
    contexts = spots.selectExpr("run", "fn", "cast(4 + 3 * i AS INT) AS line", "concat('t::', i, '|run') AS context")
    outcomes = spots.selectExpr("run", "concat('t::', i) AS nodeid", "if(i % 4 = 0, 'passed', 'failed') AS outcome")
    # parsed once: three parts of the plan read the definitions
    folder = scratch_folder(t.spark, "definitions")
    found = jobs.collect_tasks(files, contexts, outcomes, keys=["run"], folder=folder)
    kind = F.substring("intent_name", 1, 1).alias("kind")
    return found.select("run", "fn", "l", "r", kind, "n_pass_to_pass", "n_fail_to_pass", "coverage_rate")
