"""Queries that score runs and aggregate metrics.

Events become test outcomes: a user is a task, an event one result of one test in one
of four runs, and the last event of a test in a run counts.
"""

from pyspark.sql import DataFrame, functions as F

from ..operators import evaluate, metrics
from .patch_queries import LINES
from .registry import Tables, query

RUN_NAMES = ("before", "after", "gold", "model")


def outcomes(t: Tables) -> DataFrame:
    """``task, run, nodeid, outcome``; the last event per test and run, as an aggregate."""
    raw = t.events.selectExpr(
        "user_id AS task",
        "element_at(array('before', 'after', 'gold', 'model'), cast(event_id % 4 AS INT) + 1) AS run",
        "concat('t.py::test_', cast(floor(event_id / 4) AS BIGINT) % 5) AS nodeid",
        "event_id",
        "if(event_id % 4 = 1, event_type IN ('purchase', 'view'), event_type <> 'error') AS ok",
    )
    last = raw.groupBy("task", "run", "nodeid").agg(F.max_by("ok", "event_id").alias("ok"))
    return last.select("task", "run", "nodeid", F.when(F.col("ok"), "passed").otherwise("failed").alias("outcome"))


def listed(t: Tables) -> DataFrame:
    """The outcomes, with one test listed twice in the second run of some tasks."""
    once = outcomes(t)
    again = once.where("task % 17 = 3 AND run = 'after' AND nodeid = 't.py::test_0'")
    return once.unionByName(again.withColumn("outcome", F.lit("passed")))


DUPLICATES = """
dup AS (SELECT DISTINCT task FROM o WHERE task % 17 = 3 AND run = 'after' AND nodeid = 't.py::test_0')
"""

OUTCOMES = """
o AS (
  SELECT task, run, nodeid, CASE WHEN arg_max(ok, event_id) THEN 'passed' ELSE 'failed' END AS outcome FROM (
    SELECT user_id AS task, ['before', 'after', 'gold', 'model'][event_id % 4 + 1] AS run,
           't.py::test_' || ((event_id // 4) % 5) AS nodeid, event_id,
           CASE WHEN event_id % 4 = 1 THEN event_type IN ('purchase', 'view') ELSE event_type <> 'error' END AS ok
    FROM events) GROUP BY 1, 2, 3)
"""


@query(f"""
WITH {OUTCOMES}, {DUPLICATES},
x AS (SELECT task, nodeid, bool_or(run = 'gold' AND outcome = 'passed') AS g, bool_or(run = 'after' AND outcome = 'passed') AS a,
             bool_or(run = 'gold') AS ing FROM o GROUP BY 1, 2),
c AS (SELECT task, count(*) FILTER (WHERE g AND NOT a) > 0 AS ok,
        count(*) FILTER (WHERE g) > count(*) FILTER (WHERE a) AND count(*) FILTER (WHERE a AND NOT g) = 0 AS perfect,
        count(*) FILTER (WHERE g) AS p2p, count(*) FILTER (WHERE ing AND NOT g) AS f2p FROM x GROUP BY 1),
k AS (SELECT c_custkey AS task, c_custkey IN (SELECT task FROM dup) AS void FROM customer)
SELECT k.task, CASE WHEN NOT void THEN coalesce(ok, FALSE) END AS task_ok, CASE WHEN NOT void THEN coalesce(perfect, FALSE) END AS task_perfect,
  CASE WHEN NOT void THEN coalesce(p2p, 0) END AS n_pass_to_pass, CASE WHEN NOT void THEN coalesce(f2p, 0) END AS n_fail_to_pass
FROM k LEFT JOIN c ON c.task = k.task
""")
def task_correctness(t: Tables):
    return evaluate.task_correctness(listed(t), tasks=t.customer.selectExpr("c_custkey AS task"))


@query(f"""
WITH {OUTCOMES}
SELECT task, CASE outcome WHEN 'passed' THEN 'PASS_TO_PASS' ELSE 'FAIL_TO_PASS' END AS list, nodeid FROM o WHERE run = 'gold'
""")
def task_test_lists(t: Tables):
    return evaluate.task_test_lists(outcomes(t))


@query(f"""
WITH {OUTCOMES},
l AS (SELECT task, string_agg('"' || nodeid || '"', ',' ORDER BY nodeid) FILTER (WHERE outcome = 'passed') AS p,
             string_agg('"' || nodeid || '"', ',' ORDER BY nodeid) FILTER (WHERE outcome <> 'passed') AS f
      FROM o WHERE run = 'gold' GROUP BY 1)
SELECT task, '[' || coalesce(p, '') || ']' AS "PASS_TO_PASS", '[' || coalesce(f, '') || ']' AS "FAIL_TO_PASS" FROM l
""")
def test_lists_json(t: Tables):
    return evaluate.test_lists_json(evaluate.task_test_lists(outcomes(t)))


SOLVED = f"""
WITH {OUTCOMES},
e AS (SELECT task, nodeid FROM o WHERE run = 'gold' AND outcome = 'passed'),
m AS (SELECT task, nodeid, outcome FROM o WHERE run = 'model' AND task % 7 <> 0),
s AS (SELECT c_custkey AS task, CASE WHEN c_custkey NOT IN (SELECT task FROM m) THEN NULL
        WHEN EXISTS (SELECT 1 FROM e WHERE e.task = c_custkey AND e.nodeid NOT IN
               (SELECT nodeid FROM m WHERE m.task = c_custkey AND outcome = 'passed')) THEN 0 ELSE 1 END AS solved
      FROM customer)
"""


def scored(t: Tables) -> DataFrame:
    """Tasks are the customers; the model run of every seventh task broke down."""
    runs = outcomes(t)
    lists = evaluate.task_test_lists(runs).where(F.col("list") == "PASS_TO_PASS")
    model = runs.where((F.col("run") == "model") & (F.col("task") % 7 != 0))
    every = t.customer.select(F.col("c_custkey").alias("task"))
    known = lists.join(every, "task", "left_semi")
    return evaluate.solved(known, model.join(every, "task", "left_semi"), every)


@query(SOLVED + "SELECT task, solved FROM s")
def solved(t: Tables):
    return scored(t)


@query(SOLVED + """
SELECT count(*) AS n_tasks, count(*) FILTER (WHERE solved IS NULL) AS n_critical_fail,
  CAST(coalesce(sum(solved), 0) AS BIGINT) AS n_solved,
  round(count(*) FILTER (WHERE solved IS NULL) / count(*)::DOUBLE, 9) AS critical_fail_rate,
  round(coalesce(sum(solved), 0)::DOUBLE / count(*), 9) AS solved_rate FROM s
""")
def solve_rate(t: Tables):
    rates = evaluate.solve_rate(scored(t))
    rounded = {c: F.round(c, 9) for c in ("critical_fail_rate", "solved_rate")}
    return rates.withColumns(rounded)


VARIANT = f"""
WITH {OUTCOMES}, {DUPLICATES},
x AS (SELECT task, nodeid, bool_or(run = 'before' AND outcome = 'passed') AS b, bool_or(run = 'after' AND outcome = 'passed') AS a,
             bool_or(run = 'gold' AND outcome = 'passed') AS g FROM o GROUP BY 1, 2),
r AS (SELECT task, CAST(bool_or(b) AS INTEGER) AS pass_dry_run,
        CAST(NOT bool_or(b AND NOT a) AND bool_or(a) AS INTEGER) AS pass_gen,
        CAST(NOT bool_or(b AND NOT g) AND bool_or(g) AS INTEGER) AS pass_gt,
        CAST(NOT bool_or(b AND NOT a) AS INTEGER) AS loose_gen FROM x GROUP BY 1),
f AS (SELECT r.task, CASE WHEN dup.task IS NULL THEN pass_dry_run END AS pass_dry_run, CASE WHEN dup.task IS NULL THEN pass_gen END AS pass_gen,
        CASE WHEN dup.task IS NULL THEN pass_gt END AS pass_gt, CASE WHEN dup.task IS NULL THEN loose_gen END AS loose_gen
      FROM r LEFT JOIN dup ON dup.task = r.task)
"""


def variant_outcomes(t: Tables) -> DataFrame:
    names = {"before": "dry_run", "after": "gen", "gold": "gt"}
    return listed(t).where(F.col("run") != "model").replace(names, subset=["run"])


@query(VARIANT + "SELECT * FROM f")
def variant_pass(t: Tables):
    return evaluate.variant_pass(variant_outcomes(t), ["gen", "gt"], loose=["gen"])


@query(VARIANT + """
SELECT c_custkey AS task, coalesce(pass_dry_run, 0) AS pass_dry_run, coalesce(pass_gen, 0) AS pass_gen,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN coalesce(pass_gt, 0) END AS pass_gt,
  CASE WHEN pass_dry_run IS NOT NULL OR (f.task IS NULL AND c_custkey % 10 <> 0) THEN 1 ELSE 0 END AS status
FROM customer LEFT JOIN f ON f.task = c_custkey
""")
def evaluation_flags(t: Tables):
    tasks = t.customer.selectExpr(
        "c_custkey AS task", "'code' AS gen", "if(c_mktsegment <> 'BUILDING', 'code', NULL) AS gt",
        "c_custkey % 10 <> 0 AS ran",
    )
    flags = evaluate.variant_pass(variant_outcomes(t), ["gen", "gt"])
    return evaluate.zero_failed_flags(tasks, flags, ["gen", "gt"], evaluated="ran").drop("gen", "gt", "ran")


@query("""
SELECT o_custkey % 200 AS repo, o_orderpriority AS base_commit, arg_min(o_orderkey, o_orderkey) AS o_orderkey,
       arg_min(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY 1, 2
""")
def distinct_builds(t: Tables):
    tasks = t.orders.selectExpr(
        "o_custkey % 200 AS repo", "o_orderpriority AS base_commit", "o_orderkey", "o_totalprice"
    )
    return evaluate.distinct_builds(tasks, ["repo", "base_commit"], "o_orderkey")


@query("""
WITH t AS (SELECT o_orderkey, o_custkey AS repo FROM orders),
b AS (SELECT DISTINCT c_custkey AS repo FROM customer WHERE c_acctbal > 2500)
SELECT 'python' AS kind, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS keys, count(*) AS n_ok FROM t WHERE repo IN (SELECT repo FROM b)
UNION ALL
SELECT 'java', count(*), CAST(sum(o_orderkey) AS BIGINT), count(*) FILTER (WHERE repo IN (SELECT repo FROM b)) FROM t
""")
def build_gate(t: Tables):
    tasks = t.orders.selectExpr("o_orderkey", "o_custkey AS repo")
    builds = t.customer.selectExpr("c_custkey AS repo", "if(c_acctbal > 2500, 1, 0) AS success")
    python = evaluate.build_gate(tasks, builds, ["repo"]).withColumn("status", F.lit(1))
    java = evaluate.build_gate(tasks, builds, ["repo"], keep_failed=True)
    both = python.withColumn("kind", F.lit("python")).unionByName(java.withColumn("kind", F.lit("java")))
    return both.groupBy("kind").agg(
        F.count("*").alias("n_rows"), F.sum("o_orderkey").alias("keys"),
        F.count_if(F.col("status") == 1).alias("n_ok"),
    )


@query("""
SELECT c_custkey, lower(replace('Org' || c_nationkey || '/' || c_name, '/', '--') || '--' || 'A' || c_custkey) AS instance_id,
  'Org' || c_nationkey || '-' || c_name AS slug,
  CASE WHEN c_custkey % 2 = 0 THEN 'make;' || chr(10) || 'pytest' ELSE 'make;' || chr(10) || 'pytest' END AS command
FROM customer
""")
def instance_ids(t: Tables):
    rows = t.customer.selectExpr(
        "c_custkey", "concat('Org', c_nationkey, '/', c_name) AS repo", "concat('A', c_custkey) AS sha",
        "if(c_custkey % 2 = 0, 'make', 'make;') AS build",
    )
    return rows.select(
        "c_custkey",
        evaluate.instance_id(F.col("repo"), F.col("sha")).alias("instance_id"),
        evaluate.repo_slug(F.col("repo")).alias("slug"),
        evaluate.build_and_test(F.col("build"), F.lit("pytest")).alias("command"),
    )


@query("""
WITH f AS (SELECT l_orderkey AS repo, bool_or(l_partkey % 10 = 0) AS root, bool_or(l_partkey % 10 = 1) AS sub FROM lineitem GROUP BY 1)
SELECT repo, CASE WHEN root THEN 'mvn test' WHEN sub THEN 'cd java; mvn test' END AS command,
       CASE WHEN NOT root AND NOT sub THEN 'no_pom' END AS error FROM f
""")
def java_test_command(t: Tables):
    files = t.lineitem.selectExpr(
        "l_orderkey AS repo",
        "CASE l_partkey % 10 WHEN 0 THEN 'pom.xml' WHEN 1 THEN 'java/pom.xml' ELSE concat('src/F', l_partkey) END AS path",
    )
    return evaluate.java_test_command(files)


# --- metrics ----------------------------------------------------------------------

FLAGS = """
f AS (SELECT d.doc_id, CASE WHEN d.doc_id % 7 <> 0 THEN quality END AS pass_gen, toxic AS pass_gt,
             CASE WHEN d.n_chars > 400 THEN 1 ELSE 0 END AS status
      FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
"""


def task_metrics(t: Tables) -> DataFrame:
    """Flags of the labelled documents; unlabelled ones and every seventh have none."""
    rows = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id", "left")
    return rows.selectExpr(
        "doc_id", "if(doc_id % 7 <> 0, quality, NULL) AS pass_gen", "toxic AS pass_gt",
        "if(n_chars > 400, 1, 0) AS status",
    )


@query(f"""
WITH {FLAGS}
SELECT 'pass@1' AS metric, sum(pass_gen)::DOUBLE AS total, round(avg(pass_gen), 9) AS mean, count(*) - count(pass_gen) AS n_missing FROM f
UNION ALL SELECT 'pass_oracle@1', sum(pass_gt)::DOUBLE, round(avg(pass_gt), 9), count(*) - count(pass_gt) FROM f
UNION ALL SELECT 'execution_success', sum(status)::DOUBLE, round(avg(status), 9), count(*) - count(status) FROM f
UNION ALL SELECT 'num_samples', count(*)::DOUBLE, 1.0, 0 FROM f
""")
def completion_metrics(t: Tables):
    renamed = metrics.rename_metrics(task_metrics(t))
    return metrics.sum_and_mean(renamed, renamed.columns).withColumn("mean", F.round("mean", 9))


@query(f"""
WITH {FLAGS}
SELECT round(avg(coalesce(pass_gen, 0)), 9) AS "pass@1", round(avg(coalesce(pass_gt, 0)), 9) AS "compile@1", count(*) AS num_samples FROM f
""")
def testgen_metrics(t: Tables):
    tasks = task_metrics(t).withColumnsRenamed({"pass_gen": "pass@1", "pass_gt": "compile@1"})
    out = metrics.testgen_metrics(tasks)
    return out.select(F.round("`pass@1`", 9).alias("pass@1"), F.round("`compile@1`", 9).alias("compile@1"), "num_samples")


def drift_tasks(t: Tables) -> DataFrame:
    return task_metrics(t).selectExpr(
        "doc_id", "status", "pass_gen AS `pass@1`", "pass_gt AS `compile@1`",
        "cast(doc_id % 2 AS DOUBLE) AS `original_pass@1`", "if(doc_id % 5 = 0, NULL, 1.0D) AS `original_compile@1`",
        "if(doc_id % 11 = 0, concat('bad ', doc_id), '') AS error",
    )


@query(f"""
WITH {FLAGS},
a AS (SELECT count(*) AS total_tasks, count(*) FILTER (WHERE status = 1) AS successful_tasks,
  avg(coalesce(pass_gen, 0)) AS p, avg(coalesce(pass_gt, 0)) AS c, avg(doc_id % 2) AS op, avg(CASE WHEN doc_id % 5 = 0 THEN 0.0 ELSE 1.0 END) AS oc,
  count(*) FILTER (WHERE doc_id % 11 = 0) AS n_errors FROM f)
SELECT total_tasks, successful_tasks, round(successful_tasks / total_tasks::DOUBLE, 9) AS success_rate, round(p, 9) AS "avg_pass@1",
  round(c, 9) AS "avg_compile@1", round(op, 9) AS "original_avg_pass@1", round(oc, 9)::DOUBLE AS "original_avg_compile@1", n_errors,
  round(abs(p - op), 9) AS "pass@1_difference", round(abs(c - oc), 9)::DOUBLE AS "compile@1_difference" FROM a
""")
def metric_drift(t: Tables):
    drift = metrics.metric_drift(drift_tasks(t))
    return drift.select(*[F.round(f"`{c}`", 9).alias(c) if d == "double" else F.col(c) for c, d in drift.dtypes])


@query("SELECT doc_id, 'bad ' || doc_id AS error FROM documents WHERE doc_id % 11 = 0")
def task_errors(t: Tables):
    return metrics.task_errors(drift_tasks(t), ["doc_id"])


@query(f"""
WITH {FLAGS},
a AS (SELECT doc_id, status, pass_gt FROM f WHERE doc_id % 5 <> 1), b AS (SELECT doc_id, 1 - status AS status, pass_gt FROM f WHERE doc_id % 3 <> 1)
SELECT coalesce(a.doc_id, b.doc_id) AS doc_id,
  CASE WHEN a.doc_id IS NULL THEN 'second' WHEN b.doc_id IS NULL THEN 'first' ELSE 'both' END AS present_in,
  a.status IS DISTINCT FROM b.status AS status_differs, a.pass_gt IS DISTINCT FROM b.pass_gt AS pass_gt_differs
FROM a FULL JOIN b ON a.doc_id = b.doc_id
""")
def run_diff(t: Tables):
    rows = task_metrics(t)
    first = rows.where("doc_id % 5 <> 1")  # tasks missing from one run or the other
    second = rows.where("doc_id % 3 <> 1").withColumn("status", 1 - F.col("status"))
    return metrics.run_diff(first, second, ["doc_id"], ["status", "pass_gt"])


@query(f"""
WITH {FLAGS}
SELECT count(*) AS first_tasks, count(*) AS second_tasks, round(abs(avg(status) - avg(1 - status)), 9) AS status_difference,
  0.0::DOUBLE AS pass_gt_difference FROM f
""")
def run_difference(t: Tables):
    rows = task_metrics(t)
    out = metrics.run_difference(rows, rows.withColumn("status", 1 - F.col("status")), ["status", "pass_gt"])
    return out.withColumns({c: F.round(c, 9) for c in ("status_difference", "pass_gt_difference")})


# --- task tables ------------------------------------------------------------------


@query("""
SELECT doc_id AS id, source AS repo, 'c' || doc_id AS base_commit, 'function' AS intent_type, lang AS intent,
  md5(repeat(' ', CAST(doc_id % 5 AS INTEGER)) || text) AS gt, md5('gen ' || text) AS gen,
  repeat(' ', CAST(doc_id % 5 AS INTEGER)) || 'pass' AS return_pass, repeat(' ', CAST(doc_id % 5 AS INTEGER)) || 'return ""' AS return_empty_str
FROM documents
""")
def prepare_tasks(t: Tables):
    samples = t.documents.selectExpr(
        """named_struct('meta', named_struct('id', doc_id, 'repo', source, 'base_commit', concat('c', doc_id),
            'image_name', 'i', 'build_command', 'b', 'test_command', 't', 'fn', 'f.py', 'PASS_TO_PASS', 1,
            'FAIL_TO_PASS', 0, 'gt', concat(repeat(' ', cast(doc_id % 5 AS INT)), text), 'intent', lang,
            'intent_type', 'function', 'left_context', '', 'right_context', '')) AS doc""",
        "concat('gen ', text) AS fixed_code",
    )
    return metrics.prepare_tasks(samples).select(
        "id", "repo", "base_commit", "intent_type", "intent", F.md5("gt").alias("gt"), F.md5("gen").alias("gen"),
        "return_pass", "return_empty_str",
    )


@query("""
SELECT conv_id * 100 + turn AS doc_id, role AS repo,
  CASE turn % 3 WHEN 0 THEN '' WHEN 1 THEN '' ELSE text END AS generated_code,
  CASE WHEN turn % 2 = 0 THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END AS "original_pass@1", 0.0::DOUBLE AS "original_compile@1"
FROM conversations
""")
def prepare_java_tasks(t: Tables):
    samples = t.conversations.selectExpr(
        "conv_id * 100 + turn AS doc_id",
        """named_struct('meta', named_struct('instance_id', 'i', 'repo', role, 'base_commit', 'c', 'image_name', 'x',
            'test_command', 't', 'fn_test', 'T.java', 'source_code', 's')) AS doc""",
        """CASE turn % 3 WHEN 0 THEN array() WHEN 1 THEN array(array())
            ELSE array(array(concat('Sure\\n```java\\n', text, '\\n```'), 'second'), array('other')) END AS resps""",
        "if(turn % 2 = 0, NULL, 0.5D) AS `pass@1`",
        "cast(NULL AS DOUBLE) AS compilation_rate",
    )
    return metrics.prepare_java_tasks(samples).select(
        "doc_id", "repo", "generated_code", "original_pass@1", "original_compile@1"
    )


def build_logs(t: Tables) -> DataFrame:
    """A library per document and a command per line, so a script is no longer than a text."""
    rows = t.documents.selectExpr("doc_id", "posexplode(split(text, '\\n')) AS (i, ln)")
    return rows.selectExpr(
        "concat('data/v3/lib', doc_id) AS path_lib_name",
        "concat('/root/data/v3/lib', doc_id, if(length(ln) % 2 = 0, '/venv/bin/pip install p', '/setup.py b'), i, ' ', ln) AS cmd",
        "if(length(ln) % 3 = 0, 1, 0) AS returncode",
        "1000000 - i AS seq",
    )


@query(f"""
WITH {LINES}
SELECT source AS lib_name, (1000000 - i) * 1000000 + doc_id AS position,
  CASE WHEN n % 2 = 0 THEN '$path_venv/bin/pip install p' ELSE '$path_lib/setup.py b' END || i || ' ' || ln AS command
FROM dl JOIN documents USING (doc_id) WHERE n % 3 <> 0
""")
def build_command_lines(t: Tables):
    """Libraries with the commands of many documents each."""
    rows = t.documents.selectExpr("doc_id", "source", "posexplode(split(text, '\\n')) AS (i, ln)").selectExpr(
        "concat('data/v3/', source) AS path_lib_name",
        "concat('/root/data/v3/', source, if(length(ln) % 2 = 0, '/venv/bin/pip install p', '/setup.py b'), i, ' ', ln) AS cmd",
        "if(length(ln) % 3 = 0, 1, 0) AS returncode",
        "cast((1000000 - i) AS BIGINT) * 1000000 + doc_id AS seq",
    )
    return metrics.build_command_lines(rows, "/root", "venv")


BUILD = f"""
WITH {LINES},
b AS (SELECT 'lib' || doc_id AS lib_name,
    CASE WHEN n % 2 = 0 THEN '$path_venv/bin/pip install p' ELSE '$path_lib/setup.py b' END || i || ' ' || ln AS cmd,
    n % 3 = 0 AS failed, i FROM dl),
c AS (SELECT lib_name, string_agg(cmd, chr(10) ORDER BY i DESC) AS command FROM b WHERE NOT failed GROUP BY 1)
"""


@query(BUILD + """
SELECT 'lib' || doc_id AS repo, source, command, CASE WHEN command IS NULL THEN 'no_command' END AS error
FROM documents LEFT JOIN c ON lib_name = 'lib' || doc_id
""")
def build_commands(t: Tables):
    scripts = metrics.build_commands(build_logs(t), "/root", "venv")
    dataset = t.documents.selectExpr("concat('lib', doc_id) AS repo", "source")
    return metrics.add_commands(dataset, scripts)


@query(BUILD + "SELECT count(DISTINCT lib_name) AS n_libs, count(DISTINCT CASE WHEN NOT failed THEN lib_name END) AS n_libs_ok FROM b")
def library_counts(t: Tables):
    return metrics.library_counts(build_logs(t))


@query("""
SELECT page_id, 'b' || page_id AS branch, CASE WHEN page_id % 4 <> 0 THEN url END AS url,
       CASE WHEN page_id % 4 = 0 THEN 'not_one_url' END AS error FROM pages
""")
def git_metadata(t: Tables):
    rows = t.pages.selectExpr(
        "page_id",
        "concat('ref: refs/heads/x/b', page_id, '\\nrest/z') AS head",
        "concat('[remote \"origin\"]\\n\\turl = ', url, '\\n', if(page_id % 4 = 0, concat('\\turl = ', url, '\\n'), '\\tfetch = +refs\\n'))"
        " AS config",
    )
    return metrics.git_metadata(rows).select("page_id", "branch", "url", "error")
