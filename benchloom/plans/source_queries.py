"""Queries over sources and sinks: tables are written in the formats of the jobs and read back; and whole rows of operators
of which other queries compare counts."""

from pyspark.sql import functions as F

from ..operators import collect, evaluate, patches, reports, stdout_logs as logs
from ..sources import files
from .collect_queries import ITEMS, issues
from .log_queries import RUNS, javascript_logs
from .patch_queries import LINES, diffs
from .registry import Tables, query

CUSTOMER = "c_custkey LONG, c_name STRING, c_acctbal DOUBLE, note STRING"
NOTED = "c_custkey, c_name, c_acctbal, if(c_custkey % 3 = 0, NULL, concat(c_mktsegment, '\\n\"', c_name, '\" é')) AS note"
NOTED_SQL = """SELECT c_custkey, c_name, c_acctbal,
  CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment || chr(10) || '"' || c_name || '" é' END AS note FROM customer"""


@query(NOTED_SQL)
def jsonl_append(t: Tables):
    """Two halves of a table, appended."""
    folder, rows = files.scratch_folder(t.spark, "jsonl"), t.customer.selectExpr(*NOTED.split(", ", 3))
    for half in (0, 1):
        files.append_jsonl(rows.where(F.col("c_custkey") % 2 == half), folder)
    return files.read_jsonl(t.spark, folder, CUSTOMER)


@query(NOTED_SQL)
def jsonl_batches(t: Tables):
    """Three batches, two of which are written again."""
    folder, rows = files.scratch_folder(t.spark, "batches"), t.customer.selectExpr(*NOTED.split(", ", 3))
    for batch in (0, 1, 0, 2, 2):
        files.append_batch(rows.where(F.col("c_custkey") % 3 == batch), folder, f"b{batch}")
    return files.read_batches(t.spark, folder, CUSTOMER)


@query("""
SELECT p_partkey, p_size / 8.0::DOUBLE AS "pass@1", CASE WHEN p_partkey % 5 <> 0 THEN p_size % 7 END::INTEGER AS n_tests FROM part
""")
def metrics_csv(t: Tables):
    folder = files.scratch_folder(t.spark, "csv")
    rows = t.part.selectExpr("p_partkey", "p_size / 8.0D AS `pass@1`", "if(p_partkey % 5 = 0, NULL, cast(p_size % 7 AS INT)) AS n_tests")
    files.write_metrics_csv(rows, folder)
    return t.spark.read.schema("p_partkey LONG, `pass@1` DOUBLE, n_tests INT").option("header", True).csv(folder)


@query("""
SELECT 'C' || p_partkey AS "CLASS", CAST(p_size AS BIGINT) AS "INSTRUCTION_MISSED",
       CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_partkey % 100 AS BIGINT) END AS "INSTRUCTION_COVERED" FROM part
""")
def jacoco_csv(t: Tables):
    """Reports whose columns stand in another order, with a count that is no number."""
    folder = files.scratch_folder(t.spark, "jacoco")
    rows = t.part.selectExpr(
        "'g' AS GROUP", "concat('C', p_partkey) AS CLASS", "if(p_partkey % 4 = 0, 'many', cast(p_partkey % 100 AS STRING)) AS INSTRUCTION_COVERED",
        "p_size AS INSTRUCTION_MISSED", "7 AS OTHER",
    )
    rows.write.option("header", True).csv(folder)
    return files.read_jacoco(t.spark, folder).select("CLASS", "INSTRUCTION_MISSED", "INSTRUCTION_COVERED")


RUN_PATH = "concat('/runs/r', p_size, if(p_partkey % 3 = 0, '/sub/target', if(p_partkey % 3 = 1, '/sub2', '/lib')), '/f', p_partkey, '.xml')"


@query("""
WITH p AS (SELECT '/runs/r' || p_size || CASE p_partkey % 3 WHEN 0 THEN '/sub/target' WHEN 1 THEN '/sub2' ELSE '/lib' END || '/f' || p_partkey || '.xml' AS path FROM part),
r AS (SELECT DISTINCT '/runs/r' || p_size || CASE WHEN p_size % 2 = 0 THEN '/sub' ELSE '' END AS root FROM part WHERE p_size % 5 <> 4
      UNION SELECT DISTINCT '/runs/r' || p_size FROM part WHERE p_size % 4 = 0)
SELECT path, max_by(root, length(root)) AS root FROM p JOIN r ON starts_with(path, root || '/') GROUP BY path
""")
def deepest_runs(t: Tables):
    """Paths of reports and folders of runs, some of which lie in others; names of folders begin alike."""
    roots = t.part.where("p_size % 5 <> 4").selectExpr("concat('/runs/r', p_size, if(p_size % 2 = 0, '/sub', '')) AS root")
    more = t.part.where("p_size % 4 = 0").selectExpr("concat('/runs/r', p_size, '/') AS root")
    return files.deepest_root(t.part.selectExpr(f"{RUN_PATH} AS path"), roots.unionByName(more))


@query(f"""
WITH {ITEMS},
r AS (SELECT 'org0/r' || k AS repo_name, k * 10 AS stars, CASE WHEN k % 2 = 0 THEN 'Python' END AS language FROM range(0, 20, 3) x(k))
SELECT type, o_orderkey AS issue_number, (o_orderkey * 3 + k) % 4000 AS pr_number, repo_name, stars, language FROM links JOIN r USING (repo_name)
""")
def mapping_with_repo(t: Tables):
    """Mapping rows that carry the row of the repository search."""
    found = t.orders.selectExpr("o_custkey % 20 AS k").where("k % 3 = 0").distinct()
    repos = found.selectExpr(
        "concat('org0/r', k) AS nameWithOwner", "k * 10 AS stargazerCount", "if(k % 2 = 0, named_struct('name', 'Python'), NULL) AS primaryLanguage"
    )
    rows = collect.build_pr_issue_mapping(issues(t), repos, closed_after="1996-06-01T00:00:00Z")
    return rows.select(
        "type", "issue_number", "pr_number", "repo_name", F.col("_step1_data.stargazerCount").alias("stars"),
        F.col("_step1_data.primaryLanguage.name").alias("language"),
    )


# --- whole rows -------------------------------------------------------------------


@query("""
WITH b AS (SELECT DISTINCT c_custkey AS repo FROM customer WHERE c_acctbal > 2500)
SELECT 'python' AS kind, o_orderkey, o_custkey AS repo, 1 AS ok FROM orders WHERE o_custkey IN (SELECT repo FROM b)
UNION ALL SELECT 'java', o_orderkey, o_custkey, CASE WHEN o_custkey IN (SELECT repo FROM b) THEN 1 ELSE 0 END FROM orders
""")
def build_gate_rows(t: Tables):
    tasks = t.orders.selectExpr("o_orderkey", "o_custkey AS repo")
    builds = t.customer.selectExpr("c_custkey AS repo", "if(c_acctbal > 2500, 1, 0) AS success")
    row = lambda df, kind, ok: df.select(F.lit(kind).alias("kind"), "o_orderkey", "repo", ok.cast("int").alias("ok"))
    python = row(evaluate.build_gate(tasks, builds, ["repo"]), "python", F.lit(1))
    java = row(evaluate.build_gate(tasks, builds, ["repo"], keep_failed=True), "java", F.coalesce(F.col("status") == 1, F.lit(False)))
    return python.unionByName(java)


@query(f"""
WITH {RUNS}
SELECT run_id, CASE run_id % 3 WHEN 0 THEN 'mocha' ELSE 'jest' END AS framework, status, count(*) AS n FROM (
  SELECT run_id, CASE WHEN run_id % 3 = 0 THEN CASE n % 3 WHEN 0 THEN 'PASSED' WHEN 1 THEN 'FAILED' END
                      WHEN run_id % 3 = 1 THEN CASE n % 2 WHEN 0 THEN 'PASS' ELSE 'FAIL' END END AS status FROM dl)
WHERE status IS NOT NULL GROUP BY ALL
""")
def javascript_tests_per_run(t: Tables):
    tests = logs.javascript_tests(javascript_logs(t))
    framework = F.when(F.col("run_id") % 3 == 0, "mocha").otherwise("jest").alias("framework")
    return tests.groupBy("run_id", framework, "status").agg(F.count("*").alias("n"))


@query("""
SELECT doc_id, CASE WHEN doc_id % 4 < 2 THEN 'json' ELSE 'xml' END AS format FROM documents
""")
def report_format_rows(t: Tables):
    text = F.expr(
        "CASE doc_id % 4 WHEN 0 THEN concat(' \\n[', text) WHEN 1 THEN concat('{', text)"
        " WHEN 2 THEN concat('<a>', text) ELSE text END"
    )
    return t.documents.select("doc_id", reports.report_format(text).alias("format"))


@query(f"""
WITH {LINES}, d AS (SELECT doc_id, count(*) AS n_lines FROM dl GROUP BY 1)
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'empty' WHEN 1 THEN 'not_a_diff' WHEN 2 THEN 'empty' ELSE 'apply' END AS state,
       doc_id % 4 = 3 AND n_lines <= 8 AS kept FROM d
""")
def patch_applicable_rows(t: Tables):
    patch = F.expr("""CASE doc_id % 4 WHEN 0 THEN ' \\n\\t ' WHEN 1 THEN substr(full_patch, 6)
        WHEN 2 THEN NULL ELSE substr(full_patch, 13) END""")
    rows = diffs(t).withColumn("patch", patch).withColumn("state", patches.patch_applicability(F.col("patch")))
    kept = (F.col("state") == "apply") & patches.capped_diff(F.col("patch"), 8).isNotNull()
    return rows.select("doc_id", "state", kept.alias("kept"))
