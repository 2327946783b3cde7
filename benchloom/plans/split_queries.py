"""Queries over logs that are files of lines: one log per source, written from the documents and read in splits.

The log of a source is made of the logs of its documents, in the order of their ids.  Its file is written by ranges
of ids, so a source of any size is written and read by many tasks.
"""

from pyspark.sql import DataFrame, functions as F

from ..operators import reports, split_logs
from ..sources import files
from .log_queries import RUNS, maven_logs, pytest_logs, sbt_logs
from .patch_queries import PATH, diffs
from .registry import Tables, query
from .report_queries import GO, go_reports, rust_reports

KEYS = ("source",)


def log_lines(t: Tables, cells: DataFrame, text: str, key: str = "run_id") -> DataFrame:
    """``source, at, line`` of the cells, from files."""
    folder = files.scratch_folder(t.spark, "logs")
    sources = t.documents.select(F.col("doc_id").alias(key), "source").where("source IS NOT NULL")
    rows = cells.select(key, F.col(text).alias("text")).where("text IS NOT NULL").join(sources, key)
    ranged = rows.repartitionByRange("source", key).sortWithinPartitions("source", key)
    ranged.select("source", "text").write.partitionBy("source").text(folder)
    source = F.regexp_extract("_metadata.file_path", r"/source=([^/]*)/", 1)
    return files.read_log_lines(t.spark, folder, "*.txt", source).withColumnRenamed("path", "source")


#: The document lines with their source, and their place ``o`` in its log.
PLACED = f"{RUNS}, ol AS (SELECT dl.*, source, run_id * 1000000 + i AS o FROM dl JOIN documents ON doc_id = run_id)"


@query(f"""
WITH {PLACED}
SELECT source, bool_or(run_id % 2 = 0) AS success, bool_or(n % 9 = 6) AS compiled,
  CAST(coalesce(max_by(i, o) FILTER (WHERE n % 9 = 3), 0) AS BIGINT) AS tests, count(*) FILTER (WHERE n % 9 IN (0, 1, 2)) AS n_errors
FROM ol GROUP BY 1
""")
def split_maven(t: Tables):
    lines = log_lines(t, maven_logs(t), "stdout")
    return split_logs.maven_summary(lines, KEYS).select("source", "success", "compiled", "tests", "n_errors")


@query(f"""
WITH {PLACED},
c AS (SELECT source, count(*) FILTER (WHERE n % 8 IN (0, 7)) AS tests, min(o) FILTER (WHERE n % 8 IN (0, 7)) AS ft,
        min(o) FILTER (WHERE n % 8 IN (2, 5)) AS fm, max_by(i, o) FILTER (WHERE n % 8 = 1) AS lf FROM ol GROUP BY 1),
x AS (SELECT source, tests + CASE WHEN fm IS NOT NULL AND (ft IS NULL OR fm < ft) THEN 1 ELSE 0 END AS passed,
             CAST(coalesce(lf, 0) AS BIGINT) AS failed FROM c)
SELECT source, passed AS total, passed, failed,
       CASE WHEN passed = 0 THEN 'unknown' WHEN failed = 0 THEN 'passed' ELSE 'failed' END AS status FROM x
""")
def split_sbt(t: Tables):
    lines = log_lines(t, sbt_logs(t), "stdout")
    return split_logs.sbt_summary(lines, KEYS).select("source", "total", "passed", "failed", "status")


@query(f"""
WITH {PLACED},
k AS (SELECT source, run_id, n % 6 AS k, count(*) AS c FROM ol GROUP BY ALL),
newest AS (SELECT source, k, max_by(c, run_id) AS c FROM k GROUP BY ALL),
w AS (SELECT source, max_by(c, run_id) AS warning FROM (SELECT source, run_id, count(*) AS c FROM ol GROUP BY ALL) GROUP BY 1),
x AS (SELECT w.source, warning, {', '.join(f"coalesce(max(c) FILTER (WHERE k = {k}), 0) AS {name}" for k, name in enumerate(("passed", "failed", "skipped", "error", "xfailed", "xpassed")))}
      FROM w LEFT JOIN newest USING (source) GROUP BY ALL)
SELECT *, passed + error + failed AS total, CASE WHEN passed + xpassed > 0 AND error + failed + xfailed = 0 THEN 'passed'
  WHEN passed + xpassed = 0 THEN 'failed' ELSE 'unknown' END AS status FROM x
""")
def split_pytest(t: Tables):
    return split_logs.pytest_summary(log_lines(t, pytest_logs(t), "stdout"), KEYS)


@query(GO + """
, r AS (SELECT source, e.* FROM e JOIN documents ON doc_id = run_id)
SELECT source, test AS name, package AS classname,
  coalesce(max_by(i, run_id * 1000000 + i) FILTER (WHERE st IS NOT NULL), 0) / 4.0::DOUBLE AS time,
  coalesce(max_by(st, run_id * 1000000 + i) FILTER (WHERE st IS NOT NULL), 'unknown') AS status,
  md5(string_agg(ln || chr(10), '' ORDER BY run_id, i) FILTER (WHERE n % 6 IN (1, 3))) AS message
FROM r WHERE n % 6 < 4 GROUP BY source, test, package
""")
def split_go_tests(t: Tables):
    events = split_logs.go_events(log_lines(t, go_reports(t), "text"), KEYS)
    return reports.go_tests_of(events, KEYS).drop("details").withColumn("message", F.md5("message"))


@query(GO + """
, b AS (SELECT source, count(*) FILTER (WHERE i % 7 = 3 AND run_id % 5 <> 0) AS bad_lines FROM dl JOIN documents ON doc_id = run_id GROUP BY 1),
c AS (SELECT source, count(*) FILTER (WHERE st = 'passed') AS p, count(*) FILTER (WHERE st = 'failed') AS f,
             count(*) FILTER (WHERE st = 'skipped') AS s FROM e JOIN documents ON doc_id = run_id GROUP BY 1),
lp AS (SELECT source, package, max_by(st, run_id * 1000000 + i) AS st FROM pk JOIN documents ON doc_id = run_id GROUP BY 1, 2),
q AS (SELECT source, count(*) FILTER (WHERE st = 'passed') AS p, count(*) FILTER (WHERE st = 'failed') AS f FROM lp GROUP BY 1),
x AS (SELECT source, bad_lines, coalesce(c.p + c.f + c.s, 0) AS ne, coalesce(c.p, 0) AS cp, coalesce(c.f, 0) AS cf, coalesce(c.s, 0) AS cs,
             coalesce(q.p, 0) AS qp, coalesce(q.f, 0) AS qf FROM b LEFT JOIN c USING (source) LEFT JOIN q USING (source))
SELECT source, CASE WHEN ne > 0 THEN ne ELSE qp + qf END AS total, CASE WHEN ne > 0 THEN cp ELSE qp END AS passed,
  CASE WHEN ne > 0 THEN cf ELSE qf END AS failed, CASE WHEN ne > 0 THEN cs ELSE 0 END AS skipped,
  CASE WHEN ne = 0 THEN 'unknown' WHEN cf = 0 THEN 'passed' ELSE 'failed' END AS status, bad_lines FROM x
""")
def split_go_summary(t: Tables):
    events = split_logs.go_events(log_lines(t, go_reports(t), "text"), KEYS)
    return reports.go_summary_of(events, KEYS).drop("errors", "collected")


@query(f"""
WITH {PLACED},
l AS (SELECT source, max(o) FILTER (WHERE n % 6 = 4 AND run_id % 3 = 0) AS at_o, max_by(i, o) FILTER (WHERE n % 6 = 4 AND run_id % 3 = 0) AS at_i,
             max_by(n, o) FILTER (WHERE n % 6 = 4 AND run_id % 3 = 0) AS at_n, count(*) FILTER (WHERE n % 6 < 3) AS tests,
             count(*) FILTER (WHERE n % 6 = 5) AS bad FROM ol GROUP BY 1),
c AS (SELECT source, any_value(at_o) AS at_o, any_value(at_i) AS at_i, any_value(at_n) AS at_n, any_value(tests) AS tests, any_value(bad) AS bad,
        count(*) FILTER (WHERE n % 6 = 0 AND o > coalesce(at_o, -1)) AS p, count(*) FILTER (WHERE n % 6 = 1 AND o > coalesce(at_o, -1)) AS f,
        count(*) FILTER (WHERE n % 6 = 2 AND o > coalesce(at_o, -1)) AS s FROM l JOIN ol USING (source) GROUP BY 1),
x AS (SELECT source, bad, CASE WHEN at_o IS NULL THEN tests ELSE at_i + at_n % 4 + 1 END AS total, p + coalesce(at_i, 0) AS passed,
        f + coalesce(at_n % 4, 0) AS failed, s + CASE WHEN at_o IS NULL THEN 0 ELSE 1 END AS skipped FROM c)
SELECT source, total, passed, failed, skipped, bad AS bad_lines,
  CASE WHEN failed = 0 AND total > 0 THEN 'passed' WHEN failed > 0 THEN 'failed' ELSE 'unknown' END AS status FROM x
""")
def split_rust(t: Tables):
    return split_logs.rust_summary(log_lines(t, rust_reports(t), "text"), KEYS).drop("errors")


@query(f"""
WITH {PLACED},
s AS (SELECT *, {PATH} AS path, 'diff --git a/' || path || ' b/' || path || chr(10) || '@@ -1 +1 @@' || chr(10) || '+' || ln AS body,
             i = max(i) OVER (PARTITION BY run_id) AND run_id < max(run_id) OVER (PARTITION BY source) AS closes FROM ol),
k AS (SELECT source, o, ltrim('a/' || path, 'a/') AS file, body || CASE WHEN closes THEN chr(10) || 'From nobody' ELSE '' END AS body
      FROM s WHERE n % 7 <> 5),
f AS (SELECT source, file, arg_max(body, o) AS diff, min(o) AS first_o FROM k GROUP BY 1, 2)
SELECT source, CAST(row_number() OVER (PARTITION BY source ORDER BY first_o) - 1 AS BIGINT) AS position, file, md5(diff) AS diff FROM f
""")
def split_diff_files(t: Tables):
    found = split_logs.diff_files(log_lines(t, diffs(t), "full_patch", "doc_id"), KEYS)
    return found.select("source", F.col("position").cast("bigint").alias("position"), "file", F.md5("diff").alias("diff"))


@query(f"""
WITH {PLACED}
SELECT source, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) - 1 AS BIGINT) AS last_no,
       CAST(sum(CAST(n AS HUGEINT) * k) AS BIGINT) AS checksum
FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY o) - 1 AS k FROM ol) GROUP BY 1
""")
def log_line_numbers(t: Tables):
    lines = log_lines(t, t.documents, "text", "doc_id")
    numbered = files.with_line_numbers(lines, KEYS)
    checked = (F.length("line") * F.col("line_no")).cast("decimal(38,0)")
    return numbered.groupBy("source").agg(
        F.count("*").alias("n_lines"), F.max("line_no").alias("last_no"), F.sum(checked).cast("bigint").alias("checksum")
    )
