"""Queries over diff texts and generated code.

Every document becomes one text inside its row: its lines turn into the file
sections of a diff, the lines of a Java file, or the body of an answer.
"""

from pyspark.sql import DataFrame, functions as F

from ..operators import patches
from .registry import Tables, query

# --- inputs -----------------------------------------------------------------------

# The document lines with their number and length, for all SQL below.
LINES = """
dl AS (
  SELECT doc_id, i, ln, CAST(length(ln) AS BIGINT) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS ln,
               unnest(range(0, CAST(len(string_split(text, chr(10))) AS BIGINT))) AS i FROM documents))
"""

# Path of the section of line i: seven kinds by the length of the line.
PATH = """CASE n % 7 WHEN 0 THEN 'tests/f' || (i % 3) || '.py' WHEN 1 THEN 'src/mod_' || i || '.py'
  WHEN 2 THEN 'a/api/x' || (i % 2) || '.py' WHEN 3 THEN 'pkg/thing_test.py'
  WHEN 4 THEN 'contest/run' || i || '.c' WHEN 5 THEN 'broken' ELSE 'lib/latest_x.py' END"""

SECTIONS = f"""
p AS (SELECT *, {PATH} AS path, max(i) OVER (PARTITION BY doc_id) AS last_i FROM dl),
s AS (
  SELECT *, CASE WHEN n % 7 = 5 THEN 'diff --git a/' || path ELSE 'diff --git a/' || path || ' b/' || path END AS header,
         header || chr(10) || '@@ -1 +1 @@' || chr(10) || '+' || ln AS body
  FROM p)
"""


def diffs(t: Tables) -> DataFrame:
    path = """concat_ws('', CASE length(ln) % 7 WHEN 0 THEN concat('tests/f', i % 3, '.py')
        WHEN 1 THEN concat('src/mod_', i, '.py') WHEN 2 THEN concat('a/api/x', i % 2, '.py')
        WHEN 3 THEN 'pkg/thing_test.py' WHEN 4 THEN concat('contest/run', i, '.c')
        WHEN 5 THEN 'broken' ELSE 'lib/latest_x.py' END)"""
    section = f"""concat('diff --git a/', {path}, if(length(ln) % 7 = 5, '', concat(' b/', {path})),
        '\\n@@ -1 +1 @@\\n+', ln)"""
    return t.documents.selectExpr(
        "doc_id",
        f"concat('From nobody\\n', array_join(transform(split(text, '\\n'), (ln, i) -> {section}), '\\n'))"
        " AS full_patch",
    )


# --- queries ----------------------------------------------------------------------


@query(f"""
WITH {LINES}, {SECTIONS},
k AS (SELECT doc_id, i, ltrim('a/' || path, 'a/') AS file, body FROM s WHERE n % 7 <> 5),
f AS (SELECT doc_id, file, arg_max(body, i) AS diff, min(i) AS first_i FROM k GROUP BY 1, 2)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY first_i) - 1 AS BIGINT) AS position,
       file, diff FROM f
""")
def diff_files(t: Tables):
    return patches.diff_files(diffs(t)).withColumn("position", F.col("position").cast("bigint"))


@query(f"""
WITH {LINES}, {SECTIONS},
k AS (SELECT doc_id, i, ltrim('a/' || path, 'a/') AS file, body FROM s WHERE n % 7 <> 5),
f AS (SELECT doc_id, file, arg_max(body, i) AS diff, min(i) AS first_i,
             regexp_matches(file, '(tests?/|test_.*\\.py$|.*_test\\.py$)') AS is_test FROM k GROUP BY 1, 2),
j AS (SELECT doc_id, string_agg(diff, chr(10) ORDER BY first_i) FILTER (WHERE is_test) AS t,
             string_agg(diff, chr(10) ORDER BY first_i) FILTER (WHERE NOT is_test) AS p FROM f GROUP BY 1)
SELECT doc_id, md5(coalesce(t, '')) AS test_patch, md5(coalesce(p, '')) AS patch,
       CAST(length(coalesce(t, '')) AS BIGINT) AS n_test, CAST(length(coalesce(p, '')) AS BIGINT) AS n_patch
FROM documents LEFT JOIN j USING (doc_id)
""")
def split_test_patch(t: Tables):
    return patches.split_test_patch(diffs(t)).select(
        "doc_id",
        F.md5("test_patch").alias("test_patch"),
        F.md5("patch").alias("patch"),
        F.length("test_patch").cast("bigint").alias("n_test"),
        F.length("patch").cast("bigint").alias("n_patch"),
    )


@query(f"""
WITH {LINES}, {SECTIONS},
h AS (SELECT *, body || CASE WHEN i = last_i THEN '' ELSE chr(10) END AS part,
             contains(header, 'test/') OR contains(header, 'tests/') OR contains(header, '_test.py')
               OR contains(header, 'test_') AS is_test FROM s),
j AS (SELECT doc_id, string_agg(part, '' ORDER BY i) FILTER (WHERE is_test) AS t,
             string_agg(part, '' ORDER BY i) FILTER (WHERE NOT is_test) AS g FROM h GROUP BY 1)
SELECT doc_id, md5(coalesce(t, '')) AS test_patch, md5(coalesce(g, '')) AS gold_patch,
       CAST(length(coalesce(t, '')) AS BIGINT) AS n_test, CAST(length(coalesce(g, '')) AS BIGINT) AS n_gold,
       (SELECT count(*) FROM s WHERE s.doc_id = j.doc_id) AS n_sections
FROM j
""")
def gold_test_patch(t: Tables):
    return patches.patch_dict(diffs(t)).select(
        "doc_id",
        F.md5("test_patch").alias("test_patch"),
        F.md5("gold_patch").alias("gold_patch"),
        F.length("test_patch").cast("bigint").alias("n_test"),
        F.length("gold_patch").cast("bigint").alias("n_gold"),
        patches.touched_files(F.col("full_path")).alias("n_sections"),
    )


@query(f"""
WITH {LINES},
d AS (SELECT doc_id, count(*) AS n_lines, sum(n) AS chars FROM dl GROUP BY 1)
SELECT CASE doc_id % 4 WHEN 0 THEN 'empty' WHEN 1 THEN 'not_a_diff' WHEN 2 THEN 'empty' ELSE 'apply' END AS state,
       count(*) AS n, count(*) FILTER (WHERE doc_id % 4 = 3 AND n_lines > 8) AS n_rejected,
       CAST(sum(CASE WHEN doc_id % 4 = 3 AND n_lines <= 8 THEN n_lines ELSE 0 END) AS BIGINT) AS n_files
FROM d GROUP BY 1
""")
def patch_applicable(t: Tables):
    patch = F.expr("""CASE doc_id % 4 WHEN 0 THEN ' \\n\\t ' WHEN 1 THEN substr(full_patch, 6)
        WHEN 2 THEN NULL ELSE substr(full_patch, 13) END""")
    rows = diffs(t).withColumn("patch", patch).withColumn("state", patches.patch_applicability(F.col("patch")))
    kept = patches.capped_diff(F.col("patch"), 8)
    applied = F.col("state") == "apply"
    return rows.groupBy("state").agg(
        F.count("*").alias("n"),
        F.count_if(applied & kept.isNull()).alias("n_rejected"),
        F.sum(
            F.when(applied & kept.endswith("\n"), patches.touched_files(kept)).otherwise(F.lit(0))
        ).cast("bigint").alias("n_files"),
    )


@query("""
WITH c AS (SELECT doc_id, lang, text,
  text[1:(length(text) // 2)] AS l, text[(length(text) // 2 + 1):] AS r FROM documents),
x AS (SELECT *, doc_id % 5 <> 0 OR contains(text, r || '!') AS is_valid,
  CASE WHEN doc_id % 2 = 0 THEN l || chr(10) || '  x' || chr(10) || rtrim(r, chr(10))
       ELSE l || CASE WHEN l LIKE '%' || chr(10) THEN '' ELSE chr(10) END || '  x'
              || CASE WHEN rtrim(r, chr(10)) LIKE chr(10) || '%' THEN '' ELSE chr(10) END || rtrim(r, chr(10)) END AS out FROM c)
SELECT doc_id, is_valid, CASE WHEN is_valid THEN md5(out) END AS spliced FROM x
""")
def splice_candidate(t: Tables):
    rows = t.documents.selectExpr(
        "doc_id",
        "text AS content",
        "left(text, cast(floor(length(text) / 2) AS INT)) AS left_context",
        "'  x' AS gt",
        "concat(substr(text, cast(floor(length(text) / 2) AS INT) + 1), if(doc_id % 5 = 0, '!', '\\n\\n'))"
        " AS right_context",
    )
    python = patches.splice_candidate(rows.where("doc_id % 2 = 0"))
    java = patches.splice_candidate(rows.where("doc_id % 2 = 1"), dialect="java")
    return python.unionByName(java).select("doc_id", "is_valid", F.md5("spliced").alias("spliced"))


JAVA = f"""
WITH {LINES},
src AS (SELECT doc_id, string_agg(CASE n % 3 WHEN 0 THEN 'import ' || 'a.b.C' || (n % 12) || ';'
                          WHEN 1 THEN 'import static a.S' || (n % 5) || ';' ELSE '// ' || ln END, chr(10) ORDER BY i) AS body,
          list(CASE n % 3 WHEN 0 THEN 'import a.b.C' || (n % 12) || ';' ELSE 'import static a.S' || (n % 5) || ';' END ORDER BY i)
            FILTER (WHERE n % 3 < 2) AS imps FROM dl GROUP BY 1)
"""


@query(JAVA + """
, base AS (
  SELECT doc_id, coalesce(imps, []) AS imps, doc_id % 4 <> 3 AS has_package,
         CASE doc_id % 6 WHEN 0 THEN ['package old;', 'import a.b.C0;', 'class T {}']
           WHEN 1 THEN ['package trunc;', 'class T {}'] WHEN 2 THEN ['package trunc;', 'import static a.S1;', 'class T {}']
           WHEN 3 THEN ['package trunc;', 'class T {}'] WHEN 4 THEN ['class T {}'] ELSE [''] END AS rows,
         'package com.p' || (doc_id % 9) || ';' AS package
  FROM src),
fixed AS (
  SELECT *, CASE WHEN NOT has_package THEN rows
                 WHEN rows[1] LIKE 'package %' THEN list_concat([package], rows[2:])
                 ELSE list_concat([package], rows) END AS r2 FROM base),
parts AS (
  SELECT *, list_distinct(list_filter(imps, lambda x: NOT list_contains(r2, x))) AS unordered,
         CASE WHEN r2[1] LIKE 'package %' THEN 1 ELSE 0 END AS pl FROM fixed),
ordered AS (
  SELECT *, list_sort(list_transform(unordered, lambda x: struct_pack(p := list_position(imps, x), v := x))) AS srt FROM parts)
SELECT doc_id, array_to_string(list_concat(list_concat(list_slice(r2, 1, pl), list_transform(srt, lambda x: x.v)), list_slice(r2, pl + 1, len(r2))), chr(10)) AS repaired
FROM ordered
""")
def java_test_repair(t: Tables):
    source = """concat(if(doc_id % 4 <> 3, concat('package com.p', doc_id % 9, ';\\n'), '// none\\n'),
        array_join(transform(split(text, '\\n'), ln -> CASE length(ln) % 3
            WHEN 0 THEN concat('import a.b.C', length(ln) % 12, ';')
            WHEN 1 THEN concat('import static a.S', length(ln) % 5, ';')
            ELSE concat('// ', ln) END), '\\n'))"""
    test = """CASE doc_id % 6 WHEN 0 THEN 'package old;\\nimport a.b.C0;\\nclass T {}'
        WHEN 1 THEN 'ckage trunc;\\nclass T {}'
        WHEN 2 THEN 'age trunc;\\nimport static a.S1;\\nclass T {}'
        WHEN 3 THEN 'ackage trunc;\\nclass T {}'
        WHEN 4 THEN '<|code|>class T {}' END"""
    rows = t.documents.selectExpr("doc_id", f"{source} AS source_code", f"{test} AS test_code")
    return patches.java_test_repair(rows).select("doc_id", "repaired")


@query("""
SELECT conv_id, turn, CASE WHEN turn % 4 = 3 THEN 'see ```' || text ELSE text END AS code FROM conversations
""")
def fenced_code(t: Tables):
    answer = F.expr("""CASE turn % 4
        WHEN 0 THEN concat('Here:\\n```java\\n', text, '\\n```\\nand ```java\\nmore\\n```')
        WHEN 1 THEN concat('Here:\\n```', text, ' \\n```\\nbye')
        WHEN 2 THEN concat('  ', text, '\\n')
        ELSE concat('see ```', text) END""")
    return t.conversations.select("conv_id", "turn", patches.fenced_code(answer).alias("code"))


@query("""
SELECT doc_id, repeat(' ', CASE WHEN doc_id % 9 = 8 THEN 0 ELSE CAST(doc_id % 9 AS INTEGER) END) || 'pass' AS return_pass,
       repeat(' ', CASE WHEN doc_id % 9 = 8 THEN 0 ELSE CAST(doc_id % 9 AS INTEGER) END) || 'return ""' AS return_empty_str
FROM documents
""")
def stub_codes(t: Tables):
    code = """if(doc_id % 9 = 8, ' \\n\\t\\n',
        concat('\\n   \\n', repeat(if(doc_id % 2 = 0, ' ', '\\t'), cast(doc_id % 9 AS INT)), text))"""
    rows = t.documents.selectExpr("doc_id", f"{code} AS gt")
    return patches.stub_codes(rows).select("doc_id", "return_pass", "return_empty_str")
