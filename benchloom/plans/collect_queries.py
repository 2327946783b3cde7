"""Queries over repositories, issues and mappings.

Inputs are row-wise projections: orders become repositories or issues, lineitems
become links between an issue (the order) and a pull request (the part).
"""

from pyspark.sql import functions as F

from ..operators import collect
from .registry import SQL, Tables, query

# --- inputs -----------------------------------------------------------------------

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def repos(t: Tables):
    return t.orders.selectExpr(
        "concat('repo', o_orderkey) AS name",
        "concat('org', o_custkey % 50, '/repo', o_orderkey) AS nameWithOwner",
        "named_struct('login', concat('org', o_custkey % 50)) AS owner",
        f"date_format(o_orderdate, \"{ISO}\") AS createdAt",
        f"date_format(date_add(o_orderdate, cast(o_custkey % 700 AS INT)), \"{ISO}\") AS pushedAt",
        "cast(floor(o_totalprice / 100) AS BIGINT) AS stargazerCount",
        "o_custkey % 200 AS forkCount",
        "named_struct('name', CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Python' "
        "WHEN '2' THEN 'Java' WHEN '3' THEN 'Go' ELSE 'Rust' END) AS primaryLanguage",
        "named_struct('spdxId', CASE o_orderstatus WHEN 'F' THEN 'MIT' WHEN 'O' THEN 'Apache-2.0' END)"
        " AS licenseInfo",
    )


REPOS = """
repos AS (
  SELECT 'org' || (o_custkey % 50) || '/repo' || o_orderkey AS "nameWithOwner",
         CAST(o_orderdate AS DATE) AS created,
         CAST(o_orderdate AS DATE) + CAST(o_custkey % 700 AS INTEGER) AS pushed,
         CAST(floor(o_totalprice / 100) AS BIGINT) AS stars, o_custkey % 200 AS forks,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Python' WHEN '2' THEN 'Java'
              WHEN '3' THEN 'Go' ELSE 'Rust' END AS language,
         o_orderkey, o_orderstatus
  FROM orders)
"""

WINDOWS = """
windows AS (
  SELECT DATE '1995-01-01' + 7 * i AS l, DATE '1995-01-01' + 7 * (i + 1) AS r
  FROM (SELECT CAST(unnest(range(0, 1000)) AS INTEGER) AS i)
  WHERE DATE '1995-01-01' + 7 * (i + 1) <= DATE '2001-08-01')
"""


def issues(t: Tables):
    pr = """named_struct(
        'number', (o_orderkey * 3 + k) % 4000,
        'mergedAt', date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        'baseRefOid', if(k % 7 = 3, NULL, concat('b', o_orderkey, '_', k)),
        'mergeCommit', if(k % 5 = 4, NULL, named_struct('oid', concat('m', o_orderkey, '_', k),
                          'committedDate', '2000-01-01T00:00:00Z')),
        'repository', named_struct('owner', named_struct('login', concat('org', k % 3)),
                                   'name', concat('r', o_custkey % 20)))"""
    return t.orders.selectExpr(
        "concat('org0/r', o_custkey % 20) AS repo_name",
        "o_orderkey AS number",
        "concat('Issue ', o_orderkey) AS title",
        f"date_format(o_orderdate, \"{ISO}\") AS createdAt",
        f"date_format(o_orderdate, \"{ISO}\") AS closedAt",
        f"if(o_custkey % 53 = 0, NULL, date_format(date_add(o_orderdate, 30), \"{ISO}\")) AS updatedAt",
        f"""transform(sequence(0, cast(o_orderkey % 13 AS INT)), k -> named_struct(
              'closer', if((k + o_custkey) % 2 = 0, {pr}, NULL),
              'source', if((k + o_orderkey) % 3 = 0, {pr}, NULL))) AS timeline""",
    )


def mappings(t: Tables):
    return t.lineitem.selectExpr(
        "concat('org/r', l_suppkey % 20) AS repo_name",
        "l_orderkey AS issue_number",
        "l_partkey AS pr_number",
        "if(l_returnflag = 'A', 'linked', 'referenced') AS type",
        "if(l_linenumber = 7, NULL, concat('b', l_partkey)) AS base_commit",
        "if(l_quantity > 45, NULL, concat('m', l_partkey)) AS merge_commit",
        "l_suppkey",
    )


MAPPINGS = """
m AS (
  SELECT 'org/r' || (l_suppkey % 20) AS repo_name, l_orderkey AS issue_number, l_partkey AS pr_number,
         CASE WHEN l_returnflag = 'A' THEN 'linked' ELSE 'referenced' END AS type,
         CASE WHEN l_linenumber <> 7 THEN 'b' || l_partkey END AS base_commit,
         CASE WHEN l_quantity <= 45 THEN 'm' || l_partkey END AS merge_commit, l_suppkey
  FROM lineitem),
ic AS (
  SELECT repo_name, issue_number,
         count(DISTINCT CASE WHEN type = 'linked' THEN pr_number END) AS nl,
         count(DISTINCT CASE WHEN type = 'referenced' THEN pr_number END) AS nr
  FROM m GROUP BY ALL),
pc AS (
  SELECT repo_name, pr_number,
         count(DISTINCT CASE WHEN type = 'linked' THEN issue_number END) AS nl,
         count(DISTINCT CASE WHEN type = 'referenced' THEN issue_number END) AS nr
  FROM m GROUP BY ALL),
v AS (
  SELECT m.*, (ic.nl = 1 OR (ic.nl = 0 AND ic.nr = 1)) AS map_issue_ok,
         (pc.nl = 1 OR (pc.nl = 0 AND pc.nr = 1)) AS map_pr_ok,
         (ic.nl = 1 OR (ic.nl = 0 AND ic.nr = 1)) AND (pc.nl = 1 OR (pc.nl = 0 AND pc.nr = 1))
           AS map_issue_pr_ok
  FROM m JOIN ic USING (repo_name, issue_number) JOIN pc USING (repo_name, pr_number))
"""

# --- queries ----------------------------------------------------------------------


@query("""
WITH spans AS (SELECT o_orderpriority AS language, CAST(min(o_orderdate) AS DATE) AS a,
                      CAST(max(o_orderdate) AS DATE) AS b FROM orders GROUP BY 1)
SELECT language, CAST(i AS BIGINT) AS window_no, CAST(a + 30 * i AS VARCHAR) AS window_start,
       CAST(a + 30 * (i + 1) AS VARCHAR) AS window_end
FROM (SELECT *, unnest(range(0, CAST(floor((b - a) / 30) AS BIGINT))) AS j, CAST(j AS INTEGER) AS i FROM spans)
""")
def date_windows(t: Tables):
    spans = t.orders.groupBy(F.col("o_orderpriority").alias("language")).agg(
        F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")
    )
    return collect.date_windows(spans, "a", "b", 30).select(
        "language", F.col("window_no").cast("bigint").alias("window_no"), "window_start", "window_end"
    )


@query(f"""
WITH {REPOS}
SELECT "nameWithOwner", stars AS "stargazerCount" FROM repos
WHERE language = 'Python' AND stars BETWEEN 500 AND 4000 AND forks >= 20
  AND pushed >= DATE '1998-01-01' AND o_orderstatus IN ('F', 'O')
""")
def repo_filter(t: Tables):
    found = collect.filter_repos(
        repos(t), "python", min_stars=500, max_stars=4000, min_forks=20, pushed_year=1998,
        licenses=["mit", "apache-2.0"],
    )
    return found.select("nameWithOwner", "stargazerCount")


@query(f"""
WITH {REPOS}, {WINDOWS}
SELECT "nameWithOwner", CAST(l AS VARCHAR) || ':' || CAST(r AS VARCHAR) AS _period, 'python' AS language,
       CAST(l AS VARCHAR) || ':' || CAST(r AS VARCHAR) AS date_range
FROM repos JOIN windows ON created BETWEEN l AND r
""")
def repo_windows(t: Tables):
    tagged = collect.assign_windows(repos(t), "1995-01-01", "2001-08-01", 7)
    tagged = collect.tag_search(tagged, language="python", stars_min=0)
    return tagged.select("nameWithOwner", "_period", "_search_params.language", "_search_params.date_range")


@query(f"""
WITH {REPOS}, {WINDOWS},
x AS (SELECT "nameWithOwner", stars, CAST(l AS VARCHAR) || ':' || CAST(r AS VARCHAR) AS _period
      FROM repos JOIN windows ON created BETWEEN l AND r)
SELECT _period, "nameWithOwner", stars AS "stargazerCount", n AS "repositoryCount"
FROM (SELECT *, row_number() OVER (PARTITION BY _period ORDER BY stars DESC, "nameWithOwner") AS rn,
             count(*) OVER (PARTITION BY _period) AS n FROM x) WHERE rn <= 5
""")
def topk_per_window(t: Tables):
    tagged = collect.assign_windows(
        repos(t).select("nameWithOwner", "stargazerCount", "createdAt"), "1995-01-01", "2001-08-01", 7
    )
    order = [F.col("stargazerCount").desc(), F.col("nameWithOwner")]
    return collect.cap_windows(tagged, 5, order).select(
        "_period", "nameWithOwner", "stargazerCount", "repositoryCount"
    )


@query(f"""
WITH {REPOS}
SELECT "nameWithOwner", stars AS "stargazerCount",
  CASE WHEN o_orderstatus <> 'P' THEN forks + 1 ELSE forks END AS "forkCount",
  CASE WHEN o_orderstatus <> 'P' THEN o_orderkey % 97 END AS "pullRequestsTotal",
  CASE WHEN o_orderstatus <> 'P' THEN o_orderkey % 11 END AS "issuesOpen"
FROM repos
""")
def repo_details(t: Tables):
    count = lambda e: f"named_struct('totalCount', {e})"
    counts = repos(t).where(F.col("licenseInfo.spdxId").isNotNull()).withColumn(
        "k", F.regexp_extract("name", r"\d+", 0).cast("bigint")
    )
    raw = counts.selectExpr(
        "nameWithOwner", "forkCount + 1 AS forkCount",
        f"{count('k % 97')} AS pullRequests", f"{count('k % 53')} AS mergedPRs",
        f"{count('k % 31')} AS issues", f"{count('k % 23')} AS closedIssues",
        f"{count('k % 11')} AS openIssues",
    )
    details = collect.flatten_counts(raw).join(raw.select("nameWithOwner", "forkCount"), "nameWithOwner")
    return collect.enrich_repos(repos(t), details).select(
        "nameWithOwner", "stargazerCount", "forkCount", "pullRequestsTotal", "issuesOpen"
    )


ITEMS = """
iss AS (
  SELECT 'org0/r' || (o_custkey % 20) AS repo_name, o_orderkey, o_custkey, o_orderdate,
         CASE WHEN o_custkey % 53 <> 0 THEN strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%dT%H:%M:%SZ') END AS upd
  FROM orders),
items AS (
  SELECT *, unnest(range(0, o_orderkey % 13 + 1)) AS k
  FROM iss WHERE upd IS NULL OR upd >= '1996-06-01T00:00:00Z'),
links AS (
  SELECT 'linked' AS type, * FROM items WHERE (k + o_custkey) % 2 = 0
  UNION ALL SELECT 'referenced' AS type, * FROM items WHERE (k + o_orderkey) % 3 = 0)
"""


@query(f"""
WITH {ITEMS}
SELECT type, o_orderkey AS issue_number, (o_orderkey * 3 + k) % 4000 AS pr_number, repo_name AS issue_repo,
       'org' || (k % 3) || '/r' || (o_custkey % 20) AS pr_repo,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS "mergedAt",
       CASE WHEN k % 7 <> 3 THEN 'b' || o_orderkey || '_' || k END AS base_commit,
       CASE WHEN k % 5 <> 4 THEN 'm' || o_orderkey || '_' || k END AS merge_commit,
       CASE WHEN k % 5 <> 4 THEN '2000-01-01T00:00:00Z' END AS committed_date,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS issue_created_at,
       upd AS issue_updated_at, 'Issue ' || o_orderkey AS issue_title
FROM links
""")
def timeline_mappings(t: Tables):
    return collect.build_pr_issue_mapping(issues(t), closed_after="1996-06-01T00:00:00Z").select(
        "type", "issue_number", "pr_number", "issue_repo", "pr_repo", "mergedAt", "base_commit",
        "merge_commit", "committed_date", "issue_created_at", "issue_updated_at", "issue_title",
    )


@query(f"""
WITH {ITEMS},
capped AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY repo_name ORDER BY upd DESC NULLS LAST, o_orderkey) AS rn
                 FROM iss WHERE upd IS NULL OR upd >= '1996-06-01T00:00:00Z') WHERE rn <= 25)
SELECT repo_name, o_orderkey AS number, upd AS "updatedAt" FROM capped
""")
def issue_cap(t: Tables):
    recent = collect.recent_issues(issues(t), "1996-06-01T00:00:00Z")
    return collect.cap_issues(recent, 25).select("repo_name", "number", "updatedAt")


@query(f"""
WITH {MAPPINGS}
SELECT 'issue' AS side, repo_name, issue_number AS number, nl AS n_linked, nr AS n_referenced,
       (nl = 1 OR (nl = 0 AND nr = 1)) AS ok FROM ic
UNION ALL
SELECT 'pr', repo_name, pr_number, nl, nr, (nl = 1 OR (nl = 0 AND nr = 1)) FROM pc
""")
def mapping_cardinality(t: Tables):
    rows = mappings(t)
    one = lambda side: collect.link_cardinality(rows, side).select(
        F.lit(side).alias("side"), "repo_name", F.col(f"{side}_number").alias("number"),
        "n_linked", "n_referenced", F.col(f"{side}_ok").alias("ok"),
    )
    return one("issue").unionByName(one("pr"))


@query(f"""
WITH {MAPPINGS}
SELECT repo_name, issue_number, pr_number, type, map_issue_ok, map_pr_ok, map_issue_pr_ok FROM v
""")
def mapping_validation(t: Tables):
    return collect.validate_mappings(mappings(t)).select(
        "repo_name", "issue_number", "pr_number", "type", "map_issue_ok", "map_pr_ok", "map_issue_pr_ok"
    )


@query(SQL["mapping_validation"])
def mapping_increments(t: Tables):
    """The links of two thirds of the rows, and what the rest changes."""
    rows = mappings(t).withColumn("part", F.col("l_suppkey") % 3)
    old, new = rows.where("part < 2").drop("part"), rows.where("part = 2").drop("part")
    validated = collect.validate_mappings(old)
    both = collect.unchanged_flags(validated, new).unionByName(collect.changed_flags(validated, new), allowMissingColumns=True)
    return both.select("repo_name", "issue_number", "pr_number", "type", *collect.FLAGS)


@query(f"""
WITH {MAPPINGS}
SELECT repo_name, count(*) AS num_rows,
  count(DISTINCT issue_number) AS num_issues, count(DISTINCT pr_number) AS num_prs,
  count(*) FILTER (WHERE map_issue_ok) AS num_rows_issue_ok,
  count(*) FILTER (WHERE map_pr_ok) AS num_rows_pr_ok,
  count(*) FILTER (WHERE map_issue_pr_ok) AS num_rows_issue_pr_ok,
  count(DISTINCT CASE WHEN map_issue_ok THEN issue_number END) AS num_issues_issue_ok,
  count(DISTINCT CASE WHEN map_pr_ok THEN pr_number END) AS num_prs_pr_ok,
  count(DISTINCT CASE WHEN map_issue_pr_ok THEN issue_number END) AS num_issues_valid,
  count(DISTINCT CASE WHEN map_issue_pr_ok THEN pr_number END) AS num_prs_valid
FROM v GROUP BY 1
""")
def mapping_stats(t: Tables):
    return collect.mapping_stats(collect.validate_mappings(mappings(t)))


@query(f"""
WITH {MAPPINGS}
SELECT repo_name, issue_number, pr_number, type, map_issue_pr_ok,
  CASE WHEN found THEN 'PR ' || pr_number END AS pr_title,
  CASE WHEN found THEN 'Body of ' || issue_number END AS issue_body,
  CASE WHEN found THEN pr_number % 3 END AS n_pr_comments,
  CASE WHEN found AND pr_number % 3 > 0 AND pr_number % 2 = 0 THEN 'u' || pr_number END AS first_author
FROM (SELECT *, map_issue_pr_ok AND pr_number % 11 <> 0 AS found FROM v)
""")
def mapping_enrich(t: Tables):
    rows = mappings(t).drop("base_commit", "merge_commit", "l_suppkey")
    edges = """named_struct('edges', transform(slice(array(0, 1), 1, cast({n} % 3 AS INT)), i ->
        named_struct('node', named_struct(
            'author', if(({n} + i) % 2 = 0, named_struct('login', concat('u', {n} + i)), NULL),
            'body', concat('comment ', i), 'createdAt', '2000-01-01T00:00:00Z'))))"""
    detail = lambda n, title: rows.selectExpr(
        "repo_name", f"{n} AS number", f"concat('{title} ', {n}) AS title",
        f"concat('Body of ', {n}) AS body", f"{edges.format(n=n)} AS comments",
    )
    prs = detail("pr_number", "PR").where("number % 11 <> 0")  # the others could not be fetched
    enriched = collect.enrich_mappings(
        collect.validate_mappings(rows), prs, detail("issue_number", "Issue")
    )
    return enriched.select(
        "repo_name", "issue_number", "pr_number", "type", "map_issue_pr_ok", "pr_title", "issue_body",
        F.when(F.col("pr_comments").isNotNull(), F.size("pr_comments")).cast("bigint").alias("n_pr_comments"),
        F.get("pr_comments", F.lit(0))["author"].alias("first_author"),
    )


@query(f"""
WITH {MAPPINGS}
SELECT count(*) AS num_all, count(*) FILTER (WHERE map_issue_pr_ok) AS num_map_ok,
  count(*) FILTER (WHERE base_commit IS NOT NULL AND merge_commit IS NOT NULL) AS num_commits_ok,
  count(*) FILTER (WHERE map_issue_pr_ok AND base_commit IS NOT NULL AND merge_commit IS NOT NULL) AS num_will_process
FROM v
""")
def patch_eligibility(t: Tables):
    return collect.eligibility_counts(collect.patch_eligibility(collect.validate_mappings(mappings(t))))


@query(f"""
WITH {MAPPINGS}
SELECT CASE WHEN NOT (map_issue_pr_ok AND base_commit IS NOT NULL AND merge_commit IS NOT NULL) THEN 'skipped_invalid'
            WHEN l_suppkey % 17 = 0 THEN 'clone_failed' WHEN pr_number % 13 = 0 THEN 'fetch_failed'
            WHEN issue_number % 19 = 0 THEN 'diff_failed' WHEN issue_number % 29 = 0 THEN 'exception'
            ELSE 'success' END AS patch_extraction_status, count(*) AS n
FROM v GROUP BY 1
""")
def extraction_status(t: Tables):
    eligible = collect.patch_eligibility(collect.validate_mappings(mappings(t)))
    status = collect.extraction_status(
        eligible,
        cloned=F.col("l_suppkey") % 17 != 0,
        fetched=F.col("pr_number") % 13 != 0,
        diff=F.when(F.col("issue_number") % 19 != 0, F.lit("diff")),
        error=F.when(F.col("issue_number") % 29 == 0, F.lit("bad diff")),
    )
    return status.groupBy("patch_extraction_status").agg(F.count("*").alias("n"))


@query("""
WITH i AS (SELECT 'org/r' || (l_suppkey % 20) || '#' ||
                  coalesce(CAST(CASE WHEN l_linenumber <> 5 THEN l_partkey END AS VARCHAR), 'none') || '#' || l_orderkey AS item_id,
                  l_shipdate FROM lineitem)
SELECT item_id, count(*) AS n FROM i
WHERE item_id NOT IN (SELECT item_id FROM i WHERE l_shipdate < TIMESTAMP '1998-06-01') GROUP BY 1
""")
def incremental_antijoin(t: Tables):
    items = t.lineitem.selectExpr(
        "concat('org/r', l_suppkey % 20) AS repo_name",
        "if(l_linenumber <> 5, l_partkey, NULL) AS pr_number",
        "l_orderkey AS issue_number",
        "l_shipdate",
    ).select(collect.item_key("repo_name", "pr_number", "issue_number").alias("item_id"), "l_shipdate")
    processed = items.where(F.col("l_shipdate") < F.lit("1998-06-01").cast("timestamp_ntz"))
    left = collect.pending(items, processed, ["item_id"])
    return left.groupBy("item_id").agg(F.count("*").alias("n"))


@query(f"""
WITH {MAPPINGS}
SELECT 'base_commit' AS column_name, count(*) FILTER (WHERE base_commit IS NULL) AS n_missing FROM m
UNION ALL SELECT 'merge_commit', count(*) FILTER (WHERE merge_commit IS NULL) FROM m
UNION ALL SELECT 'type', count(*) FILTER (WHERE type IS NULL) FROM m
""")
def required_columns(t: Tables):
    names = ["base_commit", "merge_commit", "type"]
    return collect.null_report(collect.require_columns(mappings(t), names), names)
