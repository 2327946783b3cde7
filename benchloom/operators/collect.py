"""Collecting repositories, linking issues to pull requests, validating the pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import explode_rows

# --- repositories -----------------------------------------------------------------


def date_windows(df: DataFrame, start: str, end: str, days: int) -> DataFrame:
    """Consecutive date windows of a ``(start, end)`` row; a partial last one is dropped."""
    first = F.to_date(F.col(start))
    windows = F.floor(F.date_diff(F.to_date(F.col(end)), first) / F.lit(days)).cast("int")
    number = F.explode(F.sequence(F.lit(0), windows - 1))
    return (
        df.where(windows > 0)
        .select("*", number.alias("window_no"))
        .withColumn("window_start", F.date_add(first, F.col("window_no") * days).cast("string"))
        .withColumn("window_end", F.date_add(first, (F.col("window_no") + 1) * days).cast("string"))
    )


def filter_repos(
    repos: DataFrame,
    language: str | None = None,
    min_stars: int = 0,
    max_stars: int | None = None,
    min_forks: int = 0,
    max_forks: int | None = None,
    pushed_year: int | None = None,
    licenses: Sequence[str] | None = None,
) -> DataFrame:
    """The repository search as one conjunction; a missing bound is open."""
    tests = [F.col("stargazerCount") >= min_stars, F.col("forkCount") >= min_forks]
    if language is not None:
        tests.append(F.lower("primaryLanguage.name") == language.lower())
    if max_stars is not None:
        tests.append(F.col("stargazerCount") <= max_stars)
    if max_forks is not None:
        tests.append(F.col("forkCount") <= max_forks)
    if pushed_year:
        tests.append(F.col("pushedAt") >= f"{pushed_year}-01-01")
    if licenses:
        tests.append(F.lower("licenseInfo.spdxId").isin([name.lower() for name in licenses]))
    for test in tests:
        repos = repos.where(test)
    return repos


def assign_windows(
    repos: DataFrame, start: str, end: str, days: int, created: str = "createdAt", strict: bool = False
) -> DataFrame:
    """Tag every repository with its date window (``_period``).

    Windows are evenly spaced, so the window number follows from the date: no
    join.  Both ends of a window are inclusive, so a repository created on a
    boundary day belongs to two windows; ``strict`` makes windows half-open.
    """
    first = F.lit(start).cast("date")
    count = F.floor(F.date_diff(F.lit(end).cast("date"), first) / F.lit(days)).cast("int")
    age = F.date_diff(F.to_date(F.substring(created, 1, 10)), first)
    number = F.floor(age / F.lit(days)).cast("int")
    numbers = F.array(number)
    if not strict:
        numbers = F.when(age % days == 0, F.array(number - 1, number)).otherwise(numbers)
    inside = F.filter(numbers, lambda n: (n >= 0) & (n < count))
    left = F.date_add(first, F.col("_n") * days).cast("string")
    right = F.date_add(first, (F.col("_n") + 1) * days).cast("string")
    return (
        repos.withColumn("_n", F.explode(inside))
        .withColumn("_period", F.concat_ws(":", left, right))
        .drop("_n")
    )


def tag_search(repos: DataFrame, **params: object) -> DataFrame:
    """Attach the search parameters and the window as one ``_search_params`` struct."""
    fields = [F.lit(value).alias(name) for name, value in params.items()]
    return repos.withColumn(
        "_search_params", F.struct(*fields, F.col("_period").alias("date_range"))
    )


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of every group.

    The rank filter is pushed below the exchange (group limit), so a hot group
    sends at most ``k`` rows per input partition.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def cap_windows(repos: DataFrame, k: int | None = None, order: Sequence[Column] | None = None) -> DataFrame:
    """The repositories of every window with their number; with ``k`` only the first ``k`` in the given order."""
    totals = repos.groupBy("_period").agg(F.count("*").alias("repositoryCount"))
    if k is not None:
        repos = top_per_group(repos, ["_period"], order or [F.col("nameWithOwner")], k)
    return repos.join(totals, "_period")


def flatten_counts(counts: DataFrame) -> DataFrame:
    return counts.select(
        "nameWithOwner",
        F.col("pullRequests.totalCount").alias("pullRequestsTotal"),
        F.col("mergedPRs.totalCount").alias("pullRequestsMerged"),
        F.col("issues.totalCount").alias("issuesTotal"),
        F.col("closedIssues.totalCount").alias("issuesClosed"),
        F.col("openIssues.totalCount").alias("issuesOpen"),
    )


def enrich_repos(repos: DataFrame, details: DataFrame, key: str = "nameWithOwner") -> DataFrame:
    """Overlay detail columns on the search rows; a repository without details stays as it is."""
    found = details.withColumn("_found", F.lit(True)).alias("d")
    joined = repos.alias("r").join(found, F.col(f"r.{key}") == F.col(f"d.{key}"), "left")
    columns = []
    for name in dict.fromkeys([*repos.columns, *details.columns]):
        if name not in details.columns or name == key:
            columns.append(F.col(f"r.{name}"))
        elif name not in repos.columns:
            columns.append(F.col(f"d.{name}"))
        else:
            value = F.when(F.col("_found"), F.col(f"d.{name}")).otherwise(F.col(f"r.{name}"))
            columns.append(value.alias(name))
    return joined.select(*columns)


# --- issue / pull request links ---------------------------------------------------


def recent_issues(issues: DataFrame, closed_after: str = "2020-01-01T00:00:00Z") -> DataFrame:
    """Issues updated since a time stamp (ISO text compares as time); NULL passes."""
    return issues.where(
        F.col("updatedAt").isNull() | (F.col("updatedAt") == "") | (F.col("updatedAt") >= closed_after)
    )


def cap_issues(issues: DataFrame, max_issues: int | None = None) -> DataFrame:
    """The most recently updated issues of every repository."""
    if not max_issues:
        return issues
    order = [F.col("updatedAt").desc(), F.col("number")]
    return top_per_group(issues, ["repo_name"], order, max_issues)


def issue_mappings(issues: DataFrame, timeline_items: int | None = None) -> DataFrame:
    """One row per link between an issue and a pull request.

    A ``closer`` is a direct link, a ``source`` a cross reference; a timeline
    item may hold both.  ``timeline_items`` reads only so many items of an issue.
    """
    link = lambda kind, field: F.struct(F.lit(kind).alias("type"), F.col(f"item.{field}").alias("pr"))
    links = F.explode_outer(F.array(link("linked", "closer"), link("referenced", "source"))).alias("link")
    timeline = F.col("timeline") if timeline_items is None else F.slice("timeline", 1, timeline_items)
    items = explode_rows(issues, issues.columns, timeline, "_pos", "item")
    pr = lambda path: F.col(f"link.pr.{path}")
    return (
        items.select("*", links)
        .where(F.col("link.pr").isNotNull())
        .select(
            F.col("link.type").alias("type"),
            F.col("number").alias("issue_number"),
            pr("number").alias("pr_number"),
            F.col("repo_name").alias("issue_repo"),
            F.concat_ws("/", pr("repository.owner.login"), pr("repository.name")).alias("pr_repo"),
            pr("mergedAt").alias("mergedAt"),
            pr("baseRefOid").alias("base_commit"),
            pr("mergeCommit.oid").alias("merge_commit"),
            pr("mergeCommit.committedDate").alias("committed_date"),
            F.col("createdAt").alias("issue_created_at"),
            F.col("closedAt").alias("issue_closed_at"),
            F.col("updatedAt").alias("issue_updated_at"),
            F.col("title").alias("issue_title"),
            "repo_name",
        )
    )


def build_pr_issue_mapping(
    issues: DataFrame,
    repos: DataFrame | None = None,
    closed_after: str = "2020-01-01T00:00:00Z",
    max_issues: int | None = None,
    timeline_items: int | None = None,
) -> DataFrame:
    """Issues to mapping rows; with ``repos`` the search row is embedded as ``_step1_data``."""
    rows = issue_mappings(cap_issues(recent_issues(issues, closed_after), max_issues), timeline_items)
    if repos is None:
        return rows
    embedded = repos.select(
        F.col("nameWithOwner").alias("repo_name"), F.struct(*repos.columns).alias("_step1_data")
    )
    return rows.join(embedded, "repo_name")


# --- validation -------------------------------------------------------------------


def link_cardinality(mappings: DataFrame, side: str) -> DataFrame:
    """Distinct counterparts of every issue (``side='issue'``) or pull request (``'pr'``).

    Rows are reduced to distinct links first, so repeated links of a hot number
    are gone before the exchange.  Numbers are per ``repo_name``: the repository
    of the pull request is not part of its key.  Both sides share one plan up to the
    distinct links, whose exchange Spark then runs once.
    """
    links = mappings.select("repo_name", "type", "issue_number", "pr_number")
    for key in ("repo_name", "issue_number", "pr_number"):
        links = links.where(F.col(key).isNotNull())
    links = links.distinct()
    n = lambda kind: F.count_if(F.col("type") == kind)
    linked, referenced = F.col("n_linked"), F.col("n_referenced")
    return (
        links.groupBy("repo_name", f"{side}_number")
        .agg(n("linked").alias("n_linked"), n("referenced").alias("n_referenced"))
        .withColumn(f"{side}_ok", (linked == 1) | ((linked == 0) & (referenced == 1)))
    )


def link_flags(mappings: DataFrame, side: str) -> DataFrame:
    """``repo_name``, the number of one side and its ``ok`` as in :func:`link_cardinality`.

    Whether a number has one distinct counterpart, none or several shows in the least and the greatest one, so
    links are not made distinct: one aggregation, combined before its exchange.
    """
    other = "pr_number" if side == "issue" else "issue_number"
    links = mappings.where("repo_name IS NOT NULL AND issue_number IS NOT NULL AND pr_number IS NOT NULL")
    of = lambda kind: F.when(F.col("type") == kind, F.col(other))
    ends = [f(of(kind)).alias(f"_{name}_{kind}") for kind in ("linked", "referenced") for name, f in (("min", F.min), ("max", F.max))]
    one = lambda kind: F.coalesce(F.col(f"_min_{kind}") == F.col(f"_max_{kind}"), F.lit(False))
    ok = one("linked") | (F.col("_min_linked").isNull() & one("referenced"))
    return links.groupBy("repo_name", f"{side}_number").agg(*ends).select("repo_name", f"{side}_number", ok.alias(f"{side}_ok"))


def validate_mappings(mappings: DataFrame) -> DataFrame:
    """Flag every mapping row: is its issue, its pull request, are both unambiguous?"""
    rows = mappings
    for side in ("issue", "pr"):
        flags = link_flags(mappings, side).withColumnRenamed(f"{side}_ok", f"map_{side}_ok")
        rows = rows.join(flags, ["repo_name", f"{side}_number"], "left")
    return rows.withColumn("map_issue_pr_ok", F.col("map_issue_ok") & F.col("map_pr_ok"))


FLAGS = ("map_issue_ok", "map_pr_ok", "map_issue_pr_ok")
SIDES = ("issue", "pr")


def _touched(new: DataFrame, side: str) -> DataFrame:
    """The numbers of one side that new rows name."""
    key = ["repo_name", f"{side}_number"]
    return new.select(*key).dropna().distinct()


def unchanged_flags(validated: DataFrame, new: DataFrame) -> DataFrame:
    """The validated rows whose flags new rows cannot change: both numbers are untouched."""
    rows = validated
    for side in SIDES:
        rows = rows.join(_touched(new, side), ["repo_name", f"{side}_number"], "left_anti")
    return rows.select(*validated.columns)


def changed_flags(validated: DataFrame, new: DataFrame) -> DataFrame:
    """New mapping rows, and the validated ones that share a number with them, with fresh flags.

    A flag depends on the links of one number only.  So the links of the numbers that new rows name are counted
    again, from these rows and the validated ones with such a number; the other number of such a row keeps
    its flag.  With :func:`unchanged_flags` this is :func:`validate_mappings` of all rows, whatever the batches.
    """
    columns = new.columns
    marked = validated
    for side in SIDES:
        mark = _touched(new, side).withColumn(f"_{side}", F.lit(True))
        marked = marked.join(mark, ["repo_name", f"{side}_number"], "left")
    met = marked.where(F.col("_issue") | F.col("_pr"))
    rows = met.select(*columns, *FLAGS[:2]).unionByName(new, allowMissingColumns=True)
    for side in SIDES:
        # only touched numbers have rows here, and all of their rows are
        linked = met.where(f"_{side}").select(*columns).unionByName(new)
        fresh = link_flags(linked, side).withColumnRenamed(f"{side}_ok", "_fresh")
        rows = rows.join(fresh, ["repo_name", f"{side}_number"], "left")
        rows = rows.withColumn(f"map_{side}_ok", F.coalesce("_fresh", f"map_{side}_ok")).drop("_fresh")
    return rows.withColumn("map_issue_pr_ok", F.col("map_issue_ok") & F.col("map_pr_ok")).select(*columns, *FLAGS)


def mapping_stats(validated: DataFrame) -> DataFrame:
    """Per repository: rows, issues and pull requests, in all and valid.

    Every row counts once for its issue and once for its pull request; one
    aggregation per number and one per repository give all counters.
    """
    n = F.col
    side = lambda s: F.struct(
        F.lit(s).alias("side"), n(f"{s}_number").alias("number"), n(f"map_{s}_ok").alias("ok")
    )
    numbers = (
        validated.select(
            "repo_name", "map_issue_pr_ok", F.explode(F.array(side("issue"), side("pr"))).alias("_n")
        )
        .groupBy("repo_name", "_n.side", "_n.number")
        .agg(
            F.count("*").alias("n"),
            F.count_if("map_issue_pr_ok").alias("n_both"),
            F.bool_or("_n.ok").alias("ok"),
        )
    )
    of = lambda s, test=None: n("side") == s if test is None else (n("side") == s) & test
    rows = lambda value, test: F.sum(F.when(test, n(value)).otherwise(F.lit(0)))
    return numbers.groupBy("repo_name").agg(
        rows("n", of("issue")).alias("num_rows"),
        rows("n", of("issue", n("ok"))).alias("num_rows_issue_ok"),
        rows("n", of("pr", n("ok"))).alias("num_rows_pr_ok"),
        rows("n_both", of("issue")).alias("num_rows_issue_pr_ok"),
        *[
            F.count_if(of(s, test)).alias(name)
            for s in ("issue", "pr")
            for name, test in (
                (f"num_{s}s", None),
                (f"num_{s}s_{s}_ok", n("ok")),
                (f"num_{s}s_valid", n("n_both") > 0),
            )
        ],
    )


def flatten_comments(edges: Column) -> Column:
    """``comments.edges`` to ``[{author, body, createdAt}]``; an unknown author stays NULL."""
    return F.transform(
        edges,
        lambda e: F.struct(
            e["node"]["author"]["login"].alias("author"),
            e["node"]["body"].alias("body"),
            e["node"]["createdAt"].alias("createdAt"),
        ),
    )


def enrich_mappings(validated: DataFrame, prs: DataFrame, issues: DataFrame) -> DataFrame:
    """Add texts and comments to the valid rows; all other rows pass through unenriched.

    A row is enriched only when both of its details exist.  Details are reduced to one per number
    before they travel; the flag is part of the join condition, not of the join key, so invalid rows
    stay spread over the numbers.
    """

    def details(df: DataFrame, side: str) -> DataFrame:
        value = F.struct("title", "body", flatten_comments(F.col("comments.edges")).alias("comments"))
        one = df.groupBy("repo_name", "number").agg(F.any_value(value).alias(f"_{side}"))
        return one.withColumnsRenamed({"repo_name": f"_{side}_repo", "number": f"_{side}_no"})

    rows = validated
    for side, table in (("pr", prs), ("issue", issues)):
        match = (
            (F.col("repo_name") == F.col(f"_{side}_repo"))
            & (F.col(f"{side}_number") == F.col(f"_{side}_no"))
            & F.col("map_issue_pr_ok")
        )
        rows = rows.join(details(table, side), match, "left")
    both = F.col("_pr").isNotNull() & F.col("_issue").isNotNull()
    pick = lambda path: F.when(both, F.col(path))
    return rows.select(
        *validated.columns,
        pick("_pr.title").alias("pr_title"),
        pick("_pr.body").alias("pr_body"),
        pick("_pr.comments").alias("pr_comments"),
        pick("_issue.body").alias("issue_body"),
        pick("_issue.comments").alias("issue_comments"),
    )


# --- eligibility for patch extraction ---------------------------------------------


def patch_eligibility(validated: DataFrame) -> DataFrame:
    return (
        validated.withColumn("has_valid_mapping", F.coalesce("map_issue_pr_ok", F.lit(False)))
        .withColumn("has_base_commit", F.col("base_commit").isNotNull())
        .withColumn("has_merge_commit", F.col("merge_commit").isNotNull())
        .withColumn(
            "should_process",
            F.col("has_valid_mapping") & F.col("has_base_commit") & F.col("has_merge_commit"),
        )
    )


def eligibility_counts(eligible: DataFrame) -> DataFrame:
    return eligible.agg(
        F.count("*").alias("num_all"),
        F.count_if("has_valid_mapping").alias("num_map_ok"),
        F.count_if(F.col("has_base_commit") & F.col("has_merge_commit")).alias("num_commits_ok"),
        F.count_if("should_process").alias("num_will_process"),
    )


def item_key(*columns: str) -> Column:
    """``repo#pr#issue``; a missing part reads ``none``."""
    first, *rest = columns
    return F.concat_ws("#", F.col(first), *[F.coalesce(F.col(c).cast("string"), F.lit("none")) for c in rest])


def extraction_status(
    eligible: DataFrame, cloned: Column, fetched: Column, diff: Column, error: Column | None = None
) -> DataFrame:
    """The step at which an item left the extraction."""
    status = (
        F.when(~F.col("should_process"), "skipped_invalid")
        .when(~F.coalesce(cloned, F.lit(False)), "clone_failed")
        .when(~F.coalesce(fetched, F.lit(False)), "fetch_failed")
        .when(diff.isNull(), "diff_failed")
    )
    if error is not None:
        status = status.when(error.isNotNull(), "exception")
    return eligible.withColumn("patch_extraction_status", status.otherwise("success"))


def pending(items: DataFrame, processed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Items whose key has not been processed yet (resume after a stop)."""
    return items.join(processed.select(*keys).distinct(), list(keys), "left_anti")


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns that the table lacks."""
    return [name for name in required if name not in df.columns]


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def null_report(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows per required column that lack a value, in long form."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counts.unpivot([], list(required), "column_name", "n_missing")
