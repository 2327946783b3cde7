import pytest
from pyspark.sql import functions as F

from benchloom.operators import collect, jobs


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_windows_drop_the_partial_last_one(spark):
    df = spark.createDataFrame([("2020-01-01", "2020-01-20"), ("2020-01-01", "2020-01-03")], "a STRING, b STRING")
    got = rows(collect.date_windows(df, "a", "b", 7), "window_start", "window_end")
    assert got == [("2020-01-01", "2020-01-08"), ("2020-01-08", "2020-01-15")]


def repos(spark, *created):
    return spark.createDataFrame([(f"r{i}", c) for i, c in enumerate(created)], "name STRING, createdAt STRING")


def test_boundary_day_belongs_to_two_windows(spark):
    df = repos(spark, "2020-01-01T05:00:00Z", "2020-01-08T00:00:00Z", "2020-01-15T23:00:00Z", "2020-01-16T00:00:00Z", "2019-12-31T00:00:00Z")
    got = rows(collect.assign_windows(df, "2020-01-01", "2020-01-20", 7), "name", "_period")
    first, second = "2020-01-01:2020-01-08", "2020-01-08:2020-01-15"
    assert got == [("r0", first), ("r1", first), ("r1", second), ("r2", second)]
    strict = rows(collect.assign_windows(df, "2020-01-01", "2020-01-20", 7, strict=True), "name", "_period")
    assert strict == [("r0", first), ("r1", second)]


def test_cap_keeps_the_full_count(spark):
    df = spark.createDataFrame([("p", f"n{i}") for i in range(5)] + [("q", "x")], "_period STRING, nameWithOwner STRING")
    got = rows(collect.cap_windows(df, 2), "_period", "nameWithOwner", "repositoryCount")
    assert got == [("p", "n0", 5), ("p", "n1", 5), ("q", "x", 1)]


def test_failed_detail_lookup_keeps_the_row(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2)], "nameWithOwner STRING, stars INT")
    detail = spark.createDataFrame([("a", None, 9)], "nameWithOwner STRING, stars INT, issuesOpen INT")
    got = rows(collect.enrich_repos(base, detail), "nameWithOwner", "stars", "issuesOpen")
    assert got == [("a", None, 9), ("b", 2, None)]


MAPPING = "repo_name STRING, type STRING, issue_number INT, pr_number INT"


def validated(spark, *links):
    return collect.validate_mappings(spark.createDataFrame([("r", *x) for x in links], MAPPING))


def flags(df):
    return {(r.type, r.issue_number, r.pr_number): (r.map_issue_ok, r.map_pr_ok) for r in df.collect()}


def test_one_linked_pr_beats_any_references(spark):
    got = flags(validated(spark, ("linked", 1, 10), ("referenced", 1, 11), ("referenced", 1, 12)))
    assert got[("linked", 1, 10)] == (True, True)
    assert got[("referenced", 1, 11)] == (True, True)


def test_two_linked_or_two_referenced_are_ambiguous(spark):
    got = flags(validated(spark, ("linked", 1, 10), ("linked", 1, 11), ("referenced", 2, 20), ("referenced", 2, 21)))
    assert {v[0] for v in got.values()} == {False}


def test_repeated_links_count_once(spark):
    got = validated(spark, ("linked", 1, 10), ("linked", 1, 10)).collect()
    assert [r.map_issue_pr_ok for r in got] == [True, True]


def test_stats(spark):
    df = collect.mapping_stats(validated(spark, ("linked", 1, 10), ("linked", 2, 11), ("linked", 2, 12)))
    r = df.first()
    assert (r.num_rows, r.num_issues, r.num_prs) == (3, 2, 3)
    assert (r.num_issues_issue_ok, r.num_prs_pr_ok, r.num_issues_valid, r.num_prs_valid) == (1, 3, 1, 1)


def test_enrich_only_valid_rows_with_both_details(spark):
    df = validated(spark, ("linked", 1, 10), ("linked", 2, 11), ("linked", 2, 12), ("linked", 3, 13))
    ddl = "repo_name STRING, number INT, title STRING, body STRING, comments STRUCT<edges: ARRAY<STRUCT<node: STRUCT<author: STRUCT<login: STRING>, body: STRING, createdAt: STRING>>>>"
    edge = lambda who: {"node": {"author": {"login": who} if who else None, "body": "hi", "createdAt": "t"}}
    prs = spark.createDataFrame([("r", n, f"T{n}", "B", {"edges": [edge("u"), edge(None)]}) for n in (10, 10, 11, 12, 13)], ddl)
    issues = spark.createDataFrame([("r", n, "T", f"I{n}", {"edges": []}) for n in (1, 2)], ddl)
    got = {r.issue_number: r for r in collect.enrich_mappings(df, prs, issues).collect()}
    assert len(got) == 3 and collect.enrich_mappings(df, prs, issues).count() == 4
    assert got[1].pr_title == "T10" and got[1].issue_body == "I1"
    assert [c.author for c in got[1].pr_comments] == ["u", None]
    assert got[2].pr_title is None  # ambiguous
    assert got[3].pr_title is None and got[3].issue_body is None  # issue details missing


def test_recency_lets_null_pass(spark):
    df = spark.createDataFrame([("a", None), ("b", "2019-12-31T23:59:59Z"), ("c", "2020-01-01T00:00:00Z")], "name STRING, updatedAt STRING")
    assert rows(collect.recent_issues(df), "name") == [("a",), ("c",)]


def test_item_key_and_pending(spark):
    items = spark.createDataFrame([("r", 1, 2), ("r", None, 2)], "repo STRING, pr INT, issue INT")
    keyed = items.select(collect.item_key("repo", "pr", "issue").alias("k"))
    assert rows(keyed, "k") == [("r#1#2",), ("r#none#2",)]
    assert rows(collect.pending(keyed, keyed.where(F.col("k").contains("none")), ["k"]), "k") == [("r#1#2",)]


def test_missing_columns(spark):
    df = spark.createDataFrame([(1, None)], "a INT, b INT")
    assert collect.missing_columns(df, ["a", "c"]) == ["c"]
    with pytest.raises(ValueError, match="c"):
        collect.require_columns(df, ["a", "c"])
    assert rows(collect.null_report(df, ["a", "b"]), "column_name", "n_missing") == [("a", 0), ("b", 1)]


def test_repo_filter_bounds(spark):
    ddl = "nameWithOwner STRING, stargazerCount INT, forkCount INT, pushedAt STRING, primaryLanguage STRUCT<name: STRING>, licenseInfo STRUCT<spdxId: STRING>"
    row = lambda name, stars, forks, pushed, lang, lic: (name, stars, forks, pushed, {"name": lang}, {"spdxId": lic} if lic else None)
    df = spark.createDataFrame(
        [row("a", 5, 1, "2021-05-01", "Python", "MIT"), row("b", 50, 1, "2021-01-01T00:00:00Z", "Python", "MIT"),
         row("c", 5, 1, "2020-12-31T23:00:00Z", "Python", "MIT"), row("d", 5, 1, "2022-01-01", "Java", "MIT"),
         row("e", 5, 1, "2022-01-01", "python", None)], ddl)
    got = collect.filter_repos(df, "python", 5, 50, pushed_year=2021, licenses=["mit"])
    assert rows(got, "nameWithOwner") == [("a",), ("b",)]
    assert collect.filter_repos(df, max_stars=5).count() == 4


def test_no_cap_by_default(spark):
    df = spark.createDataFrame([("p", f"n{i:04}") for i in range(150)], "_period STRING, nameWithOwner STRING")
    assert collect.cap_windows(df).count() == 150 and collect.cap_windows(df, 1000).count() == 150


def test_jobs_refuse_tables_without_their_columns(spark):
    tasks = spark.createDataFrame([("t",)], "instance_id STRING")
    with pytest.raises(ValueError, match="PASS_TO_PASS"):
        jobs.score_benchmark(tasks, tasks)


def test_flags_after_batches_equal_those_of_all_rows(spark):
    """Links that repeat, that make earlier ones ambiguous, and rows without a number, in batches of any order."""
    import random

    draw = random.Random(11)
    number = lambda n: draw.choice([*range(n), None]) if draw.random() < 0.1 else draw.randrange(n)
    rows = [(f"r{draw.randrange(3)}", draw.choice(["linked", "referenced"]), number(40), number(40), i) for i in range(240)]
    rows += rows[:20] + [(None, "linked", 1, 1, 999)]
    ddl = "repo_name STRING, type STRING, issue_number BIGINT, pr_number BIGINT, seq INT"
    frame = lambda part: spark.createDataFrame(part, ddl)
    names = ["repo_name", "type", "issue_number", "pr_number", "seq", *collect.FLAGS]
    found = lambda df: sorted((tuple(r) for r in df.select(*names).collect()), key=str)
    validated = collect.validate_mappings(frame(rows[:150])).select(*names)
    for batch in (rows[150:151], rows[151:230], rows[230:]):
        new = frame(batch)
        after = collect.unchanged_flags(validated, new).unionByName(collect.changed_flags(validated, new))
        validated = spark.createDataFrame(after.collect(), after.schema)
    assert found(validated) == found(collect.validate_mappings(frame(rows)))
    one = frame(rows[:1])
    assert collect.changed_flags(validated, one).count() < 40


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_flags_need_no_distinct_links(spark):
    """One aggregation for each side; flags as counted from distinct links, with repeated links and nulls."""
    rows = [("r", i % 7 or None, i * i % 11 if i % 5 else None, ("linked", "referenced", "other", None)[i * 3 % 4]) for i in range(90)] * 2
    rows += [("r", 100, 200, "linked"), ("r", 100, 201, "referenced"), ("r", 101, 202, "referenced"), (None, 1, 2, "linked")]
    df = spark.createDataFrame(rows, "repo_name string, issue_number long, pr_number long, type string")
    assert _optimized(collect.validate_mappings(df)).count("Aggregate [") == 2
    for side in ("issue", "pr"):
        want = collect.link_cardinality(df, side).select("repo_name", f"{side}_number", f"{side}_ok")
        assert sorted(map(tuple, want.collect())) == sorted(map(tuple, collect.link_flags(df, side).collect()))


def test_enriching_computes_the_mappings_once(spark):
    df = spark.createDataFrame([("r", 1, 2, "linked")], "repo_name string, issue_number long, pr_number long, type string")
    edges = "named_struct('edges', array(named_struct('node', named_struct('author', named_struct('login', 'u'), 'body', 'b', 'createdAt', 'd'))))"
    detail = df.selectExpr("repo_name", "cast(2 AS bigint) AS number", "'t' AS title", "'b' AS body", f"{edges} AS comments")
    out = collect.enrich_mappings(collect.validate_mappings(df), detail, detail.selectExpr("repo_name", "1L AS number", "title", "body", "comments"))
    assert _optimized(out).count("Join Left") == 4 and out.first()["pr_title"] == "t"
