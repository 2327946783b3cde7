from pyspark.sql import functions as F

from benchloom.operators import evaluate


def outcomes(spark, *rows):
    return spark.createDataFrame(rows, "task STRING, run STRING, nodeid STRING, outcome STRING")


def test_correctness(spark):
    p, f = "passed", "failed"
    df = outcomes(
        spark,
        ("perfect", "gold", "a", p), ("perfect", "gold", "b", p), ("perfect", "after", "a", p), ("perfect", "after", "b", f),
        ("lost", "gold", "a", p), ("lost", "gold", "b", p), ("lost", "gold", "c", "xfailed"), ("lost", "after", "c", p),
        ("same", "gold", "a", p), ("same", "after", "a", p), ("same", "before", "z", p),
    )
    got = {r.task: (r.task_ok, r.task_perfect, r.n_pass_to_pass, r.n_fail_to_pass) for r in evaluate.task_correctness(df).collect()}
    assert got == {"perfect": (True, True, 2, 0), "lost": (True, False, 2, 1), "same": (False, False, 1, 0)}
    lists = evaluate.test_lists_json(evaluate.task_test_lists(df)).where("task = 'lost'").first()
    assert (lists.PASS_TO_PASS, lists.FAIL_TO_PASS) == ('["a","b"]', '["c"]')


def test_solved_and_rates(spark):
    expected = spark.createDataFrame([("ok", "a"), ("bad", "a"), ("bad", "b"), ("missing", "a"), ("crash", "a")], "task STRING, nodeid STRING")
    runs = spark.createDataFrame(
        [("ok", "a", "passed"), ("ok", "z", "failed"), ("bad", "a", "passed"), ("bad", "b", "skipped"), ("missing", "q", "passed"), ("free", "q", "failed")],
        "task STRING, nodeid STRING, outcome STRING")
    tasks = spark.createDataFrame([(t, t == "silent") for t in ("ok", "bad", "missing", "crash", "free", "silent")], "task STRING, ran BOOLEAN")
    got = {r.task: r.solved for r in evaluate.solved(expected, runs, tasks, evaluated="ran").collect()}
    assert got == {"ok": 1, "bad": 0, "missing": 0, "crash": None, "free": 1, "silent": 1}
    rate = evaluate.solve_rate(evaluate.solved(expected, runs, tasks)).first()
    assert (rate.n_tasks, rate.n_critical_fail, rate.n_solved) == (6, 2, 2)
    assert rate.solved_rate == 2 / 6
    assert evaluate.solve_rate(evaluate.solved(expected, runs, tasks).limit(0)).first().solved_rate is None


def test_variants(spark):
    df = outcomes(
        spark, ("a", "dry_run", "x", "passed"), ("a", "gen", "x", "passed"), ("a", "gt", "x", "failed"), ("a", "gt", "y", "passed"),
        ("b", "dry_run", "x", "failed"), ("b", "gen", "x", "failed"), ("b", "gt", "x", "passed"))
    get = lambda **kw: {r.task: (r.pass_dry_run, r.pass_gen, r.pass_gt) for r in evaluate.variant_pass(df, ["gen", "gt"], **kw).collect()}
    assert get() == {"a": (1, 1, 0), "b": (0, 0, 1)}
    assert get(require_nonempty=False)["b"] == (0, 1, 1)


def test_failed_evaluation_has_zeros_for_present_variants(spark):
    tasks = spark.createDataFrame([("a", None, "code"), ("b", None, None)], "task STRING, gen STRING, gt STRING")
    flags = evaluate.variant_pass(outcomes(spark, ("c", "dry_run", "x", "passed")), ["gen", "gt"])
    got = {r.task: (r.pass_dry_run, r.pass_gen, r.pass_gt, r.status) for r in evaluate.zero_failed_flags(tasks, flags, ["gen", "gt"]).collect()}
    assert got == {"a": (0, 0, 0, 0), "b": (0, 0, None, 0)}


def test_builds(spark):
    tasks = spark.createDataFrame([("r", "c1", 2, "late"), ("r", "c1", 1, "early"), ("r", "c2", 3, "x")], "repo STRING, base_commit STRING, seq INT, id STRING")
    got = evaluate.distinct_builds(tasks, ["repo", "base_commit"], "seq").collect()
    assert sorted(r.id for r in got) == ["early", "x"]
    builds = spark.createDataFrame([("c1", 1), ("c2", 0)], "base_commit STRING, success INT")
    assert evaluate.build_gate(tasks, builds, ["base_commit"]).count() == 2
    kept = evaluate.build_gate(tasks, builds, ["base_commit"], keep_failed=True).collect()
    assert sorted((r.id, r.status) for r in kept) == [("early", 1), ("late", 1), ("x", 0)]


def test_ids_and_commands(spark):
    df = spark.createDataFrame([("Org/Repo", "ABC")], "repo STRING, sha STRING")
    row = df.select(
        evaluate.instance_id(F.col("repo"), F.col("sha")), evaluate.repo_slug(F.col("repo")),
        evaluate.build_and_test(F.lit("make"), F.lit("t")), evaluate.build_and_test(F.lit("make;"), F.lit("t"))).first()
    assert tuple(row) == ("org--repo--abc", "Org-Repo", "make;\nt", "make;\nt")
    files = spark.createDataFrame([("a", "pom.xml"), ("a", "java/pom.xml"), ("b", "java/pom.xml"), ("c", "x/pom.xml")], "repo STRING, path STRING")
    got = {r.repo: (r.command, r.error) for r in evaluate.java_test_command(files).collect()}
    assert got == {"a": ("mvn test", None), "b": ("cd java; mvn test", None), "c": (None, "no_pom")}


def test_duplicates_void_and_silent_runs_count(spark):
    df = outcomes(
        spark, ("twice", "dry_run", "x", "passed"), ("twice", "gen", "x", "passed"), ("twice", "gen", "x", "failed"),
        ("good", "dry_run", "x", "passed"), ("good", "gen", "x", "passed"))
    flags = evaluate.variant_pass(df, ["gen"], loose=["gen"])
    assert {r.task: (r.pass_dry_run, r.pass_gen, r.loose_gen) for r in flags.collect()} == {"twice": (None, None, None), "good": (1, 1, 1)}
    tasks = spark.createDataFrame([("twice", True), ("good", True), ("silent", True), ("broken", False)], "task STRING, ran BOOLEAN")
    got = evaluate.zero_failed_flags(tasks, flags, ["gen"], evaluated="ran").collect()
    assert {r.task: (r.pass_dry_run, r.pass_gen, r.status) for r in got} == {"twice": (0, 0, 0), "good": (1, 1, 1), "silent": (0, 0, 1), "broken": (0, 0, 0)}
    gold = outcomes(spark, ("t", "gold", "x", "passed"), ("t", "gold", "x", "failed"), ("u", "gold", "x", "passed"))
    rows = evaluate.task_correctness(gold, tasks=spark.createDataFrame([("t",), ("u",), ("v",)], "task STRING")).collect()
    assert {r.task: (r.task_ok, r.n_pass_to_pass) for r in rows} == {"t": (None, None), "u": (True, 1), "v": (False, 0)}
