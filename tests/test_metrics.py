from benchloom.operators import metrics


def test_rename_keeps_absent_absent(spark):
    df = spark.createDataFrame([(1, 0, 1)], "pass_gen INT, pass_gt INT, status INT")
    got = metrics.rename_metrics(df)
    assert got.columns == ["pass@1", "pass_oracle@1", "execution_success", "num_samples"]
    assert tuple(got.first()) == (1, 0, 1, 1)


def test_sum_and_mean_ignore_missing(spark):
    df = spark.createDataFrame([(1,), (0,), (None,), (1,)], "`pass@1` INT")
    r = metrics.sum_and_mean(df, ["pass@1"]).first()
    assert (r.metric, r.total, r["mean"], r.n_missing) == ("pass@1", 2.0, 2 / 3, 1)


def test_testgen_metrics_count_missing_as_zero(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 1.0)], "`pass@1` DOUBLE, `compile@1` DOUBLE")
    assert tuple(metrics.testgen_metrics(df).first()) == (0.5, 1.0, 2)
    assert tuple(metrics.testgen_metrics(df.limit(0)).first()) == (0.0, 0.0, 0)


def test_drift(spark):
    ddl = "status INT, `pass@1` DOUBLE, `compile@1` DOUBLE, `original_pass@1` DOUBLE, `original_compile@1` DOUBLE, error STRING"
    df = spark.createDataFrame([(1, 1.0, 1.0, 1.0, 1.0, ""), (None, None, 0.0, 1.0, None, "boom")], ddl)
    r = metrics.metric_drift(df).first()
    assert (r.total_tasks, r.successful_tasks, r.success_rate, r["pass@1_difference"], r["compile@1_difference"], r.n_errors) == (2, 1, 0.5, 0.5, 0.0, 1)
    assert [x.error for x in metrics.task_errors(df).collect()] == ["boom"]


def test_run_diff(spark):
    make = lambda *rows: spark.createDataFrame(rows, "id INT, v INT, w INT")
    a, b = make((1, 1, None), (2, 1, 1)), make((1, 1, 1), (3, 0, 0))
    got = {r.id: (r.present_in, r.v_differs, r.w_differs) for r in metrics.run_diff(a, b, ["id"], ["v", "w"]).collect()}
    assert got == {1: ("both", False, True), 2: ("first", True, True), 3: ("second", True, True)}
    r = metrics.run_difference(a, b, ["v", "w"]).first()
    assert tuple(r) == (2, 2, 0.5, 0.0)


def test_build_commands(spark):
    logs = spark.createDataFrame(
        [("data/v3/lib", "/root/data/v3/lib/venv/bin/pip", 0, 2), ("data/v3/lib", "cd /root/data/v3/lib", 0, 1), ("data/v3/lib", "bad", 1, 3), ("data/v3/other", "x", 1, 4)],
        "path_lib_name STRING, cmd STRING, returncode INT, seq INT")
    scripts = metrics.build_commands(logs, "/root", "venv")
    assert [tuple(r) for r in scripts.collect()] == [("lib", "cd $path_lib\n$path_venv/bin/pip")]
    assert tuple(metrics.library_counts(logs).first()) == (2, 1)
    data = spark.createDataFrame([("lib",), ("other",)], "repo STRING")
    got = {r.repo: r.error for r in metrics.add_commands(data, scripts).collect()}
    assert got == {"lib": None, "other": "no_command"}


def test_git_metadata(spark):
    df = spark.createDataFrame([("ref: refs/heads/main\n", "url = https://x/y.git\n"), ("ref: a/b", "url = http://x\nurl = http://y"), ("c", "")], "head STRING, config STRING")
    got = [(r.branch, r.url, r.error) for r in metrics.git_metadata(df).collect()]
    assert got == [("main", "https://x/y.git", None), ("b", None, "not_one_url"), ("c", None, "not_one_url")]


def test_java_tasks(spark):
    meta = "STRUCT<meta: STRUCT<instance_id: STRING, repo: STRING, base_commit: STRING, image_name: STRING, test_command: STRING, fn_test: STRING, source_code: STRING>>"
    m = {"meta": {"repo": "r"}}
    df = spark.createDataFrame(
        [(1, m, [["```java\nx\n```", "b"]], 0.5, None), (2, m, [], None, None), (3, m, [[]], None, 1.0), (4, m, None, None, None)],
        f"doc_id INT, doc {meta}, resps ARRAY<ARRAY<STRING>>, `pass@1` DOUBLE, compilation_rate DOUBLE")
    got = [(r.generated_code, r["original_pass@1"], r["original_compile@1"]) for r in metrics.prepare_java_tasks(df).orderBy("doc_id").collect()]
    assert got == [("x", 0.5, 0.0), ("", 0.0, 0.0), ("", 0.0, 1.0), ("", 0.0, 0.0)]
