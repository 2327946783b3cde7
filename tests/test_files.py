import json

from pyspark.sql import functions as F

from benchloom import schemas
from benchloom.operators import reports
from benchloom.sources import files
from benchloom.streaming import incremental


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_jsonl_round_trip(spark, tmp_path):
    out = str(tmp_path / "out")
    df = spark.createDataFrame([("r", 1, None)], "repo_name STRING, pr_number BIGINT, base_commit STRING").coalesce(1)
    files.append_jsonl(df, out)
    files.append_jsonl(df, out)
    back = files.read_jsonl(spark, out, schemas.MAPPINGS)
    assert back.count() == 2 and back.first().pr_number == 1 and back.first().type is None
    line = next((tmp_path / "out").glob("*.json")).read_text()
    assert json.loads(line) == {"repo_name": "r", "pr_number": 1, "base_commit": None}
    more = spark.createDataFrame([("r", 1), ("r", 2)], "repo_name STRING, pr_number BIGINT")
    left = files.unprocessed(more, out, ["repo_name", "pr_number"], schemas.MAPPINGS)
    assert [r.pr_number for r in left.collect()] == [2]


def test_csv(spark, tmp_path):
    put(tmp_path, "jacoco.csv", "GROUP,CLASS,INSTRUCTION_MISSED,INSTRUCTION_COVERED,X\ng,A,1,3,0\ng,A,9,0,0\ng,B,0,0,0\n")
    cov = files.read_jacoco(spark, str(tmp_path / "jacoco.csv"))
    wanted = spark.createDataFrame([("A",), ("B",), ("C",)], "class_name STRING")
    got = {r.class_name: r.coverage for r in reports.jacoco_ratio(cov, wanted).collect()}
    assert got == {"A": 0.75, "B": 0.0, "C": None}
    files.write_metrics_csv(spark.createDataFrame([(0.5,)], "`pass@1` DOUBLE").coalesce(1), str(tmp_path / "m"))
    assert next((tmp_path / "m").glob("*.csv")).read_text() == "pass@1\n0.5\n"


def found(spark, root, language):
    return sorted(r.path.split("/runs/")[1] for r in files.discover_reports(spark, str(root), language).collect())


def test_discovery(spark, tmp_path):
    root = tmp_path / "runs"
    for name in ("r1/target/surefire-reports/TEST-a.xml", "r1/target/surefire-reports/deep/TEST-b.xml", "r1/target/surefire-reports/a.xml",
                 "r1/target/TEST-c.xml", "r2/test-results/x.json", "r2/test-results/y.xml", "r2/test-results/z.txt", "r2/gotest_results.jsonl",
                 "r3/report_pytest.json", "r3/jest-results.json"):
        put(root, name, "<x/>")
    assert found(spark, root, "java") == ["r1/target/surefire-reports/TEST-a.xml", "r1/target/surefire-reports/deep/TEST-b.xml"]
    assert found(spark, root, "go") == ["r2/gotest_results.jsonl", "r2/test-results/x.json", "r2/test-results/y.xml"]
    assert found(spark, root, "scala") == ["r1/target/TEST-c.xml", "r1/target/surefire-reports/TEST-a.xml", "r1/target/surefire-reports/deep/TEST-b.xml"]
    assert found(spark, root, "python") == ["r3/report_pytest.json"]
    assert found(spark, root, "typescript") == ["r3/jest-results.json"]
    ids = files.with_run_id(files.discover_reports(spark, str(root), "python"), r"/runs/([^/]+)/")
    assert ids.first().run_id == "r3"


def test_every_file_is_processed_once(spark, tmp_path):
    root, sink = tmp_path / "runs", str(tmp_path / "sink")
    state = incremental.state_folder(spark, "outcomes")
    assert state == spark.conf.get("spark.checkpoint.dir") + "/outcomes"
    text = lambda n: json.dumps({"tests": [{"nodeid": f"t{n}", "outcome": "passed"}]})
    parse = lambda batch: reports.pytest_outcomes(batch, keys=["path"])

    def run():
        source = incremental.stream_reports(spark, str(root), "python")
        incremental.process_new(source, parse, sink, state, keys=["path"]).awaitTermination()
        return sorted(r.nodeid for r in spark.read.parquet(f"{sink}/*").collect())

    put(root, "r1/report_pytest.json", text(1))
    put(root, "r1/other.json", text(9))
    assert run() == ["t1"]
    put(root, "r2/report_pytest.json", text(2))
    assert run() == ["t1", "t2"]
    assert run() == ["t1", "t2"]


def test_stream_of_mappings(spark, tmp_path):
    put(tmp_path / "in", "a.json", '{"repo_name": "r", "pr_number": 1}\n{"repo_name": "r", "pr_number": 1}\n')
    source = incremental.stream_jsonl(spark, str(tmp_path / "in"), schemas.MAPPINGS)
    sink = str(tmp_path / "sink")
    incremental.process_new(source, lambda b: b.select("pr_number"), sink, str(tmp_path / "s"), ["pr_number"]).awaitTermination()
    assert spark.read.parquet(f"{sink}/*").count() == 1


def test_a_key_in_two_files_is_written_once(spark, tmp_path):
    sink, state = str(tmp_path / "sink"), str(tmp_path / "state")
    keep = lambda batch: batch.select("repo_name", "pr_number")

    def run():
        source = incremental.stream_jsonl(spark, str(tmp_path / "in"), schemas.MAPPINGS, files_per_batch=1)
        incremental.process_new(source, keep, sink, state, ["repo_name", "pr_number"]).awaitTermination()
        return sorted(tuple(r) for r in spark.read.parquet(sink).select("repo_name", "pr_number").collect())

    put(tmp_path / "in", "a.json", '{"repo_name": "r", "pr_number": 1}\n')
    put(tmp_path / "in", "b.json", '{"repo_name": "r", "pr_number": 1}\n{"repo_name": "r", "pr_number": 2}\n')
    assert run() == [("r", 1), ("r", 2)]
    put(tmp_path / "in", "c.json", '{"repo_name": "r", "pr_number": 2}\n{"repo_name": "q", "pr_number": 1}\n')
    assert run() == [("q", 1), ("r", 1), ("r", 2)]


def test_a_batch_that_is_written_again_counts_once(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = lambda *n: spark.createDataFrame([("r", i) for i in n], "repo_name STRING, pr_number BIGINT")
    for df, batch in ((rows(1, 2), "a"), (rows(3), "b"), (rows(1, 2), "a")):
        files.append_batch(df, out, batch)
    assert sorted(r.pr_number for r in files.read_batches(spark, out, schemas.MAPPINGS).collect()) == [1, 2, 3]


def test_a_batch_does_not_read_the_sink(spark, tmp_path):
    """A restart between batches writes each key once, even where the sink has moved away; other keys come from a table."""
    state = str(tmp_path / "state")

    def run(sink):
        source = incremental.stream_jsonl(spark, str(tmp_path / "in"), schemas.MAPPINGS, files_per_batch=1)
        known = spark.createDataFrame([("r", 9)], "repo_name STRING, pr_number BIGINT")
        incremental.process_new(source, lambda b: b.select("repo_name", "pr_number"), str(sink), state, ["repo_name", "pr_number"], known).awaitTermination()
        return sorted(r.pr_number for r in spark.read.parquet(str(sink)).collect())

    put(tmp_path / "in", "a.json", '{"repo_name": "r", "pr_number": 1}\n{"repo_name": "r", "pr_number": 9}\n')
    assert run(tmp_path / "one") == [1]
    put(tmp_path / "in", "b.json", '{"repo_name": "r", "pr_number": 1}\n{"repo_name": "r", "pr_number": 2}\n')
    assert run(tmp_path / "two") == [2]
    assert spark.conf.get(incremental.PROVIDER) != incremental.ROCKSDB


def test_reports_belong_to_the_deepest_run(spark, tmp_path):
    top = tmp_path / "runs"
    for name in ("r1/build.sbt", "r1/my-test.xml", "r1/target/deep/TEST-a.xml", "r1/src/test.xml", "r1/inner/build.sbt", "r1/inner/TestB.xml",
                 "r1/inner/target/x/test-c.xml", "r1/inner/other/test.xml", "r2/test.xml", "r10/build.sbt", "r10/test-output/test.xml", "r10/readme.xml"):
        put(top, name, f"<{name.split('/')[-1]}>")
    got = files.discover_run_reports(spark, str(top), "scala", "build.sbt").collect()
    assert sorted((r.run.split("/runs/")[1], r.path.split("/runs/")[1]) for r in got) == [
        ("r1", "r1/my-test.xml"), ("r1", "r1/target/deep/TEST-a.xml"), ("r1/inner", "r1/inner/TestB.xml"),
        ("r1/inner", "r1/inner/target/x/test-c.xml"), ("r10", "r10/test-output/test.xml")]
    assert all(r.text == f"<{r.path.split('/')[-1]}>" for r in got)
