"""Whole jobs: the operators put together, from input tables to the result table.

Each job is one lazy plan; only ``collect_tasks`` stores its parsed definitions on the
way, in a folder that the caller names.  A table that lacks a column the job needs is
refused before anything runs.  ``processed`` arguments hold the keys that earlier
runs have written; those items are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas
from . import collect, coverage, evaluate, metrics, patches, reports, stdout_logs


def collect_repos(
    found: DataFrame,
    start_date: str,
    end_date: str,
    window_days: int = 7,
    max_results_per_window: int | None = None,
    details: DataFrame | None = None,
    processed: DataFrame | None = None,
    order: Sequence[Column] | None = None,
    **filters: object,
) -> DataFrame:
    """Repositories that pass the search, per date window, with details if there are any.

    ``max_results_per_window`` keeps the first of each window in the given order.  ``filters`` are those of ``filter_repos``; ``processed`` holds ``_period``.
    """
    rows = collect.assign_windows(collect.filter_repos(found, **filters), start_date, end_date, window_days)
    if processed is not None:
        rows = collect.pending(rows, processed, ["_period"])
    rows = collect.cap_windows(rows, max_results_per_window, order)
    if details is not None:
        rows = collect.enrich_repos(rows, details)
    named = {
        "language": filters.get("language"), "stars_min": filters.get("min_stars", 0),
        "stars_max": filters.get("max_stars"), "forks_min": filters.get("min_forks", 0),
        "forks_max": filters.get("max_forks"),
    }
    return collect.tag_search(rows, **named)


def metadata_extraction_and_filtering(
    mappings: DataFrame, prs: DataFrame, issues: DataFrame, processed: DataFrame | None = None
) -> DataFrame:
    """Mappings with validity flags, the valid ones with texts; ``processed`` holds ``repo_name``."""
    rows = mappings if processed is None else collect.pending(mappings, processed, ["repo_name"])
    return collect.enrich_mappings(collect.validate_mappings(rows), prs, issues)


def extract_patches(
    validated: DataFrame,
    diffs: DataFrame,
    order: str,
    test_files_regexp: str = patches.TEST_PATH,
    processed: DataFrame | None = None,
) -> DataFrame:
    """Patches of all eligible items with the status of their extraction.

    ``diffs`` holds what git said per ``item_id``: ``cloned, fetched, full_patch,
    error``.  Of several rows of an item, in the given order: an invalid one stands
    for all; else rows count up to the first that succeeds or raises an error.
    """
    collect.require_columns(validated, (*schemas.VALIDATED, order))
    collect.require_columns(diffs, schemas.DIFFS)
    key = collect.item_key("repo_name", "pr_number", "issue_number").alias("item_id")
    rows = collect.patch_eligibility(validated).select("*", key)
    if processed is not None:
        rows = collect.pending(rows, processed, ["item_id"])
    # statuses need to know whether there is a diff, not what is in it
    there = F.when(F.col("full_patch").isNotNull(), "").alias("_diff")
    git = diffs.select("item_id", "cloned", "fetched", there, "error")
    rows = collect.extraction_status(
        rows.join(git, "item_id", "left"), F.col("cloned"), F.col("fetched"), F.col("_diff"), F.col("error")
    ).drop("cloned", "fetched", "_diff")
    status, place = F.col("patch_extraction_status"), F.col(order)
    firsts = rows.groupBy("item_id").agg(
        F.min(F.when(status == "skipped_invalid", place)).alias("_invalid"),
        F.min(F.when(status.isin("success", "exception"), place)).alias("_done"),
    )
    counted = F.when(F.col("_invalid").isNotNull(), place == F.col("_invalid")).otherwise(
        F.coalesce(place <= F.col("_done"), F.lit(True))
    )
    kept = rows.join(firsts, "item_id").where(counted).drop("_invalid", "_done")
    # each diff is split once and travels once, to the rows that succeeded
    texts = diffs.where("full_patch IS NOT NULL").select(F.col("item_id").alias("_item"), "full_patch")
    split = patches.split_test_patch(texts, pattern=test_files_regexp)
    match = (F.col("item_id") == F.col("_item")) & (status == "success")
    return kept.join(split, match, "left").drop("_item").withColumnRenamed("error", "patch_extraction_error")


def score_benchmark(tasks: DataFrame, runs: DataFrame, task: str = "instance_id") -> DataFrame:
    """Tasks with ``solved``, lists as JSON text, ready to be written as JSON Lines.

    ``runs`` holds the pytest report of the patched run per task (``text``); a task
    without a run failed critically.
    """
    collect.require_columns(tasks, (task, *schemas.TASK_LISTS))
    outcomes = reports.pytest_outcomes(runs, keys=[task])
    expected = tasks.select(task, F.explode_outer("PASS_TO_PASS").alias("nodeid")).where("nodeid IS NOT NULL")
    ran = runs.groupBy(task).agg(F.lit(True).alias("ran"))
    state = tasks.select(task).join(ran, task, "left")
    scored = evaluate.solved(expected, outcomes, state, task, evaluated="ran")
    text = lambda name: F.to_json(F.array_sort(F.array_distinct(name))).alias(name)
    lists = ("PASS_TO_PASS", "FAIL_TO_PASS")
    others = [c for c in tasks.columns if c not in (*lists, task)]
    return tasks.join(scored, task, "left").select(task, *others, *[text(c) for c in lists], "solved")


def score_variants(
    tasks: DataFrame, builds: DataFrame, outcomes: DataFrame, variants: Sequence[str],
    task: str = "id", build_keys: Sequence[str] = ("repo", "base_commit"), evaluated: str | None = None,
) -> DataFrame:
    """Flags of all tasks whose environment was built, under their metric names.

    ``evaluated`` names the column of ``tasks`` that is true where the runs took place.
    """
    collect.require_columns(tasks, (task, *build_keys, *variants, *([evaluated] if evaluated else [])))
    collect.require_columns(outcomes, (task, "run", *schemas.OUTCOMES))
    ready = evaluate.build_gate(tasks, builds, list(build_keys))
    flags = evaluate.variant_pass(outcomes, variants, task)
    zeroed = evaluate.zero_failed_flags(ready, flags, variants, task, evaluated=evaluated)
    return metrics.rename_metrics(zeroed, [task])


def score_test_generation(tasks: DataFrame, logs: DataFrame, task: str = "doc_id") -> DataFrame:
    """Generated Java tests with ``pass@1`` and ``compile@1`` from their build logs.

    ``logs`` holds ``stdout`` per task; a task without a log scores 0 and has an error.
    """
    builds = stdout_logs.maven_summary(logs, keys=[task]).select(task, "success", "compiled")
    scored = evaluate.testgen_score(tasks.join(builds, task, "left"))
    failed = F.col("success").isNull()
    return (
        scored.withColumn("error", F.when(failed, "no result").otherwise(""))
        .withColumn("status", F.when(failed, 0).otherwise(1))
        .drop("success", "compiled")
    )


def collect_tasks(
    files: DataFrame, contexts: DataFrame, outcomes: DataFrame, path: str = "path", source: str = "source",
    keys: Sequence[str] = (), folder: str | None = None, cache: str | None = None,
) -> DataFrame:
    """Definitions of Python files with their covering tests counted and their coverage rate.

    ``contexts`` holds the covered lines (``fn, line, context``), ``outcomes`` the
    results of the test runs (``nodeid, outcome``); ``keys`` are the columns that tell
    runs apart in all three.  With ``folder`` the parsed definitions are written there as
    Parquet and read again; until then the files are kept beside it.  Equal sources are parsed once; with ``cache`` also
    across calls.
    """
    collect.require_columns(files, (*keys, path, source))
    collect.require_columns(contexts, (*keys, *schemas.CONTEXTS))
    collect.require_columns(outcomes, (*keys, *schemas.OUTCOMES))
    spark, beside = files.sparkSession, None if folder is None else f"{folder.rstrip('/')}-files"
    definitions = coverage.latest_definitions(coverage.parse_distinct(files, path, source, keys, cache=cache, folder=beside), keys)
    if folder is not None:
        definitions.write.mode("overwrite").parquet(folder)
        definitions = spark.read.schema(definitions.schema).parquet(folder)
        gone = spark._jvm.org.apache.hadoop.fs.Path(beside)
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    spot = [*keys, "fn", "l", "r"]
    spans = definitions.select(*spot, "seq")
    tests = coverage.definition_tests(contexts, spans, unique=True, keys=keys)
    rate = coverage.coverage_rate(contexts, spans, unique=True, keys=keys).select(*spot, "coverage_rate")
    return coverage.problem_table(definitions, tests, outcomes, unique=True, keys=keys).join(rate, spot)
