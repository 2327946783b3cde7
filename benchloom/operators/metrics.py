"""Metrics over scored tasks, and the preparation of task tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import FLAGS, all_matches
from .patches import fenced_code, stub_codes

# Task columns and the metric names they are reported under.
METRIC_NAMES = {
    "pass_gen": "pass@1",
    "pass_gt": "pass_oracle@1",
    "pass_return_pass": "pass_stub_pass@1",
    "pass_return_empty_str": "pass_stub_empty_str@1",
    "pass_dry_run": "pass_dry_run@1",
    "status": "execution_success",
}


def rename_metrics(tasks: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Task columns under their metric names; a column the table lacks stays absent."""
    found = [F.col(old).alias(new) for old, new in METRIC_NAMES.items() if old in tasks.columns]
    return tasks.select(*keep, *found, F.lit(1).alias("num_samples"))


def sum_and_mean(metrics: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(metric, total, mean, n_missing)``; missing values are ignored."""
    pair = lambda name: F.struct(
        F.lit(name).alias("metric"),
        F.sum(F.col(f"`{name}`")).cast("double").alias("total"),
        F.avg(F.col(f"`{name}`")).alias("mean"),
        F.count_if(F.col(f"`{name}`").isNull()).alias("n_missing"),
    )
    return metrics.agg(F.array(*[pair(n) for n in names]).alias("_m")).select(F.inline("_m"))


def testgen_metrics(tasks: DataFrame, pass_at: str = "pass@1", compile_at: str = "compile@1") -> DataFrame:
    """Means that count a missing value as 0; an empty table gives zeros."""
    mean = lambda name: F.coalesce(
        F.avg(F.coalesce(F.col(f"`{name}`").cast("double"), F.lit(0.0))), F.lit(0.0)
    )
    return tasks.agg(
        mean(pass_at).alias("pass@1"),
        mean(compile_at).alias("compile@1"),
        F.count("*").alias("num_samples"),
    )


def metric_drift(tasks: DataFrame) -> DataFrame:
    """Success rate, means, and their distance from the recorded metrics.

    Columns read: ``status, pass@1, compile@1, original_pass@1, original_compile@1, error``.
    Errors are counted here; ``task_errors`` lists them.
    """
    mean = lambda name: F.avg(F.coalesce(F.col(f"`{name}`").cast("double"), F.lit(0.0)))
    n_ok = F.count_if(F.coalesce("status", F.lit(0)) == 1)
    return tasks.agg(
        F.count("*").alias("total_tasks"),
        n_ok.alias("successful_tasks"),
        F.try_divide(n_ok.cast("double"), F.count("*").cast("double")).alias("success_rate"),
        mean("pass@1").alias("avg_pass@1"),
        mean("compile@1").alias("avg_compile@1"),
        mean("original_pass@1").alias("original_avg_pass@1"),
        mean("original_compile@1").alias("original_avg_compile@1"),
        F.count_if(F.coalesce("error", F.lit("")) != "").alias("n_errors"),
    ).withColumns(
        {
            "pass@1_difference": F.abs(F.col("`avg_pass@1`") - F.col("`original_avg_pass@1`")),
            "compile@1_difference": F.abs(F.col("`avg_compile@1`") - F.col("`original_avg_compile@1`")),
        }
    )


def task_errors(tasks: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return tasks.where(F.col("error") != "").select(*keep, "error")


def run_diff(first: DataFrame, second: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Two runs side by side: values that differ, and rows that only one run has."""
    side = lambda df, name: df.select(*keys, F.struct(*values).alias(name))
    paired = side(first, "_a").join(side(second, "_b"), list(keys), "full_outer")
    presence = (
        F.when(F.col("_a").isNull(), "second").when(F.col("_b").isNull(), "first").otherwise("both")
    )
    differs = [
        (~F.col(f"_a.{v}").eqNullSafe(F.col(f"_b.{v}"))).alias(f"{v}_differs") for v in values
    ]
    return paired.select(*keys, presence.alias("present_in"), *differs)


def run_difference(first: DataFrame, second: DataFrame, values: Sequence[str]) -> DataFrame:
    """Task counts of two runs and the distance of their means, as one row."""
    tagged = lambda df, name: df.select(F.lit(name).alias("_run"), *[F.col(f"`{v}`") for v in values])
    rows = tagged(first, "first").unionByName(tagged(second, "second"))
    of = lambda name: F.col("_run") == name
    mean = lambda v, name: F.avg(F.when(of(name), F.coalesce(F.col(f"`{v}`").cast("double"), F.lit(0.0))))
    return rows.agg(
        F.count_if(of("first")).alias("first_tasks"),
        F.count_if(of("second")).alias("second_tasks"),
        *[F.abs(mean(v, "first") - mean(v, "second")).alias(f"{v}_difference") for v in values],
    )


# --- task tables ------------------------------------------------------------------

# The fields of a sample's ``doc.meta`` that a task takes over.
TASK_FIELDS = (
    "id", "repo", "base_commit", "image_name", "build_command", "test_command", "fn",
    "PASS_TO_PASS", "FAIL_TO_PASS", "gt", "intent", "intent_type", "left_context", "right_context",
)
JAVA_TASK_FIELDS = (
    "instance_id", "repo", "base_commit", "image_name", "test_command", "fn_test", "source_code",
)


def prepare_tasks(samples: DataFrame) -> DataFrame:
    """Flatten ``doc.meta``, add the generated code and the stubs."""
    flat = samples.select(
        *[F.col(f"doc.meta.{name}").alias(name) for name in TASK_FIELDS], F.col("fixed_code").alias("gen")
    )
    return stub_codes(flat, "gt")


def prepare_java_tasks(samples: DataFrame) -> DataFrame:
    """Flatten Java samples; the code of the first answer, '' without one; recorded metrics."""
    answer = F.coalesce(F.get(F.get("resps", F.lit(0)), F.lit(0)), F.lit(""))
    recorded = lambda name: F.coalesce(F.col(f"`{name}`"), F.lit(0.0))
    return samples.select(
        "doc_id",
        *[F.col(f"doc.meta.{name}").alias(name) for name in JAVA_TASK_FIELDS],
        fenced_code(answer).alias("generated_code"),
        recorded("pass@1").alias("original_pass@1"),
        recorded("compilation_rate").alias("original_compile@1"),
    )


def _library(path: Column) -> Column:
    return F.get(F.split(path, "/", -1), F.lit(2))


def build_command_lines(logs: DataFrame, root: str, environment: str, order: str = "seq") -> DataFrame:
    """``lib_name, position, command``: the commands of each library that returned 0.

    Absolute paths become variables; a library is known by the folder of its first command.
    One row per command, so a library with any number of them spreads.
    """
    good = logs.where(F.col("returncode") == 0).select(
        _library(F.col("path_lib_name")).alias("lib_name"), "path_lib_name", "cmd", F.col(order).alias("position")
    )
    folders = good.groupBy("lib_name").agg(F.min_by("path_lib_name", "position").alias("_path"))
    folder = F.concat(F.lit(f"{root}/"), F.col("_path"))
    command = F.replace("cmd", F.concat(folder, F.lit(f"/{environment}")), F.lit("$path_venv"))
    return good.join(folders, "lib_name").select(
        "lib_name", "position", F.replace(command, folder, F.lit("$path_lib")).alias("command")
    )


def build_commands(logs: DataFrame, root: str, environment: str, order: str = "seq") -> DataFrame:
    """One build script per library: the output format of ``build_command_lines``.

    A script is one cell; use the long form where a library may have more commands than
    fit in one.
    """
    commands = F.transform(
        F.array_sort(F.collect_list(F.struct(F.col("position").alias("p"), F.col("command").alias("c")))),
        lambda e: e["c"],
    )
    rows = build_command_lines(logs, root, environment, order)
    return rows.groupBy("lib_name").agg(F.array_join(commands, "\n").alias("command"))


def add_commands(dataset: DataFrame, commands: DataFrame, repo: str = "repo") -> DataFrame:
    """The dataset with its build scripts; a repository without one is marked."""
    scripts = commands.withColumnRenamed("lib_name", repo)
    return dataset.join(scripts, repo, "left").withColumn(
        "error", F.when(F.col("command").isNull(), "no_command")
    )


def library_counts(logs: DataFrame) -> DataFrame:
    name = _library(F.col("path_lib_name"))
    return logs.agg(
        F.count_distinct(name).alias("n_libs"),
        F.count_distinct(F.when(F.col("returncode") == 0, name)).alias("n_libs_ok"),
    )


def git_metadata(df: DataFrame, head: str = "head", config: str = "config") -> DataFrame:
    """Branch from the HEAD text, remote address from the config text.

    Exactly one address is required; otherwise ``url`` is NULL and ``error`` is set.
    """
    urls = all_matches(F.col(config), rf"{FLAGS}(?<=url\s=\s)(https?://[^\s\x1c-\x1f]+)", 1)
    one = F.size("_urls") == 1
    return (
        df.withColumn("_urls", urls)
        .withColumn("branch", F.substring_index(F.substring_index(F.col(head), "\n", 1), "/", -1))
        .withColumn("url", F.when(one, F.get("_urls", F.lit(0))))
        .withColumn("error", F.when(~one, "not_one_url"))
        .drop("_urls")
    )
