"""Comparing runs: which tasks are well formed, which are solved.

Outcomes are long: ``(task, run, nodeid, outcome)``.  Subset tests are boolean
aggregates over one row per ``(task, nodeid)``; no test list is ever built on the
way, and every aggregation combines before its exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

PASSED = "passed"


def _passed_in(run: str) -> Column:
    return F.bool_or((F.col("run") == run) & (F.col("outcome") == PASSED))


def _per_test(outcomes: DataFrame, task: str, **columns: Column) -> DataFrame:
    return outcomes.groupBy(task, "nodeid").agg(*[c.alias(name) for name, c in columns.items()])


def _listed_twice(runs: Sequence[str]) -> Column:
    """Whether a report of one of these runs lists the test of the group more than once."""
    return F.greatest(F.lit(False), *[F.count_if(F.col("run") == run) > 1 for run in runs])


def task_correctness(outcomes: DataFrame, task: str = "task", tasks: DataFrame | None = None) -> DataFrame:
    """Is a candidate task sound?  Compares the runs ``after`` and ``gold``.

    ``task_ok``: some test passes only with the gold patch.  ``task_perfect``: more
    tests pass with it and none is lost.  The run ``before`` plays no part, but a report
    of any of the three that lists a test twice voids the task: all its figures are NULL.
    With ``tasks`` a task without any outcome has a row too, with zeros.
    """
    n = F.col
    tests = _per_test(
        outcomes, task, gold=_passed_in("gold"), after=_passed_in("after"),
        in_gold=F.bool_or(n("run") == "gold"), twice=_listed_twice(("before", "after", "gold")),
    )
    counted = tests.groupBy(task).agg(
        F.count_if("gold").alias("n_pass_to_pass"),
        F.count_if(n("in_gold") & ~n("gold")).alias("n_fail_to_pass"),
        F.count_if("after").alias("n_after"),
        F.count_if(n("gold") & ~n("after")).alias("n_gained"),
        F.count_if(n("after") & ~n("gold")).alias("n_lost"),
        F.bool_or("twice").alias("void"),
    )
    if tasks is not None:
        counted = tasks.select(task).join(counted, task, "left").na.fill(0).na.fill(False)
    figures = {
        "task_ok": n("n_gained") > 0,
        "task_perfect": (n("n_pass_to_pass") > n("n_after")) & (n("n_lost") == 0),
        "n_pass_to_pass": n("n_pass_to_pass"),
        "n_fail_to_pass": n("n_fail_to_pass"),
    }
    return counted.select(task, *[F.when(~n("void"), x).alias(name) for name, x in figures.items()])


def task_test_lists(outcomes: DataFrame, task: str = "task", run: str = "gold") -> DataFrame:
    """``(task, list, nodeid)``: PASS_TO_PASS and FAIL_TO_PASS in long form."""
    tests = outcomes.where(F.col("run") == run).groupBy(task, "nodeid").agg(
        F.bool_or(F.col("outcome") == PASSED).alias("ok")
    )
    name = F.when(F.col("ok"), "PASS_TO_PASS").otherwise("FAIL_TO_PASS")
    return tests.select(task, name.alias("list"), "nodeid")


def test_lists_json(lists: DataFrame, task: str = "task") -> DataFrame:
    """The two lists as JSON text, sorted, for the benchmark file.

    A cell holds the test ids of one task, each once; use the long form where a
    task may have more of them than fit in a cell.
    """
    cell = lambda name: F.to_json(
        F.array_sort(F.collect_set(F.when(F.col("list") == name, F.col("nodeid"))))
    )
    return lists.groupBy(task).agg(
        cell("PASS_TO_PASS").alias("PASS_TO_PASS"), cell("FAIL_TO_PASS").alias("FAIL_TO_PASS")
    )


def solved(
    expected: DataFrame, outcomes: DataFrame, tasks: DataFrame, task: str = "task",
    evaluated: str | None = None,
) -> DataFrame:
    """``solved`` per task: every expected test passed in the evaluated run.

    ``expected`` holds ``(task, nodeid)``.  A task that was evaluated but has no
    expected test is solved; one that was not evaluated failed critically (NULL).
    Evaluated is a task with an outcome, or with the column ``evaluated`` true.  A
    report that lists a test twice is invalid, and its task failed critically.
    The three inputs are stacked and aggregated, so no join can be skewed.
    """
    none = F.lit(None).cast("string")
    kind_of_task = F.lit("task") if evaluated is None else F.when(F.col(evaluated), "run").otherwise("task")
    stacked = (
        expected.select(task, "nodeid", F.lit("expected").alias("kind"))
        .unionByName(
            outcomes.select(
                task, "nodeid", F.when(F.col("outcome") == PASSED, "passed").otherwise("run").alias("kind")
            )
        )
        .unionByName(tasks.select(task, none.alias("nodeid"), kind_of_task.alias("kind")))
    )
    kind = lambda name: F.bool_or(F.col("kind") == name)
    tests = stacked.groupBy(task, "nodeid").agg(
        kind("expected").alias("expected"),
        kind("passed").alias("passed"),
        F.bool_or(F.col("kind").isin("passed", "run")).alias("ran"),
        (F.count_if(F.col("kind").isin("passed", "run")) > 1).alias("twice"),
    )
    missed = F.bool_or(F.col("expected") & ~F.col("passed"))
    return tests.groupBy(task).agg(
        F.when(F.bool_or("ran") & ~F.bool_or("twice"), F.when(missed, 0).otherwise(1)).alias("solved")
    )


def solve_rate(scored: DataFrame) -> DataFrame:
    """Critical failures (``solved`` missing) and solved tasks, as counts and rates."""
    n = F.count("*")
    critical = F.count_if(F.col("solved").isNull())
    good = F.coalesce(F.sum("solved"), F.lit(0)).cast("bigint")
    return scored.agg(
        n.alias("n_tasks"),
        critical.alias("n_critical_fail"),
        good.alias("n_solved"),
        F.try_divide(critical.cast("double"), n.cast("double")).alias("critical_fail_rate"),
        F.try_divide(good.cast("double"), n.cast("double")).alias("solved_rate"),
    )


def variant_pass(
    outcomes: DataFrame,
    variants: Sequence[str],
    task: str = "task",
    baseline: str = "dry_run",
    require_nonempty: bool = True,
    loose: Sequence[str] = (),
) -> DataFrame:
    """``pass_<variant>`` per task: the variant passes all tests that the baseline passes.

    A variant without a passed test fails unless ``require_nonempty`` is off; ``loose``
    names variants whose flag is wanted in that way too, as ``loose_<variant>``.  A report
    that lists a test twice fails the evaluation of its task: all its flags are NULL.
    """
    runs = (baseline, *variants)
    tests = _per_test(
        outcomes, task, _base=_passed_in(baseline), _twice=_listed_twice(runs), **{f"_{v}": _passed_in(v) for v in variants}
    )
    valid = ~F.bool_or("_twice")

    def flag(variant: str, strict: bool, name: str) -> Column:
        good = ~F.bool_or(F.col("_base") & ~F.col(f"_{variant}"))
        if strict:
            good = good & F.bool_or(F.col(f"_{variant}"))
        return F.when(valid, good.cast("int")).alias(f"{name}_{variant}")

    return tests.groupBy(task).agg(
        F.when(valid, F.bool_or("_base").cast("int")).alias(f"pass_{baseline}"),
        *[flag(v, require_nonempty, "pass") for v in variants],
        *[flag(v, False, "loose") for v in loose],
    )


def zero_failed_flags(
    tasks: DataFrame, flags: DataFrame, variants: Sequence[str], task: str = "task",
    baseline: str = "dry_run", always: str = "gen", evaluated: str | None = None,
) -> DataFrame:
    """Flags of all tasks; a failed evaluation has zeros.

    A variant column of ``tasks`` that is NULL means the task has no such variant:
    its flag stays NULL.  The variant ``always`` has a flag in any case.  ``evaluated``
    names a column of ``tasks`` that is true where the runs took place: a task whose
    reports list no test then has zeros and status 1.  Without it a task without
    outcomes counts as failed.
    """
    rows = tasks.join(flags.withColumn("_listed", F.lit(True)), task, "left")
    fill = lambda v: F.coalesce(F.col(f"pass_{v}"), F.lit(0))
    columns = [fill(baseline).alias(f"pass_{baseline}")]
    for variant in variants:
        present = F.lit(True) if variant == always else F.col(variant).isNotNull()
        columns.append(F.when(present, fill(variant)).alias(f"pass_{variant}"))
    done = F.col(f"pass_{baseline}").isNotNull()
    if evaluated is not None:
        done = done | (F.col("_listed").isNull() & F.coalesce(F.col(evaluated), F.lit(False)))
    return rows.select(*tasks.columns, *columns, done.cast("int").alias("status"))


def distinct_builds(tasks: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The first task of every environment, by input order (an aggregate, no window)."""
    row = F.struct(*[c for c in tasks.columns if c not in keys])
    return tasks.groupBy(*keys).agg(F.min_by(row, order).alias("_r")).select(*keys, "_r.*")


def build_gate(
    tasks: DataFrame, builds: DataFrame, keys: Sequence[str], keep_failed: bool = False
) -> DataFrame:
    """Tasks whose environment was built (``builds.success`` = 1).

    ``keep_failed`` (Java) keeps the other tasks too, with ``status`` 0.
    """
    good = builds.where(F.col("success") == 1).select(*keys).distinct()
    if not keep_failed:
        return tasks.join(good, list(keys), "left_semi")
    flagged = tasks.join(good.withColumn("_built", F.lit(1)), list(keys), "left")
    return flagged.select(*tasks.columns, F.coalesce("_built", F.lit(0)).alias("status"))


def testgen_score(builds: DataFrame, success: str = "success", compiled: str = "compiled") -> DataFrame:
    """``pass@1`` and ``compile@1`` of a generated Java test; an errored run scores 0."""
    score = lambda name: F.coalesce(F.col(name).cast("double"), F.lit(0.0))
    return builds.withColumn("pass@1", score(success)).withColumn("compile@1", score(compiled))


def build_and_test(build: Column, test: Column) -> Column:
    """The two commands as one script."""
    return F.concat(build, F.when(build.endswith(";"), F.lit("\n")).otherwise(F.lit(";\n")), test)


def instance_id(repo: Column, commit: Column) -> Column:
    return F.lower(F.concat(F.replace(repo, F.lit("/"), F.lit("--")), F.lit("--"), commit))


def repo_slug(repo: Column) -> Column:
    return F.replace(repo, F.lit("/"), F.lit("-"))


def java_test_command(files: DataFrame, repo: str = "repo", path: str = "path") -> DataFrame:
    """The Maven command of a repository from its file list; NULL with ``error`` if none fits."""
    has = lambda name: F.bool_or(F.col(path) == name)
    command = F.when(has("pom.xml"), "mvn test").when(has("java/pom.xml"), "cd java; mvn test")
    rows = files.groupBy(repo).agg(command.alias("command"))
    return rows.withColumn("error", F.when(F.col("command").isNull(), "no_pom"))
