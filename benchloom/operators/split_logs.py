"""Logs of any size, one row per line: summaries and folds over split files.

``sources.files.read_log_lines`` reads a log with as many tasks as its file has splits.  Its rows have ``at``,
which orders the lines of a log: the file, the start of the split in it, and a row id that grows within the split.

Most summaries are plain aggregations that take the order from ``at`` (``max_by``, ``min``); their partial
results are combined before the exchange, so one log is worked on by all tasks that read it.  What
depends on the lines before it is a :class:`Fold`: the lines of a split fold into a small state, and the
states of the splits are joined in order.  Joining is associative, so the result does not depend on where the
file was cut.

Operators that look at single lines (``pytest_tests``, ``sbt_tests``, ``maven_errors``, ``rust_tests``) take these rows
as they are, with ``text="line"`` and ``at`` among the keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import schemas
from ..functions.text import all_matches, compute_once, last, strip
from . import patches, reports, stdout_logs as logs

Keys = Sequence[str]


class Fold(NamedTuple):
    """A fold that can be cut anywhere.

    ``step(state, item)`` takes in one more item; ``join(a, b)`` is the state of ``b``'s items behind those of
    ``a``.  ``zero`` is the state of no items.
    """

    zero: Column
    step: Callable[[Column, Column], Column]
    join: Callable[[Column, Column], Column]


def fold_in_order(rows: DataFrame, keys: Keys, item: Column, fold: Fold, at: str = "at") -> DataFrame:
    """``keys, state``: the items of each key folded in order; rows whose item is NULL are skipped.

    ``at`` has fields ``path``, ``start`` and ``id``.  Only items travel, never lines; a cell holds the items of one
    split, or one state per split.
    """
    wanted = rows.select(*keys, F.col(at)["path"].alias("_path"), F.col(at)["start"].alias("_start"), F.col(at)["id"].alias("_id"), item.alias("_item"))
    placed = F.when(F.col("_item").isNotNull(), F.struct("_id", "_item"))
    folded = F.aggregate(F.array_sort(F.collect_list(placed)), fold.zero, lambda state, x: fold.step(state, x["_item"]))
    pieces = wanted.groupBy(*keys, "_path", "_start").agg(folded.alias("_state"))
    ordered = F.array_sort(F.collect_list(F.struct("_path", "_start", "_state")))
    joined = F.aggregate(ordered, fold.zero, lambda state, x: fold.join(state, x["_state"]))
    return pieces.groupBy(*keys).agg(joined.alias("state"))


# --- summaries that take the order from the rows ----------------------------------


def maven_summary(lines: DataFrame, keys: Keys = ("path",), path: str | None = None, at: str = "at") -> DataFrame:
    """:func:`stdout_logs.maven_summary` of line rows; ``path`` has to be among the keys."""
    line = F.col("line")
    counted = line.startswith("[INFO] Tests run:")
    compiled = F.bool_or(line.startswith("[INFO]  T E S T S"))
    if path is not None:
        compiled = compiled & ~F.bool_or(line.startswith("[ERROR]") & F.contains(line, F.col(path)))
    found = lines.groupBy(*keys).agg(
        F.bool_or(line.startswith("[INFO] BUILD SUCCESS")).alias("success"),
        compiled.alias("compiled"),
        F.max_by(F.when(counted, line), F.when(counted, F.col(at))).alias("_counted"),
        F.count_if(logs.positioned_error(line)).alias("n_errors"),
    )
    told, tests = F.col("_counted"), logs.maven_test_count(F.col("_counted"))
    return found.select(
        *keys, "success", "compiled", F.when(told.isNull(), F.lit(0)).otherwise(tests).cast("bigint").alias("tests"), "n_errors",
        F.when(told.isNotNull() & tests.isNull(), "bad_test_count").alias("parse_error"),
    )


def sbt_summary(lines: DataFrame, keys: Keys = ("path",), at: str = "at") -> DataFrame:
    """:func:`stdout_logs.sbt_summary` of line rows."""
    rows = lines.select(*keys, F.col(at).alias("_at"), logs.sbt_kind(F.col("line")).alias("_kind"), logs.sbt_failures(F.col("line")).alias("_n"))
    place = lambda kind: F.min(F.when(F.col("_kind") == kind, F.col("_at")))
    n, zero = F.col, F.lit(0).cast("bigint")
    found = rows.groupBy(*keys).agg(
        F.count_if(n("_kind") == "test").alias("_tests"), place("test").alias("_test"), place("marker").alias("_marker"),
        F.max_by("_n", F.when(n("_n").isNotNull(), n("_at"))).alias("_failed"),
    )
    bonus = n("_marker").isNotNull() & (n("_test").isNull() | (n("_marker") < n("_test")))
    counted = found.select(*keys, (n("_tests") + F.coalesce(bonus.cast("bigint"), zero)).alias("passed"), F.coalesce("_failed", zero).alias("failed"))
    return counted.select(
        *keys, n("passed").alias("total"), "passed", "failed", zero.alias("skipped"), zero.alias("errors"), logs.sbt_status().alias("status")
    )


def pytest_summary(lines: DataFrame, keys: Keys = ("path",), at: str = "at") -> DataFrame:
    """The counters of :func:`stdout_logs.pytest_summary` of line rows: the last count of each."""
    found = all_matches(F.col("line"), rf"\d+ (?:{'|'.join(logs.PYTEST_COUNTERS)})")
    rows = compute_once(lines, [*keys, at], found, "_all")
    own = lambda key: last(F.filter("_all", lambda m: m.endswith(f" {key}")))
    told = rows.select(*keys, F.col(at).alias("_at"), *[own(key).alias(key) for key in logs.PYTEST_COUNTERS])
    newest = lambda key: F.max_by(key, F.when(F.col(key).isNotNull(), F.col("_at")))
    number = lambda key: F.coalesce(F.substring_index(newest(key), " ", 1).try_cast("bigint"), F.lit(0).cast("bigint"))
    return logs.with_pytest_state(told.groupBy(*keys).agg(*[number(key).alias(key) for key in logs.PYTEST_COUNTERS]))


def pytest_session(lines: DataFrame, keys: Keys = ("path",), marker: str = "test session starts", at: str = "at") -> DataFrame:
    """The line rows from the first line that holds ``marker`` on, as a section of :func:`stdout_logs.pytest_sections`."""
    first = lines.groupBy(*keys).agg(F.min(F.when(F.contains(F.col("line"), F.lit(marker)), F.col(at))).alias("_first"))
    return lines.join(first, list(keys)).where(F.col(at) >= F.col("_first")).drop("_first")


# --- event logs -------------------------------------------------------------------


def _parsed(lines: DataFrame, keys: Keys, at: str, schema: str) -> DataFrame:
    filled = lines.where(strip(F.col("line")) != "")
    return compute_once(filled.withColumnRenamed(at, "pos"), [*keys, "pos"], reports.event_of(F.col("line"), schema), "_e")


def go_events(lines: DataFrame, keys: Keys = ("path",), at: str = "at") -> DataFrame:
    """Event rows for ``reports.go_tests_of``, ``go_packages_of`` and ``go_summary_of``."""
    return reports.go_event_rows(_parsed(lines, keys, at, schemas.GO_EVENT), keys)


_COUNTS = ("passed", "failed", "ignored")


def _rust_fold() -> Fold:
    """The last suite event, and the tests behind it."""
    number = lambda value: value.cast("bigint")
    none = F.lit(None).cast("struct<passed: bigint, failed: bigint, ignored: bigint>")
    zeros = {name: number(F.lit(0)).alias(name) for name in ("ok", "failed", "ignored", "tests", "bad")}

    def state(suite: Column, *values: Column) -> Column:
        return F.struct(suite.alias("suite"), *[number(v).alias(name) for v, name in zip(values, zeros)])

    def step(s: Column, e: Column) -> Column:
        one = lambda event: s[{"ok": "ok", "failed": "failed", "ignored": "ignored"}[event]] + F.when(e["kind"] == event, 1).otherwise(0)
        test = F.when(e["kind"].isin("ok", "failed", "ignored"), 1).otherwise(0)
        seen = state(s["suite"], one("ok"), one("failed"), one("ignored"), s["tests"] + test, s["bad"] + F.when(e["kind"] == "bad", 1).otherwise(0))
        begun = state(e["suite"], F.lit(0), F.lit(0), F.lit(0), s["tests"], s["bad"])
        return F.when(e["kind"] == "suite", begun).otherwise(seen)

    def join(a: Column, b: Column) -> Column:
        behind = lambda name: F.when(b["suite"].isNotNull(), b[name]).otherwise(a[name] + b[name])
        return state(F.coalesce(b["suite"], a["suite"]), behind("ok"), behind("failed"), behind("ignored"), a["tests"] + b["tests"], a["bad"] + b["bad"])

    return Fold(state(none, *[F.lit(0)] * len(zeros)), step, join)


def rust_summary(lines: DataFrame, keys: Keys = ("path",), at: str = "at") -> DataFrame:
    """:func:`reports.rust_summary` of line rows."""
    e = F.col("_e")
    suite = F.struct(*[F.coalesce(e[name], F.lit(0).cast("bigint")).alias(name) for name in _COUNTS])
    kind = (
        F.when(e["_corrupt_record"].isNotNull(), "bad")
        .when((e["type"] == "suite") & e["event"].isin("ok", "failed"), "suite")
        .when((e["type"] == "test") & e["event"].isin(list(reports.RUST_STATUS)), e["event"])
    )
    item = F.when(kind.isNotNull(), F.struct(kind.alias("kind"), F.when(kind == "suite", suite).alias("suite")))
    # a log without an event has a summary too, so blank lines stay
    parsed = compute_once(lines, [*keys, at], F.when(strip(F.col("line")) != "", reports.event_of(F.col("line"), schemas.RUST_EVENT)), "_e")
    state = F.col("state")
    own = lambda name: F.coalesce(state["suite"][name], F.lit(0).cast("bigint"))
    suite_total = own("passed") + own("failed") + own("ignored")
    folded = fold_in_order(parsed, keys, item, _rust_fold(), at)
    return folded.select(
        *keys,
        F.when(suite_total > 0, suite_total).otherwise(state["tests"]).alias("total"),
        (own("passed") + state["ok"]).alias("passed"),
        (own("failed") + state["failed"]).alias("failed"),
        (own("ignored") + state["ignored"]).alias("skipped"),
        F.lit(0).cast("bigint").alias("errors"),
        state["bad"].alias("bad_lines"),
    ).select(*keys, *reports.COUNTERS, reports.failed_first(F.col("failed"), F.col("total")).alias("status"), "bad_lines")


# --- diffs ------------------------------------------------------------------------


def diff_files(lines: DataFrame, keys: Keys = ("path",), strict: bool = False, at: str = "at") -> DataFrame:
    """:func:`patches.diff_files` of line rows: ``keys, position, file, diff``.

    A section may run across splits: the headers of a split are counted, the counts of the splits before it are
    added, and the lines of one section meet by its number.  Only one section is ever gathered in a cell.
    """
    line = F.col("line")
    split = [*keys, "_path", "_start"]
    rows = lines.select(*keys, F.col(at)["path"].alias("_path"), F.col(at)["start"].alias("_start"), F.col(at)["id"].alias("_id"), "line")
    header = line.startswith(patches.HEADER).cast("bigint")
    before = Window.partitionBy(*keys).orderBy("_path", "_start").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*split).agg(F.sum(header).alias("_n")).select(*split, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*split).orderBy("_id").rowsBetween(Window.unboundedPreceding, 0)
    numbered = rows.withColumn("_own", F.sum(header).over(inside)).join(counts, split)
    numbered = numbered.withColumn("_section", F.col("_own") + F.col("_before")).where("_section > 0")
    ordered = F.array_sort(F.collect_list(F.struct("_path", "_start", "_id", "line")))
    text = F.array_join(F.transform(ordered, lambda x: x["line"]), "\n")
    sections = numbered.groupBy(*keys, "_section").agg(text.alias("_diff"))
    named = compute_once(sections, [*keys, "_section", "_diff"], patches.header_key(F.col("_diff"), strict), "file").where(F.length("file") > 0)
    # of several sections of one file the last counts, at the place of the first
    newest = named.groupBy(*keys, "file").agg(F.min("_section").alias("_first"), F.max("_section").alias("_section"))
    # places are counted before the texts are joined: these move once, to their section
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_first")) - 1
    placed = newest.select(*keys, "_section", "file", place.alias("position"))
    return named.drop("file").join(placed, [*keys, "_section"]).select(*keys, "position", "file", F.col("_diff").alias("diff"))
