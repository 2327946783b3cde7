"""Mapping line coverage onto code definitions.

Tables of several runs or repositories share paths and test names.  ``keys`` names the
columns that tell the runs apart; it goes through all operators here.  Without it the
tables hold one run.
"""

from __future__ import annotations

import ast
import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import schemas
from ..functions.text import compute_once

# Lines per leaf of the tree that the range join uses.
BLOCK = 128
# A node of the tree has ``2 ** BITS`` branches.
BITS = 2

Keys = Sequence[str]


def _definitions(fn: str, source: str) -> tuple[list[tuple], str | None]:
    """Functions and classes of one Python file, outer before inner, or why there are none."""
    try:
        tree = ast.parse(source)
    except (SyntaxError, ValueError):
        return [], "syntax"
    except (RecursionError, MemoryError):
        return [], "too_deep"
    rows = source.split("\n")
    found: list[tuple] = []
    waiting: list[ast.AST] = [tree]
    while waiting:
        node = waiting.pop()
        inner = [n for n in node.body if isinstance(n, (ast.FunctionDef, ast.ClassDef))]
        waiting.extend(reversed(inner))
        if node is tree:
            continue
        kind = "function" if isinstance(node, ast.FunctionDef) else "class"
        head = node.body[0]
        if isinstance(head, ast.Expr) and isinstance(head.value, ast.Constant):
            left, doc = head.end_lineno, ast.unparse(head)
        else:
            decorators = getattr(head, "decorator_list", [])
            left = min([head.lineno - 1] + [d.lineno for d in decorators[:1]])
            doc = None
        right = node.end_lineno
        intent = f"{node.name}[{kind}]"
        code = "\n".join(rows[left:right]) + "\n"
        found.append(
            (fn, intent, kind, node.name, left, right, code, doc, f"{fn}:{intent}", len(found))
        )
    return found, None


def parse_definitions(
    files: DataFrame, path: str = "path", source: str = "source", keys: Keys = (), errors: bool = False
) -> DataFrame:
    """Functions and classes of Python files; a file that cannot be parsed has none.

    With ``errors`` such a file has one row with its ``parse_error`` instead: ``syntax``,
    or ``too_deep`` for nesting that the parser does not follow.  The one operator that
    needs Python: files are parsed independently, batch by batch, so the work spreads
    over the input partitions; Spark cuts a batch at 64 MB of text (``spark.sql.execution.arrow.maxBytesPerBatch``).  The text around a definition is left to
    ``definition_contexts``.
    """
    names = [field.split()[0] for field in schemas.DEFINITIONS.replace("\n", " ").split(",")]
    none = (None,) * (len(names) - 2)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: list[tuple] = []
        for batch in batches:
            for row in batch.itertuples(index=False):
                rows, error = _definitions(row.path, row.source)
                rows = [(*x, None) for x in rows] or [(row.path, *none, None, error)] * (error is not None)
                found += [(*row[:-2], *x) for x in rows]
                if len(found) >= 5000:
                    yield pd.DataFrame(found, columns=columns)
                    found = []
        if found:
            yield pd.DataFrame(found, columns=columns)

    columns = [*(f"_k{i}" for i in range(len(keys))), *names, "parse_error"]
    own = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    wanted = files.select(*own, F.col(path).alias("path"), F.col(source).alias("source"))
    kinds = [f"_k{i} {wanted.schema[i].dataType.simpleString()}" for i in range(len(keys))]
    schema = ", ".join([*kinds, schemas.DEFINITIONS, "parse_error STRING"])
    out = wanted.where(F.col("source").isNotNull()).mapInPandas(parse, schema).toDF(*keys, *names, "parse_error")
    return out if errors else out.where("parse_error IS NULL").drop("parse_error")


def source_hash(source: Column) -> Column:
    return F.sha2(source, 256)


def parse_distinct(
    files: DataFrame, path: str = "path", source: str = "source", keys: Keys = (), errors: bool = False, cache: str | None = None,
    folder: str | None = None,
) -> DataFrame:
    """:func:`parse_definitions` in which equal sources are parsed once, whatever files and runs they are in.

    Snapshots of a repository share most files.  A source is known by its hash; definitions of a hash are joined back to
    all files that have it and named after them.  With ``cache`` the parsed hashes stay in that folder, and later
    calls parse only what is new.  With ``folder`` the files are written there with their hashes: two parts of the
    plan read them, and a source that is computed may cost more than its parse.
    """
    # a filter on a computed source would be pushed down with a copy of what computes it
    files = compute_once(files, [*keys, F.col(path).alias("_path")], F.col(source), "_source").where("_source IS NOT NULL")
    files = files.withColumn("_hash", source_hash(F.col("_source")))
    if folder is not None:
        files.write.mode("overwrite").parquet(folder)
        files = files.sparkSession.read.schema(files.schema).parquet(folder)
    texts = files.select("_hash", "_source")
    texts = texts.groupBy("_hash").agg(F.first("_source").alias("_source"))
    if cache is None:
        found = parse_definitions(texts, "_hash", "_source", errors=True)
    else:
        found = _cached(texts, cache)
    places = files.select(*keys, "_path", "_hash")
    joined = places.join(found.withColumnRenamed("fn", "_hash"), "_hash")
    names = [c for c in found.columns if c not in ("fn", "source")]
    named = F.concat_ws(":", "_path", F.substring(F.col("source"), F.lit(66), F.length("source")))
    out = joined.select(*keys, F.col("_path").alias("fn"), *names, F.when(F.col("source").isNotNull(), named).alias("source"))
    out = out.select(*keys, *found.columns)
    return out if errors else out.where("parse_error IS NULL").drop("parse_error")


def _cached(texts: DataFrame, cache: str) -> DataFrame:
    """The definitions of all hashes in the cache, after those of new texts have been added.

    A call adds one folder of definitions and, behind it, one of the hashes they belong to, so hashes whose
    definitions were not written completely are parsed again.
    """
    spark, name = texts.sparkSession, uuid.uuid4().hex
    definitions = ", ".join([schemas.DEFINITIONS, "parse_error STRING", "call STRING"])
    read = lambda part, ddl: spark.read.schema(ddl).parquet(f"{cache}/{part}")
    try:
        known = read("hashes", "_hash STRING, call STRING").select("_hash")
        new = texts.join(known, "_hash", "left_anti")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        new = texts
    # the list of hashes is written from the same rows that were parsed
    fresh = f"{cache}/texts/call={name}"
    new.write.mode("overwrite").parquet(fresh)
    rows = spark.read.schema("_hash STRING, _source STRING").parquet(fresh)
    parse_definitions(rows, "_hash", "_source", errors=True).write.mode("overwrite").parquet(f"{cache}/definitions/call={name}")
    rows.select("_hash").write.mode("overwrite").parquet(f"{cache}/hashes/call={name}")
    done = read("hashes", "_hash STRING, call STRING").select("call").distinct()
    return read("definitions", definitions).join(done, "call", "left_semi").drop("call")


def definition_contexts(
    definitions: DataFrame, files: DataFrame, path: str = "path", source: str = "source", keys: Keys = ()
) -> DataFrame:
    """Add ``left_context`` and ``right_context``: the lines before and after a definition.

    Every row then holds the text of its whole file, so this comes last, after
    definitions have been filtered.  The text travels as one cell and is split behind the join.
    """
    rows = files.select(*keys, F.col(path).alias("fn"), F.col(source).alias("_source"))
    text = lambda part: F.concat(F.array_join(part, "\n"), F.lit("\n"))
    before = F.slice("_rows", F.lit(1), F.col("l"))
    after = F.slice("_rows", F.col("r") + 1, F.size("_rows"))
    return (
        definitions.join(rows, [*keys, "fn"])
        .withColumn("_rows", F.split("_source", "\n", -1))
        .withColumn("left_context", text(before))
        .withColumn("right_context", text(after))
        .drop("_rows", "_source")
    )


def rebase_path(path: Column, prefix: str, target: str = "/run_dir/") -> Column:
    """``<prefix><run>/rest`` to ``<target>rest``; other paths stay as they are."""
    rest = F.substring(path, F.lit(len(prefix) + 1), F.length(path))
    below = F.substring(rest, F.instr(rest, "/") + 1, F.length(rest))
    return F.when(path.startswith(prefix), F.concat(F.lit(target), below)).otherwise(path)


def latest_definitions(definitions: DataFrame, keys: Keys = ()) -> DataFrame:
    """Of several definitions with one interval in a file, the last (an aggregate)."""
    spot = [*keys, "fn", "l", "r"]
    rest = [c for c in definitions.columns if c not in spot]
    if rest == ["seq"]:
        return definitions.groupBy(*spot).agg(F.max("seq").alias("seq"))
    row = F.struct(*rest)
    return definitions.groupBy(*spot).agg(F.max_by(row, "seq").alias("_d")).select(*spot, "_d.*")


def duplicate_sources(definitions: DataFrame, keys: Keys = ()) -> DataFrame:
    """Sources that name more than one definition of a run; none in a valid table."""
    return definitions.groupBy(*keys, "source").agg(F.count("*").alias("n")).where(F.col("n") > 1)


def effective_intervals(definitions: DataFrame, keys: Keys = ()) -> DataFrame:
    """Add ``r_eff``: the last line for which a definition is found by the line lookup.

    The lookup walks back from the line and stops at the first interval that does
    not contain it.  Interval i is therefore found for line x just when
    ``l_i <= x`` and no interval from i on ends before x, that is when
    ``x <= min(r_j for j >= i)``: a suffix minimum in ``(l, r)`` order.  It is taken
    in two levels, within blocks of lines and then over the blocks, so that a file
    of any size spreads over tasks.
    """
    file = [*keys, "fn"]
    keys = [*file, "_block"]
    rows = definitions.withColumn("_block", F.floor(F.col("l") / 1024).cast("int"))
    behind = Window.partitionBy(*keys).orderBy(F.col("l").desc(), F.col("r").desc())
    later = Window.partitionBy(*file).orderBy(F.col("_block").desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    blocks = rows.groupBy(*keys).agg(F.min("r").alias("_r")).withColumn("_later", F.min("_r").over(later))
    within = rows.withColumn(
        "_within", F.min("r").over(behind.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    joined = within.join(blocks.select(*keys, "_later"), keys)
    return joined.withColumn("r_eff", F.least("_within", "_later")).drop("_block", "_within", "_later")


def _shifted(value: Column, bits: Column) -> Column:
    return F.call_function("shiftright", value, bits)


def _level(blocks: Column) -> Column:
    """The largest k with ``4**k <= blocks``."""
    return F.floor((F.length(F.bin(blocks)) - 1) / BITS).cast("int")


def tree_nodes(first: Column, last: Column) -> Column:
    """The nodes ``(k, i)`` that make up the blocks ``first`` to ``last`` (from 1): node ``(k, i)`` has ``4**k`` blocks from ``i * 4**k`` on.

    A node is taken if it lies within and its parent does not: at most six of each size, three at each end.
    """
    size = lambda k: F.call_function("shiftleft", F.lit(1).cast("bigint"), k * BITS)
    start = lambda k: _shifted(first + size(k) - 1, k * BITS)
    end = lambda k: _shifted(last + 1, k * BITS) - 1
    outer = (1 << BITS) - 1

    def at(k: Column) -> Column:
        a, c, above_a, above_c = start(k), end(k), start(k + 1), end(k + 1)
        parent_out = lambda i: ~_shifted(i, F.lit(BITS)).between(above_a, above_c)
        ends = F.concat(F.sequence(a, F.least(a + outer - 1, c)), F.sequence(F.greatest(c - outer + 1, a), c))
        inside = F.when(a <= c, F.filter(F.array_distinct(ends), parent_out)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(inside, lambda i: F.struct(k.alias("k"), i.alias("i")))

    nodes = F.flatten(F.transform(F.sequence(F.lit(0), _level(last - first + 1)), at))
    # most definitions lie in one block
    return F.when(first == last, F.array(F.struct(F.lit(0).alias("k"), first.alias("i")))).otherwise(nodes)


def line_intervals(
    lines: DataFrame, definitions: DataFrame, strict: bool = False, block: int = BLOCK,
    unique: bool = False, keys: Keys = (),
) -> DataFrame:
    """Lines joined with the definitions found for them (``lines`` holds ``fn, line``).

    A range join turned into an equi join.  Blocks of lines are the leaves of a tree with four branches per node: an
    interval is split into the largest nodes that make up its blocks, at most six per level, and a line meets the nodes
    above its block.  Nodes of intervals start at block 1 or later, so none is larger than its start, and a line has
    ``log4(block) + 1`` of them, one to three in files of usual length.
    Exactly one of them belongs to an interval that has the block, so a pair is found once; only lines of
    the two outer blocks may still lie outside.  ``strict`` takes every interval that contains the line.  ``unique``, here and below:
    ``definitions`` comes from ``latest_definitions``.
    """
    intervals = definitions if unique else latest_definitions(definitions, keys)
    end = "r" if strict else "r_eff"
    if not strict:
        intervals = effective_intervals(intervals, keys)
    file = [*keys, "fn"]
    # numbered from 1, lines before the first included
    block_of = lambda line: F.greatest(F.floor(line / block).cast("bigint"), F.lit(0)) + 1
    spread = intervals.where(F.col(end) >= F.greatest("l", F.lit(0)))
    spread = spread.withColumn("_node", F.explode(tree_nodes(block_of(F.col("l")), block_of(F.col(end)))))
    spread = spread.withColumns({"_k": F.col("_node.k"), "_i": F.col("_node.i")}).drop("_node")
    met = lines.withColumn("_k", F.explode(F.sequence(F.lit(0), _level(block_of(F.col("line"))))))
    left = met.withColumn("_i", _shifted(block_of(F.col("line")), F.col("_k") * BITS)).alias("a")
    right = spread.alias("d")
    match = F.lit(True)
    for name in (*file, "_k", "_i"):
        match = match & (F.col(f"a.{name}") == F.col(f"d.{name}"))
    inside = F.col("a.line").between(F.col("d.l"), F.col(f"d.{end}"))
    chosen = [c for c in right.columns if c not in (*file, "_k", "_i", "r_eff")]
    return left.join(right, match & inside).select(
        *[F.col(f"a.{c}") for c in lines.columns], *[F.col(f"d.{c}") for c in chosen]
    )


def definition_tests(
    contexts: DataFrame, definitions: DataFrame, strict: bool = False, unique: bool = False, keys: Keys = ()
) -> DataFrame:
    """``(keys, fn, l, r, test)``: the tests that run through a definition, each once.

    ``contexts`` holds ``fn, line, context``.  Empty contexts are dropped and
    parameters (from ``[`` on) cut off before rows are made distinct, so that only
    distinct ``(file, line, test)`` rows reach the range join.
    """
    test = F.substring_index("context", "[", 1)
    rows = contexts.where(F.col("context") != "").select(*keys, "fn", "line", test.alias("test")).distinct()
    spans = definitions.select(*keys, "fn", "l", "r", "seq")
    found = line_intervals(rows, spans, strict, unique=unique, keys=keys)
    return found.select(*keys, "fn", "l", "r", "test").distinct()


def duplicate_outcomes(outcomes: DataFrame, keys: Keys = ()) -> DataFrame:
    """``(keys, nodeid, n)``: tests that the report of a run lists more than once."""
    return outcomes.groupBy(*keys, "nodeid").agg(F.count("*").alias("n")).where(F.col("n") > 1)


def definition_outcomes(tests: DataFrame, outcomes: DataFrame, keys: Keys = ()) -> DataFrame:
    """``(keys, fn, l, r, list, nodeid)``: covering tests that passed or failed in the report of their run.

    The run name (from ``|`` on) is cut off the test before the lookup.  A test that the
    report lists twice has no outcome; ``duplicate_outcomes`` names such tests.
    """
    node = [*keys, "nodeid"]
    known = outcomes.groupBy(*node).agg(F.max("outcome").alias("outcome"), F.count("*").alias("_n"))
    known = known.where(F.col("_n") == 1).drop("_n")
    named = tests.withColumn("nodeid", F.substring_index("test", "|", 1))
    list_name = F.when(F.col("outcome") == "passed", "PASS_TO_PASS").otherwise("FAIL_TO_PASS")
    return named.join(known, node).select(*keys, "fn", "l", "r", list_name.alias("list"), "nodeid")


def coverage_rate(
    covered: DataFrame, definitions: DataFrame, unique: bool = False, keys: Keys = ()
) -> DataFrame:
    """Percentage of the lines of a definition that were run, to two decimals.

    ``covered`` holds ``fn, line``; lines are made distinct before the range join.
    """
    spot = [*keys, "fn", "l", "r"]
    intervals = definitions if unique else latest_definitions(definitions, keys)
    lines = covered.select(*keys, "fn", "line").distinct()
    found = line_intervals(lines, definitions.select(*spot, "seq"), strict=True, unique=unique, keys=keys)
    counts = found.groupBy(*spot).agg(F.count("*").alias("n_covered"))
    n = F.coalesce("n_covered", F.lit(0)).cast("double")
    rate = F.bround(F.lit(100.0) * n / (F.col("r") - F.col("l") + 1), 2)
    return intervals.join(counts, spot, "left").withColumn("coverage_rate", rate).withColumn(
        "n_covered", n.cast("bigint")
    )


def good_candidates(problems: DataFrame, keys: Keys = ()) -> DataFrame:
    """Functions with a docstring and a covering test that passes, and all definitions, per run.

    ``problems`` holds ``n_pass_to_pass, doc, intent_type``.
    """
    good = (
        (F.col("n_pass_to_pass") > 0) & F.col("doc").isNotNull() & (F.col("intent_type") == "function")
    )
    rows = problems.groupBy(*keys) if keys else problems
    return rows.agg(F.count_if(good).alias("n_good"), F.count("*").alias("n_all"))


def problem_table(
    definitions: DataFrame, tests: DataFrame, outcomes: DataFrame, unique: bool = False, keys: Keys = ()
) -> DataFrame:
    """Every definition with the number of its covering, passing and failing tests."""
    spot = [*keys, "fn", "l", "r"]
    n_tests = tests.groupBy(*spot).agg(F.count("*").alias("n_tests"))
    listed = definition_outcomes(tests, outcomes, keys).groupBy(*spot).agg(
        F.count_if(F.col("list") == "PASS_TO_PASS").alias("n_pass_to_pass"),
        F.count_if(F.col("list") == "FAIL_TO_PASS").alias("n_fail_to_pass"),
    )
    counters = ["n_tests", "n_pass_to_pass", "n_fail_to_pass"]
    rows = definitions if unique else latest_definitions(definitions, keys)
    rows = rows.join(n_tests, spot, "left").join(listed, spot, "left")
    return rows.na.fill(0, counters)
