"""Diff texts: per-file diffs, test and solution patches, code repair.

A diff is one text cell, so everything here works inside the row: splitting a diff
into files costs no shuffle however large the table is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import (
    FLAGS, LINE_ENDS, SPACE, WHITESPACE, compute_once, explode_rows, first_group, let, lines,
    strip,
)

# What makes a path a test path.
TEST_PATH = r"(tests?/|test_.*\.py$|.*_test\.py$)"
TEST_HEADER_PARTS = ("test/", "tests/", "_test.py", "test_")
HEADER = "diff --git"


def _sections(diff: Column, boundary: str) -> Column:
    """The diff cut before every header line; text before the first header is dropped."""
    return F.filter(F.split(diff, boundary, -1), lambda part: part.startswith(HEADER))


def header_key(part: Column, strict: bool = False) -> Column:
    """The file of a section: the old path in its header line."""
    words = F.split(strip(F.substring_index(part, "\n", 1)), f"{FLAGS}{SPACE}+", -1)
    old_path = let(words, lambda w: F.when(F.size(w) >= 4, F.get(w, F.lit(2))))
    if strict:
        return F.regexp_replace(old_path, "^a/", "")
    return F.ltrim(old_path, F.lit("a/"))


def file_diffs(diff: Column, strict: bool = False) -> Column:
    """``[{key, seq, diff}]`` in order of first appearance.

    The key is the old path of the header without its leading ``a`` and ``/``
    characters, however many there are (``strict``: without the prefix ``a/``).  A
    header with fewer than four words opens no file and its lines are dropped.  Of
    several diffs with one key the last one counts, at the place of the first.
    """
    def section(part: Column, at: Column, total: Column) -> Column:
        # the line end before the next header separates, it is not part of the diff
        closed = (at < total - 1) & part.endswith("\n")
        text = F.when(closed, F.substring(part, F.lit(1), F.length(part) - 1)).otherwise(part)
        return F.struct(
            F.when(part.startswith(HEADER), header_key(part, strict)).alias("key"),
            at.cast("int").alias("seq"),
            text.alias("diff"),
        )

    parts = F.split(diff, r"(?=diff --git)(?<=\n)", -1)
    sections = let(
        parts, lambda p: let(F.size(p), lambda n: F.transform(p, lambda x, i: section(x, i, n)))
    )
    return F.filter(sections, lambda s: F.length(s["key"]) > 0)


def unique_file_diffs(found: Column) -> Column:
    """Apply the last-diff-at-first-place rule to ``file_diffs``."""
    def newest(keys: Column) -> Column:
        return let(
            F.reverse(found),
            lambda back: let(
                F.reverse(keys),
                lambda names: F.transform(
                    F.array_distinct(keys),
                    lambda k: F.element_at(back, F.array_position(names, k).cast("int")),
                ),
            ),
        )

    unique = lambda keys: F.size(F.array_distinct(keys)) == F.size(keys)
    keys = F.transform(found, lambda s: s["key"])
    return let(keys, lambda k: F.when(unique(k), found).otherwise(newest(k)))


def _with_file_diffs(df: DataFrame, diff: str, strict: bool) -> DataFrame:
    found = compute_once(df, df.columns, file_diffs(F.col(diff), strict), "_found")
    return found.withColumn("_files", unique_file_diffs(F.col("_found"))).drop("_found")


def diff_files(df: DataFrame, diff: str = "full_patch", strict: bool = False) -> DataFrame:
    """One row per file of every diff: ``position, file, diff``."""
    kept = [c for c in df.columns if c != diff]
    rows = explode_rows(_with_file_diffs(df, diff, strict), kept, F.col("_files"), "position", "_f")
    return rows.select(*kept, "position", F.col("_f.key").alias("file"), F.col("_f.diff").alias("diff"))


def split_test_patch(
    df: DataFrame, diff: str = "full_patch", pattern: str = TEST_PATH, strict: bool = False
) -> DataFrame:
    """Add ``test_patch`` and ``patch``: files whose path matches the pattern, and the rest."""
    is_test = lambda f: f["key"].rlike(f"{FLAGS}{pattern}")
    text = lambda files: F.array_join(F.transform(files, lambda f: f["diff"]), "\n")
    files = F.col("_files")
    return (
        _with_file_diffs(df, diff, strict)
        .withColumn("test_patch", text(F.filter(files, is_test)))
        .withColumn("patch", text(F.filter(files, lambda f: ~is_test(f))))
        .drop("_files")
    )


def gold_test_patch(df: DataFrame, diff: str = "full_patch") -> DataFrame:
    """Add ``test_patch`` and ``gold_patch`` by a look at the whole header line.

    Unlike ``split_test_patch`` any line end counts, line ends are kept, and two
    diffs of one file are both kept.
    """
    sections = _sections(F.col(diff), f"(?={HEADER})(?<=[{LINE_ENDS}])")

    def is_test(part: Column) -> Column:
        header = F.regexp_extract(part, f"^[^{LINE_ENDS}]*", 0)
        found = F.lit(False)
        for piece in TEST_HEADER_PARTS:
            found = found | F.contains(header, F.lit(piece))
        return found

    parts = F.col("_parts")
    return (
        compute_once(df, df.columns, sections, "_parts")
        .withColumn("test_patch", F.array_join(F.filter(parts, is_test), ""))
        .withColumn("gold_patch", F.array_join(F.filter(parts, lambda p: ~is_test(p)), ""))
        .drop("_parts")
    )


def patch_dict(df: DataFrame, diff: str = "full_patch") -> DataFrame:
    """The three texts of a task: ``full_path`` (the whole diff), ``test_patch``, ``gold_patch``."""
    kept = [c for c in df.columns if c != diff]
    return gold_test_patch(df, diff).select(*kept, F.col(diff).alias("full_path"), "test_patch", "gold_patch")


def patch_applicability(patch: Column) -> Column:
    """Why a patch would be skipped, or ``apply``."""
    return (
        F.when(patch.isNull() | (strip(patch) == ""), "empty")
        .when(~patch.startswith(HEADER), "not_a_diff")
        .otherwise("apply")
    )


def touched_files(diff: Column) -> Column:
    return F.regexp_count(diff, F.lit("diff --git ")).cast("bigint")


def capped_diff(diff: Column, max_files: int | None = None) -> Column:
    """The diff with a line end at its end; NULL when it touches more than ``max_files``."""
    ended = F.when((diff != "") & ~diff.endswith("\n"), F.concat(diff, F.lit("\n"))).otherwise(diff)
    return ended if max_files is None else F.when(touched_files(diff) <= max_files, ended)


def splice_candidate(
    df: DataFrame,
    content: str = "content",
    left: str = "left_context",
    candidate: str = "gt",
    right: str = "right_context",
    dialect: str = "python",
) -> DataFrame:
    """Put a candidate between its contexts: ``is_valid`` and ``spliced``.

    Both contexts must occur in the file.  The ``java`` dialect adds line breaks
    only where none is there yet.
    """
    before, code = F.col(left), F.col(candidate)
    behind = F.rtrim(F.col(right), F.lit("\n"))
    valid = F.contains(F.col(content), before) & F.contains(F.col(content), behind)
    newline = F.lit("\n")
    if dialect == "java":
        opened = F.when(
            ~before.endswith("\n") & ~code.startswith("\n"), F.concat(newline, code)
        ).otherwise(code)
        closed = F.when(
            ~opened.endswith("\n") & ~behind.startswith("\n"), F.concat(opened, newline)
        ).otherwise(opened)
        text = F.concat(before, closed, behind)
    else:
        text = F.concat(before, newline, code, newline, behind)
    return df.withColumn("is_valid", valid).withColumn("spliced", F.when(F.col("is_valid"), text))


# --- repair of generated Java tests -----------------------------------------------


def repair_start(code: Column) -> Column:
    """Restore a truncated ``package`` at the start and drop a leading code marker."""
    return (
        F.when(code.isNull(), "")
        .when(code.startswith("ckage"), F.concat(F.lit("pa"), code))
        .when(code.startswith("age"), F.concat(F.lit("pack"), code))
        .when(code.startswith("ackage"), F.concat(F.lit("p"), code))
        .when(code.startswith("<|code|>"), F.substring(code, F.lit(9), F.length(code)))
        .otherwise(code)
    )


def repair_package(test: Column, source: Column) -> Column:
    """Give the test the package line of its source."""
    def with_line(package: Column) -> Column:
        is_package = lambda row: row.startswith("package ")
        replaced = F.transform(lines(test), lambda row: F.when(is_package(row), package).otherwise(row))
        return (
            F.when(package.isNull(), test)
            .when(F.exists(lines(test), is_package), F.array_join(replaced, "\n"))
            .otherwise(F.concat(package, F.lit("\n"), test))
        )

    return let(first_group(source, r"(?md)^package .*", 0), with_line)


def _import_lines(code: Column) -> Column:
    return F.filter(lines(code), lambda row: row.startswith("import "))


def _import_name(row: Column) -> Column:
    bare = F.replace(F.replace(row, F.lit("import "), F.lit("")), F.lit("static "), F.lit(""))
    return F.rtrim(bare, F.lit(";"))


def repair_imports(test: Column, source: Column) -> Column:
    """Insert the imports of the source that the test lacks, below its package line.

    Of several source lines that import one name the last text is used, at the
    place of the first.
    """
    have = F.transform(_import_lines(test), _import_name)
    text_of = lambda back, names, name: F.element_at(back, F.array_position(names, name).cast("int"))
    new = let(
        F.reverse(_import_lines(source)),
        lambda back: let(
            F.transform(back, _import_name),
            lambda names: F.transform(
                F.array_except(F.reverse(names), have), lambda name: text_of(back, names, name)
            ),
        ),
    )

    def insert(rows: Column) -> Column:
        flags = F.transform(rows, lambda row: row.startswith("package "))
        place = F.array_position(flags, F.lit(True)).cast("int")
        return let(
            place,
            lambda at: F.concat(F.slice(rows, F.lit(1), at), new, F.slice(rows, at + 1, F.size(rows))),
        )

    return F.array_join(let(lines(test), insert), "\n")


def java_test_repair(df: DataFrame, test: str = "test_code", source: str = "source_code") -> DataFrame:
    """Add ``repaired``: start, package line and imports put right, in this order."""
    code = F.col(source)
    return (
        df.withColumn("_start", repair_start(F.col(test)))
        .withColumn("_package", repair_package(F.col("_start"), code))
        .withColumn("repaired", repair_imports(F.col("_package"), code))
        .drop("_start", "_package")
    )


# --- model answers ----------------------------------------------------------------


def fenced_code(text: Column, language: str = "java") -> Column:
    """The code of an answer: first tagged fence, else first closed fence, else all of it."""
    tag = f"```{language}"
    tagged = F.substring(text, F.instr(text, tag) + len(tag), F.length(text))
    # a second tagged fence ends the first one just as a plain fence does
    tagged = F.substring_index(tagged, "```", 1)
    parts = F.split(text, "```", -1)
    generic = F.when(F.size(parts) >= 3, F.get(parts, F.lit(1))).otherwise(text)
    found = (
        F.when(F.contains(text, F.lit(tag)), tagged)
        .when(F.contains(text, F.lit("```")), generic)
        .otherwise(text)
    )
    return strip(found)


def stub_indent(code: Column) -> Column:
    """White space in front of the first line that is not blank."""
    filled = F.get(F.filter(lines(code), lambda row: strip(row) != ""), F.lit(0))
    width = let(filled, lambda row: F.length(row) - F.length(F.ltrim(row, F.lit(WHITESPACE))))
    return F.coalesce(width, F.lit(0))


def stub_codes(df: DataFrame, code: str = "gt") -> DataFrame:
    """Add ``return_pass`` and ``return_empty_str``: stubs at the indentation of the code."""
    indent = F.repeat(F.lit(" "), stub_indent(F.col(code)))
    return df.withColumn("return_pass", F.concat(indent, F.lit("pass"))).withColumn(
        "return_empty_str", F.concat(indent, F.lit('return ""'))
    )
