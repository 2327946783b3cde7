"""Column helpers for text cells.

The formats were defined by programs that use Python's text rules.  The helpers
here give the JVM functions the same meaning: ``\\n`` is the only line end,
``\\s`` and ``\\w`` are Unicode classes, ``strip`` trims Unicode white space.  Numbers
are read in ASCII digits.  All helpers work inside one row, so none causes a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# The characters Python treats as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The characters that end a line for ``str.splitlines``.
LINE_ENDS = r"\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029"

# Regex fragments; patterns that use them start with FLAGS.
FLAGS = "(?Ud)"
SPACE = r"[\s\x1c-\x1f]"
WORD = r"\p{L}\p{N}_"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Use a value several times, or inside a lambda, while it is computed once.

    A column that is written twice is evaluated twice in an interpreted expression,
    and once per element inside a lambda.  A lambda variable is only read.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def lines(col: Column) -> Column:
    """The lines of a text, split at ``\\n`` only; empty lines are kept."""
    return F.split(col, "\n", -1)


def with_next(array: Column) -> Column:
    """``[{line, next}]``: every line beside the line after it (NULL at the end)."""
    following = F.slice(array, F.lit(2), F.greatest(F.size(array) - 1, F.lit(0)))
    return F.zip_with(array, following, lambda a, b: F.struct(a.alias("line"), b.alias("next")))


def first_group(col: Column, pattern: str, group: int = 1) -> Column:
    """The first match of a pattern, NULL when there is none."""
    found = F.regexp_extract(col, pattern, group)
    return F.when(found != "", found)


def all_matches(col: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(col, F.lit(pattern), F.lit(group))


def last(array: Column) -> Column:
    return F.try_element_at(array, F.lit(-1))


def first_int(col: Column, pattern: str) -> Column:
    """The first match as a number, 0 when there is none."""
    return F.coalesce(F.regexp_extract(col, pattern, 1).try_cast("bigint"), F.lit(0).cast("bigint"))


def from_line_with(col: Column, marker: str) -> Column:
    """The text from the first line that holds ``marker`` to the end, else ''."""
    at = F.instr(col, marker)
    before = F.substring(col, F.lit(1), at - 1)
    line_start = F.length(before) - F.length(F.substring_index(before, "\n", -1))
    return F.when(at > 0, F.substring(col, line_start + 1, F.length(col))).otherwise("")


def after(col: Column, marker: str) -> Column:
    """The rest of a line behind the first ``marker`` in it."""
    return F.substring(col, F.instr(col, marker) + len(marker), F.length(col))


def count_where(array: Column, test) -> Column:
    return F.size(F.filter(array, test)).cast("bigint")


def explode_rows(df: DataFrame, keys: Sequence[str], array: Column, pos: str = "pos", value: str = "_v") -> DataFrame:
    """One row per array element: ``keys, pos, value``.

    An inner explode makes the optimizer add a filter on the array below it, which
    parses or splits every text a second time.  The outer form has no such filter.
    """
    rows = df.select(*keys, F.posexplode_outer(array).alias(pos, value))
    return rows.where(F.col(pos).isNotNull())


def compute_once(df: DataFrame, keys: Sequence[str], value: Column, name: str) -> DataFrame:
    """``keys`` and one computed column that later steps read but never recompute.

    A filter on a plain projected column is pushed below the projection together with
    a copy of the expression; a parse would then run once per use.  Filters do not
    pass a generator, so the value goes through an array of one.
    """
    return df.select(*keys, F.explode_outer(F.array(value)).alias(name))
