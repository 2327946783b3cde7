"""Quality rules: a table of thresholds compiled into one projection.

Every figure comes from built-in column functions on the text of the row: no user function,
no exchange.  Windows of five words are compared inside the row, by sorting only where the
row has equal windows at all.

Defined cases: a null or empty text has no word and fails; a text of any length is read whole;
rows are judged one by one, so repeated rows, ties, null keys and extra columns change nothing.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import let

SPACES = "\t\n\x0b\x0c\r"
WORD_CHAR = r"[^\x20\x09-\x0D]"
WINDOW = 5

# Frequent function words of the languages the corpus is made of.
STOP_WORDS = (
    "the be to of and that have with a in is it for on are as at this was by from or an not "
    "der die das und ist zu den im ein eine nicht mit auf als von des sich für dem auch es "
    "le la les et de des un une est pour que dans qui sur par au du en pas il "
    "el los las que y una del se por con para su al lo como más pero no mi"
).split()


class Rule(NamedTuple):
    """``low <= 100 * count / per <= high``, multiplied out: no division by 0.

    Up to 20 words need no stop word: the rule on them reads one in every hundred words beyond.
    """

    name: str
    count: str
    per: str
    low: int | None
    high: int | None


# The two base rules come first; the others make up the verdict of the method.
BASE_RULES = (
    Rule("length", "100 * n_words", "100", 1000, None),
    Rule("repeated_windows", "n_repeat_words", "n_words", None, 20),
)
RULES = (
    Rule("word_length", "word_chars", "n_words", 200, 3000),
    Rule("symbols", "n_symbols", "n_words", None, 10),
    Rule("exclamations", "n_exclamations", "n_words", None, 30),
    Rule("stop_words", "n_stop_words", "(n_words - 20)", 1, None),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 50),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 30),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", None, 90),
)


def failed(rules: tuple[Rule, ...]) -> str:
    """A table of rules as one SQL condition, true where a rule is broken."""
    broken = []
    for rule in rules:
        if rule.low is not None:
            broken.append(f"100 * {rule.count} < {rule.low} * {rule.per}")
        if rule.high is not None:
            broken.append(f"100 * {rule.count} > {rule.high} * {rule.per}")
    return " OR ".join(f"({x})" for x in broken)


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window of five found twice or more in the text."""

    def covered(ordered: Column) -> Column:
        twice = F.filter(ordered, lambda x, j: (F.get(ordered, j - 1)["w"] == x["w"]) | (F.get(ordered, j + 1)["w"] == x["w"]))
        starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
        state = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total"))
        return F.aggregate(
            starts,
            state,
            lambda a, p: F.struct(p.alias("last"), (a["total"] + F.least(F.lit(WINDOW), p - a["last"])).alias("total")),
            lambda a: a["total"],
        )

    def of_windows(windows: Column) -> Column:
        ordered = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(ordered, covered))

    starts = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))
    windows = F.transform(starts, lambda i: F.array_join(F.slice(words, i, F.lit(WINDOW)), " "))
    return F.when(F.size(words) > WINDOW, let(windows, of_windows)).otherwise(F.lit(0))


def metrics(text: Column) -> Column:
    """All counts of a text as one struct."""
    text = F.coalesce(text, F.lit(""))
    plain = text
    for space in SPACES:
        plain = F.replace(plain, F.lit(space), F.lit(" "))
    words = F.array_remove(F.split(plain, " ", -1), "")
    live = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD_CHAR))

    def of_words(w: Column) -> list[Column]:
        return [
            F.size(w).alias("n_words"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).alias("n_stop_words"),
            _repeat_words(w).alias("n_repeat_words"),
        ]

    def of_lines(x: Column) -> list[Column]:
        return [
            F.size(x).alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
            F.size(F.filter(x, lambda a: a.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))).alias("n_ellipsis_lines"),
            F.size(F.filter(x, lambda a: a.rlike(r"^[\x20\x09-\x0D]*[-*•]"))).alias("n_bullet_lines"),
        ]

    def of_text(t: Column) -> list[Column]:
        return [
            F.length(F.replace(plain, F.lit(" "), F.lit(""))).alias("word_chars"),
            F.regexp_count(t, F.lit("[#*$%&|<>]")).alias("n_symbols"),
            F.regexp_count(t, F.lit("!")).alias("n_exclamations"),
        ]

    return let(words, lambda w: let(live, lambda x: F.struct(*of_words(w), *of_lines(x), *of_text(text))))


FIGURES = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_stop_words n_lines n_ellipsis_lines "
    "n_bullet_lines n_exclamations"
).split()


def judge(df: DataFrame, keys: list[str], text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``keys``, all counts, ``base_failed`` and ``kept`` of every row."""
    held = df.select(*[F.col(k) for k in keys], F.explode_outer(F.array(metrics(F.col(text)))).alias("_quality"))
    counts = held.select(*keys, *[F.col("_quality")[name].cast("bigint").alias(name) for name in FIGURES])
    judged = counts.withColumn("base_failed", F.expr(failed(BASE_RULES)))
    return judged.withColumn("kept", ~F.col("base_failed") & ~F.expr(failed(rules)))


def keep_good(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that pass all rules, with the columns they came with."""
    names = df.columns
    numbered = df.toDF(*[f"_in{i}" for i in range(len(names))])
    own = [f"_in{i}" for i in range(len(names))]
    good = judge(numbered, own, own[names.index(text)], rules).where("kept")
    return good.select(*[F.col(a).alias(b) for a, b in zip(own, names)])


def sql(table: str = "documents") -> str:
    """The same judgement for DuckDB."""
    stop = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    space = r"[\x20\x09-\x0D]"
    return rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD_CHAR}+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD_CHAR}')) AS live
  FROM {table}),
wins AS (
  SELECT doc_id, i, array_to_string(words[i:i+4], ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM t WHERE len(words) >= 5)),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM wins),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM (SELECT doc_id, i, unnest(range(0, 5)) AS k FROM twice WHERE n > 1) GROUP BY doc_id),
m AS (
  SELECT t.doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(live) - len(list_distinct(live)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         len(list_filter(words, lambda w: lower(w) IN ({stop}))) AS n_stop_words, len(live) AS n_lines,
         len(list_filter(live, lambda x: regexp_matches(x, '(\.\.\.|…){space}*$'))) AS n_ellipsis_lines,
         len(list_filter(live, lambda x: regexp_matches(x, '^{space}*[-*•]'))) AS n_bullet_lines,
         len(regexp_extract_all(text, '!')) AS n_exclamations
  FROM t LEFT JOIN covered ON covered.doc_id = t.doc_id),
b AS (SELECT *, {failed(BASE_RULES)} AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_stop_words, n_lines, n_ellipsis_lines,
       n_bullet_lines, n_exclamations, base_failed, NOT base_failed AND NOT ({failed(RULES)}) AS kept
FROM b"""
