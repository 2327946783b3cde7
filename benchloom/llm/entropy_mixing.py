"""Mixing sources to target weights by entropy balancing.

Each source gets a target of tokens.  Among all rates of its documents that meet the target, those are taken
that are closest to one copy of each in relative entropy.  They are an exponential tilt, ``exp(tilt * size)``,
cut off at the most copies that a document may have; the tilt solves the convex dual.  A document is bound by
one target only, so the dual's Hessian is diagonal: a Newton step for all sources at once is one aggregation.
The bracket in which the dual's slope changes its sign is carried along, and a step that leaves it is halved
into it, so the steps end for any sizes.

Documents of one source and size have the same rate, so the steps work on the counts of such cells, not on
documents.  Rates become copies in two moves.  The copies of a cell are rounded from the largest size to the
smallest, each cell carrying on the words that the ones before fell short, so that a source misses its
target by what its few smallest documents cannot make up for.  Within a cell, a hash of the document's key says which of its documents
get one copy more; their order is taken in ranges of the hash, so no cell is sorted in one task.

Defined cases: a null text has no words and takes none; a null source is a source of its own, the last one; a source
without words has target 0; null keys and repeated rows are documents like any others, equal rows in any
order among themselves; other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .folders import discard, store, stored

#: Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix, as a share of all words.
SHARE = 1.5
#: Copies of a document at most, and words of a source as a multiple of its own.
MOST = 2
#: The mix is expected to miss a target by less than this part before it is rounded.
TOLERANCE = 1e-9
#: Beyond this many steps the bracket has shrunk to neighbouring numbers.
MOST_STEPS = 200
#: Ranges of the hash in which documents of a cell are ordered.
RANGES = 1024
EXACT = "decimal(38,9)"


def _sized(df: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """``key, tag, size, mark, part``: tag stands for the source, mark orders documents of one cell, part is its range."""
    size = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    name = F.col(source).cast("string")
    # in the order of tags, null is last
    tag = F.when(name.isNull(), "1").otherwise(F.concat(F.lit("0"), name))
    mark = F.xxhash64(F.col(key).cast("string"))
    rows = df.select(F.col(key).alias("key"), tag.alias("tag"), size.alias("size"), mark.alias("mark"))
    return rows.withColumn("part", F.pmod("mark", F.lit(RANGES)).cast("int"))


def _in_order(sources: DataFrame) -> DataFrame:
    """The sources with ``place``, their place in the order of tags: ranges are numbered, not one sorted list."""
    ranged = sources.repartitionByRange("tag").sortWithinPartitions("tag")
    # the id of a row holds its range and its place there
    ranged = stored(ranged.withColumn("id", F.monotonically_increasing_id()), "sources")
    bits = 33
    numbers = ranged.groupBy(F.shiftright("id", bits).alias("r")).agg(F.count("*").alias("n")).orderBy("r").collect()
    before = [(row["r"], sum(x["n"] for x in numbers[:i])) for i, row in enumerate(numbers)]
    starts = sources.sparkSession.createDataFrame(before, "r long, before long")
    numbered = ranged.withColumn("r", F.shiftright("id", bits)).join(starts, "r")
    return numbered.withColumn("place", F.col("before") + F.col("id").bitwiseAND((1 << bits) - 1)).drop("id", "r", "before")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``tag, source_size, target`` of ``tag, source_size``: shares by weight, none above ``most`` times its size.

    What a source cannot take is shared again by the weights of the others, until none is above.
    """
    scale = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("place") % len(weights) + 1).cast("int"))
    held = stored(_in_order(sizes).select("tag", "source_size", scale.alias("weight"), (F.col("source_size") * float(most)).alias("room")), "weights")
    level, full = 0.0, None
    while True:
        above = F.col("weight") * level > F.col("room")
        total, filled, weight, n = held.agg(
            F.sum("source_size"), F.sum(F.when(above, F.col("room")).otherwise(0.0)),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))), F.count_if(above),
        ).first()
        if n == full or not weight:
            return held.select("tag", "source_size", F.least(F.col("weight") * level, "room").alias("target"))
        full, level = n, (share * total - filled) / weight


def tilts(cells: DataFrame, wanted: DataFrame, most: int = MOST) -> DataFrame:
    """``tag, scale, tilt`` of cells ``tag, size, n`` and targets; rates are ``least(most, exp(tilt * size / scale))``."""
    full = math.log(most)
    cells = cells.where("size > 0")
    spread = cells.groupBy("tag").agg(F.min("size").alias("least"), F.max("size").alias("scale"))
    # at the upper end all documents are cut off, at the lower one even the smallest is tilted enough
    step, ratio = F.col("scale") / F.col("least"), F.col("target") / F.col("source_size")
    state = wanted.join(spread, "tag").select(
        "tag", "target", "scale", F.least(F.log(ratio) * step, F.lit(0.0)).alias("low"), (F.lit(full) * step).alias("high"),
        (ratio >= most * (1 - TOLERANCE)).alias("done"),
    )
    state, folder = store(state.withColumn("tilt", F.when(F.col("done"), F.col("high")).otherwise(0.0)), "tilts")
    for _ in range(MOST_STEPS):
        if state.where("NOT done").isEmpty():
            break
        x = F.col("size") / F.col("scale")
        free = F.col("tilt") * x < full
        rate = F.when(free, F.exp(F.col("tilt") * x)).otherwise(float(most))
        words = F.col("n") * F.col("size") * rate
        # exact sums: the order of adding changes nothing, so runs agree
        sums = cells.join(state.where("NOT done").select("tag", "scale", "tilt"), "tag").groupBy("tag").agg(
            F.sum(words.cast(EXACT)).cast("double").alias("got"), F.sum(F.when(free, words * x).otherwise(0.0).cast(EXACT)).cast("double").alias("slope")
        )
        gap = F.col("got") - F.col("target")
        met = state.join(sums, "tag", "left").withColumns(
            {
                "low": F.when(gap < 0, F.col("tilt")).otherwise(F.col("low")),
                "high": F.when(gap > 0, F.col("tilt")).otherwise(F.col("high")),
                "done": F.col("done") | (F.abs(gap) <= TOLERANCE * F.col("target")),
                "newton": F.col("tilt") - gap / F.when(F.col("slope") > 0, F.col("slope")),
            }
        )
        inside = F.coalesce((F.col("newton") > F.col("low")) & (F.col("newton") < F.col("high")), F.lit(False))
        moved = F.when(inside, F.col("newton")).otherwise((F.col("low") + F.col("high")) / 2)
        last = folder
        state, folder = store(met.select("tag", "target", "scale", "low", "high", "done", F.when(F.col("done"), F.col("tilt")).otherwise(moved).alias("tilt")), "tilts")
        discard(state.sparkSession, last)
    return state.select("tag", "scale", "tilt")


def rounded(cells: DataFrame, most: int = MOST) -> DataFrame:
    """``tag, size, each, extra`` of cells ``tag, size, n, rate``: the copies of every document, and how many get one more.

    A group has one row for each different size of a source, whatever its documents.
    """

    def run(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("size", ascending=False)
        copies, short = [], 0.0
        for size, n, rate in zip(own["size"].tolist(), own["n"].tolist(), own["rate"].tolist()):
            short += size * n * rate
            copies.append(min(max(math.floor(short / size + 0.5), 0), most * n))
            short -= copies[-1] * size
        total = pd.Series(copies, own.index, dtype="int64")
        return pd.DataFrame({"tag": own["tag"], "size": own["size"], "each": total // own["n"], "extra": total % own["n"]})

    return cells.groupBy("tag").applyInPandas(run, "tag string, size long, each long, extra long")


def mix(
    df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE, most: int = MOST,
) -> DataFrame:
    """``key, size, source_size, target, taken, rate, copies`` of every row.

    ``size``: words of the text; ``target``: words that its source shall give; ``rate``: expected copies; ``copies``:
    copies in the mix; ``taken``: words of the copies.
    """
    rows = stored(_sized(df, key, text, source), "sizes")
    ranges = stored(rows.groupBy("tag", "size", "part").agg(F.count("*").alias("here")), "ranges")
    cells = stored(ranges.groupBy("tag", "size").agg(F.sum("here").alias("n")), "cells")
    wanted = stored(targets(cells.groupBy("tag").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, most), "targets")
    rate = F.least(F.lit(float(most)), F.exp(F.col("tilt") * F.col("size") / F.col("scale")))
    rated = stored(cells.where("size > 0").join(tilts(cells, wanted, most), "tag").select("tag", "size", "n", rate.alias("rate")), "rates")
    plan = stored(
        cells.join(wanted, "tag").join(rated.select("tag", "size", "rate"), ["tag", "size"], "left")
        .join(rounded(rated, most), ["tag", "size"], "left")
        .select("tag", "size", "source_size", "target", *(F.coalesce(x, F.lit(0)).alias(x) for x in ("rate", "each", "extra"))),
        "plan",
    )

    earlier = Window.partitionBy("tag", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn("before", F.coalesce(F.sum("here").over(earlier), F.lit(0))).join(plan, ["tag", "size"])
    starts = starts.select("tag", "size", "part", "source_size", "target", "rate", "each", (F.col("extra") - F.col("before")).alias("more"))
    # a text without words takes none, so its place does not matter
    place = F.row_number().over(Window.partitionBy("tag", "size", "part").orderBy("mark", "key"))
    placed = rows.where("size > 0").withColumn("place", place).unionByName(rows.where("size = 0").withColumn("place", F.lit(0)))
    copies = F.col("each") + ((F.col("size") > 0) & (F.col("place") <= F.col("more"))).cast("long")
    out = placed.join(starts, ["tag", "size", "part"]).withColumn("copies", copies)
    return out.select(F.col("key").alias(key), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "rate", "copies")


def mixed(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of the mix: every row as often as it has copies, with ``copy``, its number from 1.

    Keys have to be different and not null, or equal keys take the copies of all their rows together.
    """
    copies = mix(df, key, text, source, **options).groupBy(key).agg(F.sum("copies").alias("_copies"))
    once = df.dropDuplicates([key]).alias("d").join(copies.alias("c"), F.col(f"d.{key}").eqNullSafe(F.col(f"c.{key}")))
    return once.where("_copies > 0").select("d.*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("copy"))
