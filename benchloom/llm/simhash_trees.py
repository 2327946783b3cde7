"""Near-duplicate documents: SimHash fingerprints searched in BK-trees.

Two documents are linked when their 64-bit fingerprints differ in at most ``RADIUS`` bits; a group is
what is connected by links.  Different fingerprints are dealt out to shards: of four blocks of 16 bits
two fingerprints within two bits share at least two, so every link lies in the shard of some two blocks.
A shard is a BK-tree: the children of a node are keyed by their distance to it, and a search follows
only the edges within the radius of its own distance.  A shard with many fingerprints is split once
more by the same rule over its other 32 bits, after which a tree holds at most 65,536 of them,
whatever the size of the corpus.  Trees stay in the task that owns the shard: their number grows with
the corpus, so they are not broadcast.  A shard reports one link for each member of a group, not all pairs.

Defined cases: a null or empty text has fingerprint 0 and is linked like any other; a text with fewer
words than a shingle is one shingle; repeated rows share a group; rows whose key is null belong to
their group, but do not name it unless it has no other key; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .batches import pieces, texts_of
from .components import components
from .folders import stored
from .shingles import Worded, together, worded

SEED = 42
SHINGLE = 3
RADIUS = 2
#: A shard with more fingerprints is split.
CROWDED = 4096
#: Hashes whose bits are counted at a time.
HASHES = 1 << 13


def simhashes(words: Worded, shingle: int = SHINGLE) -> np.ndarray:
    """The 64-bit SimHash of each text, unsigned."""
    hashes, ends = words.hashes(shingle, SEED)
    counts, found = np.diff(ends), np.zeros(len(ends) - 1, np.uint64)
    there = np.flatnonzero(counts)
    if not len(there):
        return found
    counts, starts = counts[there], ends[there]
    # one byte for each bit, eight in a number: up to 255 hashes are added without a carry
    parts = -(-counts // 255)
    first = np.cumsum(parts) - parts
    cuts = np.repeat(starts, parts) + 255 * (np.arange(parts.sum()) - np.repeat(first, parts))
    some = max(1, HASHES // 255)
    ones = []
    for at in range(0, len(cuts), some):
        low, high = cuts[at], cuts[at + some] if at + some < len(cuts) else len(hashes)
        bits = np.unpackbits(hashes[low:high].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view(np.uint64)
        ones.append(np.add.reduceat(bits, cuts[at : at + some] - low, axis=0))
    ones = np.add.reduceat(np.concatenate(ones).view(np.uint8).reshape(-1, 64), first, axis=0, dtype=np.int64)
    found[there] = np.packbits(2 * ones > counts[:, None], axis=1, bitorder="little").view("<u8")[:, 0]
    return found


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text, unsigned."""
    return int(simhashes(worded([text]), shingle)[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``key`` and ``fp``, the fingerprint as a signed long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            found = np.concatenate([simhashes(worded(x), shingle) for x in together(texts_of(piece, "text").to_pylist())])
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(found.view(np.int64))], ["key", "fp"])

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, fp long")


class BKTree:
    """A tree over integers under the Hamming distance."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        self.values.append(value)
        self.children.append({})
        node, own = 0, len(self.values) - 1
        while own:
            distance = (self.values[node] ^ value).bit_count()
            following = self.children[node].get(distance)
            if following is None:
                self.children[node][distance] = own
                return
            node = following

    def within(self, value: int, radius: int) -> list[int]:
        """The nodes at most ``radius`` away."""
        found, open_nodes = [], [0] if self.values else []
        while open_nodes:
            node = open_nodes.pop()
            distance = (self.values[node] ^ value).bit_count()
            if distance <= radius:
                found.append(node)
            children = self.children[node]
            if len(children) > 2 * radius + 1:
                open_nodes += [children[d] for d in range(distance - radius, distance + radius + 1) if d in children]
            else:
                open_nodes += [x for d, x in children.items() if -radius <= d - distance <= radius]
        return found


def _root(parents: list[int], i: int) -> int:
    while parents[i] != i:
        parents[i] = parents[parents[i]]
        i = parents[i]
    return i


def links_of(values: list[int], radius: int) -> list[tuple[int, int]]:
    """A link from each value of a shard to the first value of its group."""
    tree, parents = BKTree(), list(range(len(values)))
    for i, value in enumerate(values):
        for near in tree.within(value, radius):
            a, b = _root(parents, near), _root(parents, i)
            parents[max(a, b)] = min(a, b)
        tree.add(value)
    roots = [_root(parents, i) for i in range(len(values))]
    return [(values[i], values[r]) for i, r in enumerate(roots) if i != r]


def _shared_blocks(fp: Column, blocks: list[tuple[int, int]]) -> Column:
    """One key for each two of the four blocks ``(shift, bits)``."""
    keys = []
    for n, (x, y) in enumerate(combinations(blocks, 2)):
        parts = [F.shiftrightunsigned(fp, s).bitwiseAND(F.lit((1 << bits) - 1)) for s, bits in (x, y)]
        keys.append(F.lit(n) * (1 << 32) + parts[0] * (1 << y[1]) + parts[1])
    return F.array(*keys)


def shards(fps: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """``shard, part, fp``: every fingerprint in each of its shards; only shards of two or more."""
    blocks = [(16 * i, 16) for i in range(4)]
    rows = fps.select(F.explode(_shared_blocks(F.col("fp"), blocks)).alias("shard"), "fp")
    sizes = rows.groupBy("shard").agg(F.count("*").alias("_n")).where("_n > 1")
    rows = rows.join(sizes, "shard")
    small = rows.where(F.col("_n") <= crowded).select("shard", F.lit(-1).cast("bigint").alias("part"), "fp")
    # the blocks that a shard does not fix, cut into four of 8 bits
    split = None
    for n, fixed in enumerate(combinations(range(4), 2)):
        free = [(16 * i + 8 * h, 8) for i in range(4) if i not in fixed for h in (0, 1)]
        keys = _shared_blocks(F.col("fp"), free)
        split = F.when(F.shiftright("shard", 32) == n, keys) if split is None else split.when(F.shiftright("shard", 32) == n, keys)
    large = rows.where(F.col("_n") > crowded).select("shard", F.explode(split).alias("part"), "fp")
    return small.unionByName(large)


def link(fps: DataFrame, radius: int = RADIUS, crowded: int = CROWDED) -> DataFrame:
    """Links ``a, b`` that connect all fingerprints of a table within the radius (2 at most)."""
    if radius > 2:
        raise ValueError("four blocks find links of at most two bits")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = [], None
        for batch in batches:
            shard = batch.column(0).to_numpy()
            part = batch.column(1).to_numpy()
            values = batch.column(2).to_numpy().view(np.uint64)
            cuts = np.flatnonzero((shard[1:] != shard[:-1]) | (part[1:] != part[:-1])) + 1
            out = []
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shard)]):
                if a == b:
                    continue
                if own != (shard[a], part[a]):
                    out += links_of(held, radius) if len(held) > 1 else []
                    held, own = [], (shard[a], part[a])
                held += values[a:b].tolist()
            yield _links(out)
        yield _links(links_of(held, radius) if len(held) > 1 else [])

    dealt = shards(fps, crowded).repartition("shard", "part").sortWithinPartitions("shard", "part", "fp")
    return dealt.mapInArrow(run, "a long, b long")


def _links(found: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def groups(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``fp, group_fp, component_id`` for every different fingerprint of ``key, fp``."""
    firsts = stored(prints.groupBy("fp").agg(F.min("key").alias("first")), "fingerprints")
    roots = components(link(firsts.select("fp"), radius))
    rooted = firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.select("fp", "first", F.coalesce("root", "fp").alias("group_fp"))
    named = rooted.groupBy("group_fp").agg(F.min("first").alias("component_id"))
    return rooted.select("fp", "group_fp").join(named, "group_fp")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """``key, fingerprint, component_id`` of every row; ``component_id`` is the smallest key of its group."""
    prints = stored(fingerprints(df, key, text), "prints")
    named = prints.join(groups(prints, radius), "fp")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return named.select(F.col("key").alias(key), hexed.alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """The row with the smallest key of every group, with the columns the rows came with.

    Where several rows have that key, or no row of the group has one, one of them stays.
    """
    prints = stored(fingerprints(df, key, text), "prints")
    return keep_first(df, key, text, prints, groups(prints, radius), fingerprints)


def keep_first(
    df: DataFrame, key: str, text: str, prints: DataFrame, found: DataFrame, printed_by: Callable[[DataFrame, str, str], DataFrame]
) -> DataFrame:
    """:func:`keep_one` for any groups ``fp, group_fp, component_id`` of ``key, fp``, which ``printed_by`` makes from rows."""
    names = df.columns
    own = [f"_in{i}" for i in range(len(names))]
    rows = df.toDF(*own)
    k, t = F.col(own[names.index(key)]), F.col(own[names.index(text)])
    # the rows that stay, as (key, fingerprint): narrow, one for each group
    named = prints.join(found, "fp").where("key <=> component_id")
    chosen = named.groupBy("group_fp").agg(F.min("key").alias("_key"), F.min("fp").alias("_fp"), F.count("*").alias("_n"))
    single = rows.join(chosen.where("_n = 1 AND _key IS NOT NULL"), k == F.col("_key"), "left_semi")
    # groups in which the chosen key is not one row: their rows are few, so their texts may move
    several = chosen.where("_n > 1 OR _key IS NULL")
    doubt = named.join(several.select("group_fp"), "group_fp", "left_semi").select("key", "fp", "group_fp")
    held = rows.join(several.select("_key").distinct(), k.eqNullSafe(F.col("_key")), "left_semi")
    printed = printed_by(held.select(F.struct(*own).alias("row"), t.alias("text")), "row", "text")
    placed = printed.join(doubt.select("fp", "group_fp").distinct(), "fp").groupBy("group_fp").agg(F.min("key").alias("row"))
    rest = placed.select(*[F.col("row")[c].alias(c) for c in own])
    return single.unionByName(rest).toDF(*names)
