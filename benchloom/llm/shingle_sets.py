"""Near-duplicate documents: groups by the Jaccard similarity of their shingle sets.

Two documents are linked when the sets of their ``SHINGLE``-word shingles have a Jaccard similarity of
``SIMILARITY`` or more, computed exactly; a group is what is connected by links.  Candidates come two ways.
The SimHashes of the documents are searched in BK-trees (:mod:`simhash_trees`): what is connected by links
within two bits is a bucket.  Two bits reach hardly more than copies, so documents that share a band of MinHash
values are a bucket as well: a pair at 0.8 shares one of 24 bands of four values with a probability
of 0.999997, a pair that is more alike with a higher one.  Equal sets are one.

Buckets hold numbers only; sets are worked out again for the documents that share a bucket, and
buckets with the same members are one.  A bucket with many members is cut into blocks: first the members of
each block are compared, and the first ones of all blocks, then what is not connected by that is compared
across blocks.  Pairs that are connected already are not compared.

Defined cases: words are what white space separates, in lower case (ASCII); a text with fewer words than a
shingle is one shingle; null and empty texts are one group; texts of any length are read whole; shingles and
sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_intdigest

from . import simhash_trees
from .batches import pieces, texts_of
from .components import components
from .folders import stored
from .shingles import Worded, together, worded

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 24
#: MinHash values of a band.
ROWS = 4
SEED = 42
#: Documents of a bucket that are compared with each other in one unit.
UNIT = 256
#: Shingles whose MinHash values are worked out at a time.
TOGETHER = 1024


def shingle_sets(words: Worded, shingle: int = SHINGLE) -> list[np.ndarray]:
    """The hashes of the shingles of each text, ascending."""
    hashes, ends = words.hashes(shingle, SEED)
    found = []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        own = np.sort(hashes[a:b])
        found.append(own[np.append(True, own[1:] != own[:-1])[: len(own)]])
    return found


def shingle_set(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """The hashes of the shingles of a text, ascending."""
    return shingle_sets(worded([text]), shingle)[0]


def _factors() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    drawn = random.integers(0, 1 << 32, (2, BANDS * ROWS, 1), np.uint32)
    return drawn[0] | np.uint32(1), drawn[1]


FACTORS, SHIFTS = _factors()


def bands_of(hashes: np.ndarray) -> np.ndarray:
    """One key for each band of a set."""
    # the hashes are mixed already: an odd factor and a shift give another order of their high halves
    high = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(high), TOGETHER):
        mixed = high[at : at + TOGETHER] * FACTORS
        mixed += SHIFTS
        least = np.minimum(least, mixed.min(axis=1))
    return np.array([xxh64_intdigest(x.tobytes(), i) for i, x in enumerate(least.reshape(BANDS, ROWS))], np.uint64)


def _print(hashes: np.ndarray) -> int:
    return xxh64_intdigest(hashes.tobytes(), SEED)


def set_prints(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bands: bool = False) -> DataFrame:
    """``key`` and ``fp``, a hash of the shingle set as a signed long, and with ``bands`` the keys of the bands and the ``simhash``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            prints, keys, simhashes = [], [], []
            for texts in together(texts_of(piece, "text").to_pylist()):
                words = worded(texts)
                sets = shingle_sets(words, shingle)
                prints += map(_print, sets)
                if bands:
                    keys += [bands_of(x).view(np.int64) for x in sets]
                    simhashes.append(simhash_trees.simhashes(words))
            columns = [piece.column(0), pa.array(np.array(prints, np.uint64).view(np.int64))]
            if bands:
                columns += [pa.array(keys, pa.list_(pa.int64())), pa.array(np.concatenate(simhashes).view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "fp", "bands", "simhash"][: len(columns)])

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, fp long" + (", bands array<bigint>, simhash long" if bands else ""))


def set_table(df: DataFrame, text: str, shingle: int = SHINGLE) -> DataFrame:
    """``fp, hashes``: the shingle set of every row, as a binary cell."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            for texts in together(texts_of(piece, "text").to_pylist()):
                sets = shingle_sets(worded(texts), shingle)
                prints = pa.array(np.array([_print(x) for x in sets], np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([prints, pa.array([x.tobytes() for x in sets], pa.binary())], ["fp", "hashes"])

    return df.select(F.col(text).alias("text")).mapInArrow(run, "fp long, hashes binary")


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether two sets have a Jaccard similarity of ``least``."""
    if min(len(a), len(b)) < least * max(len(a), len(b)) - 1e-9:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= least * (len(a) + len(b) - both) - 1e-9


def links_of(prints: list[int], sets: list[np.ndarray], groups: list[int], blocks: list[int] | None, least: float) -> list[tuple[int, int]]:
    """Links that connect the members of a unit; those of one group are connected, with ``blocks`` only different ones are compared."""
    _, labels = np.unique(np.array(groups), return_inverse=True)
    parts = np.array(blocks) if blocks else None
    found = []
    for i in range(1, len(prints)):
        open_to = np.flatnonzero(labels[:i] != labels[i])
        open_to = open_to if parts is None else open_to[parts[open_to] != parts[i]]
        while len(open_to):
            j = int(open_to[0])
            if similar(sets[i], sets[j], least):
                found.append((prints[i], prints[j]))
                labels[labels == labels[j]] = labels[i]
                open_to = open_to[labels[open_to] != labels[i]]
            else:
                open_to = open_to[1:]
    return found


def _linked(units: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links ``a, b`` within the units of ``bucket, unit, cross, block, root, fp``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held = None, []

        def finished() -> pa.RecordBatch:
            found = []
            if len(held) > 1:
                prints, roots, blocks, sets_of = (list(x) for x in zip(*held))
                arrays = [np.frombuffer(x, np.uint64) for x in sets_of]
                found = links_of(prints, arrays, roots, blocks if own[2] else None, least)
            both = np.array(found, np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

        for batch in batches:
            columns = [batch.column(x).to_pylist() for x in ("bucket", "unit", "cross", "fp", "root", "block", "hashes")]
            for bucket, unit, cross, *row in zip(*columns):
                if own != (bucket, unit, cross):
                    yield finished()
                    own, held = (bucket, unit, cross), []
                held.append(row)
        yield finished()

    rows = units.select("bucket", "unit", "cross", "fp", "root", "block").join(sets, "fp")
    dealt = rows.select("bucket", "unit", "cross", "fp", "root", "block", "hashes")
    return dealt.repartition("bucket", "unit").sortWithinPartitions("bucket", "unit", "fp").mapInArrow(run, "a long, b long")


def _tree_buckets(prints: DataFrame) -> DataFrame:
    """``bucket, fp``: the sets whose SimHashes are connected by links that the BK-trees find."""
    marks = stored(prints.select("fp", "simhash").distinct(), "simhashes")
    roots = components(simhash_trees.link(marks.select(F.col("simhash").alias("fp")).distinct()))
    rooted = marks.join(roots.withColumnRenamed("node", "simhash"), "simhash", "left")
    return rooted.select(F.xxhash64(F.lit("simhash"), F.coalesce("root", "simhash")).alias("bucket"), "fp").distinct()


def groups(df: DataFrame, prints: DataFrame, key: str = "doc_id", text: str = "text", least: float = SIMILARITY, shingle: int = SHINGLE) -> DataFrame:
    """``fp, group_fp, component_id`` for every different set of ``prints`` (key, fp, bands, simhash)."""
    different = prints.groupBy("fp").agg(F.min("key").alias("first"), F.min("bands").alias("bands"))
    different = stored(different, "shingle-sets")
    rows = different.select(F.explode("bands").alias("bucket"), "fp").unionByName(_tree_buckets(prints))
    # of buckets with the same members one is enough
    members = F.sum(F.xxhash64("fp").cast("decimal(38,0)"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n"), members.alias("members")).where("n > 1")
    sizes = sizes.groupBy("n", "members").agg(F.min("bucket").alias("bucket")).select("bucket", "n")
    live = rows.join(sizes, "bucket").withColumn("n_blocks", F.ceil(F.col("n") / UNIT))
    live = stored(live.withColumn("block", F.pmod(F.xxhash64("fp"), "n_blocks")), "live-sets")
    # sets of the documents that share a bucket, from the texts
    needed = live.select("fp").distinct()
    keys = different.join(needed, "fp", "left_semi").select(F.col("first").alias("_key")).distinct()
    held = df.join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_semi")
    sets = set_table(held, text, shingle).join(needed, "fp", "left_semi").groupBy("fp").agg(F.min("hashes").alias("hashes"))
    sets = stored(sets, "sets")
    inside = live.select("bucket", F.col("block").alias("unit"), F.lit(False).alias("cross"), "block", F.col("fp").alias("root"), "fp")
    large = live.where("n_blocks > 1")
    heads = large.groupBy("bucket", "block").agg(F.min("fp").alias("fp"))
    heads = heads.select("bucket", F.lit(-1).cast("bigint").alias("unit"), F.lit(False).alias("cross"), "block", F.col("fp").alias("root"), "fp")
    links = stored(_linked(inside.unionByName(heads), sets, least), "set-links")
    roots = components(links)
    if not large.isEmpty():
        placed = large.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
        several = placed.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("bucket")
        placed = placed.join(several, "bucket", "left_semi").withColumn("other", F.explode(F.expr("sequence(0L, n_blocks - 1)"))).where("block <> other")
        unit = F.least("block", "other") * F.col("n_blocks") + F.greatest("block", "other")
        across = placed.select("bucket", unit.alias("unit"), F.lit(True).alias("cross"), "block", "root", "fp")
        roots = components(links.unionByName(_linked(across, sets, least)))
    rooted = different.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.select("fp", "first", F.coalesce("root", "fp").alias("group_fp"))
    named = rooted.groupBy("group_fp").agg(F.min("first").alias("component_id"))
    return rooted.select("fp", "group_fp").join(named, "group_fp")
