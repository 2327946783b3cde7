"""Prefix trie of conversations, built by burst tries.

A conversation is a sequence of turns.  The trie has a node for each distinct sequence of first turns.  A
container holds the conversations below one node, unsorted.  A container with more than ``limit`` slots (a
slot per remaining turn and one per conversation) bursts: its node becomes a trie head, and its conversations
fall, by their next turn, into smaller containers.  A round looks at several turns at once, and twice as many in
the next one, so a long run of turns that many conversations share takes few rounds.  Turns count by the
hash of everything before and in them, so sizes are an aggregation that combines before its exchange.

The containers that remain are shards: a task sorts their conversations and sweeps over them once, with one
open node per depth.  It holds no more than the nodes of one container; only one conversation alone may exceed
the limit, by its own turns.  Heads get their sums from the tops of containers and the heads below.

A digest of all ids that end in one node is sequential by definition.  Ids of a head are sorted across
all tasks and joined to pieces there; one task per head then only runs over the pieces.

Defined cases: a null role or text counts as empty; turns without a conversation key are left out; a null
turn number comes first, equal numbers are ordered by a hash of role and text; repeated rows are turns of their
own; texts of any length are hashed whole; other columns are ignored; an empty table has no node, not even a
root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .folders import stored

#: Slots of a container that is swept in one task.
LIMIT = 8192
#: Turns that the first round looks at.
STRIDE = 8
#: A head may lie in the way of a third of all conversations: their rows meet it in so many parts.
SALTS = 32
ROOT = bytes(16)
NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string"
)


def sequences(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turns``: the turns of each conversation in order, as ``(id, words)``."""
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = df.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv"),
        F.struct(
            F.col(turn).alias("turn"),
            F.unhex(F.md5(F.concat_ws(":", F.length(who), F.concat(who, said)))).alias("id"),
            F.regexp_count(said, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"),
        ).alias("at"),
    )
    ordered = F.sort_array(F.collect_list("at"))
    return rows.groupBy("conv").agg(F.transform(ordered, lambda x: F.struct(x["id"].alias("id"), x["words"].alias("words"))).alias("turns"))


def branch(held: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations that start like the first one of their group of ``every`` and go on by themselves.

    A hash of the key says how many turns (fewer than ``most``) are taken over from the first of the group.
    """
    taken = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).cast("int")
    first = held.where(F.col("conv") % every == 0).select(F.col("conv").alias("first"), F.slice("turns", 1, most - 1).alias("start"))
    own = held.select("conv", "turns", taken.alias("taken"), (F.col("conv") - F.col("conv") % every).alias("first"))
    met = own.join(first, "first", "left")
    start = F.slice(F.coalesce("start", F.slice("turns", 1, 0)), F.lit(1), F.col("taken"))
    return met.select("conv", F.concat(start, F.slice("turns", F.col("taken") + 1, F.size("turns"))).alias("turns"))


def _with_keys(held: DataFrame) -> DataFrame:
    """``conv, size, keys, words``: ``keys[d]`` stands for the first ``d`` turns, ``words[d]`` are those of turn ``d``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, words = [], []
            for turns in batch.column("turns").to_pylist():
                own, key = [ROOT], ROOT
                for turn in turns:
                    key = hashlib.md5(key + turn["id"]).digest()
                    own.append(key)
                keys.append(own)
                words.append([0, *(turn["words"] for turn in turns)])
            sizes = pa.array([len(own) - 1 for own in keys], pa.int64())
            columns = [batch.column("conv"), sizes, pa.array(keys, pa.list_(pa.binary())), pa.array(words, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["conv", "size", "keys", "words"])

    return held.mapInArrow(run, "conv long, size long, keys array<binary>, words array<long>")


def _burst(held: DataFrame, limit: int) -> tuple[DataFrame | None, DataFrame]:
    """The heads (None if nothing bursts), and ``conv, passed``: how many heads a conversation passes."""
    spark = held.sparkSession
    heads, passed = None, spark.createDataFrame([], "conv long, passed long")
    active, at, stride = held, 0, STRIDE
    while True:
        looked = active.select("conv", "size", "keys", "words", F.posexplode(F.slice("keys", at + 1, stride)).alias("i", "key"))
        depth = F.col("i") + at
        steps = looked.select(
            "conv", "key", depth.cast("long").alias("depth"), F.when(depth > 0, F.get("keys", depth - 1)).alias("parent"),
            F.get("words", depth).alias("words"), (F.col("size") - depth + 1).alias("slots"),
        )
        # depth, parent and words are the same for all rows of a key
        sized = steps.groupBy("key").agg(
            F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.min("words").alias("words"),
            F.count("*").alias("n_convs"), F.min("conv").alias("conv_id"), F.sum("slots").alias("slots"),
        )
        found = stored(sized.where((F.col("slots") > limit) & (F.col("n_convs") > 1)).drop("slots"), "heads")
        if found.isEmpty():
            return heads, passed.groupBy("conv").agg(F.sum("passed").alias("passed"))
        heads = found if heads is None else heads.unionByName(found)
        salts = found.select("key", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        salted = steps.select("conv", "key", F.pmod(F.xxhash64("conv"), F.lit(SALTS)).cast("int").alias("salt"))
        through = stored(salted.join(salts, ["key", "salt"]).groupBy("conv").agg(F.count("*").alias("passed")), "passed")
        passed = passed.unionByName(through)
        further = through.where(F.col("passed") == stride).select("conv")
        active = stored(active.where(F.col("size") >= at + stride).join(further, "conv"), "active")
        at, stride = at + stride, 2 * stride


class _Node:
    __slots__ = ("key", "depth", "words", "conv", "n", "children", "leaves", "saved", "ends", "parent")

    def __init__(self, key: bytes, depth: int, words: int, parent: _Node | None) -> None:
        self.key, self.depth, self.words, self.parent = key, depth, words, parent
        self.conv, self.n, self.children, self.leaves, self.saved, self.ends = None, 0, 0, 0, 0, None

    def end(self, conv: int) -> None:
        """One more conversation ends here; they come in ascending order."""
        if self.ends is None:
            self.ends = hashlib.sha256(b"%d" % conv)
        else:
            self.ends.update(b",%d" % conv)
        self.n += 1
        self.conv = conv if self.conv is None else min(self.conv, conv)

    def close(self) -> None:
        self.leaves = self.leaves or 1
        self.saved += (self.n - 1) * self.words
        above = self.parent
        if above is not None:
            above.n += self.n
            above.children += 1
            above.leaves += self.leaves
            above.saved += self.saved
            above.conv = self.conv if above.conv is None else min(above.conv, self.conv)


def _swept(rows: Iterable[tuple]) -> Iterator[tuple[_Node, list[bytes] | None]]:
    """The nodes of sorted ``conv, depth, keys, words``, and for the top of a container the keys above it."""
    open_nodes: list[_Node] = []
    done: list[_Node] = []
    above: list[bytes] = []
    for conv, depth, keys, words in rows:
        if open_nodes and open_nodes[0].key != keys[depth]:
            yield from _closed(open_nodes, done, above)
            open_nodes, done = [], []
        if not open_nodes:
            above = keys[:depth]
        shared = 0
        while shared < len(open_nodes) and depth + shared < len(keys) and open_nodes[shared].key == keys[depth + shared]:
            shared += 1
        while len(open_nodes) > shared:
            done.append(open_nodes.pop())
            done[-1].close()
        for d in range(depth + shared, len(keys)):
            open_nodes.append(_Node(keys[d], d, words[d], open_nodes[-1] if open_nodes else None))
        open_nodes[-1].end(conv)
    yield from _closed(open_nodes, done, above)


def _closed(open_nodes: list[_Node], done: list[_Node], above: list[bytes]) -> Iterator[tuple[_Node, list[bytes] | None]]:
    for node in reversed(open_nodes):
        node.close()
    for node in (*done, *open_nodes):
        yield node, above if node.parent is None else None


NOTHING = hashlib.sha256(b"").hexdigest()
#: Nodes that a task hands over together.
TOGETHER = 4096


def _sweep(contained: DataFrame) -> DataFrame:
    """The nodes of all containers; the top of a container has the keys above it instead of a parent."""
    names = [x.split()[0] for x in NODE.split(", ")]
    types = [*[pa.int64()] * 7, pa.string(), pa.list_(pa.binary())]

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(x).to_pylist() for x in ("conv", "depth", "keys", "words")))

    def batch_of(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held), types)], [*names, "above"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for node, above in _swept(rows(batches)):
            parent = node.parent.conv if node.parent is not None else None
            ends = node.ends.hexdigest() if node.ends is not None else NOTHING
            held.append((node.conv, node.depth, parent, node.n, node.children, node.leaves, node.saved, ends, above))
            if len(held) == TOGETHER:
                yield batch_of(held)
                held = []
        if held:
            yield batch_of(held)

    shards = contained.repartition("container").sortWithinPartitions("container", "keys", "conv")
    return shards.select("conv", "depth", "keys", "words").mapInArrow(run, f"{NODE}, above array<binary>")


def _digests(ended: DataFrame) -> DataFrame:
    """``key, ends_sha256`` of ``key, conv``."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for key, own in groupby(zip(batch.column("key").to_pylist(), batch.column("conv").to_pylist()), lambda x: x[0]):
                convs = [conv for _, conv in own]
                found.append((key, convs[0], ",".join(map(str, convs))))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*found)], ["key", "first", "piece"])

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(batch.column("key").to_pylist(), batch.column("piece").to_pylist()))
        for key, own in groupby(rows, lambda x: x[0]):
            digest = hashlib.sha256()
            for i, (_, piece) in enumerate(own):
                digest.update((("," if i else "") + piece).encode())
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], ["key", "ends_sha256"])

    cuts = ended.repartitionByRange("key", "conv").sortWithinPartitions("key", "conv")
    cuts = cuts.mapInArrow(cut, "key binary, first long, piece string")
    return cuts.repartition("key").sortWithinPartitions("key", "first").mapInArrow(fold, "key binary, ends_sha256 string")


def prefix_nodes(held: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The nodes of the trie over ``conv, turns``, each conversation once.

    ``conv_id``: the smallest member; ``depth``; ``parent_conv_id``: the parent's smallest member; ``n_convs``:
    members; ``n_children``; ``n_leaves``: childless nodes of the subtree; ``saved_tokens``: words of the subtree that
    members share, each node's words times its members but one; ``ends_sha256`` of the members that end here.  The
    last turn of a node is turn number ``depth`` of ``conv_id``.
    """
    held = stored(_with_keys(held), "sequences")
    heads, passed = _burst(held, limit)
    placed = held.join(passed, "conv", "left").withColumn("depth", F.coalesce("passed", F.lit(0))).drop("passed")
    contained = placed.where("depth <= size").withColumn("container", F.get("keys", F.col("depth").cast("int")))
    if heads is None:
        return _sweep(contained).drop("above")
    swept = stored(_sweep(contained), "nodes")

    # every top and head adds to the heads above it
    tops = swept.where("above IS NOT NULL")
    under = tops.select(F.element_at("above", -1).alias("key")).unionByName(heads.where("depth > 0").select(F.col("parent").alias("key")))
    children = under.groupBy("key").agg(F.count("*").alias("n_children"))
    counted = stored(heads.join(children, "key", "left").fillna(0, ["n_children"]), "counted-heads")
    own_leaves = (F.col("n_children") == 0).cast("long").alias("n_leaves")
    own_saved = ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")
    paths = counted.select("conv_id", "depth", own_leaves, own_saved).join(held.select(F.col("conv").alias("conv_id"), "keys"), "conv_id")
    upwards = F.explode(F.slice("keys", F.lit(1), F.col("depth").cast("int") + 1)).alias("key")
    parts = paths.select(upwards, "n_leaves", "saved_tokens").unionByName(tops.select(F.explode("above").alias("key"), "n_leaves", "saved_tokens"))
    sums = parts.groupBy("key").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))

    ended = placed.where("depth > size").select(F.get("keys", F.col("size").cast("int")).alias("key"), "conv")
    least = counted.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    known = counted.join(sums, "key").join(_digests(ended), "key", "left").join(least, "parent", "left")
    names = [x.split()[0] for x in NODE.split(", ")]
    above = known.fillna(NOTHING, ["ends_sha256"]).select(*names)
    lowest = tops.withColumn("parent", F.element_at("above", -1)).drop("parent_conv_id").join(least, "parent").select(*names)
    return above.unionByName(lowest).unionByName(swept.where("above IS NULL").select(*names))


def conversation_trie(df: DataFrame, limit: int = LIMIT) -> DataFrame:
    """:func:`prefix_nodes` of a table of conversations that branch off (:func:`branch`)."""
    return prefix_nodes(branch(sequences(df)), limit)
