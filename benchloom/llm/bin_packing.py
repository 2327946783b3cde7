"""Best-fit packing of rows into sequences of several permitted lengths.

A row longer than the largest permitted length is cut into pieces of that length and a rest.  Pieces of
one length are alike, so the packing is planned on their histogram, which has at most as many entries as
the largest length: pieces are placed in order of falling length, each into the open bin with the least
room that suffices, and if there is none, into a new bin.  Bins with equal contents stay one entry of the
plan with a count.  Which size to open is decided jointly: the plan is made once for each permitted size
as the usual one, and once with the size of least cost per token at hand; every bin is then downsized to
the smallest permitted length that holds its contents, and the plan of least total cost is kept.

The rows are never gathered: each piece is numbered among the pieces of its length (a count in its part
plus the counts of the parts before), and its number says which bin of the plan it belongs to.

Defined cases: a null, zero or negative length takes no room and gives one row without a bin; ties between
pieces of one length are settled by the order of the stored rows; repeated rows and null keys are packed
like any others; other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .folders import stored

LENGTHS = (512, 1024, 2048, 4096)
#: Pieces of one length are numbered below this.
MOST_PIECES = 1 << 40


def sequence_cost(capacity: int) -> float:
    """What a sequence costs by default: its length, attention within it, and a little for itself."""
    return 16 + capacity + capacity**2 / 16384


class Bins(NamedTuple):
    """``count`` bins with equal contents: ``(length, pieces)`` in order of placing."""

    count: int
    contents: tuple[tuple[int, int], ...]


def _place(histogram: dict[int, int], opened) -> list[tuple[int, Bins]]:
    """Best fit in order of falling length; ``opened(length, left)`` is the size of a new bin.

    Returns ``(room left, bins)``.
    """
    open_bins: dict[int, list[Bins]] = {}
    rooms: list[int] = []  # ascending, of open_bins

    def put(room: int, bins: Bins) -> None:
        if room not in open_bins:
            open_bins[room] = []
            insort(rooms, room)
        open_bins[room].append(bins)

    def fill(room: int, bins: Bins, length: int, left: int) -> int:
        """Give bins of one kind as many pieces as fit; returns the pieces that remain."""
        each = room // length
        full = min(bins.count, left // each)
        if full:
            put(room - each * length, Bins(full, (*bins.contents, (length, each))))
        left -= full * each
        rest = bins.count - full
        if rest and left:
            put(room - left * length, Bins(1, (*bins.contents, (length, left))))
            left, rest = 0, rest - 1
        if rest:
            put(room, Bins(rest, bins.contents))
        return left

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                bins = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.pop(at)
                left = fill(room, bins, length, left)
            else:
                size = opened(length, left)
                left = fill(size, Bins(-(-left // (size // length)), ()), length, left)
    return [(room, bins) for room, own in sorted(open_bins.items()) for bins in own]


def plan(histogram: dict[int, int], lengths: tuple[int, ...] = LENGTHS, cost=sequence_cost) -> tuple[float, list[tuple[int, Bins]]]:
    """The least-cost plan for a histogram of piece lengths: its cost, and ``(capacity, bins)``."""
    sizes = sorted(set(lengths))

    def usual(preferred: int):
        return lambda length, left: preferred if length <= preferred else sizes[bisect_left(sizes, length)]

    def cheapest(length: int, left: int) -> int:
        able = sizes[bisect_left(sizes, length) :]
        return min(able, key=lambda c: (cost(c) / (length * min(c // length, left)), c))

    best = None
    for rule in (*map(usual, sizes), cheapest):
        made = []
        for _, bins in _place(histogram, rule):
            held = sum(length * n for length, n in bins.contents)
            made.append((sizes[bisect_left(sizes, held)], bins))
        total = sum(cost(capacity) * bins.count for capacity, bins in made)
        if best is None or total < best[0]:
            best = total, made
    return best


class Slots(NamedTuple):
    """Where the pieces of each length go, in order of ``length * MOST_PIECES + first number``."""

    first: np.ndarray
    each: np.ndarray
    bin_id: np.ndarray
    offset: np.ndarray
    capacity: np.ndarray

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bin, offset and capacity of pieces."""
        wanted = length * MOST_PIECES + number
        at = np.searchsorted(self.first, wanted, "right") - 1
        ahead = wanted - self.first[at]
        return self.bin_id[at] + ahead // self.each[at], self.offset[at] + ahead % self.each[at] * length, self.capacity[at]


def slots(made: list[tuple[int, Bins]]) -> Slots:
    rows, taken, bin_id = [], {}, 0
    for capacity, bins in made:
        offset = 0
        for length, each in bins.contents:
            first = taken.get(length, 0)
            rows.append((length * MOST_PIECES + first, each, bin_id, offset, capacity))
            taken[length] = first + bins.count * each
            offset += length * each
        bin_id += bins.count
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return Slots(*(np.ascontiguousarray(table[:, i]) for i in range(5)))


def _pieces(df: DataFrame, key: str, length: str, largest: int) -> DataFrame:
    """``key, piece, length, part, place``: place counts the pieces of one length in a part."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(largest + 1, np.int64)
        for batch in batches:
            own = batch.column("length").to_numpy()
            order = np.argsort(own, kind="stable")
            ordered = own[order]
            starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(own) else np.zeros(0, np.int64)
            counts = np.diff(np.append(starts, len(own)))
            place = np.empty(len(own), np.int64)
            place[order] = np.arange(len(own)) - np.repeat(starts, counts) + seen[ordered]
            seen[ordered[starts]] += counts
            parts = pa.array(np.full(len(own), part, np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, parts, pa.array(place)], [*batch.schema.names, "part", "place"])

    size = F.greatest(F.coalesce(F.col(length).cast("bigint"), F.lit(0)), F.lit(0))
    rows = df.select(F.col(key).alias("key"), size.alias("size"))
    numbers = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.ceil(F.col("size") / largest) - 1, F.lit(0)))
    cut = rows.select("key", "size", F.explode(numbers).alias("piece"))
    cut = cut.select("key", "piece", F.least(F.lit(largest).cast("bigint"), F.col("size") - F.col("piece") * largest).alias("length"))
    kind = cut.schema["key"].dataType.simpleString()
    return cut.mapInArrow(run, f"key {kind}, piece long, length long, part int, place long")


def pack(
    df: DataFrame, length: str, key: str = "doc_id", lengths: tuple[int, ...] = LENGTHS, cost=sequence_cost
) -> DataFrame:
    """``key, piece, length, bin_id, offset, capacity`` of every piece of every row."""
    held = stored(_pieces(df, key, length, max(lengths)), "pieces")
    counts = stored(held.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    # at most as many entries as the largest permitted length
    histogram = dict(counts.where("length > 0").groupBy("length").agg(F.sum("n")).collect())
    shared = df.sparkSession.sparkContext.broadcast(slots(plan(histogram, lengths, cost)[1]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            size, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            packed = size > 0
            columns = [np.zeros(len(size), np.int64) for _ in range(3)]
            for column, found in zip(columns, own.find(size[packed], number[packed]) if packed.any() else ()):
                column[packed] = found
            found = [pa.array(x, mask=~packed) for x in columns]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), *found], ["key", "piece", "length", "bin_id", "offset", "capacity"]
            )

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    numbered = held.join(shift, ["part", "length"]).select("key", "piece", "length", (F.col("place") + F.col("shift")).alias("number"))
    kind = held.schema["key"].dataType.simpleString()
    out = numbered.mapInArrow(run, f"key {kind}, piece long, length long, bin_id long, offset long, capacity long")
    return out.withColumnRenamed("key", key)


def with_words(df: DataFrame, name: str, text: str = "text") -> DataFrame:
    """The table with the number of words and one end mark of each text (null: no word)."""
    words = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return df.withColumn(name, words.cast("bigint") + 1)


def pack_documents(df: DataFrame, key: str = "doc_id", text: str = "text", lengths: tuple[int, ...] = LENGTHS) -> DataFrame:
    """:func:`pack` of texts by their words."""
    bare = df.select(F.col(key).alias("doc_key"), F.col(text).alias("doc_text"))
    return pack(with_words(bare, "length", "doc_text"), "length", "doc_key", lengths).withColumnRenamed("doc_key", key)
