"""Token ids in patched frame-of-reference blocks.

``write_tokens`` encodes texts and writes their ids, in ascending key order, as blocks of 1,024 ids.
A block holds its minimum, the differences to it packed at the width that 90 % of them need, and a
list of exceptions with the high bits of the others.  A segment is a run of blocks with an index of
their starts, so a block can be read alone (``read_ids``).  Segments are the binary cells of a
Parquet table: any store that Spark writes to will do, and a lost task leaves no half-written file.

Segment layout, little-endian: ``u32`` magic, ``u32`` ids in a block, ``u64`` ids in all, ``u32``
blocks, ``u64`` start of each block and of the end (counted from the first block); then per block
``u32`` minimum, ``u8`` width, ``u16`` number of exceptions, packed low bits, ``u16`` places and
``u32`` high bits of the exceptions.

Defined cases: a null or empty text has only the end id; null keys sort first; rows with one key
follow each other in order of their text; other columns are ignored; an empty table gives an empty
one; a text of any length is encoded whole and lies in one segment.
"""

from __future__ import annotations

import functools
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from .batches import pieces, ranges, texts_of

MAGIC = 0x31524650
BLOCK = 1024
PERCENT = 90
SEGMENT_IDS = 1 << 16
#: Words whose ids a task remembers; beyond that it forgets all and starts again.
REMEMBERED = 600_000
#: A digit is always a word of its own; words without it are encoded together.
BORDER = "1"
TOGETHER = 2000
#: Bytes of text that are encoded at a time.
PIECE_BYTES = 4 << 20

#: A letter that stays one letter in lower case, before a full stop or comma.
LETTER_STOP = r"([a-z\x{DF}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}])([.,])"

SEGMENTS = "part int, seq int, part_start long, n_ids long, doc_ids array<bigint>, doc_tokens array<bigint>, data binary"


# --- the block format ---------------------------------------------------------------------------


def _bit_length(values: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.int64)


def _pack(rows: np.ndarray, width: int) -> np.ndarray:
    """Rows of values below ``2 ** width`` as rows of bytes, lowest bit first."""
    if width in (8, 16, 32):
        return np.ascontiguousarray(rows.astype(f"<u{width // 8}")).view(np.uint8).reshape(len(rows), -1)
    bits = np.unpackbits(rows.astype("<u4").view(np.uint8).reshape(*rows.shape, 4), axis=2, bitorder="little")
    return np.packbits(bits[:, :, :width].reshape(len(rows), -1), axis=1, bitorder="little")


def _unpack(rows: np.ndarray, width: int, n: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.ascontiguousarray(rows).view(f"<u{width // 8}").astype(np.uint32)
    bits = np.unpackbits(rows, axis=1, bitorder="little", count=n * width).reshape(len(rows), n, width)
    whole = np.zeros((len(rows), n, 32), np.uint8)
    whole[:, :, :width] = bits
    return np.packbits(whole, axis=2, bitorder="little").view("<u4").reshape(len(rows), n)


def _packed_bytes(width: int) -> int:
    return BLOCK * width // 8


def pack_ids(ids: np.ndarray) -> bytes:
    """A segment of unsigned 32-bit ids."""
    n = len(ids)
    n_blocks = -(-n // BLOCK)
    rows = np.empty(n_blocks * BLOCK, np.uint32)
    rows[:n] = ids
    rows[n:] = ids[-1] if n else 0  # a last short block repeats its last id
    rows = rows.reshape(n_blocks, BLOCK)
    base = rows.min(axis=1) if n_blocks else np.zeros(0, np.uint32)
    rest = rows - base[:, None]
    place = min(BLOCK - 1, BLOCK * PERCENT // 100)
    widths = _bit_length(np.partition(rest, place, axis=1)[:, place]) if n_blocks else np.zeros(0, np.int64)
    out: list[bytes] = [b""] * n_blocks
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        own = rest[at].astype(np.uint64)
        high = (own >> np.uint64(width)).astype(np.uint32)
        low = (own & np.uint64((1 << int(width)) - 1)).astype(np.uint32)
        packed = _pack(low, int(width)) if width else np.zeros((len(at), 0), np.uint8)
        for i, block in enumerate(at):
            places = np.flatnonzero(high[i])
            out[block] = b"".join(
                (
                    struct.pack("<IBH", base[block], width, len(places)),
                    packed[i].tobytes(),
                    places.astype("<u2").tobytes(),
                    high[i][places].astype("<u4").tobytes(),
                )
            )
    starts = np.cumsum([0, *map(len, out)]).astype("<u8")
    return b"".join((struct.pack("<IIQI", MAGIC, BLOCK, n, n_blocks), starts.tobytes(), *out))


def read_ids(data: bytes, start: int = 0, end: int | None = None) -> np.ndarray:
    """Ids ``start:end`` of a segment; only the blocks that hold them are read."""
    magic, block, n, n_blocks = struct.unpack_from("<IIQI", data)
    if magic != MAGIC or block != BLOCK:
        raise ValueError("no segment of token blocks")
    end = n if end is None else min(end, n)
    if start >= end:
        return np.zeros(0, np.uint32)
    head = struct.calcsize("<IIQI")
    index = np.frombuffer(data, "<u8", n_blocks + 1, head).astype(np.int64)
    body = head + 8 * (n_blocks + 1)
    first, last = start // BLOCK, -(-end // BLOCK)
    heads = [struct.unpack_from("<IBH", data, body + int(x)) for x in index[first:last]]
    base = np.array([x[0] for x in heads], np.uint32)
    widths = np.array([x[1] for x in heads])
    raw = np.frombuffer(data, np.uint8)
    rows = np.zeros((last - first, BLOCK), np.uint32)
    for width in np.unique(widths[widths > 0]):
        at = np.flatnonzero(widths == width)
        size = _packed_bytes(int(width))
        places = (body + 7 + index[first:last][at])[:, None] + np.arange(size)
        rows[at] = _unpack(raw[places], int(width), BLOCK)
    for i, (_, width, count) in enumerate(heads):
        if count:
            at = body + 7 + int(index[first + i]) + _packed_bytes(width)
            places = np.frombuffer(data, "<u2", count, at)
            high = np.frombuffer(data, "<u4", count, at + 2 * count)
            rows[i, places] |= (high.astype(np.uint64) << np.uint64(width)).astype(np.uint32)
    rows += base[:, None]
    return rows.reshape(-1)[start - first * BLOCK : end - first * BLOCK]


# --- encoding -----------------------------------------------------------------------------------


class WordEncoder:
    """A tokenizer that lower-cases, drops white space and never merges across it.

    Texts are cut at white space, and between a letter and a full stop or comma; each different
    part goes through the library once.  Texts with a special string go there whole.
    """

    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(path)
        self.special = [x.content for x in self.library.get_added_tokens_decoder().values()]
        self.border = self.library.encode(BORDER, add_special_tokens=False).ids[0]
        self._known: dict[str, bytes] = {}

    def _coded(self, words: list[str]) -> dict[str, bytes]:
        """The ids of words, many in one call, told apart by a digit that none of them holds."""
        out, plain = {}, [x for x in words if BORDER not in x]
        joined = [f" {BORDER} ".join(plain[i : i + TOGETHER]) for i in range(0, len(plain), TOGETHER)]
        at = 0
        for found in self.library.encode_batch_fast(joined, add_special_tokens=False):
            ids = np.array(found.ids, "<u4")
            ends = np.append(np.flatnonzero(ids == self.border), len(ids)).tolist()
            raw, start = ids.tobytes(), 0
            for word, end in zip(plain[at : at + TOGETHER], ends):
                out[word] = raw[4 * start : 4 * end]
                start = end + 1
            at += TOGETHER
        others = [x for x in words if BORDER in x]
        for word, found in zip(others, self.library.encode_batch_fast(others, add_special_tokens=False)):
            out[word] = np.array(found.ids, "<u4").tobytes()
        return out

    def _parts(self, parts: list[str]) -> list[bytes]:
        known = self._known
        missing = [x for x in parts if x not in known]
        fresh = self._coded(missing)
        out = [known[x] if x in known else fresh[x] for x in parts]
        if len(known) + len(fresh) > REMEMBERED:
            known.clear()
        known.update((x, y) for x, y in fresh.items() if len(x) < 32)
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many belong to each text."""
        odd = np.zeros(len(texts), bool)
        for x in self.special:
            odd |= pc.match_substring(texts, x[:2]).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), pa.scalar("", pa.large_string()), texts)
        plain = pc.replace_substring(pc.ascii_lower(plain), "\n", " ")
        plain = pc.replace_substring_regex(plain, LETTER_STOP, r"\1 \2")
        split = pc.split_pattern(plain, " ")
        offsets = split.offsets.to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        words = self._parts(coded.dictionary.to_pylist())
        sizes = np.array([len(x) >> 2 for x in words], np.int64)
        flat = np.frombuffer(b"".join(words), "<u4")
        starts = np.cumsum(sizes) - sizes
        ids = flat[ranges(starts[codes], sizes[codes])]
        sums = np.concatenate([[0], np.cumsum(sizes[codes])])
        counts = np.diff(sums[offsets - offsets[0]])
        if odd.any():
            whole = self.library.encode_batch_fast(texts.filter(pa.array(odd)).to_pylist(), add_special_tokens=False)
            cuts = np.split(ids, np.cumsum(counts)[:-1])
            for i, x in zip(np.flatnonzero(odd), whole):
                cuts[i] = np.array(x.ids, np.uint32)
            ids, counts = np.concatenate(cuts), np.array([len(x) for x in cuts], np.int64)
        return ids, counts


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


# --- tables -------------------------------------------------------------------------------------


def write_tokens(
    df: DataFrame, folder: str, path: str, end_id: int, key: str = "doc_id", text: str = "text", parts: int | None = None
) -> None:
    """Encode all texts and write their ids in ascending key order to ``folder``.

    ``parts`` files of about equal numbers of rows (the session's number of shuffle partitions by
    default); the order inside a part and between parts is the order of the keys.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = encoder(path), TaskContext.get().partitionId()
        seq, start = 0, 0
        held_ids, held_docs, held_counts, held = [], [], [], 0

        def segment() -> pa.RecordBatch:
            ids = np.concatenate(held_ids)
            values = [[part], [seq], [start], [len(ids)], [held_docs], [held_counts], [pack_ids(ids)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            names = [x.split()[0] for x in SEGMENTS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)

        for piece in pieces(batches, "text", PIECE_BYTES):
            ids, counts = own.encode(texts_of(piece, "text"))
            ends = np.cumsum(counts)
            # the end id behind each text
            ids = np.insert(ids, ends, np.uint32(end_id))
            counts = counts + 1
            ends = np.cumsum(counts)
            docs, at = piece.column("key").to_pylist(), 0
            while at < len(docs):
                done = int(ends[at - 1]) if at else 0
                upto = max(at + 1, int(np.searchsorted(ends, done + SEGMENT_IDS - held, "right")))
                held_ids.append(ids[done : ends[upto - 1]])
                held_docs += docs[at:upto]
                held_counts += counts[at:upto].tolist()
                held += int(ends[upto - 1]) - done
                if held >= SEGMENT_IDS // 2 or upto < len(docs):
                    yield segment()
                    seq, start = seq + 1, start + held
                    held_ids, held_docs, held_counts, held = [], [], [], 0
                at = upto
        if held_docs:
            yield segment()

    rows = df.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "key").sortWithinPartitions("key", "text")
    ordered.mapInArrow(run, SEGMENTS).write.option("compression", "none").parquet(folder)


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """What a folder holds: ``doc_id, start, n_tokens, ids_crc32`` and, if asked for, ``ids``.

    ``start`` is the number of ids of all rows before this one.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.ascontiguousarray(read_ids(row["data"]), "<u4")
                counts = np.array(row["doc_tokens"], np.int64)
                ends = np.cumsum(counts)
                raw = memoryview(ids).cast("B")
                sums = [zlib.crc32(raw[4 * (e - c) : 4 * e]) for c, e in zip(counts.tolist(), ends.tolist())]
                n = len(counts)
                out = [
                    pa.array([row["part"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["part_start"] + ends - counts), pa.array(counts), pa.array(sums, pa.int64()),
                ]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(out, names)

    names = ["part", "doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    kinds = ["int", "long", "long", "long", "long", "array<bigint>"]
    table = spark.read.schema(SEGMENTS).parquet(folder)
    rows = table.mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
    # one row per part of the folder
    sizes = table.groupBy("part").agg(F.sum("n_ids").alias("_size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    placed = rows.join(shift, "part").withColumn("start", F.col("start") + F.col("_before"))
    return placed.select(*names[1:])
