"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

A text starts as single characters; an agenda holds the merges that neighbouring symbols allow, best
score first, leftmost first among equals.  Each merge that is taken from the agenda is skipped with
probability ``dropout``, decided by a hash keyed with the seed, the variant, the word and the span it
would make, so the same text is cut the same way in every run and on every executor, and differently
under another seed or variant.  A skipped merge stays skipped unless one of its neighbours changes.
With ``dropout`` 0 the result is the library's own encoding.

No piece of such a vocabulary holds a word mark behind another letter, so a text is cut before spaces, and
before the punctuation that no piece holds behind a letter; each different word is worked out once per
variant.  The variant of a row follows from its key.  Where no merge of a word is skipped, the agenda would run as the
library does: which merges those are follows from the library's pieces, so such words need no agenda of their own.

Decoding joins the pieces of the ids: it gives back every text unchanged, also one that holds the word
mark itself (which is spelled in bytes here).

Defined cases: a null text counts as empty; an empty text has no ids and decodes to an empty text; rows
are independent, so repeated rows with one key are cut alike, and other columns change nothing; texts
of any length are read whole.
"""

from __future__ import annotations

import functools
import re
from array import array
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F
from sentencepiece import SentencePieceProcessor
from xxhash import xxh64_intdigest

from .batches import pieces, ranges, texts_of

MARK = "▁"
#: Stands for a word mark that is a letter of the text; no piece holds it.
ESCAPED = "\0\0"
DROPOUT = 0.1
SEED = 13
VARIANTS = 4
#: Words whose ids a task remembers; beyond that it forgets all and starts again.
REMEMBERED = 600_000
#: Odd constants that spread a span over 64 bits and mix it with the hash of a word.
SPREAD, MIX, ALL = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, (1 << 64) - 1
WORDS = re.compile(r" *[^ \n]+| +|\n")


def _word_hash(word: str, seed: int, variant: int) -> int:
    return xxh64_intdigest(word.encode(), (seed << 8 | variant) & ALL)


class Pieces:
    """The vocabulary of one model file (byte-pair pieces with byte fallback)."""

    def __init__(self, path: str) -> None:
        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        special = [model.is_control(i) or model.is_unknown(i) for i in range(size)]
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in range(size) if model.is_byte(i)}
        byte_of = {i: bytes([b]) for b, i in self.bytes.items()}
        names = [model.id_to_piece(i) for i in range(size)]
        self.ids = {x: i for i, x in enumerate(names) if i not in byte_of and not special[i]}
        # equal scores have one rank
        scores = sorted({model.get_score(i) for i in self.ids.values()}, reverse=True)
        place = {score: r for r, score in enumerate(scores)}
        self.rank = {x: place[model.get_score(i)] for x, i in self.ids.items()}
        surfaces = [byte_of.get(i, b"" if special[i] else names[i].replace(MARK, " ").encode()) for i in range(size)]
        self.flat = np.frombuffer(b"".join(surfaces), np.uint8)
        self.sizes = np.array([len(x) for x in surfaces], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        joined = set(regex.findall(r"(?<=\pL)[!-/:-@]", "\n".join(self.ids)))
        cuts = [c for c in map(chr, [*range(33, 48), *range(58, 65)]) if c not in joined]
        self.cut = r"(\pL)([" + "".join("\\" + c for c in cuts) + "])" if cuts else None
        self._known: dict[tuple, bytes] = {}

        # how the library makes each piece out of its characters: one (place, size) per merge
        traces: list[list[tuple[int, int]]] = [[] for _ in range(size)]
        for x, i in self.ids.items():
            self.segment(x.replace(MARK, " "), trace=traces[i])
        self.model = model
        self.letters = np.zeros(size, np.int64)
        for x, i in self.ids.items():
            self.letters[i] = len(x)
        self.merges = np.array([len(x) for x in traces], np.int64)
        self.first_merge = np.cumsum(self.merges) - self.merges
        self.merge_at, self.merge_size = np.array([m for x in traces for m in x], np.int64).reshape(-1, 2).T

    def segment(self, word: str, dropout: float = 0.0, seed: int = SEED, variant: int = 0, trace: list | None = None) -> list[int]:
        """The ids of one word; spaces in it are word marks.  ``trace`` gets the merges that are made."""
        symbols: list = [ESCAPED if c == MARK else c for c in word] if MARK in word else list(word)
        symbols = [MARK if c == " " else c for c in symbols] if " " in word else symbols
        n, rank = len(symbols), self.rank.get
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # an entry of the agenda is a rank and, behind it, the place of the left part
        agenda = [r * n + i for i, r in enumerate(map(rank, map(add, symbols, symbols[1:]))) if r is not None]
        heapify(agenda)
        limit = int(dropout * 2**64)
        key = _word_hash(word, seed, variant) if limit else 0
        while agenda:
            r, i = divmod(heappop(agenda), n)
            left, j = symbols[i], following[i]
            if left is None or j >= n:
                continue
            merged = left + symbols[j]
            if rank(merged) != r:
                continue  # one of its parts has changed since
            # the hash of seed, variant and word, mixed with the span
            if limit and (key ^ (i << 16 | len(merged)) * SPREAD & ALL) * MIX & ALL < limit:
                continue
            if trace is not None:
                trace.append((i, len(merged)))
            symbols[i], symbols[j] = merged, None
            following[i] = k = following[j]
            if k < n:
                before[k] = i
                r = rank(merged + symbols[k])
                if r is not None:
                    heappush(agenda, r * n + i)
            h = before[i]
            if h >= 0:
                r = rank(symbols[h] + merged)
                if r is not None:
                    heappush(agenda, r * n + h)
        ids, out = self.ids.get, []
        for x in symbols:
            if x is not None:
                own = ids(x)
                if own is None:
                    out += [self.bytes[b] for b in (MARK if x == ESCAPED else x).encode()]
                else:
                    out.append(own)
        return out

    def _kept_whole(self, words: list[str], dropout: float, seed: int, variant: int) -> list[bytes | None]:
        """The ids of words in which no merge is skipped, which are the library's; None for the others.

        The merges inside a piece are the same in any word, so those of a word are known from its pieces, and the hashes
        of all merges of all words are looked at together.
        """
        found = self.model.encode([x[1:] for x in words], out_type=int, num_threads=1)
        counts = np.array([len(x) for x in found], np.int64)
        ids = np.fromiter(chain.from_iterable(found), np.int64, int(counts.sum()))
        owner, letters = np.repeat(np.arange(len(words)), counts), self.letters[ids]
        ends = np.cumsum(letters)
        total = np.bincount(owner, letters, len(words)).astype(np.int64)
        place = ends - letters - np.repeat(np.cumsum(total) - total, counts)
        # bytes stand for no letters, so their words do not add up
        whole = total == np.array([len(x) for x in words], np.int64)
        merges = self.merges[ids]
        at = ranges(self.first_merge[ids], merges)
        span = (np.repeat(place, merges) + self.merge_at[at]) << 16 | self.merge_size[at]
        owner = np.repeat(owner, merges)
        key = np.fromiter((_word_hash(x, seed, variant) for x in words), np.uint64, len(words))
        mixed = (key[owner] ^ span.astype(np.uint64) * np.uint64(SPREAD)) * np.uint64(MIX)
        whole[owner[mixed < np.uint64(int(dropout * 2**64))]] = False
        flat, cuts = ids.astype("<u4").tobytes(), (np.cumsum(counts) * 4).tolist()
        return [flat[a:b] if kept else None for a, b, kept in zip([0, *cuts], cuts, whole.tolist())]

    def words(self, words: list[str], dropout: float, seed: int, variant: int) -> list[bytes]:
        """The ids of many words, as bytes of unsigned 32-bit integers."""
        known, own = self._known, (dropout, seed, variant)
        if len(known) > REMEMBERED:
            known.clear()
        out = [known.get((own, x)) for x in words]
        if 0 < dropout < 1:
            # the library puts a mark before a text, so it takes words that begin with one
            new = [i for i, (x, ids) in enumerate(zip(words, out)) if ids is None and x[:1] == " " and len(x) < 1000 and MARK not in x]
            for i, ids in zip(new, self._kept_whole([words[i] for i in new], *own) if new else ()):
                out[i] = ids
        for i, x in enumerate(words):
            if out[i] is None:
                out[i] = array("I", self.segment(x, dropout, seed, variant)).tobytes()
            if len(x) < 32:
                known[own, x] = out[i]
        return out

    def encode(self, texts: pa.Array, dropout: float, seed: int, variant: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many belong to each text."""
        odd = pc.or_(pc.match_substring(texts, "  "), pc.match_substring(texts, MARK))
        odd = pc.or_(odd, pc.match_substring_regex(texts, "\\A[ \n]|\\A\\z|\\x00")).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), pa.scalar("", pa.large_string()), texts)
        # a null character marks a part that no space comes before
        plain = pc.replace_substring(plain, "\n", " \n")
        plain = pc.replace_substring_regex(plain, self.cut, "\\1 \0\\2") if self.cut else plain
        split = pc.split_pattern(plain, " ")
        offsets = split.offsets.to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        words = [x if x[:1] == "\n" else x[1:] if x[:1] == "\0" else " " + x for x in coded.dictionary.to_pylist()]
        found = self.words(words, dropout, seed, variant)
        sizes = np.array([len(x) >> 2 for x in found], np.int64)
        starts = np.cumsum(sizes) - sizes
        ids = np.frombuffer(b"".join(found), "<u4")[ranges(starts[codes], sizes[codes])]
        sums = np.concatenate([[0], np.cumsum(sizes[codes])])
        counts = np.diff(sums[offsets - offsets[0]])
        if odd.any():
            cuts = np.split(ids, np.cumsum(counts)[:-1])
            for i in np.flatnonzero(odd):
                text = texts[int(i)].as_py()
                own = self.words(WORDS.findall(" " + text), dropout, seed, variant) if text else []
                cuts[i] = np.frombuffer(b"".join(own), "<u4")
            ids, counts = np.concatenate(cuts), np.array([len(x) for x in cuts], np.int64)
        return ids, counts

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The texts that runs of ids spell, in UTF-8, without the space in front of the first word."""
        joined = self.flat[ranges(self.starts[ids], self.sizes[ids])].tobytes()
        ends = np.concatenate([[0], np.cumsum(self.sizes[ids])])[np.cumsum(counts)].tolist()
        return [joined[a + 1 : b] for a, b in zip([0, *ends], ends)]


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Pieces:
    return Pieces(path)


def encode(
    df: DataFrame, path: str, key: str = "doc_id", text: str = "text", dropout: float = DROPOUT, seed: int = SEED,
    variants: int = VARIANTS,
) -> DataFrame:
    """``key, variant, n_tokens, ids, lossless`` of every row.

    ``ids`` holds unsigned little-endian integers of 16 bits, or of 32 for a vocabulary that needs them
    (see :func:`id_bytes`).  ``lossless`` says whether decoding them gave the text back.
    """
    width = id_bytes(path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(path)
        for piece in pieces(batches, "text"):
            which = piece.column("variant").to_numpy()
            for variant in np.unique(which):
                part = piece.filter(pa.array(which == variant))
                texts = texts_of(part, "text")
                ids, counts = own.encode(texts, dropout, seed, int(variant))
                same = [x == y for x, y in zip(own.decode(ids, counts), texts.cast(pa.large_binary()).to_pylist())]
                flat = pa.py_buffer(np.ascontiguousarray(ids, f"<u{width}"))
                ends = pa.py_buffer(np.concatenate([[0], np.cumsum(counts) * width]).astype(np.int32))
                cells = pa.Array.from_buffers(pa.binary(), len(counts), [None, ends, flat])
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("variant"), pa.array(counts), cells, pa.array(same)],
                    ["key", "variant", "n_tokens", "ids", "lossless"],
                )

    # null keys share variant 0 of the hash of nothing
    variant = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(seed)), F.lit(variants)).cast("int")
    rows = df.select(F.col(key).alias("key"), variant.alias("variant"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInArrow(run, f"key {kind}, variant int, n_tokens long, ids binary, lossless boolean")
    return out.withColumnRenamed("key", key)


def id_bytes(path: str) -> int:
    """Bytes of one id in the ``ids`` of a model."""
    return 2 if SentencePieceProcessor(model_file=path).get_piece_size() <= 1 << 16 else 4


def decode(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key, text`` of rows of ids as :func:`encode` makes them; null ids count as none."""
    width = id_bytes(path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(path)
        for piece in pieces(batches, "ids", 1 << 20):
            cells = [x or b"" for x in piece.column("ids").to_pylist()]
            flat = np.frombuffer(b"".join(cells), f"<u{width}").astype(np.int64)
            counts = np.array([len(x) // width for x in cells], np.int64)
            texts = [x.decode() for x in own.decode(flat, counts)]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(texts, pa.string())], ["key", "text"])

    rows = df.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)
