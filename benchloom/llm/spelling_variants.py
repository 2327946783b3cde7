"""Spelling variants by reduced-alphabet generation.

Letters are hashed to a few symbols, so a word becomes a reduced word of the same length.  Words that
differ by one inserted, deleted or replaced letter have reduced words that are equal or differ by one such
edit, therefore one reduced word lies in the one-edit neighbourhood of the other.  The neighbourhoods are
generated as 64-bit codes, joined with the reduced vocabulary, and each candidate is verified on the original strings.

The neighbourhoods of both words hold each other, so a pair would be met twice.  Each is met once: an
insertion is seen as the deletion from the longer word, a replacement from the smaller symbol upwards, and
equal reduced words in the order of the words.  What is left out on one side is generated on the other.

More symbols mean larger neighbourhoods and fewer words with one reduced word.  Their number follows from
the size of the vocabulary, so that the words per reduced word stay few at any size; it changes the cost
only.  The vocabulary is never gathered: neighbours and words meet in an equi join on a hash, which no text
or word dominates, since each different word is one row.

Defined cases: a null or empty text has no words, a null key counts as an empty string; repeated rows count
again; a word without near words has no form and is its own root; equally frequent near words are settled
by code-point order; words of any length are compared whole; other columns are ignored; an empty table
gives an empty one.
"""

from __future__ import annotations

import math
import string
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .batches import flat_bytes, pieces, ranges, texts_of
from .folders import discard, store, stored

SHORTEST = 7
LEAST = 2
#: A form is this many times as frequent as the variant, at least.
TIMES = 10
#: One word in so many of a document loses a letter (:func:`group_variants`).
EVERY = 31
FEWEST_SYMBOLS = 4
MOST_SYMBOLS = 26

#: The letters are A-Z, a-z and U+00C0 to U+00FF; the latter are this byte and one more.
LEAD = 0xC3
_BYTES = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTES >= ord("A")) & (_BYTES <= ord("Z")), _BYTES + 32, _BYTES)
_LETTER = ((_LOWER >= ord("a")) & (_LOWER <= ord("z"))) | (_BYTES == LEAD)
#: Longer runs are hashed one by one.
HASHED_TOGETHER = 64

#: Factor from one place of a reduced word to the next, and the values of its symbols.
BASE = np.uint64(0x9E3779B97F4A7C15)
VALUES = np.random.default_rng(41).integers(1, 1 << 64, MOST_SYMBOLS, np.uint64)
#: Letters up to which a word is carried by each of its neighbours.
CARRIED = 64
#: Codes that are worked out or sent together, and letters that are read together.
CELLS, PIECE_LETTERS = 1 << 20, 1 << 20


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def crc32_of(state: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The crc32 of byte strings, each carried on from the crc32 of what stands before it."""
    crc = state.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    active, at = np.flatnonzero((sizes > 0) & (sizes <= HASHED_TOGETHER)), 0
    while len(active):
        own = crc[active]
        crc[active] = _CRC[(own ^ data[starts[active] + at]) & 255] ^ (own >> 8)
        at += 1
        active = active[sizes[active] > at]
    crc ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(sizes > HASHED_TOGETHER):
        crc[i] = zlib.crc32(data[starts[i] : starts[i] + sizes[i]].tobytes(), int(state[i]))
    return crc


def _words(keys: list[str | None], texts: pa.Array, shortest: int, every: int) -> pa.Array:
    """The words of a piece with ``shortest`` letters or more, in lower case, some of them without a letter."""
    _, offsets, buffer = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffer, np.uint8)[: offsets[-1]] if buffer else np.zeros(0, np.uint8)
    lead = data == LEAD
    letter = _LETTER[data]
    letter[1:] |= lead[:-1]
    # a run starts where a letter follows none, or a text starts
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1]
    last[:-1] &= ~letter[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    first[inner], last[inner - 1] = letter[inner], letter[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    leads = np.append(0, np.cumsum(lead))
    letters = ends - starts - (leads[ends] - leads[starts])
    long = letters >= shortest
    starts, sizes, letters = starts[long], (ends - starts)[long], letters[long]
    data = _LOWER[data]

    rows = np.searchsorted(offsets, starts, "right") - 1
    prefixes = np.array([zlib.crc32(f"{'' if key is None else key}:".encode()) for key in keys], np.uint32)
    crc = crc32_of(prefixes[rows], data, starts, sizes)
    changed = crc % every == 0
    kept = ~changed
    ends = np.append(0, np.cumsum(sizes[kept]))
    flat = data[ranges(starts[kept], sizes[kept])]
    whole = pa.Array.from_buffers(pa.large_string(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(flat)])
    shorter = []
    for i in np.flatnonzero(changed & (letters > shortest)):
        word = data[starts[i] : starts[i] + sizes[i]].tobytes().decode()
        at = int(crc[i]) % len(word)
        shorter.append(word[:at] + word[at + 1 :])
    return pa.concat_arrays([whole, pa.array(shorter, pa.large_string())])


def vocabulary(
    df: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = SHORTEST, least: int = LEAST, every: int = EVERY
) -> DataFrame:
    """``word, n``: runs of letters in lower case, ``shortest`` or longer and found ``least`` times or more.

    A keyed hash of document and run drops a letter of one run in ``every``.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            words = _words(batch.column("key").to_pylist(), texts_of(batch, "text"), shortest, every)
            counted = words.value_counts()
            yield pa.RecordBatch.from_arrays([counted.field(0), counted.field(1)], ["word", "n"])

    rows = df.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least)


def symbols_for(size: int, shortest: int = SHORTEST) -> int:
    """The fewest symbols that give most words of a vocabulary a reduced word of their own."""
    wanted = math.ceil(max(size, 1) ** (1 / shortest))
    return min(max(wanted, FEWEST_SYMBOLS), MOST_SYMBOLS)


def reduced(word: Column, symbols: int) -> Column:
    """The reduced word: each letter is hashed to one of the first ``symbols`` letters of the alphabet."""
    letters = [*string.ascii_lowercase, *map(chr, range(0xC0, 0x100))]
    hashed = [string.ascii_lowercase[(ord(c) * 2654435761 >> 16) % symbols] for c in letters]
    # whatever is no letter of the runs is one symbol
    known = F.translate(word, "".join(letters), "".join(hashed))
    return F.regexp_replace(known, r"[^a-z]", string.ascii_lowercase[0])


def _places(size: int) -> tuple[np.ndarray, np.uint64]:
    """Powers of an odd number modulo 2^64, one for each place of a word, and its inverse."""
    powers = np.full(size, BASE, np.uint64)
    powers[:1] = 1
    return np.cumprod(powers), np.uint64(pow(int(BASE), -1, 1 << 64))


def near_codes(words: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """The code of each of the reduced words in the rows of a matrix, all of one length, and codes of a half of its neighbourhood.

    The neighbourhood is the word itself, what it is without one of its symbols, and with one raised.  A code is a sum over the symbols,
    so those of the neighbours follow from it; no neighbour is spelled.  A row of codes is sorted and may repeat some.
    """
    powers, inverse = _places(words.shape[1])
    parts = VALUES[words] * powers
    ends = np.cumsum(parts, axis=1)
    own = parts.sum(axis=1, keepdims=True, dtype=np.uint64)
    found = [own, ends - parts + (own - ends) * inverse]
    for symbol in range(1, symbols):
        found.append(np.where(words < symbol, own - parts + VALUES[symbol] * powers, own))
    return own[:, 0].view(np.int64), np.sort(np.concatenate(found, axis=1).view(np.int64), axis=1)


def coded(forms: DataFrame, symbols: int, near: bool) -> DataFrame:
    """``word, own`` of ``word, short``: the code of the reduced word; with ``near`` its neighbours in ``codes``, maybe in several rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "short", PIECE_LETTERS):
            data, starts = flat_bytes(x.encode() for x in batch.column("short").to_pylist())
            sizes = np.diff(starts)
            for size in np.unique(sizes).tolist():
                of_size = np.flatnonzero(sizes == size)
                # matrices of bounded size; a longer word is one by itself
                for at in np.split(of_size, range(0, len(of_size), max(1, CELLS // max(1, size * symbols)))[1:]):
                    words = data[starts[at][:, None] + np.arange(size)] - ord("a")
                    if not near:
                        own = (VALUES[words] * _places(size)[0]).sum(axis=1, dtype=np.uint64).view(np.int64)
                        yield pa.RecordBatch.from_arrays([batch.column("word").take(pa.array(at)), pa.array(own)], ["word", "own"])
                        continue
                    own, codes = near_codes(words, symbols)
                    new = np.ones(codes.shape, bool)
                    new[:, 1:] = codes[:, 1:] != codes[:, :-1]
                    ends, codes = np.cumsum(new.sum(axis=1)), codes[new]
                    if len(at) == 1:
                        cuts = np.append(np.arange(0, len(codes), CELLS), len(codes))
                    else:
                        cuts = np.append(0, ends)
                    for some in np.array_split(np.arange(len(cuts) - 1), max(1, -(-len(codes) // CELLS))):
                        row = np.minimum(some, len(at) - 1)
                        part = codes[cuts[some[0]] : cuts[some[-1] + 1]]
                        lists = pa.ListArray.from_arrays((np.append(cuts[some], cuts[some[-1] + 1]) - cuts[some[0]]).astype(np.int32), part)
                        columns = [batch.column("word").take(pa.array(at[row])), pa.array(own[row]), lists]
                        yield pa.RecordBatch.from_arrays(columns, ["word", "own", "codes"])

    kind = forms.schema["word"].dataType.simpleString()
    return forms.mapInArrow(run, f"word {kind}, own long" + (", codes array<long>" if near else ""))


def _met(near: DataFrame, held: DataFrame, symbols: int) -> DataFrame:
    """``a, b``: the words of ``held`` (word, short) in the neighbourhoods of those of ``near``."""
    around = coded(near, symbols, True).select(F.col("word").alias("a"), "own", F.explode("codes").alias("code"))
    around = around.select("a", "code", (F.col("code") == F.col("own")).alias("same"))
    # equal reduced words meet from both sides
    met = around.join(coded(held, symbols, False).select(F.col("word").alias("b"), F.col("own").alias("code")), "code")
    return met.where(~F.col("same") | (F.col("a") < F.col("b"))).select("a", "b")


def links(words: DataFrame, symbols: int | None = None) -> DataFrame:
    """``a, b``: every pair of different words that are one edit apart, once; ``words`` has ``word``, each once."""
    symbols = symbols or symbols_for(words.count())
    words = words.where("word IS NOT NULL")
    forms = words.select("word", reduced(F.col("word"), symbols).alias("short"))
    size = F.length("word")
    one_edit = F.levenshtein("a", "b", 1) == 1
    found = _met(forms.where(size <= CARRIED), forms.where(size <= CARRIED), symbols).where(one_edit)
    long = words.where(size >= CARRIED).select("word", F.xxhash64("word").alias("id"))
    if long.where(size > CARRIED).isEmpty():
        return found
    # a long word has many neighbours: they carry a number instead of it
    numbered = long.select(F.col("id").alias("word"), reduced(F.col("word"), symbols).alias("short"), size.alias("size"))
    met = _met(numbered.where(F.col("size") > CARRIED).select("word", "short"), numbered.select("word", "short"), symbols)
    for name in ("a", "b"):
        met = met.withColumnRenamed(name, "id").join(long.withColumnRenamed("word", name), "id").drop("id")
    return found.unionByName(met.where(one_edit))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form`` (a word without form has no row): the last of the forms that follow.

    A form is more frequent than its variant, so there is no ring, and chains are short: every round
    doubles the way that a word has gone.
    """
    at, folder = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        gone = at.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        gone, later = store(gone, "roots")
        discard(at.sparkSession, folder)
        at, folder = gone.select("word", "root"), later
        if not gone.where("moved").limit(1).count():
            return at


def variants(words: DataFrame, times: int = TIMES, symbols: int | None = None) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a vocabulary ``word, n``."""
    words = stored(words.select("word", "n"), "vocabulary")
    pairs = stored(links(words, symbols), "variants")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counted = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("near_n")), "b")
    # the most frequent near word; the smallest of equally frequent ones
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("b").alias("word")))
    found = counted.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), best.alias("best"))
    formed = words.join(found, "word", "left").withColumn("able", -F.col("best.n") >= F.lit(times) * F.col("n"))
    chosen = stored(
        formed.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(F.col("able"), F.col("best.word")).alias("form"), F.when(F.col("able"), -F.col("best.n")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(chosen.where("form IS NOT NULL").select("word", "form"))
    rooted = chosen.join(ends, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_variants(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """:func:`variants` of the words of a table of texts."""
    return variants(vocabulary(df, key, text))
