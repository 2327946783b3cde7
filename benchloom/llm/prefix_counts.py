"""Exact token counts of every prefix of a text, by dynamic programming over prefixes.

In a byte-pair vocabulary the encoding of a prefix ends in exactly one token, and a sequence of
tokens is an encoding if and only if every two neighbours are the encoding of their own bytes.
So one pass over a word finds, for each end, the only token whose start holds a compatible last
token, and adds one to the count stored there.  Counts at all prefixes follow without encoding any
of them, and with them the answers to "how many tokens has this text" and "how much of it fits".

Texts are cut at single spaces, where the tokenizer always cuts, so a word is computed once however
often it occurs.  Two effects reach across such cuts or back into a prefix and are handled where
they occur: a run of white space is one word as long as nothing follows it, and an apostrophe
suffix is two words until it is complete.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); special strings inside a text are one
token, as the library has it; every text is read whole; rows are independent, so repeated rows, null
keys and extra columns change nothing.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterable, Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from .batches import pieces, texts_of

#: Words whose counts a task remembers; beyond that it forgets all and starts again.
REMEMBERED = 600_000

# White space, and the words, of the tokenizer's splitting rule.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
SPACE_RUN = regex.compile(rf"[{SPACE}]{{2,}}")
# The same class for Arrow's matcher: white space beside a space.
SPACES_MEET = (
    r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "
    r"| [\t-\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
LATE_SUFFIXES = ("'re", "'ve", "'ll")


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PrefixCounter:
    """The vocabulary of one tokenizer and the counting on it."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        letters = _byte_letters()
        special = {x["content"] for x in model["added_tokens"]}
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        raw = {k: bytes(letters[c] for c in k) for k in model["model"]["vocab"] if k not in special}
        self.ids = {raw[k]: v for k, v in model["model"]["vocab"].items() if k in raw}
        # lengths of the tokens that end in given three bytes, longest first; shorter ones fit anywhere
        tails: dict[bytes, set[int]] = {}
        for x in self.ids:
            if len(x) > 2:
                tails.setdefault(x[-3:], {1, 2}).add(len(x))
        self.lengths = {k: tuple(sorted(v, reverse=True)) for k, v in tails.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}  # token: rank of its merge, left part, right part
        for n, pair in enumerate(model["model"]["merges"]):
            a, b = (raw[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            left, right = self.ids[a], self.ids[b]
            self.rank[left, right] = n
            self.made.setdefault(self.ids[a + b], (n, left, right))
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self._pairs: dict[tuple[int, int], bool] = {}
        self._before: tuple[bytes, list[int], list[int]] = (b"", [-1], [0])
        self._words: dict[str, list[int]] = {}
        self._totals: dict[str, int] = {}

    def neighbours(self, a: int, b: int) -> bool:
        """Whether the bytes of two tokens together are encoded as these two tokens.

        Merges are undone from the last to the first.  At each moment the two tokens at the border
        would have merged if their own merge ranks before those that used them up.
        """
        key, used_a, used_b, none = (a, b), 1 << 60, 1 << 60, (-1, -1, -1)
        while True:
            rank = self.rank.get((a, b))
            if rank is not None and rank < used_a and rank <= used_b:
                fits = False
                break
            made_a, made_b = self.made.get(a, none), self.made.get(b, none)
            if made_a[0] > made_b[0]:
                used_a, a = made_a[0], made_a[2]
            elif made_b[0] >= 0:
                used_b, b = made_b[0], made_b[1]
            else:
                fits = True
                break
        if len(self._pairs) >= REMEMBERED:
            self._pairs.clear()
        self._pairs[key] = fits
        return fits

    def word(self, word: str) -> list[int]:
        """Token counts of the character prefixes of one word of the splitting rule."""
        found = self._words.get(word)
        if found is not None:
            return found
        data = word.encode()
        get, fits, pairs, lengths = self.ids.get, self.neighbours, self._pairs.get, self.lengths.get
        # what the word shares with the one before it is already counted: words come in order
        before, last, count = self._before
        shared = len(commonprefix((data, before)))
        last, count = last[: shared + 1], count[: shared + 1]
        for end in range(shared + 1, len(data) + 1):
            for length in lengths(data[end - 3 : end], (2, 1)) if end > 2 else (2, 1):
                start = end - length
                token = get(data[start:end]) if start >= 0 else None
                if token is None:
                    continue
                fit = start == 0 or pairs((last[start], token))
                if fit or (fit is None and fits(last[start], token)):
                    last.append(token)
                    count.append(count[start] + 1)
                    break
        self._before = data, last, count
        if len(count) == len(word) + 1:
            counts = count[1:]
        else:
            counts = [count[i] for i in range(1, len(data) + 1) if i == len(data) or data[i] & 0xC0 != 0x80]
        if word in LATE_SUFFIXES:
            counts[1] = 2
        if len(word) < 64:
            if len(self._words) >= REMEMBERED // 10:
                self._words.clear()
            self._words[word] = counts
        return counts

    def words(self, text: str) -> list[str]:
        # the library decides on letters that newer Unicode versions may have added
        return WORDS.findall(text) if text.isascii() or max(text) < "ɐ" else [
            text[a:b] for _, (a, b) in self.split(text)
        ]

    def ordinary(self, text: str) -> np.ndarray:
        """Counts at all character prefixes of a text without special strings."""
        out, base = [], 0
        for word in self.words(text):
            counts = self.word(word)
            out += [base + x for x in counts] if base else counts
            base += counts[-1]
        for run in SPACE_RUN.finditer(text):
            start = run.start()
            before = out[start - 1] if start else 0
            out[start : run.end()] = [before + x for x in self.word(run.group())]
        return np.asarray(out, np.int64)

    def prefixes(self, text: str) -> np.ndarray:
        """Counts at all character prefixes of any text."""
        out, base, at = [np.zeros(0, np.int64)], 0, 0
        for special in self.special.finditer(text) if self.special else ():
            # until it is complete, a special string is ordinary text
            counts = base + self.ordinary(text[at : special.end()])
            whole = base + self.total(text[at : special.start()])
            base, at = whole + 1, special.end()
            counts[-1] = base
            out.append(counts)
        out.append(base + self.ordinary(text[at:]))
        return np.concatenate(out)

    def total(self, text: str) -> int:
        """Tokens of a text; special strings in it count as ordinary text."""
        return sum(self.word(x)[-1] for x in self.words(text)) if text else 0

    def totals(self, texts: list[str]) -> np.ndarray:
        """Tokens of many texts that are cut off at spaces."""
        known, total = self._totals, self.total
        if len(known) >= REMEMBERED:
            known.clear()
        out = np.empty(len(texts), np.int64)
        for i, x in enumerate(texts):
            n = known.get(x)
            if n is None:
                n = total(x)
                if len(x) < 64:
                    known[x] = n
            out[i] = n
        return out


@functools.lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def count_texts(own: PrefixCounter, texts: pa.Array, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each text, and the characters of its longest prefix of at most ``budget`` tokens."""
    n = len(texts)
    odd = pc.match_substring_regex(texts, SPACES_MEET)
    if own.special:
        odd = pc.or_(odd, pc.match_substring_regex(texts, own.special.pattern))
    odd = odd.to_numpy(zero_copy_only=False)
    parts = pc.split_pattern(texts, " ")
    offsets = parts.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    flat = parts.flatten()
    first = np.zeros(len(flat), bool)
    first[offsets[:-1]] = True
    amounts = np.empty(len(flat), np.int64)
    for mask, lead in ((first, ""), (~first, " ")):
        if not mask.any():
            continue
        coded = flat.filter(pa.array(mask)).dictionary_encode()
        words = coded.dictionary
        order = pc.array_sort_indices(words).to_numpy()  # neighbours in order share their last word
        found = np.empty(len(words), np.int64)
        found[order] = own.totals([lead + x for x in words.take(pa.array(order)).to_pylist()])
        amounts[mask] = found[coded.indices.to_numpy()]
    sums = np.concatenate([[0], np.cumsum(amounts)])
    tokens = sums[offsets[1:]] - sums[offsets[:-1]]
    fit = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    for i in np.flatnonzero(odd):
        counts = own.prefixes(texts[int(i)].as_py())
        tokens[i] = counts[-1] if len(counts) else 0
        within = np.flatnonzero(counts <= budget)
        fit[i] = within[-1] + 1 if len(within) else 0
    for i in np.flatnonzero((tokens > budget) & ~odd):
        own_sums = sums[offsets[i] : offsets[i + 1] + 1] - sums[offsets[i]]
        part = int(np.searchsorted(own_sums, budget, "right")) - 1  # the first part that does not fit whole
        words = flat.slice(offsets[i], part + 1).to_pylist()
        before = sum(map(len, words[:part])) + max(part - 1, 0)
        counts = own_sums[part] + own.ordinary((" " if part else "") + words[part])
        within = np.flatnonzero(counts <= budget)
        fit[i] = before + (within[-1] + 1 if len(within) else 0)
    return tokens, fit


def count_tokens(df: DataFrame, key: str, path: str, text: str = "text", budget: int = 1024) -> DataFrame:
    """``key``, ``n_bytes``, ``n_tokens`` and ``fit_chars`` of every row.

    ``fit_chars`` is the length in characters of the longest prefix with at most ``budget`` tokens.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for piece in pieces(batches, "text"):
            texts = texts_of(piece, "text")
            tokens, fit = count_texts(own, texts, budget)
            size = pc.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), size, pa.array(tokens), pa.array(fit)], ["key", "n_bytes", "n_tokens", "fit_chars"]
            )

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInArrow(run, f"key {kind}, n_bytes long, n_tokens long, fit_chars long")
    return out.withColumnRenamed("key", key)


def prefix_profile(df: DataFrame, key: str, path: str, text: str = "text") -> DataFrame:
    """``key`` and ``prefix_counts``: the token count of every character prefix, shortest first.

    With it ``element_at(prefix_counts, n)`` is the count of the first ``n`` characters, and
    :func:`fits` the length that a budget leaves.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for piece in pieces(batches, "text", 1 << 20):
            counts = [own.prefixes(x).astype(np.int32) for x in texts_of(piece, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(counts, pa.list_(pa.int32()))], ["key", "prefix_counts"]
            )

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, prefix_counts array<int>").withColumnRenamed("key", key)


def fits(prefix_counts, budget: int):
    """The characters of the longest prefix within the budget, from a stored profile."""
    return F.greatest(F.array_max(F.transform(prefix_counts, lambda n, i: F.when(n <= budget, i + 1))), F.lit(0))
