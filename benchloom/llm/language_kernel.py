"""Language identification with a string kernel.

The kernel of two texts is the number of letter n-grams (n = 1, 2, 3) present in both, divided by the
root of the product of their own numbers.  A bounded sample of labelled texts (``PER_LANGUAGE`` texts of
each language, those with the smallest text hash) gives the landmarks of a Nyström approximation and the
rows of a ridge regression, one language versus the rest.  Prediction takes batches of texts: one matrix
product gives their kernel values with all landmarks, a second one the scores of all languages.

Letters are folded into 63 classes: a to z without case, all others by their code point; everything else
is a border, and runs of it are one.  So the table of n-grams has a fixed size and a text of any length is
reduced to at most that many flags, read from the whole text.

Defined cases: a text that is null or has no letter is ``und`` with score 0, and so is every text if no
row is labelled; repeated rows are predicted alike (and learned once); rows without a language are not
learned from; equal scores go to the language that sorts first; other columns and null keys change nothing;
more than ``MOST_LANGUAGES`` labels are refused, since the driver gets a sample of each (256 labels with 400 texts are some
hundred MB of n-gram numbers; the four languages here take 2 MB).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .batches import pieces, texts_of

CLASSES = 64
GRAMS = CLASSES + CLASSES**2 + CLASSES**3
#: Texts of each language that the model is fitted on, and how many of them are landmarks.
PER_LANGUAGE = 400
LANDMARKS = 32
#: More different labels than this are no languages.
MOST_LANGUAGES = 256
#: The texts of a language are ranked in so many parts first.
PARTS = 64
RIDGE = 1e-3
SHARPNESS = 4.0
UNKNOWN = "und"
#: Texts in one matrix product.
ROWS = 128


def _letter_classes() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        letter = chr(point)
        if letter.isalpha():
            low = letter.lower()
            low = ord(low) if len(low) == 1 else point
            table[point] = low - 96 if 97 <= low <= 122 else 27 + low % 37
    return table


_CLASS_TABLE: list[np.ndarray] = []


class Presence:
    """The n-grams of texts, one after another, with one table of flags."""

    def __init__(self) -> None:
        if not _CLASS_TABLE:
            _CLASS_TABLE.append(_letter_classes())
        self.classes, self.flags = _CLASS_TABLE[0], np.zeros(GRAMS, bool)

    def grams(self, text: str) -> np.ndarray:
        """The different n-grams of a text, ascending; none without a letter."""
        found = self.classes[np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")]
        found = np.concatenate([[0], found, [0]]).astype(np.int32)
        found = found[np.append(True, (found[1:] != 0) | (found[:-1] != 0))]
        if len(found) < 2:
            return np.zeros(0, np.int64)
        two = found[:-1] * CLASSES + found[1:]
        self.flags[found] = True
        self.flags[CLASSES + two] = True
        self.flags[CLASSES + CLASSES**2 + two[:-1] * CLASSES + found[2:]] = True
        out = np.flatnonzero(self.flags)
        self.flags[out] = False
        return out


class KernelModel(NamedTuple):
    languages: list[str]
    column: np.ndarray  # of each n-gram in the landmark table; -1: in no landmark
    landmarks: np.ndarray  # presence, n-grams by landmarks
    norms: np.ndarray
    weights: np.ndarray  # landmarks and a constant by languages

    def kernel(self, grams: list[np.ndarray]) -> np.ndarray:
        """Kernel values of texts with the landmarks."""
        rows = np.zeros((len(grams), len(self.landmarks)), np.float32)
        for i, own in enumerate(grams):
            columns = self.column[own]
            rows[i, columns[columns >= 0]] = 1
        sizes = np.sqrt([max(len(x), 1) for x in grams])
        return (rows @ self.landmarks.astype(np.float32)) / sizes[:, None] / self.norms

    def scores(self, grams: list[np.ndarray]) -> np.ndarray:
        """Scores of texts for all languages; those of a text sum to 1."""
        values = SHARPNESS * (self.kernel(grams) @ self.weights[:-1] + self.weights[-1])
        values = np.exp(values - values.max(axis=1, keepdims=True))
        return values / values.sum(axis=1, keepdims=True)


def fit(grams: list[np.ndarray], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> KernelModel | None:
    """A model of texts in the order in which landmarks are to be taken from each language."""
    languages = sorted(set(labels))
    if not languages:
        return None
    chosen = [i for x in languages for i in [k for k, y in enumerate(labels) if y == x][:landmarks]]
    used = np.unique(np.concatenate([grams[i] for i in chosen]))
    column = np.full(GRAMS, -1, np.int32)
    column[used] = np.arange(len(used))
    presence = np.zeros((len(used), len(chosen)), np.uint8)
    for k, i in enumerate(chosen):
        presence[column[grams[i]], k] = 1
    norms = np.sqrt(presence.sum(axis=0).astype(np.float64))
    bare = KernelModel(languages, column, presence, norms, np.zeros((len(chosen) + 1, len(languages))))
    # Nyström features: kernel values times the inverse root of the landmarks' own kernel matrix
    own = presence.astype(np.float32).T @ presence.astype(np.float32) / norms[:, None] / norms
    values, vectors = np.linalg.eigh(own.astype(np.float64))
    kept = values > 1e-6 * values.max()
    root = vectors[:, kept] / np.sqrt(values[kept])
    batches = [bare.kernel(grams[i : i + ROWS]) for i in range(0, len(grams), ROWS)]
    features = np.concatenate(batches) @ root
    target = np.where(np.array(labels)[:, None] == np.array(languages), 1.0, -1.0)
    middle, mean = features.mean(axis=0), target.mean(axis=0)
    centred = features - middle
    inner = centred.T @ centred + ridge * len(grams) * np.eye(centred.shape[1])
    weights = np.linalg.solve(inner, centred.T @ (target - mean))
    return bare._replace(weights=np.vstack([root @ weights, mean - middle @ weights]))


def train(df: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> KernelModel | None:
    """Fit on ``per_language`` texts of each language; None if no row has both text and language.

    The driver gets the n-gram numbers of that sample, nothing else.
    """
    rows = df.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    rows = rows.withColumn("h", F.xxhash64("text"))
    if len(rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect()) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    # a language may have a third of all rows: the first of each of its parts, then the first of those
    part = Window.partitionBy("lang", F.pmod("h", F.lit(PARTS))).orderBy("h")
    first = Window.partitionBy("lang").orderBy("h")
    chosen = rows.groupBy("lang", "h").agg(F.count("*").alias("n"))
    for window in (part, first):
        chosen = chosen.withColumn("place", F.row_number().over(window)).where(F.col("place") <= per_language)
    chosen = chosen.select("lang", "h", "place")
    # at most per_language * MOST_LANGUAGES narrow rows
    sample = rows.join(F.broadcast(chosen), ["lang", "h"]).dropDuplicates(["lang", "h"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Presence()
        for piece in pieces(batches, "text"):
            found = [own.grams(x).astype(np.int32) for x in texts_of(piece, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column("lang"), piece.column("place"), pa.array(found, pa.list_(pa.int32()))], ["lang", "place", "grams"]
            )

    counted = sample.select("lang", "place", "text").mapInArrow(run, "lang string, place int, grams array<int>")
    found = sorted((x for x in counted.collect() if x["grams"]), key=lambda x: (x["lang"], x["place"]))
    return fit([np.array(x["grams"], np.int64) for x in found], [x["lang"] for x in found])


def _judge(model: KernelModel | None, texts: list[str], own: Presence) -> tuple[np.ndarray, np.ndarray]:
    """The best language and its score, for each text."""
    best, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
    if model is None:
        return best, score
    languages = np.array(model.languages, object)
    for at in range(0, len(texts), ROWS):
        grams = [own.grams(x) for x in texts[at : at + ROWS]]
        there = [i for i, x in enumerate(grams) if len(x)]
        if there:
            scores = model.scores([grams[i] for i in there])
            places = np.array(there) + at
            best[places] = languages[scores.argmax(axis=1)]
            score[places] = scores.max(axis=1)
    return best, score


def predict(df: DataFrame, model: KernelModel | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score`` of every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # at most GRAMS flags for each landmark

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Presence()
        for piece in pieces(batches, "text"):
            best, score = _judge(shared.value, texts_of(piece, "text").to_pylist(), own)
            columns = [piece.column(0), pa.array(best, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "lang_pred", "score"])

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)


def keep_known(df: DataFrame, model: KernelModel | None, text: str = "text", least: float = 0.3) -> DataFrame:
    """The rows whose text has a language with a score of ``least`` or more, with the columns they came with."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    names = df.columns
    place = names.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Presence()
        for piece in pieces(batches, f"_in{place}"):
            best, score = _judge(shared.value, texts_of(piece, f"_in{place}").to_pylist(), own)
            yield piece.filter(pa.array((best != UNKNOWN) & (score >= least)))

    own_names = df.toDF(*[f"_in{i}" for i in range(len(names))])
    return own_names.mapInArrow(run, own_names.schema).toDF(*names)


def held_out(key: Column, parts: int, part: int = 2) -> Column:
    """Whether the checksum of a key, as text, leaves remainder ``part``; a null key is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == part, F.lit(False))
