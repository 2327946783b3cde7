"""Shingles hashed together have the hashes of shingles hashed one by one."""

import random

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from benchloom.llm import shingle_sets, shingles, simhash_trees

from .odd import ROWS


def test_hashes_of_any_size():
    draw = random.Random(4)
    parts = [draw.randbytes(size) for size in range(140) for _ in range(shingles.SEVERAL + 1)] + [draw.randbytes(100_000)]
    draw.shuffle(parts)
    starts = np.cumsum([0, *map(len, parts)])
    for seed in (0, 42, 2**64 - 1):
        assert shingles.hashes_of(b"".join(parts), starts[:-1], np.diff(starts), seed).tolist() == [xxh64_intdigest(x, seed) for x in parts]


@pytest.mark.parametrize("limit", [1, 1 << 12, 1 << 30])
def test_texts_together(limit):
    draw = random.Random(6)
    texts = [r[1] or "" for r in ROWS] + ["a", "A b", "b\x0ba c\x1cd é É", "\ud800 x y z", "v " * 3000, "x" * 5000 + " y"]
    texts += [" ".join(f"Wörd{draw.randrange(50)}" for _ in range(draw.randrange(700))) for _ in range(60)]
    sets, prints = [], []
    for some in shingles.together(texts, limit):
        words = shingles.worded(some)
        sets += shingle_sets.shingle_sets(words)
        prints += simhash_trees.simhashes(words).tolist()
    for text, own, print_ in zip(texts, sets, prints, strict=True):
        words = text.encode("utf-8", "replace").lower().split()
        of = lambda n: [xxh64_intdigest(b" ".join(words[i : i + n]), 42) for i in range(max(1, len(words) - n + 1))] if words else []
        assert own.tolist() == sorted(set(of(5)))
        assert print_ == sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in of(3)) > len(of(3)))
