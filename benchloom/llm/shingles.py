"""Hashes of word shingles, of many texts at once.

The hash of a shingle is the xxh64 of its words with single spaces between them; shingles of one size are hashed
together, step by step.  Words are what white space separates, in lower case (ASCII); a text with fewer words
than a shingle is one shingle, a text without words has none.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from xxhash import xxh64_intdigest

#: Characters of the texts that are worked on together; a single longer text is worked on by itself.
TOGETHER = 1 << 19
#: Byte strings of one size from which on they are hashed together.
SEVERAL = 24
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return x << np.uint64(by) | x >> np.uint64(64 - by)


def _round(state: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _turned(state + lane * _P2, 31) * _P1


def _of_size(lanes: np.ndarray, at: np.ndarray, size: int, seed: int) -> np.ndarray:
    """The xxh64 of the ``size`` bytes at each of some places; ``lanes`` are the eight bytes at every place."""
    place, start = 0, np.full(len(at), seed, np.uint64)
    if size >= 32:
        states = [start + _P1 + _P2, start + _P2, start, start - _P1]
        while size - place >= 32:
            states = [_round(x, lanes[at + place + 8 * i]) for i, x in enumerate(states)]
            place += 32
        found = sum(_turned(x, by) for x, by in zip(states, (1, 7, 12, 18)))
        for x in states:
            found = (found ^ _round(np.zeros_like(x), x)) * _P1 + _P4
    else:
        found = start + _P5
    found = found + np.uint64(size)
    while size - place >= 8:
        found = _turned(found ^ _round(np.zeros_like(found), lanes[at + place]), 27) * _P1 + _P4
        place += 8
    if size - place >= 4:
        found = _turned(found ^ (lanes[at + place] & np.uint64(0xFFFFFFFF)) * _P1, 23) * _P2 + _P3
        place += 4
    while place < size:
        found = _turned(found ^ (lanes[at + place] & np.uint64(0xFF)) * _P5, 11) * _P1
        place += 1
    found = (found ^ found >> np.uint64(33)) * _P2
    found = (found ^ found >> np.uint64(29)) * _P3
    return found ^ found >> np.uint64(32)


def hashes_of(data: bytes, starts: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    """The xxh64 of each of some parts of a byte string."""
    found = np.zeros(len(starts), np.uint64)
    if not len(starts):
        return found
    order = np.argsort(sizes, kind="stable")
    own, cuts, counts = np.unique(sizes[order], return_index=True, return_counts=True)
    padded = data + bytes(8)
    lanes = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,)).copy()
    for size, a, n in zip(own.tolist(), cuts.tolist(), counts.tolist()):
        which = order[a : a + n]
        if n < SEVERAL:
            found[which] = [xxh64_intdigest(data[x : x + size], seed) for x in starts[which].tolist()]
        else:
            found[which] = _of_size(lanes, starts[which], size, seed)
    return found


class Worded(NamedTuple):
    """Words of texts, each with a space behind it, and where they start; ``first`` is the first one of each text, one more for the end."""

    data: bytes
    starts: np.ndarray
    first: np.ndarray

    def hashes(self, shingle: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all shingles, and where those of each text start, one more for the end."""
        words = np.diff(self.first)
        counts = np.where(words > 0, np.maximum(words - shingle + 1, 1), 0)
        ends = np.append(0, np.cumsum(counts))
        which = np.arange(ends[-1]) + np.repeat(self.first[:-1] - ends[:-1], counts)
        starts = self.starts[which]
        behind = self.starts[which + np.repeat(np.minimum(words, shingle), counts)]
        return hashes_of(self.data, starts, behind - 1 - starts, seed), ends


def worded(texts: list[str]) -> Worded:
    words = [x.encode("utf-8", "replace").lower().split() for x in texts]
    flat = [w for own in words for w in own]
    starts = np.zeros(len(flat) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, flat), np.int64, len(flat)) + 1, out=starts[1:])
    return Worded(b" ".join(flat) + b" ", starts, np.append(0, np.cumsum([len(x) for x in words])))


def together(texts: list[str], limit: int = TOGETHER) -> Iterator[list[str]]:
    """The texts in groups of about ``limit`` characters."""
    held, size = [], 0
    for x in texts:
        if held and size + len(x) > limit:
            yield held
            held, size = [], 0
        held.append(x)
        size += len(x)
    if held:
        yield held
