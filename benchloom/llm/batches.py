"""Arrow batches inside Python tasks.

A batch that Spark sends holds many rows, whatever their size.  The helpers here cut it
so that the work on one piece is bounded by bytes of text (a single longer text is a piece
of its own), and tell apart the words of all texts of a piece at once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 8 << 20


def pieces(batches: Iterable[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut where ``column`` reaches ``limit`` bytes."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = (np.cumsum(sizes) - sizes) // limit
        cuts = np.flatnonzero(np.diff(group)) + 1
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(int(start), int(end - start))


def texts_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    """A text column in which null is empty, in buffers of its own: some functions misread a slice."""
    texts = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
    return pa.concat_arrays([texts, pa.array([], texts.type)])


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Row and text of every word ``[^\\x20\\x09-\\x0D]+``, in order."""
    parts = pc.ascii_split_whitespace(texts)
    rows = pc.list_parent_indices(parts).to_numpy(zero_copy_only=False)
    flat = parts.flatten()
    there = pc.not_equal(flat, "")
    return rows[there.to_numpy(zero_copy_only=False)], flat.filter(there)


def flat_bytes(values: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated byte strings as one array, and where each of them starts (one more for the end)."""
    values = list(values)
    starts = np.zeros(len(values) + 1, np.int64)
    np.cumsum([len(x) for x in values], out=starts[1:])
    return np.frombuffer(b"".join(values), np.uint8), starts


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ``arange(start, start + length)``."""
    lengths = np.asarray(lengths, np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(np.asarray(starts, np.int64) - (ends - lengths), lengths)
