"""Texts cut into words at byte level, many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD, SPACE, BREAK = 0, 1, 2


def kinds(space: bytes, breaks: bytes = b"") -> np.ndarray:
    """Kind of every byte: part of a word, white space, or a mark that ends a piece of text."""
    table = np.zeros(256, np.uint8)
    table[list(space)] = SPACE
    table[list(breaks)] = BREAK
    return table


# Characters that part words and pieces.
BLANKS = b" \t\n\x0b\x0c\r"
BY_BLANKS = kinds(BLANKS)
BY_PIECES = kinds(b" \t", b".,;:!?\n\x0b\x0c\r")


def slices(batch: pa.RecordBatch, column: str | int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows whose texts have at most ``most_bytes`` together; a longer text comes alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, first = np.cumsum(sizes, dtype=np.int64), 0
    while first < len(sizes):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
        yield batch.slice(first, last - first)
        first = last


def words_of(texts: pa.Array, table: np.ndarray, lower: bool = False) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words as bytes, the text of each and the piece of each; pieces are numbered over all texts.

    The table has to part words or pieces at a line feed, which is put between texts; ``lower`` is for A-Z alone.
    A null text is empty.
    """
    encoded = [(t or "").encode() for t in texts.to_pylist()]
    raw = b"\n".join(encoded)
    letters = np.frombuffer(raw.lower() if lower else raw, np.uint8)
    kind = table[letters]
    inside = kind == WORD
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    body = np.ascontiguousarray(letters[inside])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
    after = np.cumsum([len(t) + 1 for t in encoded])
    return words, np.searchsorted(after, starts, side="right"), np.searchsorted(np.flatnonzero(kind == BREAK), starts)
