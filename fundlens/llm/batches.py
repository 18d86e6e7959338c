"""Helpers over Arrow batches of texts, for functions run by ``mapInArrow``.

Texts are handled as one UTF-8 byte buffer with row offsets; words are byte
spans in it and are identified by a 64-bit hash, all with numpy, so no Python
object is made per word.  Words are maximal runs without the ASCII white
space characters x20 and x09-x0D (never part of a multi-byte character).
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: The ASCII white space characters that separate words.
SPACES = " \t\n\x0b\x0c\r"

NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[ord(c) for c in SPACES]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

#: Multiplier of the word hash (odd, so it has an inverse modulo 2**64).
_MULT = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULT, -1, 1 << 64)

#: Text bytes handled at once; bounds the memory of a task.
CHUNK_BYTES = 1 << 20


def release() -> None:
    """Give memory that this worker no longer uses back to the system; at the
    end of a task, since workers outlive it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not the GNU library
        pass


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and row offsets; a null text counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str,
           limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with at most ``limit`` text bytes each (a longer
    text comes alone)."""
    for batch in batches:
        _, offsets = text_buffer(batch.column(text))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end byte and row of every word."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = NOT_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class SpanHash:
    """64-bit hashes of byte spans of one buffer, from prefix sums."""

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(_TABLES.get("up", ())) < n:
            size = max(n, CHUNK_BYTES + 1)
            _TABLES["up"], _TABLES["down"] = _powers(_MULT, size), _powers(_INVERSE, size)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(data * _TABLES["up"][:n - 1], dtype=np.uint64, out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * _TABLES["down"][starts]
        return mix(h + (ends - starts).astype(np.uint64))

    def every(self, size: int) -> np.ndarray:
        """The hashes of all spans of ``size`` bytes."""
        h = self.sums[size:] - self.sums[:-size]
        h *= _TABLES["down"][:len(h)]
        h += np.uint64(size)
        return mix(h)


_TABLES: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the SplitMix64 finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def unmix(h: np.ndarray) -> np.ndarray:
    """The inverse of ``mix``."""
    h = h ^ (h >> np.uint64(31)) ^ (h >> np.uint64(62))
    h = h * np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    h = h ^ (h >> np.uint64(27)) ^ (h >> np.uint64(54))
    h = h * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return h ^ (h >> np.uint64(30)) ^ (h >> np.uint64(60))


def row_sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sum of ``values`` per row number below ``n``."""
    return np.bincount(rows, weights=values, minlength=n)
