"""Hashes shuffled in packed pieces instead of one row each.

Hashes are 64 bits, so a range of their top bits (a bucket) is an even share of
all distinct ones, whatever the data.  A task sorts what it has gathered and
sends each bucket's slice as one row: differences of the sorted hashes and the
columns beside them, byte plane by byte plane, compressed.  The number of buckets
is chosen from the number of tokens, so that a bucket fits a task at every size of
input.  With very many buckets a piece holds few hashes, and costs up to about
twice the bytes of plain rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Tokens of the corpus for each bucket.
SHARE = 1_500_000
LEAST = 16
#: Keys that a task adds up before it hands them on.
HELD = 1_500_000


def buckets(tokens: int) -> int:
    """Bits of the bucket number for a corpus of this size."""
    return max(-(-tokens // SHARE), LEAST - 1, 1).bit_length()


def planes(values: np.ndarray) -> bytes:
    """The integers' first bytes, then their second bytes, and so on, compressed
    (a byte that takes few values to what it tells); before them their size."""
    if not len(values):
        return b""
    whole = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(whole).to_bytes(8, "little") + pa.compress(whole, "zstd", asbytes=True)


def values(blob: bytes, dtype) -> np.ndarray:
    """The integers of ``planes``."""
    if not blob:
        return np.zeros(0, dtype)
    size = np.dtype(dtype).itemsize
    whole = pa.decompress(memoryview(blob)[8:], int.from_bytes(blob[:8], "little"), "zstd")
    return np.ascontiguousarray(np.frombuffer(whole, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def ranges(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Each bucket that has any of the sorted ``keys``, and its slice of them."""
    half = 1 << (bits - 1)  # the top bits are signed
    bound = np.searchsorted(keys, np.arange(-half, half) << np.int64(64 - bits))
    bound = np.append(bound, len(keys))
    for bucket in np.flatnonzero(bound[1:] > bound[:-1]):
        yield int(bucket) - half, slice(bound[bucket], bound[bucket + 1])


def pieces(keys: np.ndarray, columns: list[np.ndarray], bits: int) -> Iterator[list]:
    """[bucket, packed keys, packed columns...] of each bucket that has any of
    the sorted ``keys``."""
    for bucket, here in ranges(keys, bits):
        gaps = np.diff(keys[here].view(np.uint64), prepend=np.uint64(0))
        yield [bucket, planes(gaps), *[planes(c[here]) for c in columns]]


def keys_of(blob: bytes) -> np.ndarray:
    """The sorted keys of a piece."""
    return np.cumsum(values(blob, np.uint64), dtype=np.uint64).view(np.int64)


def joined(table: pa.Table, name: str, dtype=None) -> np.ndarray:
    """One column of all pieces of a table; keys if there is no type."""
    blobs = table.column(name).to_pylist()
    return np.concatenate([keys_of(b) if dtype is None else values(b, dtype) for b in blobs])


class Gathered:
    """Counted keys of a task, added up until there are too many, then handed
    on as a batch of pieces.  The columns are keys, counts and what depends on
    the key alone; ``pack`` makes pieces with the columns ``names`` of them."""

    def __init__(self, names: list[str], bits: int, limit: int = HELD,
                 pack: Callable[[np.ndarray, list[np.ndarray], int], Iterator[list]] = pieces):
        self.names, self.bits, self.limit, self.pack = names, bits, limit, pack
        self.held, self.size = [], 0

    def add(self, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        self.held.append(columns)
        self.size += len(columns[0])
        if self.size > self.limit:
            self.held = [added(*map(np.concatenate, zip(*self.held, strict=True)))]
            self.size = len(self.held[0][0])
            if self.size > self.limit // 2:
                yield self._batch(self.held[0])
                self.held, self.size = [], 0

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            yield self._batch(added(*map(np.concatenate, zip(*self.held, strict=True))))

    def _batch(self, columns: list[np.ndarray]) -> pa.RecordBatch:
        rows = list(self.pack(columns[0], columns[1:], self.bits))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()),
             *[pa.array([r[i + 1] for r in rows], pa.binary()) for i in range(len(self.names))]],
            ["bucket", *self.names])


def added(keys: np.ndarray, n: np.ndarray, *others: np.ndarray) -> list[np.ndarray]:
    """The distinct keys in order, their counts, and what stands beside them."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return [keys[first], np.add.reduceat(n[order], first, dtype=n.dtype), *[x[order[first]] for x in others]]
