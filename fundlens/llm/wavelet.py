"""Token files: one wavelet matrix per shard.

Documents are encoded (``bpe``), an end id is appended, and the ids are written
in ascending id order of the documents.  A shard is one Parquet file with one
row, written and read by Spark: per bit of an id, from the highest, a bit plane
of the shard's tokens, stably sorted by the bits above; the number of zeros of
each plane; the documents' ids and where they start.  A plane is stored as
blocks of 65,536 bits, compressed one by one, and a directory of the set bits
before every 1,024th place.

``WaveletMatrix`` answers on a shard, from its planes and their directories:
``access`` (the token at a place), ``rank`` (occurrences of a token before a
place), ``count`` and ``select`` (the place of an occurrence), each in one step
per bit, and ``tokens`` (all of them).  A step unpacks only the block it reads,
so an answer needs at most two blocks a plane.

Shards are ranges of the document id, a hash of the document's tokens and the
row's place in the encoded table, so a shard holds about ``shard_tokens`` however
often an id or a whole row repeats; one very long document is never split.
Documents with the same id lie next to each other in the order of that hash; null
ids come last.  A null text counts as empty and has the end id only.  An empty
table gives no shard.  Only the id and text columns are read, so other columns
may have any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundlens.llm import bpe
from fundlens.llm.frames import stored

END_ID = 2
#: Tokens of a shard, about.
SHARD_TOKENS = 1 << 22
#: Bytes of a compressed block, and of a step of the rank directory.
BLOCK = 8192
STEP = 128
#: Tokens handled at once while a plane is split or merged.
CUT = 1 << 15


class Plane:
    """A bit plane in compressed blocks, with its rank directory."""

    def __init__(self, blocks: list[bytes], ranks: np.ndarray):
        """``ranks``: the set bits before every ``STEP`` bytes."""
        self.blocks, self.ranks = blocks, ranks
        self._open: dict[int, np.ndarray] = {}

    @classmethod
    def of(cls, ones: np.ndarray) -> Plane:
        packed = np.packbits(ones, bitorder="little")
        counts = np.bitwise_count(packed)
        sums = np.add.reduceat(counts, np.arange(0, len(counts), STEP), dtype=np.int64) if len(counts) else []
        ranks = np.zeros(len(sums) + 1, np.int64)
        np.cumsum(sums, out=ranks[1:])
        pack = zstandard.ZstdCompressor(level=1).compress
        return cls([pack(packed[i:i + BLOCK]) for i in range(0, len(packed), BLOCK)], ranks)

    def bytes_at(self, step: int) -> np.ndarray:
        """The bytes of one step of the directory."""
        block, place = divmod(step * STEP, BLOCK)
        if block not in self._open:
            self._open[block] = np.frombuffer(zstandard.ZstdDecompressor().decompress(self.blocks[block]), np.uint8)
        return self._open[block][place:place + STEP]

    def bit(self, i: int) -> int:
        step, place = divmod(i, 8 * STEP)
        return int(self.bytes_at(step)[place // 8]) >> (place % 8) & 1

    def ones(self, i: int) -> int:
        """Set bits before place ``i``."""
        step, place = divmod(i, 8 * STEP)
        total = int(self.ranks[step])
        if place:
            part = self.bytes_at(step)
            total += int(np.bitwise_count(part[:place // 8]).sum())
            if place % 8:
                total += (int(part[place // 8]) & (1 << place % 8) - 1).bit_count()
        return total

    def find(self, j: int, one: int) -> int:
        """The place of the j-th set (or clear) bit."""
        before = self.ranks if one else np.arange(len(self.ranks)) * 8 * STEP - self.ranks
        # the directory's last entry is the end, not a step
        step = int(np.searchsorted(before[:-1], j, "right")) - 1
        bits = np.unpackbits(self.bytes_at(step), bitorder="little")
        return step * 8 * STEP + int(np.flatnonzero(bits == one)[j - int(before[step])])

    def whole(self, n: int) -> np.ndarray:
        unpack = zstandard.ZstdDecompressor().decompress
        packed = np.frombuffer(b"".join(map(unpack, self.blocks)), np.uint8)
        return np.unpackbits(packed, count=n, bitorder="little").view(bool)


def _cuts(one: np.ndarray, zeros: int) -> Iterator[tuple[slice, np.ndarray, slice, slice]]:
    """A plane in parts that fit a processor's cache: each part, the places of
    its set bits, and where its set and its clear bits go in the next row."""
    low, high = 0, zeros
    for start in range(0, len(one), CUT):
        part = slice(start, min(start + CUT, len(one)))
        places = np.flatnonzero(one[part])
        ones, clear = len(places), part.stop - start - len(places)
        yield part, places, slice(high, high + ones), slice(low, low + clear)
        low, high = low + clear, high + ones


class WaveletMatrix:
    """Rank, select and access over a sequence of integers below 2**bits."""

    def __init__(self, planes: list[Plane], zeros: list[int], n: int):
        """``planes``: the highest bit's first."""
        self.planes, self.zeros, self.n = planes, zeros, n
        self.bits = len(planes)

    @classmethod
    def build(cls, tokens: np.ndarray, bits: int = 16) -> WaveletMatrix:
        planes, zeros = [], []
        row = tokens
        for k in range(bits):
            one = (row & row.dtype.type(1 << (bits - 1 - k))).astype(bool)
            planes.append(Plane.of(one))
            zeros.append(len(row) - int(np.count_nonzero(one)))
            below = np.empty_like(row)
            for part, places, high, low in _cuts(one, zeros[k]):
                below[high] = row[part][places]
                below[low] = row[part].compress(~one[part])
            row = below
        return cls(planes, zeros, len(tokens))

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        token = 0
        for k, plane in enumerate(self.planes):
            ones, bit = plane.ones(i), plane.bit(i)
            token = token << 1 | bit
            i = self.zeros[k] + ones if bit else i - ones
        return token

    def _range(self, token: int, i: int) -> tuple[int, int]:
        """The last plane's places of the token's occurrences before ``i``."""
        low, high = 0, i
        for k, plane in enumerate(self.planes):
            a, b = plane.ones(low), plane.ones(high)
            if token >> (self.bits - 1 - k) & 1:
                low, high = self.zeros[k] + a, self.zeros[k] + b
            else:
                low, high = low - a, high - b
        return low, high

    def rank(self, token: int, i: int) -> int:
        """Occurrences before place ``i``."""
        if not 0 <= token < 1 << self.bits:
            return 0
        low, high = self._range(token, i)
        return high - low

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, j: int) -> int:
        """The place of occurrence ``j``, counted from 0."""
        if not 0 <= j < self.count(token):
            raise IndexError(j)
        i = self._range(token, self.n)[0] + j
        for k in range(self.bits - 1, -1, -1):
            one = token >> (self.bits - 1 - k) & 1
            i = self.planes[k].find(i - self.zeros[k] if one else i, one)
        return i

    def tokens(self) -> np.ndarray:
        """The whole sequence, by undoing the planes from the last."""
        dtype = np.uint16 if self.bits <= 16 else np.uint32
        row = np.zeros(self.n, dtype)
        for k in range(self.bits - 1, -1, -1):
            one = self.planes[k].whole(self.n)
            row[self.zeros[k]:] |= dtype(1 << (self.bits - 1 - k))
            above = np.empty_like(row)
            for part, places, high, low in _cuts(one, self.zeros[k]):
                above[part][places] = row[high]
                above[part][np.flatnonzero(~one[part])] = row[low]
            row = above
        return row


SHARD = ("shard int, n long, zeros array<long>, planes array<array<binary>>, ranks array<binary>, "
         "doc_ids array<long>, starts array<long>")


def _build(bits: int):
    """For ``mapInArrow`` over a sorted partition (id, ids as bytes): its
    shard, numbered by the partition."""
    def row(shard: int, ids: list, parts: list) -> pa.RecordBatch:
        tokens = np.frombuffer(b"".join(parts), f"<u{bits // 8}")
        lengths = np.array([len(p) for p in parts]) // (bits // 8)
        matrix = WaveletMatrix.build(tokens, bits)
        return pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int32()), "n": pa.array([len(tokens)], pa.int64()),
            "zeros": pa.array([matrix.zeros], pa.list_(pa.int64())),
            "planes": pa.array([[p.blocks for p in matrix.planes]], pa.list_(pa.list_(pa.binary()))),
            "ranks": pa.array([[p.ranks.tobytes() for p in matrix.planes]], pa.list_(pa.binary())),
            "doc_ids": pa.array([ids], pa.list_(pa.int64())),
            "starts": pa.array([np.cumsum(lengths) - lengths], pa.list_(pa.int64()))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts = [], []
        for batch in batches:
            ids += batch.column("id").to_pylist()
            parts += batch.column("ids").to_pylist()
        if parts:
            yield row(TaskContext.get().partitionId(), ids, parts)
    return run


def write_shards(df: DataFrame, tokenizer: str, out: str, id_col: str = "doc_id",
                 text_col: str = "text", end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> str:
    """Encode ``df`` and write its shards to the folder ``out``."""
    coded = bpe.encode(df, tokenizer, text_col, [id_col], packed=True, tail=[end_id]).toDF("id", "ids")
    rows = stored(coded.withColumn("id", F.col("id").cast("long")), "encoded")
    width = bpe.id_bytes(tokenizer)
    total = rows.agg(F.sum(F.length("ids"))).head()[0] or 0
    shards = max(1, -(-total // (width * shard_tokens)))
    # the row's number splits rows that are equal; it follows from the stored files
    order = [F.col("id").asc_nulls_last(), F.col("hash"), F.col("number")]
    (rows.withColumns({"hash": F.xxhash64("ids"), "number": F.monotonically_increasing_id()})
     .repartitionByRange(shards, *order).sortWithinPartitions(*order).select("id", "ids")
     .mapInArrow(_build(8 * width), SHARD).write.parquet(out))
    return out


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD).parquet(path)


def load(row) -> tuple[WaveletMatrix, list, list]:
    """The matrix of a row of ``read_shards``, its documents' ids and starts."""
    planes = [Plane(list(p), np.frombuffer(r, np.int64)) for p, r in zip(row["planes"], row["ranks"], strict=True)]
    return WaveletMatrix(planes, list(row["zeros"]), row["n"]), row["doc_ids"], row["starts"]


def stored_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the shards: ``doc_id``, ``start`` (tokens of all
    documents before it), ``n_tokens`` and ``ids_crc32`` (of its tokens as
    little-endian unsigned 32-bit integers)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                matrix, ids, starts = load(row)
                tokens = memoryview(matrix.tokens().astype("<u4").view(np.uint8))
                ends = [*starts[1:], matrix.n]
                crc = [zlib.crc32(tokens[4 * a:4 * b]) for a, b in zip(starts, ends, strict=True)]
                del matrix, tokens
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([row["shard"]] * len(ids), pa.int32()), "doc_id": pa.array(ids, pa.int64()),
                    "place": pa.array(starts, pa.int64()),
                    "n_tokens": pa.array(np.subtract(ends, starts), pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64())})

    shards = read_shards(spark, path)
    # one row per shard
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = shards.select(F.col("shard").alias("s"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    docs = shards.mapInArrow(run, "shard int, doc_id long, place long, n_tokens long, ids_crc32 long")
    # one number per shard of millions of tokens
    return docs.join(F.broadcast(bases), F.col("shard") == F.col("s")).select(
        "doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
