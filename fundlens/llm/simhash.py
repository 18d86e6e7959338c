"""SimHash near-duplicates through pivot distance tables.

A text's fingerprint: A-Z in lower case, words between ASCII white space,
3-word shingles with repeats (fewer words: the whole sequence; none:
fingerprint 0), XXH64 of each shingle with seed 42; a bit of the fingerprint is
set if it is set in more than half of the hashes.  Documents link when their
fingerprints differ in at most ``MAX_BITS`` bits.

Equal fingerprints are one node, so copies cost nothing further.  Each node's
Hamming distances to ``PIVOTS`` fixed reference fingerprints are computed once
per task as a table.  By the triangle inequality, two fingerprints within 2
bits differ by at most 2 in every coordinate: pairs are discarded by their
largest coordinate difference, and the survivors verified by their exact
distance.

Which pairs meet at all is settled by the same bound on parts: cut into 4 parts
of 16 bits, two fingerprints within 2 bits agree whole in at least 2 parts, so a
node goes to the 6 buckets of its pairs of parts and every link meets in one.
Buckets above ``BUCKET`` nodes are cut again, in the same way, over the bits
that they do not share (4 parts of 8 bits, then of 4), after which at most 8
bits remain, so no task compares all pairs of a large group and no link is
lost.  Within a task verified pairs are reduced to a spanning forest before they
are returned; ``components`` joins the forests.

A null text counts as empty; empty texts all have fingerprint 0 and form one
group.  A null id is ignored in choosing a component's smallest id (null if
there is no other).  Texts are taken whole whatever their length.  Rows repeated
whole and texts of one fingerprint are one component; of rows with equal ids the
one with the smallest row hash stays.  An empty table gives an empty result.
Columns whose names clash with those used inside keep their names and values.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fundlens.llm.batches import LOWER, chunks, release, text_buffer, word_spans
from fundlens.llm.components import components
from fundlens.llm.frames import small_batches, stored

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: Reference fingerprints.
PIVOTS = 16
#: Shingles hashed at once.
SLICE = 1 << 16
#: Nodes of a bucket that are compared directly.
BUCKET = 1024


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The words, joined by single spaces, and where each starts."""
    length = ends - starts
    to = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(length + 1, out=to[1:])
    out = np.full(to[-1], ord(" "), np.uint8)
    at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    out[at + np.repeat(to[:-1], length)] = LOWER[data[at + np.repeat(starts, length)]]
    return out.tobytes(), to


def fingerprints(texts: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """The 64-bit SimHash of every text.  Shingles are hashed and counted
    ``SLICE`` at a time, so memory is a few bytes per byte of text."""
    data, offsets = text_buffer(texts)
    starts, ends, rows = word_spans(data, offsets)
    count = np.bincount(rows, minlength=len(texts))
    last_word = np.cumsum(count) - 1
    shingles = np.maximum(count - shingle + 1, np.minimum(count, 1))
    votes = np.zeros((len(texts), 64), np.int64)
    digest = xxhash.xxh64_intdigest
    for low in range(0, len(starts), SLICE):
        high = min(low + SLICE, len(starts))
        reach = min(high + shingle - 1, len(starts))
        joined, to = _joined(data, starts[low:reach], ends[low:reach])
        # shingle i: from word i to word i + shingle - 1, or to the row's last
        row, word = rows[low:high], np.arange(low, high)
        final = np.minimum(word + shingle - 1, last_word[row])
        whole = (word + shingle - 1 <= last_word[row]) | (word == last_word[row] - count[row] + 1)
        first, end = to[word[whole] - low], to[final[whole] - low + 1] - 1
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(first.tolist(), end.tolist(), strict=True)),
                             np.uint64, len(first))
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row = row[whole]
        head = np.flatnonzero(np.diff(row, prepend=-1))
        if len(head):
            votes[row[head]] += np.add.reduceat(bits, head, axis=0, dtype=np.int64)
    majority = 2 * votes > shingles[:, None]
    return np.packbits(majority, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def fingerprint_table(df: DataFrame, text_col: str = "text", keep: list[str] | None = None,
                      shingle: int = SHINGLE) -> DataFrame:
    """Columns ``keep`` of ``df`` with ``fp``, the fingerprint as a signed
    64-bit integer."""
    small_batches(df.sparkSession)
    keep = [] if keep is None else keep
    rows = df.select(*[df[f"`{c}`"] for c in keep], df[text_col].alias("_text"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "_text"):
            fp = pa.array(fingerprints(part.column("_text"), shingle).view(np.int64))
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], fp], [*keep, "fp"])
        release()

    return rows.mapInArrow(run, schema)


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Fixed pseudo-random reference fingerprints."""
    return np.random.default_rng(SEED).integers(0, 1 << 64, n, np.uint64, endpoint=False)


def distance_table(fps: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Hamming distances, one row per reference."""
    return np.bitwise_count(fps[None, :] ^ references[:, None]).astype(np.int8)


def verified_pairs(fps: np.ndarray, bucket: np.ndarray, references: np.ndarray,
                   max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within ``max_bits`` in the same bucket; ``bucket`` is
    sorted.  The i-th neighbours of all nodes are compared at once."""
    table = distance_table(fps, references)
    size = np.bincount(np.unique(bucket, return_inverse=True)[1]) if len(bucket) else np.zeros(0, int)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(bucket)) - 1  # nodes behind in the bucket
    node = np.flatnonzero(left > 0)
    found_a, found_b = [], []
    step = 1
    while len(node):
        a, b = node, node + step
        for coordinate in table:
            near = np.abs(coordinate[a] - coordinate[b]) <= max_bits
            a, b = a[near], b[near]
        near = np.bitwise_count(fps[a] ^ fps[b]) <= max_bits
        found_a.append(a[near])
        found_b.append(b[near])
        step += 1
        node = node[left[node] >= step]
    none = [np.zeros(0, np.int64)]
    return np.concatenate(found_a or none), np.concatenate(found_b or none)


def spanning_forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node reachable from each of ``n`` nodes."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        if np.array_equal(before, root):
            break
    return root


def _masks(level: int) -> list[int]:
    """Bits on which a bucket's nodes agree: of every block of bits still
    free at a level, two of four equal parts."""
    masks = [0]
    for depth in range(level + 1):
        part = 16 >> depth
        out = []
        for mask in masks:
            free = [i for i in range(64) if not mask >> i & 1]
            parts = [free[k * part:(k + 1) * part] for k in range(4)]
            out += [mask | sum(1 << i for p in pair for i in p) for pair in combinations(parts, 2)]
        masks = out
    return masks


def _compare(level: int, max_bits: int, n_pivots: int, limit: int):
    """For ``mapInArrow`` over (mask, value, fp): edges (a, b) of the buckets
    and, as (mask, value, a), the nodes of buckets to be cut again."""
    last = level == 2
    finer = _masks(level + 1) if not last else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [x for x in batches if x.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        mask, value, fp = (table.column(i).to_numpy() for i in range(3))
        order = np.lexsort((fp, value, mask))
        mask, value, fp = mask[order], value[order], fp[order].view(np.uint64)
        new = np.ones(len(fp), bool)
        new[1:] = (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])
        bucket = np.cumsum(new) - 1
        size = np.bincount(bucket)[bucket]
        direct = (size <= limit) | last
        nodes, which = fp[direct], bucket[direct]
        a, b = verified_pairs(nodes, which, pivots(n_pivots), max_bits)
        names, place = np.unique(nodes, return_inverse=True)
        root = spanning_forest(len(names), place[a], place[b])
        tree = np.flatnonzero(root != np.arange(len(names)))
        yield _rows(None, None, names[tree].view(np.int64), names[root[tree]].view(np.int64))
        again = ~direct
        for k in range(6) if again.any() else ():
            number = mask[again].astype(np.int64) * 6 + k
            bits = np.array(finer, np.uint64)[number]
            nodes = fp[again]
            yield _rows(number.astype(np.int32), (nodes & bits).view(np.int64), nodes.view(np.int64), None)
    return run


def _rows(mask, value, a, b) -> pa.RecordBatch:
    n = len(a)
    column = lambda x, kind: pa.nulls(n, kind) if x is None else pa.array(x, kind)
    return pa.RecordBatch.from_arrays([column(mask, pa.int32()), column(value, pa.int64()),
                                       column(a, pa.int64()), column(b, pa.int64())], ["mask", "value", "a", "b"])


def near_edges(nodes: DataFrame, max_bits: int = MAX_BITS, n_pivots: int = PIVOTS,
               limit: int = BUCKET) -> DataFrame:
    """Edges (a, b) that connect every two fingerprints of ``nodes`` (``fp``,
    distinct) within ``max_bits`` (at most 2), directly or over others."""
    if not 0 <= max_bits <= 2:
        raise ValueError("two of four parts agree only up to 2 bits")
    edges = None
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("mask"),
                                        F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("value"))
                               for i, m in enumerate(_masks(0))])).alias("key")
    rows = nodes.select(keys, "fp").select("key.mask", "key.value", "fp")
    for level in range(3):
        dealt = rows.repartition("mask", "value")
        out = stored(dealt.mapInArrow(_compare(level, max_bits, n_pivots, limit),
                                      "mask int, value long, a long, b long"), "near")
        found = out.where("b is not null").select("a", "b")
        edges = found if edges is None else edges.union(found)
        rows = out.where("b is null").select("mask", "value", F.col("a").alias("fp"))
        if rows.isEmpty():
            break
    return edges


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS, **options) -> DataFrame:
    """One row per row of ``df``: its id, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id reachable over links."""
    rows = stored(fingerprint_table(df.select(df[id_col].alias("id"), df[text_col].alias("text")),
                                    "text", ["id"], shingle), "fingerprints")
    groups = _components(rows, max_bits, options)
    return rows.join(groups, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("least").alias("component_id"))


def _components(rows: DataFrame, max_bits: int, options: dict) -> DataFrame:
    """``fp``, ``component`` (its smallest fingerprint) and ``least`` (its
    smallest id) per distinct fingerprint of ``rows`` (id, fp)."""
    nodes = stored(rows.groupBy("fp").agg(F.min("id").alias("id")), "nodes")
    member = components(near_edges(nodes.select("fp"), max_bits, **options))
    known = nodes.join(member, F.col("fp") == F.col("node"), "left") \
        .select("fp", "id", F.coalesce("component", "fp").alias("component"))
    least = known.groupBy("component").agg(F.min("id").alias("least"))
    return known.join(least, "component").select("fp", "component", "least")


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = SHINGLE, max_bits: int = MAX_BITS, **options) -> DataFrame:
    """One row of each component, with the columns of ``df``: the one with
    the smallest id (null last), then the smallest row hash."""
    hashed = [df[f"`{f.name}`"] for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    tie = F.xxhash64(*hashed)
    compact = df.select(df[id_col].alias("id"), tie.alias("tie"), df[text_col].alias("text"))
    rows = stored(fingerprint_table(compact, "text", ["id", "tie"], shingle), "fingerprints")
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", "tie")
    stays = (rows.join(_components(rows, max_bits, options), "fp").groupBy("component")
             .agg(F.min(rank).alias("best")).select("best.id", "best.tie"))
    whole = df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"),
                      df[id_col].alias("key"), tie.alias("hash"))
    found = whole.join(stays, F.col("key").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("tie")), "left_semi")
    first = F.row_number().over(Window.partitionBy("key", "hash").orderBy("hash"))
    return found.withColumn("place", first).where("place = 1").select("row.*")
