"""Removal of repeated passages by a depth-limited radix sort of suffixes.

Texts are UTF-8 bytes.  A window is a byte string of ``length`` inside one
document; each byte covered by a window that also starts earlier (smaller id,
or earlier in the same document) is removed.  Only the first ``length`` bytes of
a suffix matter, so suffixes are sorted to that depth and no further, from the
most significant digit; equal groups are exactly the repeated windows.

The digits, and where each pass runs:

1. *The window's anchor*: its ``ANCHOR``-byte string of least hash, the leftmost
   of equals.  Equal windows have equal anchors at equal places.  Neighbouring
   windows share an anchor, so the pass sorts *segments* (the windows of one
   anchor occurrence, about 3 in 100 bytes) and not suffixes.  It is a shuffle
   by the anchor's hash.
2. *The whole segment*, by its 64-bit hash.  Of equal segments under one anchor
   all but the first are repeats as a whole.  This pass runs in the task before
   the shuffle (so a segment of many copies leaves a block once) and again after
   it.  An anchor with one segment left is finished.
3. *The bytes*: where an anchor has different segments, their windows are sorted
   by 8 bytes a pass, and groups of one leave after each pass.  Anchors with
   more than ``HOT`` different segments are dealt by the hashes of their windows
   instead, equal windows of a block combined first, so no group is gathered in
   one task.

Texts are shuffled once, to *blocks* by a hash of their keys, and each pass goes
over whole blocks.  What passes between blocks is packed and holds no place in a
text: a segment is sent as two hashes and its document's id, and answered with
two bits in the order in which it was sent; the block then finds its segments
again.  Byte ranges are merged and come back packed by block.  So disk holds the
texts once, some 15 bytes a segment, and the bytes of the open segments, however
many of the segments are repeats.

Rows with the same id and the same text are one document, and each gets its
result; different texts with the same id are ordered by a hash of the text, and
null ids come last.  A null text counts as empty; a text shorter than
``length`` keeps all its bytes.  Texts above 1 MiB are sorted in pieces that
overlap by a window.  An empty table gives an empty result.  Only ``id_col``
and ``text_col`` are read, so further columns, whatever their names, change
nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.llm import packing
from fundlens.llm.batches import CHUNK_BYTES, SpanHash, release, text_buffer
from fundlens.llm.frames import small_batches

LENGTH = 100
#: Bytes of an anchor (shorter for windows below 48 bytes).
ANCHOR = 24
#: Different segments of one anchor that one task sorts.
HOT = 1000
#: Text bytes, about, of a block, whose segments are combined before they are shuffled.
BLOCK_BYTES = 8 << 20
#: Text bytes, about, whose segments one shuffle bucket takes.
BUCKET_BYTES = 32 << 20
#: Windows that are sorted at once; bounds the memory of a task.
WINDOWS = 1 << 19

#: A segment in its block: its anchor's hash (40 bits) and its own (64), which together
#: tell equal ones, its document's number in the block, its first window and the windows.
SEGMENT = np.dtype([("h", "<i8"), ("digest", "<u8"), ("doc", "<i4"), ("start", "<i4"), ("n", "<i2")])
_TOP = np.uint64(0xFFFFFFFFFF000000)
_HALF = np.uint64(32)

#: What is known of a segment that its block has sent.
REPEAT, OPEN, HOT_OPEN = 1, 2, 3


def anchor_length(length: int) -> int:
    return max(1, min(ANCHOR, length // 2))


def segments(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Of all windows of a buffer's rows: per segment its row, first window,
    number of windows, anchor place, and the two hashes."""
    k = anchor_length(length)
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    spans = SpanHash(data)
    grams = spans.every(k)
    # hash above, place below: the least is the leftmost of the least hashes
    least = grams & np.uint64(0xFFFFFFFF00000000)
    least |= np.arange(len(grams), dtype=np.uint64)
    width, have = length - k + 1, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:len(least) - step], least[step:])
        have += step
    anchor = least.astype(np.uint32)  # the place
    # windows that end inside their row
    row = np.zeros(len(data), np.int32)
    np.add.at(row, offsets[1:-1][offsets[1:-1] < len(data)], 1)
    np.cumsum(row, out=row)
    inside = row[:len(anchor)] == row[length - 1:]
    new = inside.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    first = np.flatnonzero(new)
    count = np.add.reduceat(inside, first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)
    anchor = anchor[first].astype(np.int64)
    return row[first], first, count, anchor, grams[anchor], spans(first, first + count + (length - 1))


def _dealt(h: np.ndarray) -> np.ndarray:
    """An anchor's hash as it deals: its lower half first, as the upper half is
    the least of many, and so not spread over its range."""
    return ((h << _HALF | h >> _HALF) & _TOP).view(np.int64)


def _order(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """A block's rows in the order of their documents, and the document's
    number for each row."""
    ids, ties = table.column("id").to_numpy(), table.column("tie").to_numpy()
    order = np.lexsort((ties, ids))
    if (order[1:] < order[:-1]).any():
        table, ids, ties = table.take(pa.array(order)), ids[order], ties[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (ties[1:] != ties[:-1])
    return table, np.cumsum(new) - 1


class Block(NamedTuple):
    """A block's documents in their order, each once, and their segments."""

    ids: np.ndarray
    ties: np.ndarray
    data: np.ndarray
    offsets: np.ndarray
    firsts: np.ndarray  #: of each class of equal segments the first, sorted by class
    others: np.ndarray  #: those that repeat one of them

    @classmethod
    def of(cls, table: pa.Table, length: int) -> Block:
        table, doc = _order(table)
        if len(doc) and doc[-1] < len(doc) - 1:  # a document found twice counts once
            table = table.filter(pa.array(np.diff(doc, prepend=-1) > 0))
        data, offsets = text_buffer(table.column("text"))
        held = []
        for a, b in _slices(offsets):
            base, size = offsets[a], offsets[b] - offsets[a]
            step = CHUNK_BYTES if b == a + 1 else size + 1
            for at in range(0, max(size - length + 1, 1), step):
                piece = data[base + at:min(base + at + step + length - 1, offsets[b])]
                places = np.array([0, len(piece)]) if b == a + 1 else offsets[a:b + 1] - base
                row, first, n, _, h, digest = segments(piece, places, length)
                rows = np.empty(len(row), SEGMENT)
                rows["h"], rows["digest"] = _dealt(h), digest
                rows["doc"], rows["start"], rows["n"] = a + row, first + at - places[row], n
                held.append(rows)
        firsts, others = combine(np.concatenate(held) if held else np.zeros(0, SEGMENT))
        return cls(table.column("id").to_numpy(), table.column("tie").to_numpy(), data, offsets, firsts, others)


def _slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows with at most ``CHUNK_BYTES`` bytes together (a longer one alone)."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = min(max(int(np.searchsorted(offsets, offsets[a] + CHUNK_BYTES, "right")) - 1, a + 1), n)
        yield a, b
        a = b


def _differ(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before in any of the columns."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return new


def combine(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of segments in the order of their documents: the first of each class of
    equal ones, sorted by class, and the others, which repeat it whole."""
    rows = rows[np.lexsort((rows["digest"], rows["h"]))]
    new = _differ(rows["h"], rows["digest"])
    return rows[new], rows[~new]


def _ties(block: Block, doc: np.ndarray, clash: bool) -> np.ndarray:
    """Ties go along only where an id has different ones."""
    return block.ties[doc] if clash else np.zeros(0, np.int64)


_SENT = "bucket int, block int, h binary, digest binary, id binary, tie binary"
_ANSWER = "bucket int, block int, bits binary"


def _scan(length: int, bits: int, clash: bool):
    """For whole blocks: their segments, packed by bucket."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        release()  # what the group before has left
        block = Block.of(table, length)
        doc = block.firsts["doc"]
        rows = list(packing.pieces(block.firsts["h"], [
            block.firsts["digest"].copy(), block.ids[doc], *([_ties(block, doc, clash)] if clash else [])], bits))
        names = ["h", "digest", "id"] + ["tie"] * clash
        columns = {name: pa.array([r[i + 1] for r in rows], pa.binary()) for i, name in enumerate(names)}
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()),
                         "block": pa.array([key[0].as_py()] * len(rows), pa.int32()), **columns,
                         **({} if clash else {"tie": pa.nulls(len(rows), pa.binary())})})
    return run


def _settle(hot: int, clash: bool):
    """For whole buckets: to each piece two bits a segment, whether it repeats
    one of a smaller document, or its anchor has different segments."""
    def run(table: pa.Table) -> pa.Table:
        release()
        h = [packing.keys_of(x) for x in table.column("h").to_pylist()]
        cut = np.cumsum([len(x) for x in h])
        h = np.concatenate(h)
        digest, id_ = packing.joined(table, "digest", np.uint64), packing.joined(table, "id", np.int64)
        by = (packing.joined(table, "tie", np.int64), id_) if clash else (id_,)
        order = np.lexsort((*by, digest, h))
        h, digest = h[order], digest[order]
        new = _differ(h, digest)
        anchor = np.cumsum(_differ(h)) - 1
        several = np.bincount(anchor, weights=new)[anchor]
        known = np.empty(len(order), np.uint8)
        known[order] = np.where(~new, REPEAT, np.where(several > hot, HOT_OPEN, np.where(several > 1, OPEN, 0)))
        answers = [np.packbits(np.unpackbits(x[:, None], axis=1)[:, -2:]).tobytes()
                   for x in np.split(known, cut[:-1])]
        return pa.table({"bucket": table.column("bucket"), "block": table.column("block"),
                         "bits": pa.array(answers, pa.binary())})
    return run


def _known(answers: pa.Table, firsts: np.ndarray, bits: int) -> np.ndarray:
    """What the answers tell of a block's segments."""
    told = dict(zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist(), strict=True))
    known = np.zeros(len(firsts), np.uint8)
    for bucket, here in packing.ranges(firsts["h"], bits):
        n = here.stop - here.start
        pair = np.unpackbits(np.frombuffer(told[bucket], np.uint8), count=2 * n).reshape(n, 2)
        known[here] = pair[:, 0] * 2 + pair[:, 1]
    return known


def merged(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges that cover the same bytes and neither meet nor overlap, in order."""
    start, stop = (doc.astype(np.int64) << 32) + start, (doc.astype(np.int64) << 32) + stop
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > stop[:-1]
    head = np.flatnonzero(new)
    start, stop = start[head], stop[np.append(head[1:], len(stop)) - 1] if len(head) else stop
    low = np.int64(0xFFFFFFFF)
    return start >> 32, start & low, stop & low


def _packed_ranges(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> bytes:
    return packing.planes(np.concatenate([doc, start, stop - start]).astype(np.int32))


def _ranges_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = [packing.values(x, np.int32).reshape(3, -1) for x in table.column("ranges").to_pylist() if x]
    doc, start, size = np.concatenate(parts, axis=1) if parts else np.zeros((3, 0), np.int32)
    return doc, start, start + size


#: Rows of ``deal`` below 0 are a block's finished ranges; of even ones, open
#: segments of a bucket; of odd ones, windows under hot anchors.
_FETCHED = ("deal int, block int, ranges binary, h binary, check binary, id binary, tie binary, doc binary, "
            "start binary, size binary, bytes binary")
_FETCHED_NAMES = [x.split()[0] for x in _FETCHED.split(", ")]


def _fetch(length: int, bits: int, clash: bool):
    """For whole blocks with the answers to their segments: the ranges of
    repeated segments, and the bytes of open ones, packed by bucket.  Under hot
    anchors the hashes of windows, dealt by themselves; those that repeat one
    of the block are ranges at once."""
    def run(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        release()
        number, out = key[0].as_py(), {name: [] for name in _FETCHED_NAMES}

        def add(**row) -> None:
            for name in _FETCHED_NAMES:
                out[name].append(row.get(name, number if name == "block" else None))

        def bucket(i: int) -> int:
            return 2 * (i + (1 << (bits - 1)))

        block = Block.of(table, length)
        known = _known(answers, block.firsts, bits)
        gone = np.concatenate([block.others, block.firsts[known == REPEAT]])
        done = [(gone["doc"], gone["start"], gone["start"] + gone["n"] + (length - 1))]
        rows = block.firsts[known == OPEN]
        for i, here in packing.ranges(rows["h"], bits):
            part = rows[here]
            size = part["n"].astype(np.int64) + (length - 1)
            first = block.offsets[part["doc"]] + part["start"]
            add(deal=bucket(i), h=packing.planes(part["h"].copy()), id=packing.planes(block.ids[part["doc"]]),
                tie=packing.planes(_ties(block, part["doc"], clash)), doc=packing.planes(part["doc"].copy()),
                start=packing.planes(part["start"].copy()), size=packing.planes(size.astype(np.int32)),
                bytes=packing.planes(block.data[_places(first, size)]))
        rows = block.firsts[known == HOT_OPEN]
        rows = rows[np.lexsort((rows["start"], rows["doc"]))]
        if len(rows):
            both = SpanHash(block.data), SpanHash(_OTHER[block.data])
        for part in _parts(rows):
            windows = part["n"].astype(np.int64)
            low = _places(part["start"].astype(np.int64), windows)
            doc = np.repeat(part["doc"], windows)
            first = block.offsets[doc] + low
            h, check = (spans(first, first + length).view(np.int64) for spans in both)
            order = np.lexsort((check, h))
            h, check, doc, low = h[order], check[order], doc[order], low[order]
            new = _differ(h, check)
            done.append((doc[~new], low[~new], low[~new] + length))
            h, check, doc, low = h[new], check[new], doc[new], low[new]
            for i, here in packing.ranges(h, bits):
                at = doc[here]
                add(deal=bucket(i) + 1, h=packing.planes(h[here]), check=packing.planes(check[here]),
                    id=packing.planes(block.ids[at]), tie=packing.planes(_ties(block, at, clash)),
                    doc=packing.planes(at), start=packing.planes(low[here].astype(np.int32)))
        ready = merged(*map(np.concatenate, zip(*done, strict=True)))
        if len(ready[0]):
            add(deal=-1 - number, ranges=_packed_ranges(*ready))
        return pa.table({name: pa.array(x, pa.int32() if name in ("deal", "block") else pa.binary())
                         for name, x in out.items()})
    return run


#: Another alphabet, for a second hash of a window.
_OTHER = np.random.default_rng(5).permutation(256).astype(np.uint8)


def _parts(rows: np.ndarray) -> Iterator[np.ndarray]:
    """Segments of some ``WINDOWS`` windows at a time."""
    part = np.cumsum(rows["n"], dtype=np.int64) // WINDOWS
    yield from np.split(rows, np.flatnonzero(np.diff(part)) + 1) if len(rows) else ()


def _places(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``first`` to ``first + size`` of each element, in a row."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)


def equal_windows(data: np.ndarray, starts: np.ndarray, groups: np.ndarray,
                  length: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows at ``starts`` that equal another of their group: their
    indices in sorted order and a number per set of equal ones.  Sorts by 8
    bytes a pass from the first; windows alone in their group leave."""
    index = np.argsort(groups, kind="stable")
    group = groups[index]
    for depth in range(0, length, 8):
        digit = np.zeros(len(index), np.uint64)
        for i in range(depth, min(depth + 8, length)):
            digit = digit << np.uint64(8) | data[starts[index] + i].astype(np.uint64)
        order = np.lexsort((digit, group))
        index, group, digit = index[order], group[order], digit[order]
        new = np.ones(len(index), bool)
        new[1:] = (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])
        number = np.cumsum(new) - 1
        several = np.bincount(number, minlength=1)[number] > 1
        index, group = index[several], number[several]
    return index, group


def _pieces(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> pa.Array:
    offsets = pa.py_buffer(np.append(0, np.cumsum(size)).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(first), [None, offsets, pa.py_buffer(data[_places(first, size)])])


_RANGES = "block int, ranges binary"


def _sort(length: int, clash: bool):
    """For whole buckets of what blocks have fetched: ranges of the windows
    that equal an earlier one, packed by block."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        deal = key[0].as_py()
        if deal < 0:
            return table.select(["block", "ranges"])
        release()

        def column(name: str, kind: type) -> np.ndarray:
            return packing.joined(table, name, kind)

        h, ids, doc, start = (column(*x) for x in (
            ("h", np.int64), ("id", np.int64), ("doc", np.int32), ("start", np.int32)))
        ties = column("tie", np.int64) if clash else np.zeros(len(h), np.int64)
        sent = [len(packing.values(x, np.int32)) for x in table.column("doc").to_pylist()]
        block = np.repeat(table.column("block").to_numpy(), sent)
        if deal % 2:
            parts = [_equal_hashes(h, column("check", np.int64), ids, ties, start)]
        else:
            parts = _equal_bytes(h, column("size", np.int32), column("bytes", np.uint8), ids, ties, start, length)
        found = list(parts)
        which, low = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2
        place, at = np.unique((block[which].astype(np.int64) << 32) + doc[which], return_inverse=True)
        at, low, stop = merged(at, low, low + length)
        of_block, doc = place[at] >> 32, place[at] & np.int64(0xFFFFFFFF)
        head = np.flatnonzero(np.diff(of_block, prepend=-1))
        packed = [_packed_ranges(doc[x], low[x], stop[x])
                  for x in map(slice, head, np.append(head[1:], len(of_block)))]
        return pa.table({"block": pa.array(of_block[head].astype(np.int32)), "ranges": pa.array(packed, pa.binary())})
    return run


def _equal_hashes(h, check, ids, ties, start) -> tuple[np.ndarray, np.ndarray]:
    """Windows under hot anchors that equal one of an earlier place: their
    element and place."""
    order = np.lexsort((start, ties, ids, check, h))
    later = order[~_differ(h[order], check[order])]
    return later, start[later].astype(np.int64)


def _equal_bytes(h, size, data, ids, ties, start, length) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of open segments the windows that equal one of an earlier place: their
    element and place.  Whole anchors are sorted, some windows at a time."""
    offset, windows = np.cumsum(size, dtype=np.int64) - size, size.astype(np.int64) - (length - 1)
    order = np.argsort(h, kind="stable")
    head = np.flatnonzero(_differ(h[order])) if len(h) else np.zeros(0, np.int64)
    before = np.append(0, np.cumsum(windows[order]))[head] // WINDOWS
    for part in np.split(order, head[1:][np.diff(before) > 0]) if len(head) else ():
        which = np.repeat(part, windows[part])
        low = _places(start[part].astype(np.int64), windows[part])
        index, group = equal_windows(data, _places(offset[part], windows[part]), h[which], length)
        which, low = which[index], low[index]
        order_ = np.lexsort((low, ties[which], ids[which], group))
        later = order_[~_differ(group[order_])] if len(group) else order_
        yield which[later], low[later]


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, tie, text): ids as longs, the largest for null; ties tell the texts
    of one id, and null from that id, apart."""
    text = F.coalesce(df[text_col], F.lit(""))
    key = df[id_col].cast("long")
    return df.select(F.coalesce(key, F.lit((1 << 63) - 1)).alias("id"),
                     F.coalesce(F.xxhash64(key.isNull(), text), F.lit(0)).alias("tie"), text.alias("text"),
                     df[id_col].alias("key"))


def _blocks(docs: DataFrame, total: int) -> DataFrame:
    """Documents, equal rows once with their number, dealt to blocks by their
    keys.  Each use of it reads the same one shuffle of the texts."""
    n = max(64, -(-total // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("id", "tie"), F.lit(n)).cast("int")
    return docs.withColumn("block", block).repartition("block").groupBy("block", "id", "tie", "key").agg(
        F.max("text").alias("text"), F.count(F.lit(1)).alias("copies"))


def _repeated(blocks: DataFrame, length: int, hot: int, bits: int, clash: bool) -> DataFrame:
    """Byte ranges that cover exactly the repeated windows, packed by block."""
    sent = blocks.groupBy("block").applyInArrow(_scan(length, bits, clash), _SENT)
    answers = sent.groupBy("bucket").applyInArrow(_settle(hot, clash), _ANSWER)
    fetched = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _fetch(length, bits, clash), _FETCHED)
    return fetched.groupBy("deal").applyInArrow(_sort(length, clash), _RANGES)


def _cover(name: str, copies: str):
    """For whole blocks with their ranges: what is kept of each row."""
    def run(key: tuple, table: pa.Table, ranges: pa.Table) -> pa.Table:
        release()
        table, doc = _order(table)
        whole, bounds = text_buffer(table.column("text"))
        of, low, high = merged(*_ranges_of(ranges))
        cut = np.searchsorted(of, np.arange(len(doc) + 1))  # documents are as many as rows at most
        out = []
        for a, b in _slices(bounds):
            data, offsets = whole[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a]
            several = cut[doc[a:b] + 1] - cut[doc[a:b]]
            here, base = _places(cut[doc[a:b]], several), np.repeat(offsets[:-1], several)
            start, stop = low[here] + base, high[here] + base
            depth = np.bincount(start, minlength=len(data) + 1) - np.bincount(stop, minlength=len(data) + 1)
            gone = np.cumsum(depth[:-1]) > 0
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            begins[start] = gone[start] & (begins[start] | np.isin(start, offsets))
            below = lambda x: np.append(0, np.cumsum(x))[offsets]
            removed, spans = np.diff(below(gone)), np.diff(below(begins))
            size = np.diff(offsets)
            out.append(pa.table([
                table.column("key").slice(a, b - a), table.column("copies").slice(a, b - a),
                pa.array(size), pa.array(removed), pa.array(spans),
                _pieces(data[~gone], np.cumsum(size - removed) - (size - removed), size - removed)],
                [name, copies, "n_bytes", "n_removed", "n_spans", "kept"]))
        return pa.concat_tables(out)
    return run


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """One row per row of ``df``: its id, ``n_bytes``, ``n_removed``,
    ``n_spans`` (runs of removed bytes) and ``kept``, the remaining bytes (not
    always UTF-8, as a range may cut a character)."""
    small_batches(df.sparkSession)
    docs = _keyed(df, id_col, text_col)
    total, clash = docs.groupBy("id").agg(
        F.sum(F.octet_length("text")).alias("size"), (F.min("tie") != F.max("tie")).alias("clash")) \
        .agg(F.sum("size"), F.max("clash")).head()
    bits = max(6, (-(-(total or 0) // BUCKET_BYTES) - 1).bit_length())
    blocks = _blocks(docs, total or 0)
    ranges = _repeated(blocks, length, hot, bits, bool(clash))
    kind = df.schema[id_col].dataType.simpleString()
    name = "copies_" if id_col.lower() == "copies" else "copies"
    whole = blocks.groupBy("block").cogroup(ranges.groupBy("block")).applyInArrow(
        _cover(id_col, name),
        f"`{id_col}` {kind}, {name} long, n_bytes long, n_removed long, n_spans long, kept binary")
    # a row for each of the equal rows
    return whole.select("*", F.explode(F.sequence(F.lit(1), F.col(name)))).select(
        f"`{id_col}`", "n_bytes", "n_removed", "n_spans", "kept")
