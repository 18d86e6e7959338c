"""Alignment of two tokenizers' tokens by their bytes.

Side A is a byte-level BPE (a ``tokenizers`` file) over a space and the text,
side B a ``sentencepiece`` model over the text (it adds the space itself); the
strings of special tokens are plain text.  A's entries are decoded byte by byte;
of B's pieces U+2581 is a space and <0xHH> a byte.  Where the joined bytes of
both sides equal the space and the text in UTF-8, each token covers a byte
range.

A batch is aligned at once: every token start finds the other side's token that
covers it, by binary search or, where tokens are empty, by ``pandas.merge_asof``.
Two tokens overlap if and only if one's start lies in the other, so the union of
both directions is all overlaps, the *links*.  Byte offsets where a token of each
side ends cut a document into groups.  Tokens, links and groups end where a word
does, so in texts of words with one space between them a task aligns each word
once (up to ``WORDS`` are kept) and adds up a document's; other texts are aligned
whole.

The tokens are made once: each document's numbers and its links, as id pairs
with their counts, are stored.  Pair counts over the corpus are a sum combined
in tasks; the best count of each B id is one number per entry of B's
vocabulary.  Pairs with at least ``HELD_SHARE`` of all links (so at most
1 / ``HELD_SHARE`` pairs) are broadcast; the others' links are looked up by a
shuffle join, combined per document and pair, with the same results.

Null and empty texts, and texts whose bytes a side does not reproduce, have no
tokens: all numbers are 0 and the digest is ''.  Links that tie for the best
count are all best.  Rows repeated whole are counted and returned each.  A text
is aligned whole, whatever its length, by one task.  An empty table gives an
empty result.  Only ``id_col`` and ``text_col`` are read, so further columns,
whatever their names, change nothing.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import sentencepiece
import tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlens.llm.batches import chunks
from fundlens.llm.bpe import _byte_letters
from fundlens.llm.frames import small_batches, stored

#: Pairs with this share of all links are held by every task.
HELD_SHARE = 5e-7
#: Pieces whose ids side A keeps before it starts anew.
CACHE = 300_000
#: Words that a task keeps aligned, and their characters.
WORDS = 400_000
WORD_CHARS = 16_000_000
#: Links that a task combines before it passes their counts on.
COMBINE_LINKS = 4_000_000

#: Fixed value: the pieces of byte-level vocabularies.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Texts on whose pieces every version of Unicode agrees.
_SETTLED = re.compile("[\t\n\r -~¡-ɏ]*")


class ByteSide(dict):
    """Side A: piece -> its ids as bytes, made on first use."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # bound once: each look at ``tokenizer.model`` makes a new object
        self.tokenize = self.tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.table = dict(enumerate(self.letters))
        back = {c: i for i, c in self.table.items()}
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.bytes = [bytes(back[c] for c in n) if all(c in back for c in n) else n.encode() for n in names]
        pre = self.tokenizer.pre_tokenizer
        #: pieces that their ids do not reproduce
        self.lossy: set[str] = set()
        #: whether pieces may be cut by PIECE: nothing but byte-level cutting
        self.plain = type(pre).__name__ == "ByteLevel" and not pre.add_prefix_space and pre.use_regex \
            and self.tokenizer.normalizer is None

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        plain = piece.encode()
        word = plain.decode("latin-1").translate(self.table)
        ids = [t.id for t in self.tokenize(word)]
        if b"".join([self.bytes[i] for i in ids]) != plain:
            self.lossy.add(piece)
        self[piece] = out = array("i", ids).tobytes()
        return out

    def whole(self, text: str) -> list[int]:
        """The ids of a text as the library gives them."""
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode(self, texts: list[str]) -> list[np.ndarray | None]:
        """The texts' ids; None where their bytes are not the text's."""
        settled = [self.plain and _SETTLED.fullmatch(t) is not None for t in texts]
        others = iter(self.tokenizer.encode_batch_fast([t for t, s in zip(texts, settled, strict=True) if not s],
                                                       add_special_tokens=False))
        out: list[np.ndarray | None] = []
        for text, cut in zip(texts, settled, strict=True):
            if cut:  # pieces cover a text without gaps, and each was compared when it was kept
                pieces = PIECE.findall(text)
                ids = np.frombuffer(b"".join(map(self.__getitem__, pieces)), np.int32)
                out.append(ids if not self.lossy or self.lossy.isdisjoint(pieces) else None)
            else:
                out.append(_same(next(others).ids, self.bytes, text.encode()))
        return out


class PieceSide:
    """Side B."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.vocab_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i)
                              else piece.replace("▁", " ").encode())
        #: whether no piece reaches from a word to the next
        self.by_word = not any(re.search(b"[^ ] ", x) for x in self.bytes)

    def encode(self, texts: list[str]) -> list[np.ndarray | None]:
        """As that of side A."""
        return [_same(x, self.bytes, (" " + t).encode())
                for x, t in zip(self.model.encode(texts, num_threads=1), texts, strict=True)]


def _same(ids: list[int], parts: list[bytes], whole: bytes) -> np.ndarray | None:
    return np.array(ids, np.int32) if b"".join([parts[i] for i in ids]) == whole else None


def covering(starts: np.ndarray, others: np.ndarray, docs: np.ndarray, other_docs: np.ndarray) -> np.ndarray:
    """For each token start the other side's token that covers it: the last
    one of its document that starts no later.  Starts are counted over all
    documents, which have the same bytes on both sides, so without empty tokens
    no start has a covering one in another document."""
    if (starts[1:] > starts[:-1]).all() and (others[1:] > others[:-1]).all():
        return np.searchsorted(others, starts, "right") - 1
    left = pd.DataFrame({"doc": docs, "at": starts})
    right = pd.DataFrame({"doc": other_docs, "at": others, "token": np.arange(len(others))})
    return pd.merge_asof(left, right, on="at", by="doc")["token"].to_numpy()


def align(size_a: np.ndarray, size_b: np.ndarray, doc_a: np.ndarray, doc_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of tokens in document order (each document has the same bytes on both
    sides): the links as two columns of token numbers, and the group of every
    token of each side; groups are numbered over all documents."""
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    start_a, start_b = end_a - size_a, end_b - size_b
    over_a = covering(start_a, start_b, doc_a, doc_b)
    over_b = covering(start_b, start_a, doc_b, doc_a)
    both = start_a[over_b] == start_b  # found from side A already
    links_a = np.concatenate([np.arange(len(size_a)), over_b[~both]])
    links_b = np.concatenate([over_a, np.flatnonzero(~both)])
    ends = np.intersect1d(end_a, end_b, assume_unique=True)
    return (links_a, links_b, np.searchsorted(ends, start_a, "right"), np.searchsorted(ends, start_b, "right"))


class Written:
    """Token ids written in groups: ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, n_a: int, n_b: int):
        self.parts = [np.array([f"{i}{end}" for i in range(n)], object)
                      for n, ends in ((n_a, ",|"), (n_b, ",;")) for end in ends]

    def __call__(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> np.ndarray:
        """The parts in order; token i of side A is part i plus the number of
        side B's tokens in the groups before, and the other way round."""
        out = np.empty(len(a) + len(b), object)
        for ids, group, others, side, mine in ((a, group_a, group_b, "left", 0), (b, group_b, group_a, "right", 2)):
            last = np.append(group[1:] != group[:-1], True)[:len(ids)]
            place = np.arange(len(ids)) + np.searchsorted(others, group, side)
            out[place[~last]] = self.parts[mine][ids[~last]]
            out[place[last]] = self.parts[mine + 1][ids[last]]
        return out


@dataclass
class Table:
    """Aligned texts: ``numbers`` (tokens of each side, groups, links), the
    links as id pairs from ``first`` on, and the groups as written."""
    numbers: np.ndarray
    first: np.ndarray
    pairs: np.ndarray
    written: list[str]

    def add(self, other: Table) -> None:
        self.numbers = np.concatenate([self.numbers, other.numbers])
        self.first = np.append(self.first, other.first[1:] + self.first[-1])
        self.pairs = np.append(self.pairs, other.pairs)
        self.written += other.written

    def head(self, n: int) -> Table:
        return Table(self.numbers[:n].copy(), self.first[:n + 1].copy(), self.pairs[:self.first[n]].copy(), self.written[:n])


class Words(dict):
    """Word -> its place among the words kept, in the order they come in; -1 if
    it is to be aligned within its text only."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []
        self.known = 0

    def __missing__(self, word: str) -> int:
        if word[-1] in "\n\t\r" or not _SETTLED.fullmatch(word):
            return -1
        self[word] = place = self.known + len(self.new)
        self.new.append(word)
        return place


class Aligner:
    """Both sides over texts, with the words aligned so far."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteSide(path_a), PieceSide(path_b)
        self.written = Written(len(self.a.bytes), len(self.b.bytes))
        self.sizes = [np.array([len(x) for x in s.bytes]) for s in (self.a, self.b)]
        self.opens = [np.array([x[:1] == b" " for x in s.bytes]) for s in (self.a, self.b)]
        self.by_word = self.a.plain and self.b.by_word
        self.words, self.table, self.chars = Words(), self.align([]), 0

    def align(self, texts: list[str]) -> Table:
        """A row per text, each after a space; without tokens where a side does
        not give its bytes."""
        none = np.zeros(0, np.int32)
        coded = [(none, none) if x is None or y is None else (x, y)
                 for x, y in zip(self.a.encode([" " + t for t in texts]), self.b.encode(texts), strict=True)]
        return self._table(*(np.concatenate([none, *(x[k] for x in coded)]) for k in (0, 1)),
                           *(np.array([len(x[k]) for x in coded], np.int64) for k in (0, 1)))

    def align_words(self, words: list[str]) -> Table:
        """The same of settled words, encoded at once: a token that opens with
        a space opens a word."""
        text = " ".join(words)
        ids = [np.array(x, np.int32) for x in (self.a.whole(" " + text), self.b.model.encode(text))]
        whole = (" " + text).encode()
        heads = [np.flatnonzero(opens[x]) for opens, x in zip(self.opens, ids, strict=True)]
        if any(len(h) != len(words) or b"".join(map(side.bytes.__getitem__, x.tolist())) != whole
               for h, x, side in zip(heads, ids, (self.a, self.b), strict=True)):
            return self.align(words)
        return self._table(*ids, *(np.diff(np.append(h, len(x))) for h, x in zip(heads, ids, strict=True)))

    def _table(self, a: np.ndarray, b: np.ndarray, count_a: np.ndarray, count_b: np.ndarray) -> Table:
        n = len(count_a)
        doc_a, doc_b = np.repeat(np.arange(n), count_a), np.repeat(np.arange(n), count_b)
        links_a, links_b, group_a, group_b = align(self.sizes[0][a], self.sizes[1][b], doc_a, doc_b)
        heads = np.flatnonzero(np.append(True, group_a[1:] != group_a[:-1]))[:len(a)]
        parts = self.written(a, b, group_a, group_b).tolist()
        ends = np.cumsum(count_a + count_b)
        row = doc_a[links_a]
        order = np.argsort(row, kind="stable")
        count = np.column_stack([count_a, count_b, np.bincount(doc_a[heads], minlength=n), np.bincount(row, minlength=n)])
        return Table(
            count, np.append(0, np.cumsum(count[:, 3])), (a[links_a].astype(np.int64) << 32 | b[links_b])[order],
            ["".join(parts[x:y]) for x, y in zip((ends - count_a - count_b).tolist(), ends.tolist(), strict=True)])

    def _shrink(self) -> None:
        # the first words are the frequent ones
        left = 0 if self.chars > WORD_CHARS else WORDS // 4
        kept = list(islice(self.words, left))
        self.words = Words()
        self.words.update(zip(kept, range(len(kept)), strict=True))
        self.words.known, self.chars = len(kept), sum(map(len, kept))
        self.table = self.table.head(len(kept))

    def __call__(self, texts: list[str]) -> tuple[list[list[int]], Table]:
        """For each text the rows of the table of what it is made of: its
        words, or the whole."""
        if len(self.words) > WORDS or self.chars > WORD_CHARS:
            self._shrink()
        place = self.words.__getitem__
        out = [list(map(place, t.split(" "))) if self.by_word and _spaced(t) else [] for t in texts]
        new = self.words.new
        if new:
            self.table.add(self.align_words(new))
            self.words.known += len(new)
            self.chars += sum(map(len, new))
            self.words.new = []
        bad = set(np.flatnonzero(self.table.numbers[:, 0] == 0).tolist())
        whole = [i for i, rows in enumerate(out) if not rows or min(rows) < 0 or bad and not bad.isdisjoint(rows)]
        if not whole:
            return out, self.table
        table = self.table.head(len(self.table.written))
        for k, i in enumerate(whole):
            out[i] = [len(table.written) + k]
        table.add(self.align([texts[i] for i in whole]))
        return out, table


def _spaced(text: str) -> bool:
    """Whether each space follows a word and has something after it.  Then no
    token reaches over the start of a space: side A's pieces of settled text
    end there, and no entry of side B has anything before a space."""
    return text[0] != " " and text[-1] != " " and not any(x in text for x in ("  ", "\n ", "\t ", "\r "))


def _align(path_a: str, path_b: str, name: str):
    """For ``mapInArrow`` over (id, text): a row of ``ALIGNED`` per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        aligner = Aligner(path_a, path_b)
        for batch in chunks(batches, "text"):
            texts = batch.column("text").to_pylist()
            full = [i for i, t in enumerate(texts) if t]
            found, table = aligner([texts[i] for i in full])
            yield _numbers(batch, list(zip(full, found, strict=True)), table)

    def _numbers(batch, good, table) -> pa.RecordBatch:
        n = batch.num_rows
        doc = np.array([i for i, _ in good], np.int64)
        ends = np.cumsum([0, *(len(x) for _, x in good)])
        part = np.fromiter(chain.from_iterable(x for _, x in good), np.int64, int(ends[-1]))
        sums = np.zeros((len(part) + 1, 4), np.int64)
        np.cumsum(table.numbers[part], axis=0, out=sums[1:])
        numbers = np.zeros((n, 4), np.int64)
        numbers[doc] = np.diff(sums[ends], axis=0)
        digests = [""] * n
        for i, places in good:
            if numbers[i, 0]:
                digests[i] = hashlib.sha256("".join(map(table.written.__getitem__, places))[:-1].encode()).hexdigest()
        # links as pairs of ids, each once per document with its number
        times = table.numbers[part, 3]
        key = table.pairs[np.repeat(table.first[part] - sums[:-1, 3], times) + np.arange(sums[-1, 3])]
        cut = np.append(0, np.cumsum(numbers[:, 3]))
        for start, end in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            key[start:end].sort()
        row = np.repeat(np.arange(n), numbers[:, 3])
        new = np.append(True, (key[1:] != key[:-1]) | (row[1:] != row[:-1]))[:len(key)]
        first = np.flatnonzero(new)
        times = np.diff(np.append(first, len(key))).astype(np.uint32)
        key, pair_row = key[first], row[first]
        cut = np.searchsorted(pair_row, np.arange(n + 1))
        low, high = (key & 0xFFFFFFFF).astype(np.uint32), (key >> 32).astype(np.uint32)
        packed = [high[s:e].tobytes() + low[s:e].tobytes() + times[s:e].tobytes()
                  for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), *map(pa.array, numbers.T.copy()), pa.array(digests), pa.array(packed, pa.binary())],
            [name, "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"])
    return run


def _links(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, id pair (A's above 32 bits, B's below) and number of all links."""
    count = np.array([len(p) // 12 for p in packed], np.int64)
    parts = [np.frombuffer(p, np.uint32).reshape(3, -1) for p in packed]
    a, b, times = np.concatenate([np.zeros((3, 0), np.uint32), *parts], axis=1).astype(np.int64)
    return np.repeat(np.arange(len(packed)), count), a << 32 | b, times


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))[:len(keys)]
    return keys[head], np.add.reduceat(values, head) if len(head) else values


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow`` over ``links``: pairs with their sums in the task."""
    keys, values = np.zeros(0, np.int64), np.zeros(0, np.int64)
    held, size = [], 0
    out = lambda: pa.RecordBatch.from_arrays([pa.array(keys), pa.array(values)], ["pair", "n"])
    for batch in batches:
        _, pair, times = _links(batch.column("links").to_pylist())
        held.append((pair, times))
        size += len(pair)
        if size >= COMBINE_LINKS:
            keys, values = _sums(np.concatenate([keys, *(h[0] for h in held)]),
                                 np.concatenate([values, *(h[1] for h in held)]))
            held, size = [], 0
            if len(keys) >= COMBINE_LINKS:
                yield out()
                keys, values = keys[:0], values[:0]
    keys, values = _sums(np.concatenate([keys, *(h[0] for h in held)]),
                         np.concatenate([values, *(h[1] for h in held)]))
    yield out()


def link_counts(aligned: DataFrame) -> DataFrame:
    """``pair`` (A's id above 32 bits, B's below) and ``n``, its links in all
    documents of a stored ``aligned_rows``."""
    return aligned.select("links").mapInArrow(_counted, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def aligned_rows(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row of ``df``: its id, ``n_a`` and ``n_b`` (tokens), ``n_groups``,
    ``n_links``, ``groups_sha256`` and ``links`` (packed id pairs)."""
    small_batches(df.sparkSession)
    rows = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    schema = T.StructType([T.StructField(id_col, rows.schema["id"].dataType),
                           *(T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")),
                           T.StructField("groups_sha256", T.StringType()), T.StructField("links", T.BinaryType())])
    return rows.mapInArrow(_align(path_a, path_b, id_col), schema)


def _looked_up(pairs, best):
    """For ``mapInArrow`` over (row, links): sums over the held pairs in one
    row per row, and a row per other pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = pairs.value
        for batch in batches:
            row, pair, times = _links(batch.column("links").to_pylist())
            at = np.minimum(np.searchsorted(keys, pair), max(len(keys) - 1, 0))
            known = keys[at] == pair if len(keys) else np.zeros(len(pair), bool)
            n = counts[at[known]]
            weight = times[known]
            is_best = n == best.value[pair[known] & 0xFFFFFFFF]
            sums = np.zeros((2, batch.num_rows), np.int64)
            np.add.at(sums[0], row[known], weight * is_best)
            np.add.at(sums[1], row[known], weight * n)
            names = batch.column("row").to_numpy()
            none = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(names), none, none, pa.array(sums[0]), pa.array(sums[1])], _LOOK)
            rest = ~known
            none = pa.nulls(int(rest.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[row[rest]]), pa.array(pair[rest]), pa.array(times[rest]), none, none], _LOOK)
    return run


_LOOK = ["row", "pair", "times", "n_best", "count_sum"]


def _held(spark: SparkSession, counts: DataFrame, share: float, n_b: int):
    """Broadcast values: the pairs with the share of all links, sorted, with
    their counts; and the best count of each B id."""
    total = counts.agg(F.sum("n")).head()[0] or 0
    common = counts.where(F.col("n") >= share * total).toArrow()  # at most 1 / share rows
    keys, n = (common.column(c).to_numpy() for c in ("pair", "n"))
    order = np.argsort(keys)
    top = counts.groupBy(F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b")).agg(F.max("n").alias("n")).toArrow()
    best = np.zeros(n_b, np.int64)  # one number per entry of B's vocabulary
    best[top.column("b").to_numpy()] = top.column("n").to_numpy()
    context = spark.sparkContext
    return context.broadcast((keys[order], n[order])), context.broadcast(best)


def cross_alignment(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
                    held_share: float = HELD_SHARE) -> DataFrame:
    """``aligned_rows`` without ``links`` and with ``n_best`` (links whose
    pair's count is the highest of its B id) and ``count_sum`` (over links)."""
    spark = df.sparkSession
    rows = stored(aligned_rows(df, path_a, path_b, id_col, text_col).toDF("id", *_NUMBERS, "links")
                  .withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = stored(link_counts(rows), "link-counts")
    pairs, best = _held(spark, counts, held_share, sentencepiece.SentencePieceProcessor(model_file=path_b).vocab_size())
    looked = rows.select("row", "links").mapInArrow(
        _looked_up(pairs, best), ", ".join(f"{c} long" for c in _LOOK))
    looked = stored(looked, "looked-up")
    top = counts.groupBy(F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b")).agg(F.max("n").alias("top"))
    rest = looked.where("pair is not null").select("row", "pair", "times") \
        .join(counts, "pair").withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF)).join(F.broadcast(top), "b") \
        .select("row", F.when(F.col("n") == F.col("top"), F.col("times")).otherwise(0).alias("n_best"),
                (F.col("times") * F.col("n")).alias("count_sum"))
    sums = looked.where("pair is null").select("row", "n_best", "count_sum").union(rest) \
        .groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return rows.join(sums, "row").select(F.col("id").alias(id_col), *_NUMBERS[:4], "n_best", "count_sum",
                                         "groups_sha256")


_NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
