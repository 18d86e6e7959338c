"""Language-model scoring with a probabilistic suffix tree over words.

Tokens are words (A-Z in lower case, between ASCII white space) and one end per
text.  Words, and runs of up to ``DEPTH`` + 1 tokens, are known by 64-bit
hashes.  Every training token is counted, and the base model is the add-one
smoothed unigram over all of them.  Runs are shuffled in packed pieces by ranges
of their hashes (``packing``).

The tree grows with the corpus: every run that occurs at least ``FLOOR`` times
is in it, whatever its share.  Runs are counted by shuffle, summed up in blocks
of tokens first: pairs, then the longer runs all of whose pairs may be frequent,
as told by a filter of fixed size that misses none, then all that may be, with
the contexts and suffixes that they belong to.  A context (the run without
its last token) is retained if its next-token counts diverge from its suffix's
distribution by more than their description costs (log-likelihood ratio against
half a log N per token).  Its distribution is smoothed towards its suffix's:
counted tokens get (count + STRENGTH * p_suffix) / (total + STRENGTH), the
others the rest in proportion to p_suffix.  A token is scored in the longest
retained context that ends before it; the first token follows an end.

The score of a text is a sum over its words and runs: log p of a word, the
``rest`` of a run that is a retained context, and the ``gain`` of a run over its
suffix in one.  Only what is common, words of at least ``MIN_SHARE`` and runs of
at least ``GRAM_SHARE`` of all tokens, goes to the tasks whole (so its size is
bounded); the others meet the stored tables by a shuffle into ranges of hashes,
with the same results.

A null text counts as empty: its only token is the end.  Without training rows
all probabilities are 1.  Rows repeated whole are counted and scored each.  An
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from fundlens.llm.batches import LOWER, SpanHash, chunks, mix, release, text_buffer, word_spans
from fundlens.llm.frames import small_batches, stored
from fundlens.llm.packing import Gathered, added, buckets, joined, keys_of, pieces, planes, ranges, values
from fundlens.session import remove_dir, shared_dir
from fundlens.sources.files import materialize

#: Shares of all tokens from which words and runs are held in every task.
MIN_SHARE = 2e-6
GRAM_SHARE = 1e-6
#: Occurrences from which a run is in the tree.
FLOOR = 5
DEPTH = 3
STRENGTH = 5.0
#: Tokens of a block in which runs are summed up.
BLOCK = 1_000_000
#: Distinct words that a task counts before it hands them on.
HELD = 2_000_000
#: Bits of a filter, as a power of two.
FILTER = 27

#: Multiplier of a context's hash in a run's.
STEP = np.uint64(0xD6E8FEB86659FD93)
#: Lookups and texts of a block of scores.
ASKED, TEXTS = 250_000, 50_000

#: Symbols; END is also the hash of the end.
END, RARE = 0, 1


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word, in order."""
    data, offsets = text_buffer(texts)
    data = LOWER[data]
    starts, ends, rows = word_spans(data, offsets)
    return SpanHash(data)(starts, ends).view(np.int64), rows


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of the texts, added up as far as memory allows."""
    held, n_held = [], 0

    def added() -> tuple[np.ndarray, np.ndarray]:
        words = np.concatenate([w for w, _ in held])
        names, place = np.unique(words, return_inverse=True)
        return names, np.bincount(place, np.concatenate([n for _, n in held])).astype(np.int64)

    for part in chunks(batches, "text"):
        words, _ = hashed_words(part.column("text"))
        held.append(np.unique(words, return_counts=True))
        n_held += len(held[-1][0])
        if n_held > HELD:
            held = [added()]
            n_held = len(held[0][0])
            if n_held > HELD // 2:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], ["word", "n"])
                held, n_held = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in added()], ["word", "n"])


def _sequence(symbols: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows' symbols (or hashes) one after the other, each row closed by
    the end; also each token's row, and its place in the row."""
    size = np.bincount(rows, minlength=n) + 1
    ends = np.cumsum(size) - 1
    out = np.full(int(size.sum()), END, np.int64)
    body = np.ones(len(out), bool)
    body[ends] = False
    out[body] = symbols
    row = np.repeat(np.arange(n), size)
    return out, row, np.arange(len(out)) - np.repeat(ends - size + 1, size)


def _runs(words: np.ndarray, place: np.ndarray, depth: int):
    """For lengths 2, 3, ...: the tokens at which a run of that length ends
    (the end before a row's first token counts), and the hashes of the run, of
    it without its last, and of it without its first token."""
    last = words.view(np.uint64)
    suffix = last
    for length in range(2, depth + 2):
        context = np.zeros_like(suffix)  # END before a row's first token
        context[1:] = suffix[:-1]
        if length == 2:
            context[place == 0] = END
        run = mix(context * STEP + last + np.uint64(length))
        at = np.flatnonzero(place >= length - 2)
        yield length, at, run.view(np.int64), context.view(np.int64), suffix.view(np.int64)
        suffix = run


class Places:
    """Places of hashes in a sorted list of distinct ones; -1 if not there."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.shift = np.int64(64 - max(len(keys).bit_length(), 1) - 1)
        half = 1 << (63 - int(self.shift))  # the top bits are signed
        self.starts = np.searchsorted(keys >> self.shift, np.arange(-half, half + 1)).astype(np.int32)
        self.half = half

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int64)
        group = (hashes >> self.shift) + self.half
        at, end = self.starts[group], self.starts[group + 1]
        open_ = np.flatnonzero(at < end)
        at, end = at[open_], end[open_]
        while len(open_):
            hit = self.keys[at] == hashes[open_]
            out[open_[hit]] = at[hit]
            on = ~hit & (at + 1 < end)
            open_, at, end = open_[on], at[on] + 1, end[on]
        return out


def _lookup(words: np.ndarray, vocabulary: np.ndarray | Places) -> np.ndarray:
    """Symbols of word hashes; ``vocabulary`` is sorted."""
    at = (vocabulary if isinstance(vocabulary, Places) else Places(vocabulary))(words)
    return np.where(at >= 0, at + 2, RARE)


def _blocks(batches: Iterator[pa.RecordBatch]):
    """Hash sequences and places of about ``BLOCK`` tokens."""
    held, size = [], 0
    for part in chunks(batches, "text"):
        words, rows = hashed_words(part.column("text"))
        words, _, place = _sequence(words, rows, part.num_rows)
        held.append((words, place))
        size += len(words)
        if size >= BLOCK:
            yield tuple(map(np.concatenate, zip(*held, strict=True)))
            held, size = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


#: Shifts of the two bits of a hash within its word of a filter.
WITHIN = (FILTER - 6, FILTER)


def _filter(hashes: DataFrame) -> np.ndarray:
    """Two bits set for each hash of a one-column table, both in one 64-bit
    integer of the filter."""
    key = F.col(hashes.columns[0])
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(key, by).bitwiseAND(F.lit(63)).cast("int"))
            for by in WITHIN]
    set_ = hashes.select(key.bitwiseAND(F.lit((1 << (FILTER - 6)) - 1)).alias("at"), bits[0].bitwiseOR(bits[1]).alias("bits")) \
        .groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER - 6), np.uint64)
    out[set_.column("at").to_numpy()] = set_.column("bits").to_numpy().view(np.uint64)
    return out


def _passes(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether the filter may hold each hash."""
    h, one, low = hashes.view(np.uint64), np.uint64(1), np.uint64(63)
    word = bits[hashes & np.int64((1 << (FILTER - 6)) - 1)]
    return (word >> (h >> np.uint64(WITHIN[0]) & low) & (word >> (h >> np.uint64(WITHIN[1]) & low)) & one).astype(bool)


def _counts(runs: np.ndarray) -> list[np.ndarray]:
    names, n = np.unique(runs, return_counts=True)
    return [names, n.astype(np.uint32)]


def _count_pairs(bits: int):
    """For ``mapInArrow``: runs of two tokens and their counts, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Gathered(["runs", "n"], bits)
        for words, place in _blocks(batches):
            for _, _, run, _, _ in _runs(words, place, 1):
                yield from found.add(_counts(run))
        yield from found.rest()
        release()
    return run


def _count_longer(pairs: np.ndarray, depth: int, bits: int):
    """For ``mapInArrow``: longer runs all of whose pairs pass, and their
    counts, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Gathered(["runs", "n"], bits)
        for words, place in _blocks(batches):
            passes = None
            for length, at, runs, _, _ in _runs(words, place, depth):
                if length == 2:
                    passes = _passes(runs, pairs)
                    continue
                passes[1:] &= passes[:-1].copy()
                yield from found.add(_counts(runs[at[passes[at]]]))
        yield from found.rest()
        release()
    return run


def _window(codes: np.ndarray, at: np.ndarray, length: int, width: int) -> np.ndarray:
    """The words of the runs of one length that end at some tokens, last first;
    the token before the first is an end, as the last one is."""
    out = np.zeros((len(at), width), np.uint32)
    for j in range(length):
        out[:, j] = codes[at - j]
    return out


def _word_pieces(size: int, rarer: dict[int, int]):
    """Makes pieces of runs known by their words.  Codes below ``size`` are the
    same in all tasks; ``rarer`` has a task's others, whose hashes go along."""
    def pack(runs: np.ndarray, columns: list[np.ndarray], bits: int) -> Iterator[list]:
        hashes = np.fromiter(rarer, np.int64, len(rarer))
        for bucket, here in ranges(runs, bits):
            n, length, codes = (x[here] for x in columns)
            order = np.argsort(length.astype(np.int64) << 58 | codes[:, 0].astype(np.int64) << 29 | codes[:, 1])
            n, length, codes = n[order], length[order], codes[order]
            far = codes >= size
            rest, place = np.unique(codes[far], return_inverse=True)
            codes[far] = size + place
            words = [np.diff(codes[:, 0], prepend=np.uint32(0))]
            words += [codes[length > j, j] for j in range(1, codes.shape[1])]
            yield [bucket, *map(planes, (n, length, np.concatenate(words), hashes[rest - size]))]
    return pack


def _count_runs(often: np.ndarray, depth: int, bits: int, common: np.ndarray):
    """For ``mapInArrow``: the runs that pass, with counts, lengths and words,
    packed.  A word goes as its place among the ``common`` ones, after which the
    piece's others are numbered; run, context and suffix follow from the words."""
    size = len(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_hash = np.argsort(common[1:])
        spots, code_of = Places(common[1:][by_hash]), np.append(by_hash + 1, END).astype(np.uint32)
        rarer: dict[int, int] = {}
        found = Gathered(["n", "length", "words", "rare"], bits, pack=_word_pieces(size, rarer))
        for words, place in _blocks(batches):
            before = codes = None
            counted = []
            for length, at, runs, _, _ in _runs(words, place, depth):
                passes = _passes(runs, often)
                if length > 2:
                    # a frequent run's context and suffix are frequent
                    passes &= before
                    passes[1:] &= before[:-1]
                else:
                    spot = spots(words)
                    codes = code_of[spot]
                    far = passes.copy()
                    far[:-1] |= passes[1:]
                    far &= (spot < 0) & (words != END)
                    names, which = np.unique(words[far], return_inverse=True)
                    codes[far] = np.array([rarer.setdefault(w, size + len(rarer)) for w in names.tolist()],
                                          np.uint32)[which]
                before = passes
                at = at[passes[at]]
                if len(at):
                    names, n, first = added(runs[at], np.ones(len(at), np.uint32), at)
                    counted.append([names, n, np.full(len(n), length, np.uint8),
                                    _window(codes, first, length, depth + 1)])
            if counted:
                yield from found.add(list(map(np.concatenate, zip(*counted, strict=True))))
            if not found.size:
                rarer.clear()
        yield from found.rest()
        release()
    return run


def _chained(words: list[np.ndarray]) -> list[np.ndarray]:
    """Hashes of runs, contexts and suffixes from the words' hashes, in order."""
    level, before = [w.view(np.uint64) for w in words], []
    last = level
    for length in range(2, len(words) + 1):
        before = level
        level = [mix(x * STEP + w + np.uint64(length)) for x, w in zip(level, last[length - 1:], strict=False)]
    return [x.view(np.int64) for x in (*level, *before)]


def _spelled(table: pa.Table, common: np.ndarray) -> list[np.ndarray]:
    """Runs, counts, lengths, contexts and suffixes of the pieces of a bucket."""
    size, rarer, n_rarer, lengths, parts = len(common), [], 0, [], []
    for length, words, rare in zip(*(table.column(c).to_pylist() for c in ("length", "words", "rare")), strict=True):
        length, words, rare = values(length, np.uint8), values(words, np.uint32).copy(), values(rare, np.int64)
        bound = np.cumsum([(length > j).sum() for j in range(length.max())])
        words[:bound[0]] = np.cumsum(words[:bound[0]], dtype=np.uint32)
        words[words >= size] += np.uint32(n_rarer)
        lengths.append(length)
        parts.append(np.split(words, bound[:-1]))
        rarer.append(rare)
        n_rarer += len(rare)
    length = np.concatenate(lengths)
    rarer, out = np.concatenate(rarer), [np.zeros(len(length), np.int64) for _ in range(3)]
    names = []
    for j in range(length.max()):
        codes = np.concatenate([p[j] for p in parts if len(p) > j])
        far = codes >= size
        hashes = common[np.where(far, 0, codes)]
        hashes[far] = rarer[codes[far] - size]
        names.append(np.zeros(len(length), np.int64))
        names[j][length > j] = hashes
    for k in np.unique(length):
        here = np.flatnonzero(length == k)
        for to, x in zip(out, _chained([names[j][here] for j in reversed(range(k))]), strict=True):
            to[here] = x
    return [out[0], joined(table, "n", np.uint32).astype(np.int64), length.astype(np.int32), *out[1:]]


def _frequent(floor: int, common: np.ndarray | None):
    """For ``applyInArrow`` on a bucket: its runs of at least ``floor``
    occurrences; with ``common`` from their words, with what stands beside them."""
    def run(table: pa.Table) -> pa.Table:
        columns = [joined(table, "runs"), joined(table, "n", np.uint32).astype(np.int64)] \
            if common is None else _spelled(table, common)
        out = added(*columns)
        kept = np.flatnonzero(out[1] >= floor)
        return pa.table([x[kept] for x in out], names=["run", "n", "length", "context", "suffix"][:len(out)])
    return run


def _frequent_runs(texts: DataFrame, count, floor: int, common: np.ndarray | None = None) -> DataFrame:
    """(run, n), with ``common`` also (length, context, suffix), of the runs that
    ``count`` packs and that occur ``floor`` times."""
    packed, out = ("runs binary, n binary", "run long, n long") if common is None else (
        "n binary, length binary, words binary, rare binary",
        "run long, n long, length int, context long, suffix long")
    return texts.mapInArrow(count, "bucket int, " + packed).groupBy("bucket").applyInArrow(
        _frequent(floor, common), out)


def _packed(name: str, bits: int):
    """For ``mapInArrow``: distinct keys and what stands beside them, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Gathered(["keys", name], bits)
        for part in batches:
            yield from found.add([x.to_numpy(zero_copy_only=False) for x in part.columns])
        yield from found.rest()
        release()
    return run


@dataclass
class Tree:
    """What is common, for every task, and the stored table of the others."""
    vocabulary: np.ndarray  # sorted hashes; symbol = place + 2
    root: np.ndarray        # log10 p per symbol
    keys: np.ndarray        # sorted hashes of the common words and runs of the tree
    gain: np.ndarray        # per key: what its last token gains over the suffix's p; nan if none
    rest: list[np.ndarray]  # per key, as a context: what all tokens get of the suffix's p; nan if not retained
    others: DataFrame       # (run, value): gain and rest of the others, added up
    passes: np.ndarray      # filter of all, common or not
    min_count: float        # from which a word is in the vocabulary
    tokens: int             # N
    distinct: int           # V
    depth: int
    places: Places | None = None

    def scores(self, symbols: np.ndarray, place: np.ndarray) -> np.ndarray:
        """log10 p of every token's symbol, by the common runs."""
        words = np.concatenate([[END, RARE], self.vocabulary])[symbols]
        return self.walk(words, symbols, place)[0]

    def walk(self, words: np.ndarray, symbols: np.ndarray,
             place: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """The scores of tokens with these hashes by the common runs; and the
        runs that may be among the others, as (tokens, hashes)."""
        out, rest = self.root[symbols], self.rest[0]
        if self.places is None:
            self.places = Places(self.keys)
        start = self.places(np.array([END]))[0]
        if start >= 0 and not np.isnan(rest[start]):
            out[place == 0] += rest[start]
        single = np.flatnonzero(symbols != END)
        others = []
        for at, hashes in [(single, words[single]), *[(at, run[at]) for _, at, run, _, _ in _runs(
                words, place, self.depth)]]:
            passed = _passes(hashes, self.passes)
            at, hashes = at[passed], hashes[passed]
            spot = self.places(hashes)
            held = spot >= 0
            others.append((at[~held], hashes[~held]))
            at, spot = at[held], spot[held]
            # a run's gain is its last token's, its rest the next token's
            inner = at + 1 < len(place)
            inner[inner] = place[at[inner] + 1] > 0
            for to, value in ((at, self.gain[spot]), (at[inner] + 1, rest[spot[inner]])):
                known = np.flatnonzero(~np.isnan(value))
                out[to[known]] += value[known]
        return out, others


@contextmanager
def _tidy(spark: SparkSession):
    """Gives a function that stores a table until the end; shuffle files go
    as soon as the query that wrote them ends."""
    key, paths = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")

    def held(df: DataFrame, name: str) -> DataFrame:
        paths.append(shared_dir(spark, name))
        return materialize(df, paths[-1])

    try:
        yield held
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
        for path in paths:
            remove_dir(spark, path)


def grow(words: DataFrame, runs: DataFrame, tokens: int, total: int, depth: int, strength: float,
         held) -> DataFrame:
    """Divergence tests and smoothing: (run, n, gain, rest) of the words and
    runs of the tree.  ``words``: (word, n) with the end; ``held`` stores a
    table while the tree grows."""
    known = words.select(F.col("word").alias("run"), "n", ((F.col("n") + 1) / F.lit(float(total))).alias("p"))
    nodes = []
    for length in range(2, depth + 2):
        here = held(runs.where(F.col("length") == length).select("run", "context", "suffix", "n")
                      .join(known.select(F.col("run").alias("suffix"), F.col("p").alias("below")), "suffix"), "runs")
        next_ = here.groupBy("context").agg(
            F.count("*").alias("m"), F.sum("n").alias("c"), F.sum("below").alias("sum_below"),
            F.sum(F.col("n") * F.log(F.col("n") / F.col("below"))).alias("odds"))
        left = F.greatest(1 - F.col("sum_below"), F.lit(1e-12))
        other = F.col("total") - F.col("c")
        gain = F.col("odds") - F.col("c") * F.log(F.col("total")) + F.when(
            other > 0, other * F.log(other / F.col("total") / left)).otherwise(0.0)
        given = (F.col("c") + strength * F.col("sum_below")) / (F.col("total") + strength)
        kept = held(
            next_.join(known.select(F.col("run").alias("context"), F.col("n").alias("total")), "context")
            .where(gain > F.col("m") * F.lit(math.log(max(tokens, 2)) / 2))
            .select("context", "total", F.log10(F.greatest(1 - given, F.lit(1e-12)) / left).alias("rest")), "contexts")
        p = (F.col("n") + strength * F.col("below")) / (F.col("total") + strength)
        known = held(
            here.join(kept, "context", "left").select(
                "run", "n", F.coalesce(p, "below").alias("p"),
                (F.log10(p) - F.log10("below") - F.col("rest")).alias("gain")), "tree")
        none = F.lit(None).cast("double")
        nodes += [kept.select(F.col("context").alias("run"), F.col("total").alias("n"), none.alias("gain"), "rest"),
                  known.where("gain is not null").select("run", "n", "gain", none.alias("rest"))]
    return reduce(DataFrame.unionByName, nodes).groupBy("run").agg(
        F.max("n").alias("n"), F.max("gain").alias("gain"), F.max("rest").alias("rest"))


def fit(train: DataFrame, text_col: str = "text", min_share: float = MIN_SHARE, gram_share: float = GRAM_SHARE,
        depth: int = DEPTH, strength: float = STRENGTH, floor: int = FLOOR) -> tuple[Tree, DataFrame]:
    """The tree of ``train``'s texts, and the counts (word, n) of all their
    words, stored."""
    small_batches(train.sparkSession)
    texts = train.select(F.coalesce(train[text_col], F.lit("")).alias("text"))
    with _tidy(train.sparkSession) as held:
        words = stored(texts.mapInArrow(_counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")),
                       "words")
        ends = texts.count()
        n, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).head()
        tokens, distinct = n + ends, v + (ends > 0)
        total = tokens + distinct + 1
        min_count = max(min_share * tokens, 1)  # at most 1 / min_share words reach it
        top = words.where(F.col("n") >= min_count).toArrow().sort_by("word")
        vocabulary, counts = top.column("word").to_numpy(), top.column("n").to_numpy()
        rare = (n - int(counts.sum()) + v - len(vocabulary) + 1) / total
        root = np.log10(np.concatenate([[(ends + 1) / total, max(rare, 1 / total)], (counts + 1) / total]))

        def often(count) -> np.ndarray:
            return _filter(_frequent_runs(texts, count, floor).select("run"))

        bits = buckets(tokens)
        passes = often(_count_pairs(bits))
        passes |= often(_count_longer(passes, depth, bits))
        by_count = np.concatenate([[END], vocabulary[np.argsort(-counts)]])  # of most words the code is small
        runs = _frequent_runs(texts, _count_runs(passes, depth, bits, by_count), floor, by_count)
        end = train.sparkSession.range(1).select(
            F.lit(END).cast("long").alias("word"), F.lit(ends).cast("long").alias("n"))
        nodes = stored(grow(words.unionByName(end), held(runs, "counts"), tokens, total, depth, strength, held),
                       "nodes")
        # at most 1 / gram_share of each length reach the share
        common = (F.col("n") >= gram_share * tokens) | (F.col("run") == END)
        head = nodes.where(common).toArrow().sort_by("run")
        passes = _filter(nodes.select("run"))
    gain, rest = (head.column(c).to_numpy().astype(float) for c in ("gain", "rest"))
    others = nodes.where(~common).select(
        "run", (F.coalesce("gain", F.lit(0.0)) + F.coalesce("rest", F.lit(0.0))).alias("value"))
    return Tree(vocabulary, root, head.column("run").to_numpy(), gain, [rest], others,
                passes, min_count, tokens, distinct, depth), words


def score(df: DataFrame, tree: Tree, words: DataFrame, id_col: str = "doc_id",
          text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Per row of ``df``: columns ``keep`` (by default the id), ``n_tokens``,
    ``n_known``, ``train_tokens``, ``base_score`` and ``score``."""
    keep = [id_col] if keep is None else keep
    small_batches(df.sparkSession)
    rows = df.select(*[df[f"`{c}`"].alias(f"_{i}") for i, c in enumerate(keep)],
                     F.coalesce(df[text_col], F.lit("")).alias("text"))
    unit = math.log10(tree.tokens + tree.distinct + 1)
    vocabulary, root, trained = tree.vocabulary, tree.root, tree.tokens > 0
    bits = buckets(tree.tokens // 4)  # fewer, for fewer answers a text
    walk = Tree(vocabulary, root, tree.keys, tree.gain, tree.rest, None, tree.passes, tree.min_count,
                tree.tokens, tree.distinct, tree.depth).walk

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_number, held, size = TaskContext.get().partitionId() << 40, [], 0
        base = row_number
        known = root + unit  # log10(count + 1)
        symbol_of = Places(vocabulary)
        for part in chunks(batches, "text"):
            m = part.num_rows
            hashes, rows = hashed_words(part.column("text"))
            words, row, place = _sequence(hashes, rows, m)
            symbols = _sequence(_lookup(hashes, symbol_of), rows, m)[0]
            each, found = walk(words, symbols, place)
            states = np.bincount(row, each, m)
            often = symbols != RARE
            often_score = np.bincount(row[often], known[symbols[often]], m)
            n_often = np.bincount(row[often], minlength=m) if trained else np.zeros(m, np.int64)
            # the rarer words, and the runs that are looked up
            far = np.flatnonzero(~often)
            single, names = found[0]
            found[0] = single[often[single]], names[often[single]]
            yield heads_of(part, base, row_number - base, [np.bincount(row, minlength=m), n_often, np.bincount(
                row[far], minlength=m), often_score, states])
            held.append((np.concatenate([words[far], *[x for _, x in found]]),
                         row_number - base + np.concatenate([row[far], *[row[at] for at, _ in found]])))
            size += len(held[-1][0])
            row_number += m
            if size >= ASKED or row_number - base >= TEXTS:
                yield from asked(held, base)
                held, size, base = [], 0, row_number
        yield from asked(held, base)
        release()

    def heads_of(part: pa.RecordBatch, block: int, first: int, columns: list[np.ndarray]) -> pa.RecordBatch:
        """A row with the sums of each text, dealt out evenly."""
        at = first + np.arange(part.num_rows)
        bucket = (mix((block + at).astype(np.uint64)).view(np.int64) >> np.int64(64 - bits)).astype(np.int32)
        none = pa.nulls(part.num_rows, pa.binary())
        return pa.RecordBatch.from_arrays(
            [*part.columns[:-1], *map(pa.array, columns), pa.array(at), pa.array(np.full(len(at), block)),
             pa.array(bucket), none, none],
            [*part.schema.names[:-1], *sums, "at", "block", "bucket", "keys", "texts"])

    def asked(held: list[tuple[np.ndarray, np.ndarray]], block: int) -> Iterator[pa.RecordBatch]:
        """The lookups of a block, packed; texts count from the block's first."""
        if not sum(len(h) for h, _ in held):
            return
        keys, at = map(np.concatenate, zip(*held, strict=True))
        order = np.argsort(keys)
        rows = list(pieces(keys[order], [at[order].astype(np.uint32)], bits))
        yield pa.RecordBatch.from_arrays(
            [*[pa.nulls(len(rows), t) for t in head_types], pa.array(np.full(len(rows), block)),
             *[pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary()))]],
            [*head_names, "block", "bucket", "keys", "texts"])

    def answered(left: pa.Table, right: pa.Table) -> pa.Table:
        """The heads of a bucket; and for each of its pieces what its texts
        find, added up and packed."""
        is_head = pc.is_null(left.column("keys"))
        heads, asks = left.filter(is_head), left.filter(pc.invert(is_head))
        blobs = []
        if right.num_rows and asks.num_rows:
            stored_keys, stored_n, stored_value = [], [], []
            for keys, n, value in zip(*(right.column(c).to_pylist() for c in ("keys", "n", "value")), strict=True):
                stored_keys.append(keys_of(keys))
                none = np.zeros(len(stored_keys[-1]))
                stored_n.append(none if n is None else values(n, np.int64))
                stored_value.append(none if value is None else values(value, float))
            names, place = np.unique(np.concatenate(stored_keys), return_inverse=True)
            # a rarer word may be in both tables
            n, value = (np.bincount(place, np.concatenate(x)) for x in (stored_n, stored_value))
            logs = np.log10(n + 1)
            for block, keys, at in zip(*(asks.column(c).to_pylist() for c in ("block", "keys", "texts")), strict=True):
                keys, at = keys_of(keys), values(at, np.uint32)
                spot = np.minimum(np.searchsorted(names, keys), len(names) - 1)
                hit = np.flatnonzero(names[spot] == keys)
                spot, at = spot[hit], at[hit].astype(np.int64)
                texts = np.flatnonzero(np.bincount(at))
                found = [np.bincount(at, x[spot])[texts] for x in (logs, value, n > 0)]
                if len(texts):
                    # few texts find a rarer word in a piece
                    blobs.append((block, planes(np.diff(texts, prepend=0).astype(np.uint32)), planes(
                        found[0][found[2] > 0]), planes(found[1]), planes(found[2].astype(np.uint32))))
        none = [pa.nulls(heads.num_rows, pa.binary())] * 4
        return pa.concat_tables([
            pa.table([*[heads.column(c) for c in (*head_names, "block")], *none], schema=answers),
            pa.table([*[pa.nulls(len(blobs), t) for t in head_types],
                      *[pa.array([b[i] for b in blobs], t) for i, t in enumerate(answers.types[-5:])]],
                     schema=answers)])

    def added_up(table: pa.Table) -> pa.Table:
        """The texts of a block with all that they have found."""
        is_head = pc.is_null(table.column("texts"))
        heads, parts = table.filter(is_head), table.filter(pc.invert(is_head))
        at = heads.column("at").to_numpy()
        out = [np.zeros(int(at.max()) + 1) for _ in answer]
        for texts, *found in zip(*(parts.column(c).to_pylist() for c in ("texts", *answer)), strict=True):
            texts = np.cumsum(values(texts, np.uint32))
            logs, value, n = (values(blob, dtype) for blob, dtype in zip(found, (float, float, np.uint32), strict=True))
            for total, to, x in zip(out, (texts[n > 0], texts, texts), (logs, value, n), strict=True):
                total[to] += x
        return pa.table([*[heads.column(c) for c in head_names[:-1]], pa.array(out[0][at]), pa.array(out[1][at]),
                         pa.array(out[2][at].astype(np.int64))], names=[*head_names[:-1], *answer])

    sums = {"n_tokens": "long", "n_often": "long", "n_rare": "long", "often_score": "double", "states": "double"}
    answer = ["rare_score", "run_score", "n_rare_known"]
    kept = [*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]),
            *(f"{c} {t}" for c, t in sums.items())]
    reply = ", ".join([*kept, "at long, block long, texts binary", *(f"{c} binary" for c in answer)])
    answers = to_arrow_schema(StructType.fromDDL(reply))
    head_names, head_types = answers.names[:-5], answers.types[:-5]
    asks = rows.mapInArrow(run, ", ".join([*kept, "at long, block long, bucket int, keys binary, texts binary"]))
    known = words.where(F.col("n") < tree.min_count).select("word", "n").mapInArrow(
        _packed("n", bits), "bucket int, keys binary, n binary").unionByName(
        tree.others.select("run", "value").mapInArrow(
            _packed("value", bits), "bucket int, keys binary, value binary"), allowMissingColumns=True)
    found = asks.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(answered, reply) \
        .groupBy("block").applyInArrow(
            added_up, ", ".join([*kept, "rare_score double, run_score double, n_rare_known long"]))
    zero, none = F.lit(0).cast("long"), F.lit(0.0)
    rare_score = F.coalesce("rare_score", none)
    return found.select(
        *[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], "n_tokens",
        (F.col("n_often") + F.coalesce("n_rare_known", zero)).alias("n_known"),
        F.lit(tree.tokens).cast("long").alias("train_tokens"),
        (F.col("often_score") + rare_score - F.col("n_tokens") * F.lit(unit)).alias("base_score"),
        # a rare word: its own p in place of that of any
        (F.col("states") + F.coalesce("run_score", none) + rare_score
         - F.col("n_rare") * F.lit(unit + float(tree.root[RARE]))).alias("score"))
