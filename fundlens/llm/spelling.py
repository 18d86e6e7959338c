"""Grouping of spelling variants by a trie of letter-group counts.

Words are runs of letters, counted over the corpus.  Two words are near if one
code point inserted, deleted or replaced turns one into the other.  A word's
form is its near word of largest count (ties: the smallest in code-point order)
if that is at least ``RATIO`` times its own, and its root the last of the forms
that follow one another.

Letters are dealt into ``GROUPS`` groups by their code point, and a word is
known by how many letters it has of each.  An edit adds at most one to one group
(a surplus) and takes at most one from one group (a deficit).  Words are arranged
in a trie by their successive counts; a depth-first search, for all words that
ask at a node at once, follows a child while the surplus and the deficit so far
are at most one each, and the words at the leaves it reaches are verified letter
by letter.  Leaves with many words are first matched on the half of the word
that the edit leaves alone, so no task compares all pairs of a group.

On the cluster the trie is cut into subtrees: nodes from depth ``TOP`` on with
at most ``SUBTREE`` words.  The nodes above them are few (each has more words
than that) and known to every task, which searches them in the same way to find
the subtrees that a word must ask; a word is sent to those behind its own, so
each pair meets once.  Words, counts and subtrees are dealt by shuffle.

Null texts have no words, and a null id counts as ''.  Words are kept whole,
whatever their length.  Rows repeated whole are counted each.  An empty table
gives an empty result.  Only ``id_col`` and ``text_col`` are read, so further
columns, whatever their names, change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.llm.batches import SpanHash
from fundlens.llm.frames import stored

MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
#: One in so many occurrences loses a letter.
DAMAGE = 199
GROUPS = 20
#: Least depth of a subtree, and the words it has at most (if it can be cut).
TOP = 4
SUBTREE = 10_000
#: Words of a node that are compared without a further descent.
LEAF = 8
#: Pairs of a leaf that are compared directly, and pairs verified at once.
DIRECT, BLOCK = 1 << 14, 1 << 20


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT, damage: int = DAMAGE) -> DataFrame:
    """``word`` and ``n``: maximal runs of Latin letters, A-Z in lower case.
    Where ``damage`` divides the unsigned crc32 of '<id>:<run>', the run has
    lost its code point at that number modulo its length."""
    run = F.regexp_extract_all(df[text_col], F.lit(f"[A-Za-zÀ-ÿ]{{{min_length},}}"), F.lit(0))
    # explode_outer: a plain explode would extract the runs twice
    rows = df.select(F.coalesce(df[id_col].cast("string"), F.lit("")).alias("id"), F.explode_outer(run).alias("run"))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    rows = rows.where("run is not null").select("id", F.translate("run", upper, upper.lower()).alias("run"))
    crc = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    at = (crc % F.length("run")).cast("int")
    lost = F.concat(F.expr("substring(run, 1, at)"), F.expr("substring(run, at + 2)"))
    rows = rows.select("run", (crc % damage == 0).alias("hit"), at.alias("at"))
    rows = rows.select(F.when(F.col("hit"), lost).otherwise(F.col("run")).alias("word"))
    return (rows.where(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= min_count))


class Words:
    """Words as bytes (their letters are Latin-1) with their group counts."""

    def __init__(self, words: list[str]):
        self.size = np.array([len(w) for w in words], np.int64)
        self.end = np.cumsum(self.size)
        self.start = self.end - self.size
        self.data = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
        row = np.repeat(np.arange(len(words)), self.size)
        self.vector = np.bincount(row * GROUPS + self.data % GROUPS, minlength=len(words) * GROUPS) \
            .reshape(-1, GROUPS).astype(np.int32)
        self._hash = None

    def halves(self, rows: np.ndarray, shorter: np.ndarray) -> list[np.ndarray]:
        """Hashes of the first and of the last half of words, as halves of a
        near word of size ``shorter`` (their own, or one less)."""
        self._hash = self._hash or SpanHash(self.data)
        half = shorter // 2
        key = shorter.astype(np.uint64) << np.uint64(1)
        first = self._hash(self.start[rows], self.start[rows] + half)
        last = self._hash(self.end[rows] - (shorter - half), self.end[rows])
        return [first ^ key, last ^ (key | np.uint64(1))]


def near(words: Words, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words a and b differ by exactly one edit."""
    size_a, size_b = words.size[a], words.size[b]
    ok = (np.abs(size_a - size_b) <= 1) & (a != b)
    out = np.zeros(len(a), bool)
    alive = np.flatnonzero(ok)
    a, b, size_a, size_b = a[alive], b[alive], size_a[alive], size_b[alive]
    short, long = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
    same = [np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)]
    for k in range(2):  # equal letters from the front, then from the back
        go = np.arange(len(a))
        step = 0
        while len(go):
            go = go[short[go] > step]
            at = (words.start[a[go]] + step, words.start[b[go]] + step) if k == 0 else \
                (words.end[a[go]] - 1 - step, words.end[b[go]] - 1 - step)
            go = go[words.data[at[0]] == words.data[at[1]]]
            same[k][go] += 1
            step += 1
    one = same[0] + same[1] >= long - 1
    one &= (size_a != size_b) | (same[0] < short)
    out[alive] = one
    return out


def _pairs_of_leaf(words: Words, ask: np.ndarray, have: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    if len(ask) * len(have) <= DIRECT:
        yield np.repeat(ask, len(have)), np.tile(have, len(ask))
        return
    for less_ask, less_have in ((0, 0), (1, 0), (0, 1)):  # whose word is the longer one
        for key, other in zip(words.halves(ask, words.size[ask] - less_ask),
                              words.halves(have, words.size[have] - less_have), strict=True):
            order = np.argsort(other)
            low = np.searchsorted(other[order], key, "left")
            count = np.searchsorted(other[order], key, "right") - low
            for part in np.array_split(np.arange(len(ask)), 1 + int(count.sum()) // BLOCK):
                n = count[part]
                place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[part], n)
                yield np.repeat(ask[part], n), have[order[place]]


def search(words: Words, ask: np.ndarray, have: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (word of ``ask``, word of ``have``) that are near, by a
    depth-first search in the trie of ``have``."""
    have = have[np.lexsort(words.vector[have].T[::-1])]
    vector = words.vector[have]
    found_a, found_b, held, size = [], [], [], 0
    ask = np.asarray(ask)
    none = np.zeros(len(ask), np.int8)
    stack = [(0, 0, len(have), ask, none, none)] if len(ask) and len(have) else []

    def verify():
        a, b = (np.concatenate([h[i] for h in held]) for i in range(2))
        ok = near(words, a, b)
        pairs = np.unique(np.column_stack([a[ok], b[ok]]), axis=0)
        found_a.append(pairs[:, 0])
        found_b.append(pairs[:, 1])

    while stack:
        level, low, high, who, surplus, deficit = stack.pop()
        if level == GROUPS or high - low <= LEAF:
            for pair in _pairs_of_leaf(words, who, have[low:high]):
                held.append(pair)
                size += len(pair[0])
                if size >= BLOCK:
                    verify()
                    held, size = [], 0
            continue
        column = vector[low:high, level]
        cut = [0, *(np.flatnonzero(column[1:] != column[:-1]) + 1).tolist(), high - low]
        asked = words.vector[who, level]
        for first, end in zip(cut[:-1], cut[1:], strict=True):
            more = column[first] - asked
            plus, minus = surplus + np.maximum(more, 0), deficit + np.maximum(-more, 0)
            on = (plus <= 1) & (minus <= 1)
            if on.any():
                stack.append((level + 1, low + first, low + end, who[on], plus[on].astype(np.int8),
                              minus[on].astype(np.int8)))
    if held:
        verify()
    pairs = np.unique(np.column_stack([np.concatenate(found_a or [none[:0]]), np.concatenate(found_b or [none[:0]])])
                      .astype(np.int64), axis=0)
    return pairs[:, 0], pairs[:, 1]


def _subtrees(vector: tuple[int, ...], upper: set, top: int) -> list[tuple[int, ...]]:
    """The subtrees that a word of these counts must ask (the first is its
    own): a depth-first search of the nodes above the subtrees."""
    own = next(d for d in range(top, GROUPS + 1) if vector[:d] not in upper)
    out, stack = [vector[:own]], [((), 0, 0)]
    while stack:
        prefix, surplus, deficit = stack.pop()
        depth = len(prefix)
        if depth >= top and prefix not in upper:
            if prefix > vector[:own]:
                out.append(prefix)
            continue
        for more in (-1, 0, 1):
            plus, minus = surplus + (more > 0), deficit + (more < 0)
            if plus <= 1 and minus <= 1 and vector[depth] + more >= 0:
                stack.append(((*prefix, vector[depth] + more), plus, minus))
    return out


def _deal(upper: set, top: int):
    """For ``mapInArrow`` over (word, n): a row per subtree that the word
    belongs to (``own``) or must ask."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deepest = max([top, *(len(p) + 1 for p in upper)])
        known: dict[tuple, list[str]] = {}
        for batch in batches:
            words = Words(batch.column("word").to_pylist())
            keys, own, row = [], [], []
            for i, vector in enumerate(map(tuple, words.vector.tolist())):
                head = vector[:deepest]
                if head not in known:
                    known[head] = [",".join(map(str, p)) for p in _subtrees(vector, upper, top)]
                keys += known[head]
                own += [True] + [False] * (len(known[head]) - 1)
                row += [i] * len(known[head])
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(own, pa.bool_()),
                                              batch.column("word").take(at), batch.column("n").take(at)],
                                             ["subtree", "own", "word", "n"])
    return run


def _search_subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow`` over whole subtrees: for each word with near ones in
    this task, their number and the best of them."""
    batches = [x for x in batches if x.num_rows]
    if not batches:
        return
    dealt = pa.Table.from_batches(batches)
    rows = dealt.group_by("word").aggregate([("own", "max"), ("n", "max")])
    words = Words(names := rows.column("word").to_pylist())
    own, n = rows.column("own_max").to_numpy(), rows.column("n_max").to_numpy()
    a, b = search(words, np.arange(len(names)), np.flatnonzero(own))
    # a task has many subtrees: a word that only asks meets here those that it
    # asks, not the others, whose words ask its own subtree in another task
    subtrees = pc.unique(dealt.column("subtree"))
    at = pc.index_in(dealt.column("word"), rows.column("word").combine_chunks()).to_numpy().astype(np.int64)
    tree = pc.index_in(dealt.column("subtree"), subtrees).to_numpy().astype(np.int64)
    home = np.zeros(len(names), np.int64)
    mine = dealt.column("own").to_numpy()
    home[at[mine]] = tree[mine]
    meets = own[a] | np.isin(a * len(subtrees) + home[b], at * len(subtrees) + tree)
    a, b = a[meets], b[meets]
    # it is not asked itself: both directions from one
    guest = ~own[a]
    a, b = np.concatenate([a, b[guest]]), np.concatenate([b, a[guest]])
    rank = np.empty(len(names), np.int64)
    rank[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
    order = np.lexsort((rank[b], -n[b], a))
    a, b = a[order], b[order]
    head = np.flatnonzero(np.append(True, a[1:] != a[:-1]))[:len(a)]
    take = lambda at: pa.array([names[i] for i in at.tolist()], pa.string())
    yield pa.RecordBatch.from_arrays(
        [take(a[head]), pa.array(np.diff(np.append(head, len(a)))), pa.array(n[b[head]]), take(b[head])],
        ["word", "n_near", "best_n", "best"])


def _upper_nodes(words: DataFrame, top: int, subtree: int) -> set:
    """Nodes from depth ``top`` on with more than ``subtree`` words, as tuples
    of counts: at most one per ``subtree`` words and depth."""
    letters = [chr(c) for c in (*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100))]
    counts = []
    for g in range(GROUPS):
        mine = "".join(c for c in letters if ord(c) % GROUPS == g)
        counts.append(F.length("word") - F.length(F.translate("word", mine, "")))
    out: set = set()
    rows = words
    for depth in range(top, GROUPS):
        prefix = F.concat_ws(",", *[c.cast("string") for c in counts[:depth]])
        full = [r[0] for r in rows.groupBy(prefix.alias("p")).count().where(F.col("count") > subtree).collect()]
        if not full:
            break
        out |= {tuple(map(int, p.split(","))) for p in full}
        rows = rows.where(prefix.isin(full))
    return out


def near_words(words: DataFrame, top: int = TOP, subtree: int = SUBTREE) -> DataFrame:
    """For each word of (``word``, ``n``) with near ones: ``n_near``, and the
    near word ``best`` of largest count ``best_n``."""
    upper = _upper_nodes(words, top, subtree)
    dealt = words.mapInArrow(_deal(upper, top), "subtree string, own boolean, word string, n long")
    found = dealt.repartition("subtree").mapInArrow(
        _search_subtrees, "word string, n_near long, best_n long, best string")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                     F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("first")) \
        .select("word", "n_near", (-F.col("first.n")).alias("best_n"), F.col("first.best").alias("best"))


def variant_forms(words: DataFrame, ratio: int = RATIO, top: int = TOP, subtree: int = SUBTREE) -> DataFrame:
    """Per word of a stored (``word``, ``n``): ``n``, ``form``, ``form_n``,
    ``root`` and ``n_near``."""
    found = near_words(words, top, subtree)
    known = words.join(found, "word", "left")
    has = F.col("best_n") >= ratio * F.col("n")
    rows = stored(known.select("word", "n", F.when(has, F.col("best")).alias("form"),
                               F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                               F.when(has, F.col("best_n")).alias("form_n")), "forms")
    # each step doubles the forms that are followed; counts grow by the ratio
    # at every form, so a chain has few of them
    links = rows.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = stored(links.join(onward, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if links.where("moved").isEmpty():
            break
        links = links.select("word", "root")
    return rows.join(links.select("word", "root"), "word", "left").select(
        "word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n")


def spelling_variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                      min_count: int = MIN_COUNT, ratio: int = RATIO, damage: int = DAMAGE, top: int = TOP,
                      subtree: int = SUBTREE) -> DataFrame:
    """``variant_forms`` of the words of a table of texts."""
    words = stored(word_counts(df, id_col, text_col, min_length, min_count, damage), "words")
    return variant_forms(words, ratio, top, subtree)
