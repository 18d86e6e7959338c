"""Document quality by co-training two views.

The content view sees a text's words: relative frequencies of hashed words and
of word shapes (letters, digits, symbols, length, repetition).  The metadata
view sees the page around them: source, language, recorded length and layout
(lines, words a line, characters a word).  Each view has its own logistic
regression.  Over some rounds each labels the unlabelled rows it is most sure
of, in the labels' own proportion, and hands them to the other as further
training rows.  Both are then calibrated on labelled rows that neither has
learned from, and a last logistic regression over the two calibrated log-odds
scores every document.

Fitting (numpy, on the driver) uses bounded samples of labelled and unlabelled
rows, taken in the order of a hash of the id, with their whole texts reduced to
features in tasks.  Scoring covers all rows and whole texts.

A null text counts as empty and has no content features; null metadata is a
value of its own.  Without labels, or with one label only, the score tends to
the labels' share (0.5 without any).  Repeated rows score alike; an id with
several rows is sampled once, by the row of least features, so one id cannot fill
the sample.  Rows that a view is equally sure of are taken in id order.  Texts of any
length are read whole, a very long one as a batch of its own.  Clashing column
names are kept; ``quality_score`` and ``accepted`` are appended last.  An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlens.llm.batches import LOWER, SpanHash, chunks, release, text_buffer, word_spans
from fundlens.llm.frames import fresh, small_batches

WORD_SLOTS = 1024
SHAPES = 96
#: Slots of the metadata view: source, language, length, lines, words a line,
#: characters a word.
SLOTS = (64, 32, 32, 24, 24, 24)
#: Labelled and unlabelled rows used to fit, at most.
LABELLED = 4000
POOL = 3000
ROUNDS = 4
#: Share of the pool that a view labels in a round.
SURE = 0.05
THRESHOLD = 0.5

SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
DIGIT = np.zeros(256, bool)
DIGIT[ord("0"):ord("9") + 1] = True
LETTER = np.zeros(256, bool)
LETTER[ord("a"):ord("z") + 1] = True
LETTER[128:] = True


class Page:
    """The two views of a batch of documents, as sparse slots.

    Content: per word a word slot and a shape slot, each weighing one over the
    text's words.  Metadata: one slot of each kind per document."""

    def __init__(self, texts: pa.Array, sources: pa.Array, langs: pa.Array, lengths: pa.Array):
        data, offsets = text_buffer(texts)
        data = LOWER[data]
        starts, ends, self.rows = word_spans(data, offsets)
        self.n = n = len(texts)
        self.count = np.bincount(self.rows, minlength=n)
        hashes = SpanHash(data)(starts, ends)
        self.word = (hashes % np.uint64(WORD_SLOTS)).astype(np.int64)
        repeated = np.zeros(len(starts), bool)
        repeated[1:] = (hashes[1:] == hashes[:-1]) & (self.rows[1:] == self.rows[:-1])

        def any_of(table: np.ndarray) -> np.ndarray:
            total = np.zeros(len(data) + 1, np.int64)
            np.cumsum(table[data], out=total[1:])
            return total[ends] > total[starts]

        size = np.searchsorted([3, 6, 10, 15, 25], ends - starts, "right")
        self.shape = (any_of(LETTER) + 2 * any_of(DIGIT) + 4 * any_of(SYMBOL) + 8 * repeated
                      + 16 * size)
        lines = np.bincount(np.searchsorted(offsets, np.flatnonzero(data == ord("\n")), "right") - 1, minlength=n) + 1
        letters = np.bincount(self.rows, weights=ends - starts, minlength=n)
        known = lengths.cast(pa.float64()).fill_null(-1).to_numpy(zero_copy_only=False)

        def scale(x: np.ndarray, fine: float, slots: int) -> np.ndarray:
            return np.minimum(np.log2(np.maximum(x, 0) + 1) * fine, slots - 2).astype(int) + 1

        def named(column: pa.Array, slots: int) -> np.ndarray:
            data, offsets = text_buffer(column.cast(pa.string()))
            slot = SpanHash(data)(offsets[:-1], offsets[1:]) % np.uint64(slots - 1)
            return np.where(column.is_null().to_numpy(zero_copy_only=False), 0, slot.astype(np.int64) + 1)

        kinds = [named(sources, SLOTS[0]), named(langs, SLOTS[1]),
                 np.where(known < 0, 0, scale(known, 1.5, SLOTS[2])), scale(lines, 2, SLOTS[3]),
                 scale(self.count / lines, 3, SLOTS[4]), scale(letters / np.maximum(self.count, 1), 6, SLOTS[5])]
        self.meta = np.column_stack(kinds) + np.cumsum([0, *SLOTS[:-1]])

    def content_sums(self, weights: np.ndarray) -> np.ndarray:
        """Per document: the mean weight of its words and shapes."""
        each = weights[self.word] + weights[WORD_SLOTS + self.shape]
        return np.bincount(self.rows, each, self.n) / np.maximum(self.count, 1)

    def content_matrix(self) -> np.ndarray:
        out = np.zeros((self.n, WORD_SLOTS + SHAPES), np.float32)
        share = (1 / np.maximum(self.count, 1))[self.rows]
        np.add.at(out, (self.rows, self.word), share)
        np.add.at(out, (self.rows, WORD_SLOTS + self.shape), share)
        return out

    def meta_matrix(self) -> np.ndarray:
        out = np.zeros((self.n, sum(SLOTS)), np.float32)
        out[np.arange(self.n)[:, None], self.meta] = 1
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and shift, by accelerated gradient descent."""
    n = max(len(y), 1)
    # an upper bound of the loss's curvature
    rate = 1 / (0.25 * (float((x * x).sum(axis=1).max(initial=0)) + 1) + ridge)
    prior = (y.sum() + 1) / (len(y) + 2)
    w, b = np.zeros(x.shape[1], x.dtype), float(np.log(prior / (1 - prior)))
    w_ahead, b_ahead, rate = w, b, x.dtype.type(rate)
    for k in range(steps):
        d = ((sigmoid(x @ w_ahead + b_ahead) - y) / n).astype(x.dtype)
        w_next, b_next = w_ahead - rate * (d @ x + ridge * w_ahead), b_ahead - float(rate * d.sum())
        pull = k / (k + 3)
        w_ahead, b_ahead = w_next + pull * (w_next - w), b_next + pull * (b_next - b)
        w, b = w_next, b_next
    return w, b


@dataclass
class Model:
    content: tuple[np.ndarray, float]
    meta: tuple[np.ndarray, float]
    #: slope and shift of each view, then weights and shift of both
    views: list[tuple[float, float]]
    both: tuple[np.ndarray, float]

    def combine(self, content: np.ndarray, meta: np.ndarray) -> np.ndarray:
        odds = np.column_stack([z * s + b for z, (s, b) in zip((content, meta), self.views, strict=True)])
        return sigmoid(odds @ self.both[0] + self.both[1])

    def score(self, page: Page) -> np.ndarray:
        content = page.content_sums(self.content[0]) * SCALE + self.content[1]
        meta = self.meta[0][page.meta].sum(axis=1) + self.meta[1]
        return self.combine(content, meta)


#: Content shares are small; their features are scaled up by this.
SCALE = 10.0


def platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and shift that calibrate log-odds."""
    w, b = fit_logistic(np.clip(z, -30, 30)[:, None] / 4, y, 1e-3)
    return max(float(w[0]) / 4, 0.0), float(b)


def co_train(content: np.ndarray, meta: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS,
             sure: float = SURE) -> Model:
    """``labels``: 0, 1, or -1 for the pool.  Every third labelled row is
    left for calibration."""
    views = [content * SCALE, meta]
    known = np.flatnonzero(labels >= 0)
    held = known[2::3] if len(known) >= 30 else known
    first = np.setdiff1d(known, held) if len(known) >= 30 else known
    pool = np.flatnonzero(labels < 0)
    share = labels[first].mean() if len(first) else 0.5
    given = [(first, labels[first].astype(float)) for _ in views]
    free = [np.ones(len(labels), bool) for _ in views]
    ridges = (1e-4, 1e-3)

    def fitted() -> list:
        return [fit_logistic(v[rows], y, r) for v, (rows, y), r in zip(views, given, ridges, strict=True)]

    models = fitted()
    for _ in range(rounds if len(first) and len(pool) else 0):
        news = []
        for i, (w, b) in enumerate(models):
            rest = pool[free[1 - i][pool]]
            z = views[i][rest] @ w + b
            order, most = rest[np.argsort(z, kind="stable")], max(1, int(sure * len(pool)))
            bad, good = order[:int(round(most * (1 - share)))], order[len(order) - int(round(most * share)):]
            news.append((np.concatenate([bad, good]), np.repeat([0.0, 1.0], [len(bad), len(good)])))
        for i, (rows, y) in enumerate(news):
            free[1 - i][rows] = False
            given[1 - i] = tuple(np.concatenate(x) for x in zip(given[1 - i], (rows, y), strict=True))
        models = fitted()
    z = [v[held] @ w + b for v, (w, b) in zip(views, models, strict=True)]
    y = labels[held].astype(float)
    scales = [platt(x, y) for x in z]
    odds = np.column_stack([x * s + b for x, (s, b) in zip(z, scales, strict=True)])
    return Model(*models, scales, fit_logistic(np.clip(odds, -30, 30), y, 1e-3))


def _page(part: pa.RecordBatch) -> Page:
    return Page(*(part.column(c) for c in ("_text", "_source", "_lang", "_length")))


def _views(df: DataFrame, text_col: str, source_col: str, lang_col: str, length_col: str) -> list[Column]:
    return [F.coalesce(df[text_col], F.lit("")).alias("_text"), df[source_col].cast("string").alias("_source"),
            df[lang_col].cast("string").alias("_lang"), df[length_col].cast("double").alias("_length")]


COLUMNS = ("text", "source", "lang", "n_chars")


def fit(df: DataFrame, labels: DataFrame, trains: Column | None = None, id_col: str = "doc_id",
        label_col: str = "quality", columns: tuple[str, str, str, str] = COLUMNS,
        labelled: int = LABELLED, unlabelled: int = POOL) -> Model:
    """Fit on samples of ``df``: at most ``labelled`` and ``unlabelled`` ids.  ``labels`` has one or more rows per id (a
    document with any label 0 counts as bad); ``trains`` tells from the column
    ``id`` which ids may be learned from; ``columns``: text, source, language
    and recorded length."""
    small_batches(df.sparkSession)
    trains = F.lit(True) if trains is None else trains
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")) \
        .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & trains)
    known = known.groupBy("id").agg(F.min("label").alias("label")) \
        .orderBy(F.xxhash64("id", F.lit("labelled")), "id").limit(labelled)
    pool = df.select(df[id_col].alias("id")).where(F.col("id").isNotNull() & trains).distinct() \
        .orderBy(F.xxhash64("id", F.lit("pool")), "id").limit(unlabelled)
    ids = known.unionByName(pool.withColumn("label", F.lit(None).cast("int"))) \
        .groupBy("id").agg(F.max("label").alias("label"))
    rows = df.select(df[id_col].alias("key"), *_views(df, *columns)) \
        .join(F.broadcast(ids), F.col("key") == F.col("id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "_text"):
            page = _page(part)
            pack = lambda m: pa.array([r.astype(np.float32).tobytes() for r in m], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("label"), pack(page.content_matrix()), pack(page.meta_matrix())],
                ["id", "label", "content", "meta"])
        release()

    kind = df.schema[id_col].dataType.simpleString()
    found = rows.mapInArrow(run, f"id {kind}, label int, content binary, meta binary").groupBy("id") \
        .agg(F.min(F.struct("content", "meta", "label")).alias("of")).select("id", "of.*").orderBy("id").toArrow()
    labels_of = found.column("label").combine_chunks().fill_null(-1).to_numpy().astype(int)
    unpack = lambda c, n: np.frombuffer(b"".join(found.column(c).to_pylist()), np.float32).reshape(-1, n)
    return co_train(unpack("content", WORD_SLOTS + SHAPES), unpack("meta", sum(SLOTS)), labels_of)


def score(df: DataFrame, model: Model, columns: tuple[str, str, str, str] = COLUMNS,
          threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with ``quality_score`` (0 to 1) and ``accepted``."""
    small_batches(df.sparkSession)
    names = fresh(df, "_text", "_source", "_lang", "_length")
    rows = df.withColumns({n: c for n, c in zip(names, _views(df, *columns), strict=True)})
    schema = T.StructType([*df.schema.fields, T.StructField("quality_score", T.DoubleType()),
                           T.StructField("accepted", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, names[0]):
            p = model.score(Page(*(part.column(n) for n in names)))
            yield pa.RecordBatch.from_arrays([*part.columns[:-4], pa.array(p), pa.array(p >= threshold)],
                                             names=schema.names)
        release()

    return rows.mapInArrow(run, schema)
