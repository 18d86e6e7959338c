"""Toxicity scores from a bidirectional gated recurrent network.

The input of a time step is a word (A-Z in lower case): the embedding of its
hash and the sum of the embeddings of its character 4-grams (over UTF-8 bytes,
with separators before it), so unknown forms of a known stem are seen by
their characters.  One gated recurrent layer reads a window of words forwards,
one backwards; an attention layer weighs the steps, and the weighted sum gives
the window's logit.  Windows of ``WINDOW`` words start every ``STRIDE`` words,
so every text is covered whole by overlapping windows.

Labels belong to documents, not to windows: training (numpy, on the driver, on
a bounded sample of labelled documents) takes from a toxic document the window
that looks most toxic, first by its 4-grams' surplus in toxic documents, then by
the network itself, and from a clean document its most toxic looking window and
another.  A document's score is the calibrated largest logit of its windows.
Scoring runs per Arrow batch in tasks; the network is shipped with them.

``fit`` does this for texts of any length: the 4-grams' surplus is counted over
whole texts in tasks, and a text of more than ``KEPT`` windows sends the
``KEPT - SPREAD`` that look most toxic by it and ``SPREAD`` drawn by place.  The
calibration reads the logits of whole texts that the network has not learned from.

A null text counts as empty; a text without words is one window without steps,
whose pooled state is zero.  Without labelled rows the score is 0.5.  Repeated
rows score alike; an id with several texts is sampled once, by the text of least
hash.  Windows that look equally toxic are taken in text order.  An empty table
gives an empty result.  Clashing column names are kept; ``score`` and
``predicted`` are appended last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlens.llm.batches import CHUNK_BYTES, LOWER, SpanHash, chunks, mix, text_buffer, word_spans
from fundlens.llm.frames import fresh, small_batches, stored

WINDOW = 32
STRIDE = 24
WORD_SLOTS = 1 << 15
GRAM_SLOTS = 1 << 15
WIDTH = 8     # of an embedding
STATES = 12   # of a direction
ATTENTION = 8
#: Labelled documents used to fit, at most, of each label.
POSITIVES = 2000
NEGATIVES = 3000
#: Windows that a sampled text sends to the driver, at most, and how many of
#: them are spread over it when it has more.
KEPT = 24
SPREAD = 8
ROUNDS = 4
#: Training steps a round, and windows a step, half of them of toxic documents.
STEPS = 90
BATCH = 256
THRESHOLD = 0.7
EMBEDDINGS = ("word", "gram")
EMBEDDING_RATE = 20.0


class Words:
    """The words of a batch of texts as network input, and their windows."""

    def __init__(self, texts: pa.Array):
        data, offsets = text_buffer(texts)
        data = LOWER[data]
        starts, ends, self.rows = word_spans(data, offsets)
        self.n = len(texts)
        self.data, self.spans = data, (starts, ends)
        self.word = (SpanHash(data)(starts, ends) % np.uint64(WORD_SLOTS)).astype(np.int32)
        # the 4-gram that ends at each byte of a word, with separators before
        # the word
        length = ends - starts
        self.first_gram = np.cumsum(length) - length
        place = np.arange(int(length.sum())) - np.repeat(self.first_gram, length)
        at = place + np.repeat(starts, length)
        gram = data[at].astype(np.uint64)
        for back in (1, 2, 3):
            before = np.where(place >= back, data[np.maximum(at - back, 0)], np.uint8(32))
            gram |= before.astype(np.uint64) << np.uint64(8 * back)
        self.gram = (mix(gram) % np.uint64(GRAM_SLOTS)).astype(np.int32)
        count = np.bincount(self.rows, minlength=self.n)
        # windows: enough strides that the last one reaches the end, and one
        # for a text without words
        windows = 1 + np.maximum(0, -(-(count - WINDOW) // STRIDE))
        self.window_row = np.repeat(np.arange(self.n), windows)
        number = np.arange(len(self.window_row)) - np.repeat(np.cumsum(windows) - windows, windows)
        begin = np.cumsum(count) - count
        self.window_start = begin[self.window_row] + number * STRIDE
        self.window_size = np.clip(count[self.window_row] - number * STRIDE, 0, WINDOW)

    @classmethod
    def of(cls, texts: list[str], limit: int = CHUNK_BYTES) -> Words:
        """Those of many texts, read ``limit`` characters at a time."""
        sizes = np.cumsum([len(t) + 1 for t in texts]) // limit
        borders = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(texts)]
        parts = [cls(pa.array(texts[a:b], pa.large_string())) for a, b in zip(borders, borders[1:], strict=False)]
        out = parts[0]
        for name, total in (("rows", "n"), ("first_gram", "gram"), ("window_row", "n"), ("window_start", "word")):
            size = [getattr(p, total) if total == "n" else len(getattr(p, total)) for p in parts]
            shifts = np.cumsum([0, *size[:-1]])
            setattr(out, name, np.concatenate([getattr(p, name) + k for p, k in zip(parts, shifts, strict=True)]))
        for name in ("word", "gram", "window_size"):
            setattr(out, name, np.concatenate([getattr(p, name) for p in parts]))
        out.n = len(texts)
        return out

    def texts(self, windows: np.ndarray) -> list[str]:
        """The texts of windows, from their first word to their last (of words
        that were not put together by ``of``)."""
        starts, ends = self.spans
        first, size = self.window_start[windows], self.window_size[windows]
        return [bytes(self.data[starts[a]:ends[a + n - 1]]).decode() if n else ""
                for a, n in zip(first.tolist(), size.tolist(), strict=True)]

    def steps(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word places (windows x WINDOW) and which of them exist."""
        step = np.arange(WINDOW)
        real = step[None, :] < self.window_size[windows][:, None]
        return np.where(real, self.window_start[windows][:, None] + step, 0), real


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def new_network(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    net = {"word": normal(WORD_SLOTS, WIDTH, scale=0.02), "gram": normal(GRAM_SLOTS, WIDTH, scale=0.02)}
    for way in ("forward", "backward"):
        net |= {f"{way}_in": normal(2 * WIDTH, 3 * STATES, scale=0.3),
                f"{way}_state": normal(STATES, 3 * STATES, scale=0.3),
                f"{way}_bias": np.zeros(3 * STATES, np.float32)}
    net |= {"attend": normal(2 * STATES, ATTENTION, scale=0.3), "attend_bias": np.zeros(ATTENTION, np.float32),
            "focus": normal(ATTENTION, scale=0.3), "out": normal(2 * STATES, scale=0.3),
            "out_bias": np.zeros(1, np.float32)}
    return net


def _inputs(net: dict, words: Words, low: int = 0, high: int | None = None) -> np.ndarray:
    """The network's input vectors of the words from ``low`` to ``high``."""
    first = np.append(words.first_gram, len(words.gram))
    high = len(words.word) if high is None else high
    if low >= high:
        return np.zeros((1, 2 * WIDTH), np.float32)
    grams = net["gram"][words.gram[first[low]:first[high]]]
    grams = np.add.reduceat(grams, first[low:high] - first[low], axis=0)
    return np.concatenate([net["word"][words.word[low:high]], np.tanh(grams)], axis=1)


def _run(net: dict, way: str, x: np.ndarray, real: np.ndarray, keep: bool = False):
    """States after each step of one direction; ``x`` has the projected
    inputs (windows x steps x 3 * STATES)."""
    n, steps, _ = x.shape
    h = np.zeros((n, STATES), np.float32)
    out = np.zeros((n, steps, STATES), np.float32)
    cache = []
    order = range(steps) if way == "forward" else range(steps - 1, -1, -1)
    state = net[f"{way}_state"]
    for t in order:
        back = h @ state
        gates = _sigmoid(x[:, t, :2 * STATES] + back[:, :2 * STATES])
        reset, update = gates[:, :STATES], gates[:, STATES:]
        new = np.tanh(x[:, t, 2 * STATES:] + reset * back[:, 2 * STATES:])
        step = np.where(real[:, t, None], h + update * (new - h), h)
        if keep:
            cache.append((t, h, back, reset, update, new))
        h = step
        out[:, t] = h
    return out, cache


def forward(net: dict, place: np.ndarray, real: np.ndarray, inputs: np.ndarray, keep: bool = False):
    """Logits of windows, whose steps are ``place`` in ``inputs`` where
    ``real`` (and what the backward pass needs)."""
    caches, states = {}, []
    for way in ("forward", "backward"):
        projected = inputs[place] @ net[f"{way}_in"] + net[f"{way}_bias"]
        out, caches[way] = _run(net, way, projected, real, keep)
        states.append(out)
    h = np.concatenate(states, axis=2)
    u = np.tanh(h @ net["attend"] + net["attend_bias"])
    e = np.where(real, u @ net["focus"], -1e9)
    a = np.exp(e - e.max(axis=1, keepdims=True)) * real
    a /= np.maximum(a.sum(axis=1, keepdims=True), 1e-9)
    pooled = np.einsum("nt,ntd->nd", a, h)
    logits = pooled @ net["out"] + net["out_bias"][0]
    return logits, (caches, h, u, a, pooled) if keep else None


def gradients(net: dict, words: Words, windows: np.ndarray, labels: np.ndarray) -> tuple[float, dict]:
    """Mean cross-entropy of windows and its gradients."""
    place, real = words.steps(windows)
    used, place = np.unique(place, return_inverse=True)
    place = place.reshape(real.shape)
    inputs = np.zeros((len(used), 2 * WIDTH), np.float32)
    if len(words.word):
        size = (np.append(words.first_gram[1:], len(words.gram)) - words.first_gram)[used]
        first = np.cumsum(size) - size
        gram = words.gram[np.arange(int(size.sum())) + np.repeat(words.first_gram[used] - first, size)]
        summed = np.tanh(np.add.reduceat(net["gram"][gram], first, axis=0))
        inputs = np.concatenate([net["word"][words.word[used]], summed], axis=1)
    logits, (caches, h, u, a, pooled) = forward(net, place, real, inputs, keep=True)
    p = _sigmoid(logits)
    loss = -np.mean(np.log(np.where(labels > 0, p, 1 - p) + 1e-9))
    d = ((p - labels) / len(labels)).astype(np.float32)
    grad = {"out": pooled.T @ d, "out_bias": d.sum(keepdims=True)}
    d_pool = d[:, None] * net["out"]
    d_a = np.einsum("nd,ntd->nt", d_pool, h)
    d_e = a * (d_a - (a * d_a).sum(axis=1, keepdims=True))
    d_u = d_e[:, :, None] * net["focus"] * (1 - u * u)
    grad["focus"] = np.einsum("nt,nta->a", d_e, u)
    grad["attend"] = np.einsum("ntd,nta->da", h, d_u)
    grad["attend_bias"] = d_u.sum(axis=(0, 1))
    d_h = a[:, :, None] * d_pool[:, None, :] + d_u @ net["attend"].T
    d_in = np.zeros_like(inputs)
    for i, way in enumerate(("forward", "backward")):
        d_out = d_h[:, :, i * STATES:(i + 1) * STATES]
        state = net[f"{way}_state"]
        d_x = np.zeros((*place.shape, 3 * STATES), np.float32)
        d_state, d_now = np.zeros_like(state), np.zeros((len(windows), STATES), np.float32)
        for t, h0, back, reset, update, new in reversed(caches[way]):
            d_now = d_now + d_out[:, t]
            live = real[:, t, None]
            d_new = d_now * update * (1 - new * new) * live
            d_update = d_now * (new - h0) * update * (1 - update) * live
            d_reset = d_new * back[:, 2 * STATES:] * reset * (1 - reset)
            d_back = np.concatenate([d_reset, d_update, d_new * reset], axis=1)
            d_x[:, t] = np.concatenate([d_reset, d_update, d_new], axis=1)
            d_state += h0.T @ d_back
            d_now = np.where(live, d_now * (1 - update), d_now) + d_back @ state.T
        grad[f"{way}_state"] = d_state
        grad[f"{way}_bias"] = d_x.sum(axis=(0, 1))
        flat, at = d_x.reshape(-1, 3 * STATES), place.ravel()
        grad[f"{way}_in"] = inputs[at].T @ flat
        np.add.at(d_in, at, flat @ net[f"{way}_in"].T)
    grad["word"], grad["gram"] = np.zeros_like(net["word"]), np.zeros_like(net["gram"])
    if len(words.word):
        np.add.at(grad["word"], words.word[used], d_in[:, :WIDTH])
        np.add.at(grad["gram"], gram, np.repeat(d_in[:, WIDTH:] * (1 - summed * summed), size, axis=0))
    return float(loss), grad


class Steps:
    """Gradient steps: Adam for the layers; plain ones for the embeddings, so
    that a word counts by how often it is seen (Adam would learn the words of
    single windows by heart)."""

    def __init__(self, net: dict, rate: float = 0.01, embedding_rate: float = EMBEDDING_RATE):
        self.rate, self.embedding_rate, self.t = rate, embedding_rate, 0
        self.first = {k: np.zeros_like(v) for k, v in net.items() if k not in EMBEDDINGS}
        self.second = {k: np.zeros_like(v) for k, v in self.first.items()}

    def step(self, net: dict, grad: dict) -> None:
        self.t += 1
        rate = self.rate * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        for k, g in grad.items():
            if k in EMBEDDINGS:
                net[k] -= (self.embedding_rate * g).astype(np.float32)
                continue
            self.first[k] += 0.1 * (g - self.first[k])
            self.second[k] += 0.001 * (g * g - self.second[k])
            net[k] -= (rate * self.first[k] / (np.sqrt(self.second[k]) + 1e-7)).astype(np.float32)


def _all_logits(net: dict, words: Words, step: int = 4096) -> np.ndarray:
    """Logits of all windows, ``step`` at a time with their own words."""
    out = [np.zeros(0, np.float32)]
    for i in range(0, len(words.window_row), step):
        windows = np.arange(i, min(i + step, len(words.window_row)))
        place, real = words.steps(windows)
        low = int(words.window_start[windows].min())
        high = int((words.window_start + words.window_size)[windows].max())
        out.append(forward(net, np.where(real, place - low, 0), real, _inputs(net, words, low, high))[0])
    return np.concatenate(out)


def document_logits(net: dict, texts: pa.Array) -> np.ndarray:
    """The largest logit of each text's windows."""
    words = Words(texts)
    best = np.full(words.n, -np.inf, np.float32)
    np.maximum.at(best, words.window_row, _all_logits(net, words))
    return best


def _gram_counts(words: Words, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Toxic and clean documents that hold each 4-gram; documents with label
    nan do not count."""
    counts = np.zeros((2, GRAM_SLOTS))
    starts = np.append(words.first_gram, len(words.gram))[np.searchsorted(words.rows, np.arange(words.n + 1))]
    for label, start, end in zip(labels, starts, starts[1:], strict=False):
        if not np.isnan(label):
            seen = np.zeros(GRAM_SLOTS, bool)
            seen[words.gram[start:end]] = True
            counts[int(label)] += seen
    return counts[1], counts[0]


def _surplus(toxic: np.ndarray, clean: np.ndarray, share: float) -> np.ndarray:
    """Per 4-gram: toxic documents above their ``share``, in standard
    deviations of the number of documents that hold it."""
    n = toxic + clean
    return (toxic - n * share) / np.sqrt(np.maximum(n, 1) * share * (1 - share))


def _window_odds(words: Words, odds: np.ndarray) -> np.ndarray:
    """Per window: the largest surplus of its 4-grams."""
    out = np.zeros(len(words.window_row))
    if len(words.word):
        of_word = np.maximum.reduceat(odds[words.gram], words.first_gram)
        for i in range(0, len(out), 8192):
            place, real = words.steps(np.arange(i, min(i + 8192, len(out))))
            out[i:i + 8192] = np.where(real, of_word[place], 0).max(axis=1)
    return out


def _share(labels: np.ndarray) -> float:
    return (np.nansum(labels) + 1) / ((~np.isnan(labels)).sum() + 2)


def _gram_odds(words: Words, labels: np.ndarray) -> np.ndarray:
    """Per window: the largest surplus of a 4-gram in toxic documents."""
    return _window_odds(words, _surplus(*_gram_counts(words, labels), _share(labels)))


def learn(words: Words, owner: np.ndarray, labels: np.ndarray, learns: np.ndarray, looks: np.ndarray,
          seed: int = 7, rounds: int = ROUNDS, steps: int = STEPS) -> tuple[dict, np.ndarray]:
    """The network and its logits of all windows.  Per window: its document
    ``owner`` (each has one at least, in order) and how toxic it ``looks``; per
    document: its label and whether it is learned from."""
    net = new_network(seed)
    rng, steps_of = np.random.default_rng(seed), Steps(net)
    for _ in range(rounds):
        # each document's most toxic looking window, and another of clean ones
        order = np.lexsort((-looks, owner))
        first = order[np.searchsorted(owner, np.arange(len(labels)))]
        clean = np.flatnonzero(labels[owner] == 0)
        other = rng.choice(clean, min(len(clean), len(labels)), replace=False)
        sides = [first[learns & (labels == 1)], np.concatenate([first[labels == 0], other])]
        sides = [x[learns[owner[x]]] for x in sides]
        sides = [x for x in sides if len(x)]
        for _ in range(steps if sides else 0):
            chosen = np.concatenate([rng.choice(x, BATCH // len(sides)) for x in sides])
            target = labels[owner[chosen]].astype(np.float32)
            steps_of.step(net, gradients(net, words, chosen, target)[1])
        looks = _all_logits(net, words)
        steps_of.rate *= 0.6
    return net, looks


def train(texts: list[str], labels: list[int], seed: int = 7, rounds: int = ROUNDS,
          steps: int = STEPS) -> tuple[dict, tuple[float, float]]:
    """The network and the calibration (slope, shift) of document logits, from
    texts at hand with all their windows."""
    labels = np.array(labels, float)
    if not len(labels):
        return new_network(seed), (0.0, 0.0)
    words = Words.of(texts)
    # every fifth document is left for the calibration
    learns = np.arange(words.n) % 5 != 4 if words.n >= 50 else np.ones(words.n, bool)
    looks = _gram_odds(words, np.where(learns, labels, np.nan))
    net, looks = learn(words, words.window_row, labels, learns, looks, seed, rounds, steps)
    best = np.full(words.n, -np.inf)
    np.maximum.at(best, words.window_row, looks)
    check = ~learns if not learns.all() else learns
    return net, calibrate(best[check], labels[check])


def calibrate(logits: np.ndarray, labels: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    """Slope and shift of a logistic regression on one value (Newton)."""
    x = np.column_stack([logits, np.ones(len(logits))]).astype(float)

    def loss(w: np.ndarray) -> float:
        return np.logaddexp(0, np.where(labels > 0, -1, 1) * (x @ w)).sum() + ridge * ((w - [1, 0]) ** 2).sum() / 2

    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(x @ w)
        grad = x.T @ (p - labels) + ridge * (w - [1.0, 0.0])
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(2), grad)
        while loss(w - step) > loss(w) and np.abs(step).max() > 1e-9:
            step /= 2
        w = w - step
    return max(float(w[0]), 0.0), float(w[1])


def sample_rows(df: DataFrame, labels: DataFrame, trains: Column, id_col: str = "doc_id",
                  text_col: str = "text", label_col: str = "toxic", positives: int = POSITIVES,
                  negatives: int = NEGATIVES) -> DataFrame:
    """A bounded sample of labelled documents with their whole texts: columns
    ``id``, ``label``, ``text`` and ``learns`` (false: left for the calibration).
    Ids are taken in the order of a hash and count once, however many rows they
    have.  ``trains`` tells from the column ``id`` which ids may be learned from."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")) \
        .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & trains)
    known = known.groupBy("id").agg(F.max("label").cast("int").alias("label")) \
        .join(df.select(df[id_col].alias("id")).distinct(), "id", "left_semi")
    place = F.xxhash64("id", F.lit("toxicity"))
    ids = [known.where(F.col("label") == label).orderBy(place, "id").limit(most)
           for label, most in ((1, positives), (0, negatives))]
    text = F.coalesce(df[text_col], F.lit(""))
    rows = df.select(df[id_col].alias("key"), text.alias("text")) \
        .join(F.broadcast(ids[0].unionByName(ids[1])), F.col("key") == F.col("id"))
    # equal texts of an id are merged before the shuffle
    chosen = rows.groupBy("id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("of"))
    return chosen.select("id", "label", "of.text",
                         (F.pmod(F.xxhash64("id", F.lit("calibration")), F.lit(5)) != 0).alias("learns"))


def training_rows(df: DataFrame, labels: DataFrame, trains: Column, **columns: str) -> tuple[list[str], list[int]]:
    """The sample's whole texts and labels for ``train``, on the driver; for
    tables of short texts (``fit`` has no such condition)."""
    rows = sample_rows(df, labels, trains, **columns).orderBy(F.xxhash64("id", F.lit("toxicity")), "id").collect()
    return [r.text for r in rows], [r.label for r in rows]


def fit(df: DataFrame, labels: DataFrame, trains: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", positives: int = POSITIVES, negatives: int = NEGATIVES, kept: int = KEPT,
        spread: int = SPREAD, seed: int = 7, rounds: int = ROUNDS,
        steps: int = STEPS) -> tuple[dict, tuple[float, float]]:
    """The network and the calibration from a sample of ``df``.  The driver
    holds at most ``kept`` windows of each of the sample's documents."""
    small_batches(df.sparkSession)
    rows = stored(sample_rows(df, labels, trains, id_col, text_col, label_col, positives, negatives)
                  .repartition(df.sparkSession.sparkContext.defaultParallelism, "id"), "toxicity-sample")
    sizes = {(r.label, r.learns): r["count"] for r in rows.groupBy("label", "learns").count().collect()}
    if not sizes:
        return new_network(seed), (0.0, 0.0)
    if sum(sizes.values()) < 50:  # too few to leave any out
        rows = rows.withColumn("learns", F.lit(True))
        sizes = {(label, True): sizes.get((label, True), 0) + sizes.get((label, False), 0) for label in (0, 1)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, GRAM_SLOTS))
        for part in chunks(batches, "text"):
            found += _gram_counts(Words(part.column("text")), part.column("label").to_numpy().astype(float))
        gram = np.flatnonzero(found.any(axis=0))
        yield pa.RecordBatch.from_pydict({"gram": pa.array(gram, pa.int32()), "toxic": pa.array(found[0][gram]),
                                          "clean": pa.array(found[1][gram])})

    learned = rows.where("learns").select("id", "label", "text")
    # at most GRAM_SLOTS rows
    held = learned.mapInArrow(count, "gram int, toxic double, clean double").groupBy("gram") \
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).toArrow()
    table = np.zeros((2, GRAM_SLOTS))
    table[:, held.column("gram").to_numpy()] = held.column("toxic").to_numpy(), held.column("clean").to_numpy()
    toxic, clean = sizes.get((1, True), 0), sizes.get((0, True), 0)
    odds = _surplus(*table, (toxic + 1) / (toxic + clean + 2))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            words = Words(part.column("text"))
            looks = _window_odds(words, odds)
            taken = _taken(words, looks, kept, spread)
            yield pa.RecordBatch.from_arrays(
                [part.column("id").take(pa.array(words.window_row[taken])),
                 part.column("label").take(pa.array(words.window_row[taken])), pa.array(taken),
                 pa.array(words.texts(taken), pa.string()), pa.array(looks[taken])],
                ["id", "label", "place", "text", "looks"])

    kind = df.schema[id_col].dataType.simpleString()
    sample = learned.mapInArrow(windows, f"id {kind}, label int, place long, text string, looks double") \
        .orderBy(F.xxhash64("id", F.lit("order")), "id", "place").toArrow()
    new = np.ones(sample.num_rows, bool)
    ids = sample.column("id").to_pylist()
    new[1:] = [a != b for a, b in zip(ids, ids[1:], strict=False)]
    owner = np.cumsum(new) - 1
    marks = sample.column("label").to_numpy()[new].astype(float)
    words = Words.of(sample.column("text").to_pylist())
    net, _ = learn(words, owner, marks, np.ones(len(marks), bool), sample.column("looks").to_numpy(), seed, rounds, steps)

    def logits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("label"), pa.array(document_logits(net, part.column("text")).astype(float))],
                ["id", "label", "logit"])

    left = rows.where("not learns") if any(n for (_, learns), n in sizes.items() if not learns) else rows
    check = left.select("id", "label", "text").mapInArrow(logits, f"id {kind}, label int, logit double") \
        .orderBy("id").toArrow()
    return net, calibrate(check.column("logit").to_numpy(), check.column("label").to_numpy().astype(float))


def _taken(words: Words, looks: np.ndarray, kept: int, spread: int) -> np.ndarray:
    """Windows that a batch's texts send: all of at most ``kept``, else the
    ``kept - spread`` that look most toxic and ``spread`` others at equal
    distances."""
    order = np.lexsort((-looks, words.window_row))
    size = np.bincount(words.window_row, minlength=words.n)
    rank = np.arange(len(order)) - np.repeat(np.cumsum(size) - size, size)
    size = np.repeat(size, size)
    best = (rank < kept - spread) | (size <= kept)
    taken = [order[best]]
    rest, size = np.sort(order[~best]), size[~best]
    row = words.window_row[rest]
    place = np.arange(len(rest)) - np.searchsorted(row, row)
    left = np.maximum(size - (kept - spread), 1)
    # the first window of each of ``spread`` equal parts of the others
    part = place * spread // left
    first = np.ones(len(rest), bool)
    first[1:] = (part[1:] != part[:-1]) | (row[1:] != row[:-1])
    return np.sort(np.concatenate([taken[0], rest[first]]))


def score(df: DataFrame, net: dict, calibration: tuple[float, float], text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with ``score`` (0 to 1) and ``predicted`` (1 from the threshold)."""
    small_batches(df.sparkSession)
    slope, shift = calibration
    text = fresh(df, "whole_text")[0]
    rows = df.withColumn(text, F.coalesce(df[text_col], F.lit("")))
    schema = T.StructType([*df.schema.fields, T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, text):
            p = _sigmoid(document_logits(net, part.column(text)).astype(float) * slope + shift)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=schema.names)

    return rows.mapInArrow(run, schema)
