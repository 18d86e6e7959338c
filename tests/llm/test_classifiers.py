"""Toxicity, quality and the native quality rules."""

import math
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from fundlens.llm import frames, quality, rules, toxicity

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def slow_logit(net, words):
    """One window's logit, step by step from the definition."""
    sig = lambda x: 1 / (1 + np.exp(-x))
    n = toxicity.STATES
    batch = toxicity.Words(pa.array([" ".join(words)]))
    xs = toxicity._inputs(net, batch)[:len(words)]
    states = []
    for way in ("forward", "backward"):
        h, out = np.zeros(n), [None] * len(words)
        for t in range(len(words)) if way == "forward" else reversed(range(len(words))):
            a, b = xs[t] @ net[f"{way}_in"] + net[f"{way}_bias"], h @ net[f"{way}_state"]
            r, u = sig(a[:n] + b[:n]), sig(a[n:2 * n] + b[n:2 * n])
            h = (1 - u) * h + u * np.tanh(a[2 * n:] + r * b[2 * n:])
            out[t] = h
        states.append(out)
    hs = [np.concatenate(x) for x in zip(*states, strict=True)]
    e = np.array([np.tanh(h @ net["attend"] + net["attend_bias"]) @ net["focus"] for h in hs])
    w = np.exp(e - e.max())
    return sum(a * h for a, h in zip(w / w.sum(), hs, strict=True)) @ net["out"] + net["out_bias"][0]


def test_network_equals_its_definition_over_all_windows():
    net = toxicity.new_network(3)
    words = [f"w{i * 7 % 31}" for i in range(75)]
    starts = range(0, 75 - toxicity.WINDOW + toxicity.STRIDE, toxicity.STRIDE)
    want = max(slow_logit(net, words[s:s + toxicity.WINDOW]) for s in starts)
    other = " ".join(["x"] * 3)
    got = toxicity.document_logits(net, pa.array(["", " ".join(words), None, other]))
    assert math.isclose(got[1], want, abs_tol=1e-4)
    assert math.isclose(got[3], slow_logit(net, ["x"] * 3), abs_tol=1e-4)
    assert got[0] == got[2] == net["out_bias"][0]


def test_windows_cover_texts_and_overlap():
    for n in (0, 1, 31, 32, 33, 56, 57, 200):
        w = toxicity.Words(pa.array(["a b", " ".join(["w"] * n), "c"]))
        own = w.window_row == 1
        spans = [(s - 2, s - 2 + k) for s, k in zip(w.window_start[own], w.window_size[own], strict=True)]
        assert sorted({i for a, b in spans for i in range(a, b)}) == list(range(n))
        assert all(b > c for (_, b), (c, _) in zip(spans, spans[1:], strict=False))


def test_words_by_parts_equal_the_whole():
    texts = ["a bc", "", " x " * 50, "é stupid", *["w " * k for k in range(80)]]
    whole, parts = toxicity.Words(pa.array(texts)), toxicity.Words.of(texts, limit=60)
    assert whole.n == parts.n
    for name in ("rows", "word", "gram", "first_gram", "window_row", "window_start", "window_size"):
        assert getattr(whole, name).tolist() == getattr(parts, name).tolist(), name


def test_gradients():
    net = {k: v.astype(float) for k, v in toxicity.new_network(1).items()}
    words = toxicity.Words(pa.array(["you are a stupid moron and more words here", "", "hello world é "]))
    labels = np.array([1.0, 0, 0])
    _, grads = toxicity.gradients(net, words, np.arange(3), labels)
    for name, grad in grads.items():
        at = np.unravel_index(np.argmax(np.abs(grad)), grad.shape)
        kept, ends = net[name][at], []
        for step in (1e-3, -1e-3):
            net[name][at] = kept + step
            ends.append(toxicity.gradients(net, words, np.arange(3), labels)[0])
        net[name][at] = kept
        assert math.isclose((ends[0] - ends[1]) / 2e-3, grad[at], rel_tol=0.02, abs_tol=1e-4), name


def test_calibration_of_separable_and_constant_logits():
    slope, shift = toxicity.calibrate(np.array([-5.0, -4, 4, 5]), np.array([0.0, 0, 1, 1]))
    assert slope > 0 and math.isfinite(shift)
    slope, shift = toxicity.calibrate(np.full(10, 1500.0), np.array([1.0] + [0] * 9))
    assert math.isfinite(slope) and math.isfinite(shift)


def test_toxicity_learns_stems(spark):
    rng = np.random.default_rng(0)
    clean = ["the", "house", "of", "stone", "river", "and", "green", "walk", "along"]
    text = lambda bad: " ".join(
        [*rng.choice(clean, 60), *([f"zlurk{rng.integers(999)}"] * 2 if bad else []), *rng.choice(clean, 20)])
    labels = [i % 3 == 0 for i in range(300)]
    net, calibration = toxicity.train([text(b) for b in labels], [int(b) for b in labels])
    docs = spark.createDataFrame([(i, text(i % 2)) for i in range(60)], "doc_id long, text string")
    rows = toxicity.score(docs, net, calibration).collect()
    assert sum(r.predicted == r.doc_id % 2 for r in rows) >= 57


def test_toxicity_learns_from_long_texts(spark):
    rng = np.random.default_rng(0)
    clean = ["the", "house", "of", "stone", "river", "and", "green", "walk", "along"]

    def text(bad):
        words = rng.choice(clean, 3000).tolist()
        at = int(rng.integers(2900))
        return " ".join(words[:at] + [f"zlurk{rng.integers(999)}"] * 3 * bool(bad) + words[at:])

    rows = [(i, text(i % 3 == 0)) for i in range(200)] + [(3, "the house")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert min(len(t) for _, t in rows[:200]) > 6000
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(150)] + [(5000, 1)], "doc_id long, toxic int")
    sample = toxicity.sample_rows(docs, labels, F.lit(True), positives=40, negatives=60).collect()
    assert len(sample) == len({r.id for r in sample}) == 100 and sum(r.label for r in sample) == 40
    net, calibration = toxicity.fit(docs, labels, F.lit(True))
    held = toxicity.score(docs.where("doc_id >= 150"), net, calibration).collect()
    assert sum(r.predicted == (r.doc_id % 3 == 0) for r in held) >= 47


def test_windows_sent_by_a_text():
    words = toxicity.Words(pa.array(["a b", " ".join(map(str, range(1000))), "", " ".join(["w"] * 500)]))
    looks = np.random.default_rng(1).random(len(words.window_row))
    taken = toxicity._taken(words, looks, 12, 4)
    assert np.bincount(words.window_row[taken]).tolist() == [1, 12, 1, 12]
    mine = np.flatnonzero(words.window_row == 1)
    assert set(mine[np.argsort(-looks[mine])[:8]]) <= set(taken)
    assert words.texts(taken)[:2] == ["a b", " ".join(map(str, range(a := words.window_start[taken[1]] - 2, a + 32)))]
    toxic, seen_clean = toxicity._gram_counts(words, np.array([1.0, 0, np.nan, 1]))
    held = [set(toxicity.Words(pa.array([t])).gram) for t in ("a b", " ".join(map(str, range(1000))), " ".join(["w"] * 500))]
    assert set(np.flatnonzero(toxic)) == held[0] | held[2] and set(np.flatnonzero(seen_clean)) == held[1]


def test_toxicity_fit_edges(spark, clash_docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] * 2 + [(None, 1), (3, None)], "doc_id long, toxic int")
    net, calibration = toxicity.fit(clash_docs, labels, F.lit(True), rounds=1, steps=2)
    assert toxicity.score(clash_docs, net, calibration).count() == clash_docs.count()
    assert toxicity.fit(no_docs, labels, F.lit(True))[1] == (0.0, 0.0)
    assert toxicity.fit(clash_docs, labels.limit(0), F.lit(True))[1] == (0.0, 0.0)
    one_side = toxicity.fit(clash_docs, labels.where("toxic = 0"), F.lit(True), rounds=1, steps=2)
    assert all(0 <= r.score <= 1 for r in toxicity.score(clash_docs, *one_side).select("score").collect())


def test_toxicity_edges(spark, clash_docs, no_docs):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts, marks = toxicity.training_rows(docs, labels, frames.remainder(F.col("id"), 3) != 1)
    assert texts and set(marks) <= {0, 1}
    net, calibration = toxicity.train(texts, marks, rounds=1, steps=5)
    out = toxicity.score(clash_docs, net, calibration)
    assert out.columns == [*clash_docs.columns, "score", "predicted"]
    rows = out.collect()
    assert len(rows) == clash_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if not (r.text or "").strip()}) == 1
    assert toxicity.score(no_docs, net, calibration).count() == 0
    assert toxicity.training_rows(no_docs, labels.limit(0), F.lit(True)) == ([], [])
    untrained = toxicity.score(clash_docs, *toxicity.train([], [])).collect()
    assert all(r["score"] == 0.5 for r in untrained)


def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    held_out = lambda c: frames.remainder(F.col(c), 3) == 1
    model = quality.fit(docs, labels, ~held_out("id"))
    rows = quality.score(docs.where(held_out("doc_id")), model).join(labels, "doc_id").collect()
    good = [r.accepted for r in rows if r.quality == 1]
    bad = [r.accepted for r in rows if r.quality == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.3 * len(bad)


def test_views_by_matrix_and_by_sums():
    page = quality.Page(pa.array(["a b b $$$\nc 12", "", None]), pa.array(["s", None, "t"]),
                        pa.array(["en", "de", None]), pa.array([13, None, 5]))
    weights = np.random.default_rng(0).standard_normal(quality.WORD_SLOTS + quality.SHAPES)
    assert np.allclose(page.content_matrix() @ weights, page.content_sums(weights), atol=1e-5)
    assert page.meta_matrix().sum() == 3 * len(quality.SLOTS)


def test_co_training_hands_labels_over():
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 600)
    content = (rng.random((600, 20)) + y[:, None] * 0.5).astype(np.float32) / 10
    meta = (rng.random((600, 10)) + y[:, None] * 0.5).astype(np.float32)
    labels = np.where(np.arange(600) < 60, y, -1)
    alone, together = (quality.co_train(content, meta, labels, rounds=r) for r in (0, 4))

    def right(m):
        z = [v @ w + b for v, (w, b) in zip((content * quality.SCALE, meta), (m.content, m.meta), strict=True)]
        return ((m.combine(*z) > 0.5) == y)[60:].mean()

    assert right(together) >= right(alone) - 0.02 and right(together) > 0.9


def slow_logistic(x, y, ridge, steps=300):
    """Accelerated descent on the mean log-loss, one document at a time."""
    rate = 1 / (0.25 * (max((sum(v * v for v in r) for r in x), default=0) + 1) + ridge)
    prior = (sum(y) + 1) / (len(y) + 2)
    w, b = np.zeros(len(x[0])), math.log(prior / (1 - prior))
    ahead, b_ahead = w.copy(), b
    for k in range(steps):
        grad, shift = ridge * ahead, 0.0
        for row, label in zip(x, y, strict=True):
            d = (1 / (1 + math.exp(-max(-30, min(30, float(row @ ahead) + b_ahead)))) - label) / len(y)
            grad, shift = grad + d * row, shift + d
        w_next, b_next = ahead - rate * grad, b_ahead - rate * shift
        ahead, b_ahead = w_next + k / (k + 3) * (w_next - w), b_next + k / (k + 3) * (b_next - b)
        w, b = w_next, b_next
    return w, b


def slow_co_training(views, labels, rounds, sure):
    known = [i for i, y in enumerate(labels) if y >= 0]
    held = known[2::3]
    first = [i for i in known if i not in held]
    pool = [i for i, y in enumerate(labels) if y < 0]
    share = sum(labels[i] for i in first) / len(first)
    given = [{i: labels[i] for i in first} for _ in views]
    most = max(1, int(sure * len(pool)))
    n_bad, n_good = round(most * (1 - share)), round(most * share)
    fits = lambda: [slow_logistic(v[list(g)], list(g.values()), r)
                    for v, g, r in zip(views, given, (1e-4, 1e-3), strict=True)]
    models = fits()
    for _ in range(rounds):
        news = []
        for i in (0, 1):
            rest = sorted((float(views[i][j] @ models[i][0]) + models[i][1], j) for j in pool if j not in given[1 - i])
            news.append([(j, 0) for _, j in rest[:n_bad]] + [(j, 1) for _, j in rest[len(rest) - n_good:]])
        for i in (0, 1):
            given[1 - i].update(news[i])
        models = fits()
    z = [[float(v[j] @ w) + b for j in range(len(labels))] for v, (w, b) in zip(views, models, strict=True)]
    odds = []
    for one in z:
        w, b = slow_logistic(np.clip(np.array(one)[held], -30, 30)[:, None] / 4, [labels[j] for j in held], 1e-3)
        odds.append(np.array(one) * max(float(w[0]) / 4, 0) + b)
    odds = np.column_stack(odds)
    w, b = slow_logistic(np.clip(odds[held], -30, 30), [labels[j] for j in held], 1e-3)
    return 1 / (1 + np.exp(-(odds @ w + b)))


def test_quality_matches_a_plain_loop(spark):
    rng = np.random.default_rng(2)
    words = [["river", "stone", "house", "walk"], ["buy$$$", "now!", "###", "12", "cheap"]]
    rows = [(i, " ".join(rng.choice(words[bad := i % 2], 5 + i % 7).tolist() + ["and", f"w{rng.integers(50)}"]) + "\n" * bad,
             ["web", "book"][i % 2 if i % 5 else 0], "en", 40 + i) for i in range(72)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    marks = [1 - i % 2 if i < 36 else -1 for i in range(72)]
    labels = spark.createDataFrame([(i, y) for i, y in enumerate(marks) if y >= 0], "doc_id long, quality int")
    page = quality.Page(*(pa.array([r[k] for r in rows]) for k in (1, 2, 3, 4)))
    views = [page.content_matrix().astype(float) * quality.SCALE, page.meta_matrix().astype(float)]
    want = slow_co_training(views, marks, quality.ROUNDS, quality.SURE)
    got = {r.doc_id: r.quality_score for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    assert max(abs(got[i] - want[i]) for i in range(72)) < 1e-3
    # an id that repeats counts once, and leaves room for the others
    hot = docs.unionByName(docs.where("doc_id = 3")).unionByName(docs.where("doc_id = 40")).repartition(5)
    again = quality.fit(hot, labels)
    assert all(abs(r.quality_score - got[r.doc_id]) < 1e-6 for r in quality.score(hot, again).collect())


def test_quality_edges(spark, clash_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (8, 1), (None, 0), (9, None)], "doc_id long, quality long")
    model = quality.fit(clash_docs, labels)
    out = quality.score(clash_docs, model)
    assert out.columns == [*clash_docs.columns, "quality_score", "accepted"]
    assert out.count() == clash_docs.count() and out.where("quality_score is null").count() == 0
    empty = quality.fit(no_docs, labels.limit(0))
    assert quality.score(no_docs, empty).count() == 0
    assert [round(r.quality_score, 6) for r in quality.score(clash_docs, empty).limit(1).collect()] == [0.5]


def brute_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, covered = {}, set()
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i:i + 3]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            covered |= {p + k for p in places for k in range(3)}
    n, rep = len(words), len(covered)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), rep,
            n < 50 or 100 * rep > 50 * n)


def brute_buckets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = lambda s: xxhash.xxh64_intdigest(s.encode(), 42)
    pair = lambda a, b: xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42))
    hs = [h(w) for w in words]
    runs = re.findall(r"[#*$%&|<>]+", text or "")
    return [x % rules.BUCKETS for x in [*hs, *[pair(a, b) for a, b in zip(hs, hs[1:], strict=False)], *map(h, runs)]]


@pytest.mark.parametrize("edge", [False, True])
def test_rules_match_brute_force(spark, edge, clash_docs):
    docs = clash_docs if edge else spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").where("quality = 1").select("doc_id")
    good = {r.doc_id for r in labels.collect()}
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    raw, target = np.ones(rules.BUCKETS), np.ones(rules.BUCKETS)
    for i, t in texts:
        np.add.at(raw, brute_buckets(t), 1)
        if i in good:
            np.add.at(target, brute_buckets(t), 1)
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    want = []
    for i, t in texts:
        *counts, failed = brute_rules(t)
        grams = brute_buckets(t)
        mean = ratio[grams].mean() if grams else 0.0
        want.append((i or -1, *counts, failed, round(mean, 9), not failed and mean >= rules.THRESHOLD))
    got = [(r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed,
            round(r.llr, 9), r.kept) for r in rules.quality_rules(docs, labels).collect()]
    assert sorted(got) == sorted(want)


def test_repeated_windows(spark):
    texts = ["a b c a b c", "a a a a", "a a a", "x a b c y a b c z", "a b c d a b c d", "a b", "", "p q r p q",
             "a b c x b c a b c", " ".join(["k"] * 70)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = rules.quality_rules(docs, docs.select("doc_id").limit(0)).orderBy("doc_id").collect()
    assert [r.n_repeat_words for r in got] == [brute_rules(t)[4] for t in texts]


def test_rules_without_rows(spark, no_docs):
    assert rules.quality_rules(no_docs, no_docs.select("doc_id")).count() == 0


def test_every_trusted_label_counts(spark, tmp_path):
    """Many label rows of one id do not crowd out the others."""
    from fundlens.llm import queries
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    good = spark.read.parquet(f"{SF_SMALL}/labels.parquet").where("quality = 1").select("doc_id")
    first = good.orderBy(F.xxhash64("doc_id")).limit(1).crossJoin(spark.range(20_000)).select("doc_id")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    good.unionByName(first).select("doc_id", F.lit(1).cast("long").alias("quality")) \
        .write.parquet(str(tmp_path / "labels.parquet"))
    want = {r.doc_id: (round(r.llr, 9), r.kept) for r in rules.quality_rules(docs, good).collect()}
    got = {r.doc_id: (round(r.llr, 9), r.kept) for r in queries.op10_quality_rules(spark, str(tmp_path)).collect()}
    assert got == want
