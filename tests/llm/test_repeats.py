"""Removal of repeated byte windows against brute force."""

import hashlib
import random

import numpy as np
import pytest
from conftest import frame
from pyspark.sql import functions as F

from fundlens.llm import packing, repeats


def brute(rows, length):
    """Per (id, text): what is left after the windows that start earlier too;
    the texts of one id in the order of their ties."""
    seen, out = set(), {}
    for id_, text, _ in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[2])):
        data = (text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - length + 1):
            window = data[i:i + length]
            if window in seen:
                gone[i:i + length] = [True] * length
            seen.add(window)
        runs = sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[id_, text] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def check(df, length, **options):
    rows = [(r.key, r.text, r.tie) for r in repeats._keyed(df, "doc_id", "text").collect()]
    expected = brute(rows, length)
    got = repeats.remove_repeats(df, length=length, **options)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    got = sorted([(r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.h)
                  for r in got.withColumn("h", F.sha2("kept", 256)).collect()])
    assert got == sorted((i is None, i or 0, *expected[i, t]) for i, t, _ in rows)
    return got


def passages(seed, n=60):
    """Texts made of passages that repeat within and across documents, with
    unique words, near copies and characters of several bytes between them."""
    rng = random.Random(seed)
    words = ["ab", "bab", "é", "漢字", "aa", "b", "Zürich", "the", "cat"]
    shared = [" ".join(rng.choices(words, k=rng.randint(5, 40))) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.6 else " ".join(rng.choices(words, k=rng.randint(0, 15)))
                 for _ in range(rng.randint(0, 6))]
        rows.append((i, " ".join(parts)))
    copy = rows[5][1] + " ".join(shared)
    rows += [(n + i, copy[:i * 3] + "x" + copy[i * 3 + 1:]) for i in range(25)]
    return rows


@pytest.mark.parametrize("length", [8, 30, 100])
@pytest.mark.parametrize("hot", [repeats.HOT, 2])
def test_equals_brute_force(spark, length, hot):
    got = check(frame(spark, passages(length)).repartition(7), length, hot=hot)
    assert sum(r[3] for r in got) > 1000


def test_edge_rows(edge_docs, clash_docs):
    # no two of these texts with one id differ
    assert check(edge_docs, 100) == check(clash_docs, 100)


def test_empty(no_docs):
    assert repeats.remove_repeats(no_docs).collect() == []


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 1000)
    rng = random.Random(3)
    base = "".join(rng.choices("abcde ", k=9000))
    rows = [(1, base), (2, base[500:4000] + "Z" + base[4001:8000]), (3, "q" + base[:2500]), (4, "a" * 3000)]
    assert check(frame(spark, rows), 50)


def test_copies_hold_a_third(spark):
    rng = random.Random(4)
    hot = " ".join(rng.choices(["alpha", "beta", "gamma"], k=60))
    rows = [(i, hot if i % 3 else " ".join(rng.choices(["delta", "eps", "zeta"], k=40))) for i in range(300)]
    got = check(frame(spark, rows).repartition(5), 100, hot=5)
    assert sum(r[3] == r[2] for r in got) >= 199
    check(frame(spark, [(None, hot)] * 40 + [(7, hot)] * 40 + rows[:20]), 100, hot=2)


def test_one_shuffle_of_the_texts(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        out = repeats.remove_repeats(frame(spark, passages(1)))
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert "ReusedExchange" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_ids_that_clash_and_rows_that_repeat(spark):
    """Texts of one id in several blocks, null ids, and rows found many times."""
    rows = passages(9, 40)
    rows = [(None if i % 5 == 0 else i % 7, text) for i, text in rows]
    got = check(frame(spark, rows * 3).repartition(6), 30, hot=3)
    assert len(got) == 3 * len(rows)


def test_buckets_are_even(spark):
    """An anchor's hash is the least of many, and yet deals evenly."""
    rng = random.Random(8)
    data = np.frombuffer("".join(rng.choices("abcdefgh ", k=200_000)).encode(), np.uint8)
    h = repeats._dealt(repeats.segments(data, np.array([0, len(data)]), 100)[4])
    sizes = [i.stop - i.start for _, i in packing.ranges(np.sort(h), 4)]
    assert len(sizes) == 16 and max(sizes) < 1.5 * min(sizes)


def test_shuffles_little_beside_the_texts(spark):
    """What is shuffled beside the texts for copies of whole texts is small, and
    nothing is stored (the range of each repeated segment was, in files)."""
    rng = random.Random(6)
    texts = ["".join(rng.choices("abcdefghijklmnop qrstuvw", k=2000)) for _ in range(400)]
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        left = repeats.remove_repeats(frame(spark, [(i, texts[i % 400]) for i in range(2400)]))
        assert sum(r.n_removed for r in left.collect()) == 2000 * 2000
        nodes, sizes = [left._jdf.queryExecution().executedPlan()], set()
        assert "FileScan" not in nodes[0].toString()  # nothing is stored
    finally:
        spark.conf.set(key, before)
    inner = {"AdaptiveSparkPlan": "executedPlan", "ResultQueryStage": "plan", "ShuffleQueryStage": "shuffle"}
    while nodes:
        node = nodes.pop()
        name = node.nodeName()
        if name == "Exchange":
            sizes.add(node.metrics().apply("shuffleBytesWritten").value())
        nodes += [getattr(node, inner[name])()] if name in inner else []
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    assert 0 < sum(sizes) < 1.5 * max(sizes)
