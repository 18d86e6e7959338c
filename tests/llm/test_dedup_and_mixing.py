"""Exact deduplication, near-duplicates, components and mixing."""

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from fundlens.llm import components as cc
from fundlens.llm import exact_dedup, mixing, simhash

SPACE = re.compile(r"[\x20\x09-\x0D]")

SF_SMALL = "/root/testdata/sf0.001"


def brute_groups(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(SPACE.sub("", text or ""), []).append((-len(text or ""), i is None, i))
    return {(i, text): (min(groups[SPACE.sub("", text or "")])[2], len(groups[SPACE.sub("", text or "")]))
            for i, text in rows}


def test_exact_groups_match_brute_force(spark, edge_docs):
    for counters in (1, 2, 1000):  # from almost no heavy hitters to all
        got = exact_dedup.duplicate_groups(edge_docs, counters=counters).collect()
        rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
        assert len(got) == len(rows)
        want = sorted((i or -1, k or -1, n) for (i, _), (k, n) in
                      [((i, t), brute_groups(rows)[i, t]) for i, t in rows])
        assert sorted((r.doc_id or -1, r.keep_id or -1, r.group_size) for r in got) == want


def test_exact_dedup_of_a_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = {k for k, _ in brute_groups(rows).values()}
    assert {r.doc_id for r in exact_dedup.deduplicate(docs, counters=5).collect()} == want
    kept = exact_dedup.duplicate_groups(docs, counters=5).where("kept").select("doc_id").collect()
    assert {r.doc_id for r in kept} == want


def test_summary_keeps_heavy_hitters():
    random.seed(3)
    items = ["hot"] * 400 + [f"x{random.randrange(400)}" for _ in range(600)]
    random.shuffle(items)
    summary = {}
    for i in range(0, 1000, 50):
        counts = {}
        for x in items[i:i + 50]:
            counts[x] = counts.get(x, 0) + 1
        summary = exact_dedup.merge_summaries(summary, counts, 5)
    assert len(summary) <= 5 and 400 - 1000 / 6 <= summary["hot"] <= 400


def test_dedup_edges(clash_docs, no_docs):
    out = exact_dedup.deduplicate(clash_docs)
    assert out.columns == clash_docs.columns
    # the repeated row stays once, the null id goes, of empty texts the longest stays
    assert sorted(r.doc_id for r in out.collect()) == [1, 2, 5, 6, 7, 8, 9]
    assert exact_dedup.duplicate_groups(no_docs).count() == 0
    assert exact_dedup.deduplicate(no_docs).count() == 0


def brute_fingerprint(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    names = list(fps)
    root = {f: f for f in names}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(names):
        for b in names[:i]:
            if (a ^ b).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in names}


def test_fingerprints(spark, edge_docs):
    got = simhash.near_duplicates(edge_docs).collect()
    rows = edge_docs.collect()
    assert sorted(r.fingerprint for r in got) == sorted(f"{brute_fingerprint(r.text):016x}" for r in rows)
    assert {r.component_id for r in got if r.doc_id == 2} == {1}
    assert {r.component_id for r in got if r.doc_id in (3, 4, 5)} == {3}  # no words


def near_fingerprints(seed=5):
    """Single ones, chains of steps of 1 and 2 bits, and a dense ball."""
    rng = random.Random(seed)
    fps = {rng.getrandbits(64) for _ in range(200)} | {0, (1 << 64) - 1, 1 << 63}
    for _ in range(20):
        f = rng.getrandbits(64)
        for _ in range(rng.randint(1, 8)):
            fps.add(f)
            for _ in range(rng.randint(1, 3)):
                f ^= 1 << rng.randrange(64)
    centre = rng.getrandbits(64)
    fps |= {centre ^ 1 << i ^ 1 << j for i in range(0, 64, 3) for j in range(0, 64, 3)}
    return sorted(fps)


def test_links_match_brute_force_with_small_buckets(spark):
    fps = near_fingerprints()
    nodes = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    want = brute_components(fps)
    for limit in (4, 1024):  # cut hot buckets again and again, or never
        edges = simhash.near_edges(nodes, limit=limit)
        for a, b in edges.collect():
            assert want[a % (1 << 64)] == want[b % (1 << 64)]
        got = {r.node % (1 << 64): r.component for r in cc.components(edges).collect()}
        parts = {}
        for f in fps:
            parts.setdefault(got.get(f, f), set()).add(f)
        wanted = {}
        for f in fps:
            wanted.setdefault(want[f], set()).add(f)
        assert sorted(map(sorted, parts.values())) == sorted(map(sorted, wanted.values()))


def test_pivots_discard_no_near_pair():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 500, np.uint64)
    b = a ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64))
    table = simhash.distance_table(np.concatenate([a, b]), simhash.pivots())
    assert np.abs(table[:, :500] - table[:, 500:]).max() <= 1


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 101), (500, 500)]
    got = {r.node: r.component for r in cc.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 103: 100}


def test_near_dedup_edges(clash_docs, no_docs):
    out = simhash.drop_near_duplicates(clash_docs)
    assert out.columns == clash_docs.columns
    ids = [r.doc_id for r in out.collect()]
    assert ids.count(2) == 0 and ids.count(1) == 1 and ids.count(3) == 1 and None not in ids
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.drop_near_duplicates(no_docs).count() == 0


def brute_targets(sizes):
    total, names = sum(sizes.values()), sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, out = set(), {}
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        out = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_} | {s: 3 * sizes[s] for s in full}
        over = {s for s in open_ if out[s] > 3 * sizes[s] + 1e-9}
        if not over:
            return out
        full |= over


def test_targets(spark):
    for sizes in ({"a": 10, "b": 100, "c": 50, None: 7}, {"a": 5, "b": 5}, {"a": 0, "b": 9}, {"x": 1000, "a": 1},
                  {"a": 1, "b": 1, "c": 1, "d": 500, "e": 2}, {"a": 0}):
        rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
        got = {r.source: r.target for r in mixing.source_targets(rows).collect()}
        want = brute_targets(sizes)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want), sizes


def test_mix_takes_about_its_targets(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").cache()
    plan = mixing.plan_mix(docs)
    rows = plan.collect()
    again = {r.doc_id: tuple(r.positions) for r in mixing.plan_mix(docs.repartition(5)).collect()}
    assert again == {r.doc_id: tuple(r.positions) for r in rows}
    longest = {}
    taken, target = {}, {}
    for r in rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", docs_text(docs)[r.doc_id]))
        assert r.taken == r.size * len(r.positions) <= 3 * r.size
        assert all(0 <= p <= 1 for p in r.positions) and list(r.positions) == sorted(r.positions)
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        longest[r.source] = max(longest.get(r.source, 0), r.size)
    assert all(abs(taken[s] - target[s]) <= longest[s] / 2 + 1e-6 for s in target)


def docs_text(docs, _kept={}):
    if not _kept:
        _kept.update({r.doc_id: r.text or "" for r in docs.collect()})
    return _kept


def test_positions_follow_the_schedule(spark):
    # a source whose weight falls has most of its words early
    docs = spark.createDataFrame([(i, "w " * 10, s) for i in range(600) for s in "abc"], "doc_id long, text string, source string")
    plan = mixing.plan_mix(docs, schedules=((2.0, 0.0), (1.0, 1.0), (0.0, 2.0)))
    early = {r.source: r.early for r in plan.select("source", F.explode("positions").alias("p")).groupBy("source")
             .agg(F.avg((F.col("p") < 0.5).cast("int")).alias("early")).collect()}
    # the integral of 2 - 2t up to a half is 3/4
    assert abs(early["a"] - 0.75) < 0.01 and abs(early["b"] - 0.5) < 0.01 and abs(early["c"] - 0.25) < 0.01


def test_mix_edges(clash_docs, no_docs):
    out = mixing.mix(clash_docs)
    assert out.columns == clash_docs.columns
    plan = mixing.plan_mix(clash_docs).collect()
    assert len(plan) == clash_docs.count()
    assert out.count() == sum(len(r.positions) for r in plan)
    assert mixing.plan_mix(no_docs).count() == 0 and mixing.mix(no_docs).count() == 0


def test_fingerprints_of_a_long_text_take_little_memory():
    import tracemalloc

    import pyarrow as pa

    from fundlens.llm import simhash
    words = [f"Word{i % 7919}x{i % 13}" for i in range(1_900_000)]
    text = pa.array([" ".join(words)])
    assert text.nbytes > 20_000_000
    tracemalloc.start()
    got = simhash.fingerprints(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6
    votes = [0] * 64
    for i in range(0, 3000):
        h = simhash.xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).lower(), 42)
        votes = [v + (h >> b & 1) for b, v in enumerate(votes)]
    part = simhash.fingerprints(pa.array([" ".join(words[:3002])]))
    assert int(part[0]) == sum(1 << b for b in range(64) if 2 * votes[b] > 3000) and got.shape == (1,)
