"""BPE, wavelet shards and suffix-tree scores."""

import math
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fundlens.llm import bpe, frames, suffix_tree, wavelet
from fundlens.session import shared_dir

ALPHABET = list("abcdefthe ing  '’sStreE0123.,!?<|>\n\t\x1c\u0301ééÉßΣσİıñ漢字😀  xyz") + ["<|endoftext|>", "'s", "'re", "the"]

SF_SMALL = "/root/testdata/sf0.001"


def random_texts(n, most, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, most))) for _ in range(n)]


def library(tokenizer):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer)


def test_encoder_equals_the_library(tokenizer):
    coder, whole = bpe.Encoder(tokenizer), library(tokenizer)
    for text in random_texts(1500, 60):
        want = whole.encode(text, add_special_tokens=False)
        ids = np.frombuffer(coder.encode(text), coder.dtype)
        assert ids.tolist() == want.ids, text
        assert coder.tokens(text).tolist() == [[i, *o] for i, o in zip(want.ids, want.offsets, strict=True)]
        assert coder.decode(ids) == whole.decode(want.ids, skip_special_tokens=False)


def test_encoder_keeps_its_first_pieces(tokenizer, monkeypatch):
    coder, whole = bpe.Encoder(tokenizer), library(tokenizer)
    text = "Wonderful, wonderful words. The others: Others, WORDS."
    want = whole.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(coder.encode(text), coder.dtype).tolist() == want
    assert {"Wonderful,", "wonderful", "words.", "Others,"} <= set(coder)  # also those made of others
    monkeypatch.setattr(bpe, "NEXT", 3)
    first = list(coder)[:3]
    coder.rest()
    assert list(coder) == first and np.frombuffer(coder.encode(text), coder.dtype).tolist() == want
    monkeypatch.setattr(bpe, "CACHE", 5)
    coder.clear()
    for text in random_texts(300, 60):
        assert np.frombuffer(coder.encode(text), coder.dtype).tolist() == whole.encode(text, add_special_tokens=False).ids
        assert len(coder) <= 5


def test_tree_concatenation_equals_the_library(tokenizer):
    coder, whole = bpe.Encoder(tokenizer), library(tokenizer)
    rng = random.Random(2)
    texts = random_texts(100, 900)
    texts += ["".join(rng.choice("abcdefghilnorst") for _ in range(rng.randint(300, 1500))) for _ in range(100)]
    texts += [x * rng.randint(100, 600) for x in ("a", "ab", "!", "the", "é", "aab") for _ in range(10)]
    for text in texts:
        cuts = bpe.cuts(len(text), 40)
        leaves = [coder.tokens(text[a:b], a) for a, b in zip(cuts, cuts[1:], strict=False)]
        assert all(np.array_equal(bpe._unpacked(bpe._packed(x, a), a), x) for x, a in zip(leaves, cuts, strict=False))
        got = bpe.concatenate(text, leaves, cuts, coder.tokens)
        assert got[:, 0].tolist() == whole.encode(text, add_special_tokens=False).ids


def test_encode_and_decode_tables(spark, clash_docs, no_docs, tokenizer):
    whole = library(tokenizer)
    for leaf in (64, bpe.LEAF_CHARS):
        out = bpe.decode(bpe.encode(clash_docs.limit(100), tokenizer, keep=["doc_id", "ids", "row"], leaf_chars=leaf)
                         .toDF("doc_id", "x", "row", "ids"), tokenizer).collect()
        want = sorted((r.doc_id or -1, tuple(whole.encode(r.text or "", add_special_tokens=False).ids))
                      for r in clash_docs.collect())
        assert sorted((r.doc_id or -1, tuple(r.ids)) for r in out) == want
        assert all(r.decoded == whole.decode(r.ids, skip_special_tokens=False) for r in out)
    assert bpe.encode(no_docs, tokenizer, keep=["doc_id"]).count() == 0


def test_wavelet_matrix():
    rng = np.random.default_rng(4)
    for n, top in ((0, 5), (1, 5), (7, 3), (1000, 60), (4096, 1 << 16)):
        row = rng.integers(0, top, n).astype(np.uint16)
        m = wavelet.WaveletMatrix.build(row)
        assert m.tokens().tolist() == row.tolist()
        for i in range(0, n, 37):
            assert m.access(i) == row[i]
        for token in {0, 1, 2, top - 1, 70_000, *row[:5].tolist()}:
            places = np.flatnonzero(row == token).tolist()
            assert m.count(token) == len(places)
            assert [m.select(token, j) for j in range(len(places))][:50] == places[:50]
            assert all(m.rank(token, i) == int((row[:i] == token).sum()) for i in range(0, n + 1, 101))


def test_shards_round_trip(spark, edge_docs, no_docs, tokenizer):
    whole = library(tokenizer)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text") \
        .unionByName(edge_docs.where("doc_id is not null").select((F.col("doc_id") + 10_000).alias("doc_id"), "text"))
    out = wavelet.write_shards(docs, tokenizer, shared_dir(spark, "t"), shard_tokens=20_000)
    assert wavelet.read_shards(spark, out).count() > 3
    got = sorted(map(tuple, wavelet.stored_documents(spark, out).collect()))
    coded = sorted((r.doc_id, struct.pack(f"<{len(ids)}H", *ids), ids) for r in docs.collect()
                   for ids in [whole.encode(r.text or "", add_special_tokens=False).ids + [2]])
    start, want = 0, []
    for i, _, ids in coded:
        want.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    assert got == sorted(want)
    matrix, ids, starts = wavelet.load(wavelet.read_shards(spark, out).where("shard = 0").head())
    assert matrix.access(int(starts[1]) - 1) == 2 and matrix.count(2) >= len(ids)
    empty = wavelet.write_shards(no_docs, tokenizer, shared_dir(spark, "t"))
    assert wavelet.stored_documents(spark, empty).count() == 0
    nulls = wavelet.write_shards(edge_docs, tokenizer, shared_dir(spark, "t"))
    assert wavelet.stored_documents(spark, nulls).count() == edge_docs.count()


def test_shards_answer_from_their_files(spark, tokenizer):
    row = np.random.default_rng(5).zipf(1.3, 300_000) % 49_000
    whole = wavelet.WaveletMatrix.build(row.astype(np.uint16))
    stored = {"planes": [p.blocks for p in whole.planes], "ranks": [p.ranks.tobytes() for p in whole.planes],
              "zeros": whole.zeros, "n": whole.n, "doc_ids": [1], "starts": [0]}
    matrix = wavelet.load(stored)[0]
    assert matrix.access(200_000) == row[200_000]
    assert all(len(p.blocks) == 5 and len(p._open) == 1 for p in matrix.planes)
    for token in (1, 2, 77, 48_999):
        places = np.flatnonzero(row == token)
        assert matrix.count(token) == len(places)
        assert [matrix.select(token, j) for j in range(0, len(places), 997)] == places[::997].tolist()
        assert matrix.rank(token, 123_457) == (row[:123_457] == token).sum()


def test_shards_split_an_id_that_repeats(spark, tokenizer, clash_docs):
    texts = [f"some words {i} and more of them" * 5 for i in range(400)]
    rows = [(7 if i % 3 == 0 else i, texts[0] if i % 2 else texts[i]) for i in range(400)] + [(None, "x y")] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = wavelet.write_shards(docs, tokenizer, shared_dir(spark, "t"), shard_tokens=1000)
    sizes = [r.n for r in wavelet.read_shards(spark, out).collect()]
    assert len(sizes) > 10 and max(sizes) < 4 * sum(sizes) / len(sizes)
    whole = library(tokenizer)
    coded = {t: whole.encode(t, add_special_tokens=False).ids + [2] for t in {t for _, t in rows}}
    got = wavelet.stored_documents(spark, out).collect()
    crc = lambda ids: zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(
        (i, len(coded[t]), crc(coded[t])) for i, t in rows)
    got.sort(key=lambda r: r.start)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:], strict=False))
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is None, i or 0))
    clashing = wavelet.write_shards(clash_docs, tokenizer, shared_dir(spark, "t"))
    assert wavelet.stored_documents(spark, clashing).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def brute_base(texts, train):
    token = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]
    counts = Counter(w for t in train for w in token(t))
    n, v = sum(counts.values()), len(counts)
    return [(len(token(t)), sum(counts[w] > 0 for w in token(t)), n,
             sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in token(t))) for t in texts]


def test_suffix_tree_on_a_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").cache()
    train = docs.where(frames.remainder(F.col("doc_id"), 7) != 2)
    tree, words = suffix_tree.fit(train)
    got = {r.doc_id: r for r in suffix_tree.score(docs, tree, words).collect()}
    rows = docs.collect()
    for r, want in zip(rows, brute_base([r.text for r in rows], [r.text for r in train.collect()]), strict=True):
        g = got[r.doc_id]
        assert (g.n_tokens, g.n_known, g.train_tokens) == want[:3]
        assert math.isclose(g.base_score, want[3], rel_tol=1e-9, abs_tol=1e-9)


def test_scores_beat_the_unigram_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = frames.remainder(F.col("doc_id"), 7) == 2
    tree, words = suffix_tree.fit(docs.where(~held_out))
    got = suffix_tree.score(docs.where(held_out), tree, words).collect()
    assert sum(r.score > r.base_score for r in got) > 0.8 * len(got)
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_states_are_distributions_and_scores_walk_them(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["a b c", "a c b", "b b", "d"]) for _ in range(30)) for _ in range(60)]
    train = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    tree, words = suffix_tree.fit(train, min_share=0.01, gram_share=0.001)
    n = len(tree.root)
    assert any((~np.isnan(x)).any() for x in tree.rest)
    unit = sum(10 ** tree.root)
    assert abs(unit - 1) < 1e-9
    # every next symbol after a history: the scores must sum to 1
    names = np.arange(n)
    for history in ([], [2], [2, 3], [3, 2, 4], [2, 3, 4, 2]):
        total = 0.0
        for s in names:
            row = np.array([*history, s])
            total += 10 ** tree.scores(row, np.arange(len(row)))[-1]
        assert abs(total - 1) < 1e-6, history
    # scores of a text: the sum over its tokens
    got = suffix_tree.score(train, tree, words).where("doc_id = 0").head()
    symbols, _, place = suffix_tree._sequence(
        suffix_tree._lookup(suffix_tree.hashed_words(__import__("pyarrow").array([texts[0]]))[0], tree.vocabulary),
        np.zeros(got.n_tokens - 1, int), 1)
    assert math.isclose(got.score, tree.scores(symbols, place).sum(), rel_tol=1e-9)
    assert got.score > got.base_score


def test_suffix_tree_edges(spark, clash_docs, no_docs):
    tree, words = suffix_tree.fit(clash_docs)
    out = suffix_tree.score(clash_docs, tree, words).collect()
    rows = [r.text for r in clash_docs.collect()]
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == sorted(
        (*w[:3], round(w[3], 6)) for w in brute_base(rows, rows))
    tree, words = suffix_tree.fit(no_docs)
    assert suffix_tree.score(no_docs, tree, words).count() == 0
    untrained = suffix_tree.score(clash_docs, tree, words).collect()
    assert all(r.base_score == 0 and abs(r.score) < 1e-9 and r.n_known == 0 for r in untrained)


def brute_scores(texts, floor, depth=3, strength=5.0):
    """The suffix tree over every run that occurs ``floor`` times."""
    seqs = [re.findall(r"[^\x20\x09-\x0D]+", t.lower()) + [None] for t in texts]
    counts = [Counter((w,) for s in seqs for w in s)]
    for k in range(2, depth + 2):
        counts.append(Counter(tuple(([None] + s)[i:i + k]) for s in seqs for i in range(len(s) + 2 - k)))
    tokens = sum(map(len, seqs))
    total, tree, rest = tokens + len(counts[0]) + 1, {}, {}

    def p(context, symbol):
        factor = 1.0
        while context:
            if context in tree:
                if symbol in tree[context]:
                    return factor * tree[context][symbol]
                factor *= rest[context]
            context = context[1:]
        return factor * (counts[0][symbol,] + 1) / total

    for k in range(1, depth + 1):
        follow = {}
        for run, n in counts[k].items():
            if n >= floor:
                follow.setdefault(run[:-1], []).append((run[-1], n))
        found = {}
        for context, next_ in follow.items():
            n, left = counts[k - 1][context], max(1 - sum(p(context[1:], s) for s, _ in next_), 1e-12)
            other = n - sum(c for _, c in next_)
            gain = sum(c * math.log(c / n / p(context[1:], s)) for s, c in next_)
            gain += other * math.log(other / n / left) if other else 0
            if gain > len(next_) * math.log(tokens) / 2:
                got = {s: (c + strength * p(context[1:], s)) / (n + strength) for s, c in next_}
                found[context] = got, max(1 - sum(got.values()), 1e-12) / left
        tree |= {c: x[0] for c, x in found.items()}
        rest |= {c: x[1] for c, x in found.items()}
    return [sum(math.log10(p(tuple(([None] + s[:i])[-depth:]), w)) for i, w in enumerate(s)) for s in seqs], tree


def test_runs_of_any_share_are_in_the_tree(spark):
    """Runs far below the shares held in tasks count and are looked up."""
    rng = random.Random(3)
    parts = [f"x{i} y{i} z{i} u{i}" for i in range(40)] + [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want, retained = brute_scores(texts, 5)
    assert {len(c) for c in retained} >= {1, 2}
    for word_share, run_share in ((2e-6, 1e-5), (0.004, 0.01), (1.0, 1.0), (1e-9, 0.02)):
        tree, words = suffix_tree.fit(docs, min_share=word_share, gram_share=run_share)
        got = {r.doc_id: r.score for r in suffix_tree.score(docs, tree, words).collect()}
        assert all(math.isclose(got[i], x, rel_tol=1e-9, abs_tol=1e-9) for i, x in enumerate(want))
    more, _ = brute_scores(texts, 2)
    tree, words = suffix_tree.fit(docs, gram_share=1.0, floor=2)
    got = {r.doc_id: r.score for r in suffix_tree.score(docs, tree, words).collect()}
    assert all(math.isclose(got[i], x, rel_tol=1e-9, abs_tol=1e-9) for i, x in enumerate(more))


@pytest.mark.parametrize("n_common", [0, 150, 300])
@pytest.mark.parametrize("limit", [10, 1_500_000])
def test_runs_are_shuffled_as_words(monkeypatch, n_common, limit):
    """A run's context and suffix follow from its words, which take less room
    than the three hashes; the words that are not common go as hashes."""
    rng = random.Random(8)
    texts = [" ".join(f"w{int(300 * rng.random() ** 3)}" for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    batches = [pa.record_batch({"text": texts[:700]}), pa.record_batch({"text": texts[700:]})]
    often = Counter(w for t in texts for w in t.split())
    common = suffix_tree.hashed_words(pa.array([" ".join(w for w, _ in often.most_common(n_common))]))[0]
    common = np.concatenate([[suffix_tree.END], common])
    want = {}
    for words, place in suffix_tree._blocks(iter(batches)):
        for length, at, *hashes in suffix_tree._runs(words, place, 3):
            for run, context, suffix in zip(*(h[at].tolist() for h in hashes), strict=True):
                want[run] = want.get(run, (0,))[0] + 1, length, context, suffix
    monkeypatch.setattr(suffix_tree, "BLOCK", 5000)
    monkeypatch.setattr(suffix_tree.Gathered.__init__, "__defaults__", (limit, suffix_tree.pieces))
    every = np.full(1 << (suffix_tree.FILTER - 6), 2 ** 64 - 1, np.uint64)
    packed = pa.Table.from_batches(suffix_tree._count_runs(every, 3, 3, common)(iter(batches)))
    got = {}
    for bucket in range(-4, 4):
        here = packed.filter(pa.array([b == bucket for b in packed.column("bucket").to_pylist()]))
        for row in suffix_tree._frequent(2, common)(here).to_pylist():
            got[row["run"]] = row["n"], row["length"], row["context"], row["suffix"]
    assert got == {run: x for run, x in want.items() if x[0] >= 2}
    if n_common and limit > 10:
        size = sum(len(b) for c in packed.column_names[1:] for b in packed.column(c).to_pylist())
        assert size < 8 * len(want)
