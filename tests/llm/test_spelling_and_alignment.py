"""Spelling variants and cross-tokenizer alignment against brute force."""

import bisect
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from conftest import frame

from fundlens.llm import alignment, spelling

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(rows, min_length=6, min_count=5):
    counts = Counter()
    for id_, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if id_ is None else id_}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n, form[w], root, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def variants(df, **options):
    got = spelling.spelling_variants(df, **options)
    assert got.columns == ["word", "n", "form", "root", "n_near", "form_n"]
    return sorted(tuple(r) for r in got.collect())


def vocabulary_texts(seed=0, n=400):
    """Texts over few letters, with variants of variants, capitals and accents."""
    rng = random.Random(seed)
    base = ["".join(rng.choices("abcdefghinorstuÀéÿ", k=rng.randint(5, 9))) for _ in range(12)]
    words = [w for w in base for _ in range(200)]
    for w in base:
        for _ in range(6):
            at = rng.randrange(len(w))
            one = rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice("abzé") + w[at:], w[:at] + "x" + w[at + 1:]])
            two = one[:1] + "q" + one[1:]
            words += [one] * rng.choice([4, 5, 20, 40]) + [two.upper()] * 6
    rng.shuffle(words)
    size = -(-len(words) // n)
    return [(i, " 1,".join(words[i * size:(i + 1) * size])) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"subtree": 5}, {"subtree": 5, "top": 2}])
def test_variants_equal_brute_force(spark, options):
    rows = vocabulary_texts()
    got = variants(frame(spark, rows), **options)
    assert got == brute_variants(rows)
    assert any(r[2] for r in got) and any(r[3] != r[2] and r[2] for r in got)


@pytest.mark.parametrize("options", [{}, {"subtree": 5}, {"subtree": 5, "top": 2}])
def test_pairs_meet_once_if_tasks_hold_many_subtrees(spark, options):
    rows = vocabulary_texts(2)
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "3"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert variants(frame(spark, rows), **options) == brute_variants(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_large_leaves_are_matched_by_halves(monkeypatch):
    rng = random.Random(1)
    names = sorted({"".join(rng.sample("aabbccddee", k=rng.choice([7, 8, 8, 9]))) for _ in range(1500)})
    words = spelling.Words(names)
    all_ = np.arange(len(names))
    plain = spelling.search(words, all_, all_)
    assert set(zip(*map(list, plain), strict=True)) == {
        (i, j) for i in all_ for j in all_ if one_edit(names[i], names[j])}
    monkeypatch.setattr(spelling, "DIRECT", 0)
    monkeypatch.setattr(spelling, "BLOCK", 100)
    monkeypatch.setattr(spelling, "LEAF", 2000)
    assert all(np.array_equal(x, y) for x, y in zip(plain, spelling.search(words, all_, all_), strict=True))


def test_variants_edges(spark, edge_docs, clash_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert variants(edge_docs) == variants(clash_docs) == brute_variants(rows)
    assert variants(no_docs) == []
    # ties of the largest count; a very long word; repeated rows; null ids; one hot word
    long = "ab" * 3000
    rows = [(1, " ".join(["zettelx"] * 50 + ["zettely"] * 50 + ["zettel"] * 5 + [long] * 30 + [long + "a"] * 5))] * 3
    rows += [(None, "zettelx ZETTELX zettelX"), (2, "  "), (3, "")] + [(i, "hottest") for i in range(10, 400)]
    got = variants(frame(spark, rows))
    assert got == brute_variants(rows)
    assert ("zettel", "zettelx") in {(r[0], r[2]) for r in got}


def brute_alignment(rows):
    a_side = tokenizers.Tokenizer.from_file(A)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=B)
    decoder = tokenizers.decoders.ByteLevel()
    shown = {c: i for i, c in enumerate(alignment._byte_letters())}
    assert decoder.decode(["Ġhi"]) == " hi"
    found, counts = [], Counter()
    for _, text in rows:
        links, groups, a_ids, b_ids = [], [], [], []
        if text:
            a_ids = a_side.encode(" " + text, add_special_tokens=False).ids
            b_ids = b_side.encode(text)
            a_bytes = [bytes(shown[c] for c in a_side.id_to_token(i)) for i in a_ids]
            b_bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()
                       for p in map(b_side.id_to_piece, b_ids)]
            if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                a_ids, b_ids = [], []
            else:
                ends_a, ends_b = np.cumsum([len(x) for x in a_bytes]), np.cumsum([len(x) for x in b_bytes])
                j = 0
                for i, end in enumerate(ends_a):
                    start = end - len(a_bytes[i])
                    while ends_b[j] <= start:
                        j += 1
                    k = j
                    while k < len(b_ids) and ends_b[k] - len(b_bytes[k]) < end:
                        links.append((a_ids[i], b_ids[k]))
                        k += 1
                cuts = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
                inside = [([], []) for _ in cuts]
                for side, (ids, ends) in enumerate(((a_ids, ends_a), (b_ids, ends_b))):
                    for t, e in zip(ids, ends.tolist(), strict=True):
                        inside[bisect.bisect_left(cuts, e)][side].append(str(t))
                groups = [",".join(x) + "|" + ",".join(y) for x, y in inside]
        counts.update(links)
        found.append((len(a_ids), len(b_ids), groups, links))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [(id_, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
             sum(counts[x] for x in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "")
            for (id_, _), (n_a, n_b, groups, links) in zip(rows, found, strict=True)]


ORDER = lambda r: (r[0] is None, r[0] or 0, *r[1:])


def aligned(df, **options):
    got = alignment.cross_alignment(df, A, B, **options)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=ORDER)


ODD = ["Hello  world,\n\tit's 3.14 o'clock", "naïve café Ünïcode 漢字かな 🙂🙂", "<|endoftext|> <s> </s> <unk> <0x41>",
       "  leading", "trailing  ", "\x00\x01 control", "a b c", "½ ﬁ Ⅳ ①", "▁ piece mark", "é combining",
       "don't we'll I'VE", "...!!??", " ", "\n", "x" * 3000, "ab­ soft", "ｆｕｌｌ width", "͸ unassigned ᲀ"]


@pytest.mark.parametrize("share", [0.0, 0.002, 2.0])
def test_alignment_equals_brute_force(spark, share):
    rng = random.Random(5)
    words = " ".join(ODD[:12]).split()
    rows = [(i, t) for i, t in enumerate(ODD)]
    rows += [(100 + i, " ".join(rng.choices(words, k=30))) for i in range(40)]
    rows += [(i % 7, "the same text for a third of all rows, the same") for i in range(25)]
    got = aligned(frame(spark, rows).repartition(3), held_share=share)
    assert got == sorted(brute_alignment(rows), key=ORDER)
    assert sum(r[1] > 0 for r in got) > 50 and any(r[1] == 0 for r in got)


def test_alignment_edges(edge_docs, clash_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert aligned(edge_docs) == aligned(clash_docs) == sorted(brute_alignment(rows), key=ORDER)
    assert aligned(no_docs) == []


def test_settled_texts_are_cut_as_the_library_does():
    rng = random.Random(9)
    side = alignment.ByteSide(A)
    assert side.plain
    letters = "".join(c for c in map(chr, range(9, 0x250)) if alignment._SETTLED.fullmatch(c))
    texts = ["".join(rng.choices(letters + " '\n,.st" * 20, k=rng.randint(1, 60))) for _ in range(4000)]
    assert all(alignment._SETTLED.fullmatch(t) for t in texts)
    whole = side.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    assert [x.tolist() for x in side.encode(texts)] == [x.ids for x in whole]


def test_covering_tokens_are_found_without_a_join(monkeypatch):
    rng = np.random.default_rng(0)
    size = rng.integers(1, 40, 50)  # bytes of documents
    docs, starts = [], []
    for _ in range(2):
        cut = [np.unique(np.append(0, rng.integers(0, n, 8))) for n in size]
        docs.append(np.repeat(np.arange(len(size)), [len(c) for c in cut]))
        starts.append(np.concatenate([c + b for c, b in zip(cut, np.cumsum(size) - size, strict=True)]))
    monkeypatch.setattr(alignment.pd, "merge_asof", None)
    got = alignment.covering(starts[0], starts[1], docs[0], docs[1])
    assert got.tolist() == [max(j for j, s in enumerate(starts[1].tolist()) if s <= at and docs[1][j] == doc)
                            for at, doc in zip(starts[0].tolist(), docs[0], strict=True)]
    none = np.zeros(0, np.int64)
    assert len(alignment.covering(none, none, none, none)) == 0
    monkeypatch.undo()  # an empty token: the last one of its own document
    assert alignment.covering(np.array([0, 3, 3]), np.array([0, 3]), np.array([0, 0, 1]), np.array([0, 1])) \
        .tolist() == [0, 0, 1]


def test_words_are_aligned_once(monkeypatch):
    rng = random.Random(4)
    words = ["don't", "naïve", "a\nb", "\nlead", "3.14", "<|endoftext|>", "</s>", "漢字", "x" * 50, "end\n", "the", "Straße,"]
    texts = [" ".join(rng.choices(words[:7] + words[8:9] + words[10:], k=rng.randint(1, 12))) for _ in range(300)]
    texts += [" ".join(rng.choices(words, k=8)) for _ in range(60)] + ["a  b", " a", "a ", " ", "a\n b", "漢"]
    for kept, chars in ((4, 10**6), (10**6, 30), (10**6, 10**6)):
        monkeypatch.setattr(alignment, "WORDS", kept)
        monkeypatch.setattr(alignment, "WORD_CHARS", chars)
        aligner = alignment.Aligner(A, B)
        for at in range(0, len(texts), 20):
            some = texts[at:at + 20]
            parts, table = aligner(some)
            whole = aligner.align(some)
            for i, rows in enumerate(parts):
                assert table.numbers[rows].sum(0).tolist() == whole.numbers[i].tolist(), some[i]
                assert "".join(table.written[r] for r in rows) == whole.written[i]
                assert sorted(x for r in rows for x in table.pairs[table.first[r]:table.first[r + 1]].tolist()) \
                    == sorted(whole.pairs[whole.first[i]:whole.first[i + 1]].tolist())
    # words that are known are not encoded again
    calls = []
    monkeypatch.setattr(aligner, "align_words", lambda words: calls.append(words))
    parts, _ = aligner(texts[:300])
    assert not calls and all(len(rows) == len(t.split(" ")) for rows, t in zip(parts, texts[:300], strict=True))
