"""Transcript parsing, the registered queries and the pipeline."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundlens.llm import queries, transcripts
from fundlens.llm.frames import stored

SF_SMALL = "/root/testdata/sf0.001"


def random_model(seed=0):
    rng = np.random.default_rng(seed)
    n = transcripts.N_STATES
    return tuple(np.log(rng.dirichlet(np.ones(k), m).squeeze()) for m, k in ((1, n), (n, n), (n, transcripts.N_SEEN)))


def brute_path(seen, model):
    first, move, emit = model
    score = lambda p: first[p[0]] + sum(move[a, b] for a, b in zip(p, p[1:], strict=False)) + sum(
        emit[s, o] for s, o in zip(p, seen, strict=True))
    return max(itertools.product(range(transcripts.N_STATES), repeat=len(seen)), key=score)


def parse_lines(spark, lines, model):
    df = spark.createDataFrame(lines, "conv_id long, turn long, raw string")
    return transcripts.parse(stored(transcripts.lines_of(df, "conv_id", "turn", "raw"), "t"), model)


def test_viterbi_over_blocks_equals_all_paths(spark, monkeypatch):
    model = random_model()
    rng = np.random.default_rng(1)
    texts = ["User: hi?", "Bot: " + "x" * 50, "plain", "", "# System: y", "z" * 500]
    lines = [(c, t, texts[rng.integers(6)]) for c in range(12) for t in range(1 + c % 6)]
    want = None
    for block in (1, 2, 3, 512):  # conversations of many blocks, or of one
        monkeypatch.setattr(transcripts, "BLOCK", block)
        rows = parse_lines(spark, lines, model).orderBy("conv", "place").collect()
        got = {}
        for r in rows:
            got.setdefault(r.conv, []).append(r.state)
        seen = {}
        for r in rows:
            seen.setdefault(r.conv, []).append(r.seen)
        want = want or {c: list(brute_path(s, model)) for c, s in seen.items()}
        assert got == want, block


def test_long_conversation_is_decoded_alike_in_blocks(spark, monkeypatch):
    model = random_model(3)
    rng = np.random.default_rng(2)
    lines = [(1, t, ["User: a", "b?", "[bot] c", "d" * 130][rng.integers(4)]) for t in range(700)]
    out = []
    for block in (32, 100_000):
        monkeypatch.setattr(transcripts, "BLOCK", block)
        out.append([(r.state, r.turn) for r in parse_lines(spark, lines, model).orderBy("place").collect()])
    assert out[0] == out[1]


def test_roles_of_raw_transcripts(spark):
    turns = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    got = queries.op8_transcript_hmm(spark, SF_SMALL).collect()
    want = {}
    for r in turns.orderBy("conv_id", "turn").collect():
        want.setdefault(r.conv_id, []).append((r.role, r.text))
    right = sum((r.role, r.text) == want[r.conv_id][r.turn] for r in got if r.turn < len(want[r.conv_id]))
    assert right > 0.85 * sum(map(len, want.values()))
    assert all(r.rendered == f"<|{r.role}|>\n{r.text}\n<|end|>\n" for r in got)


def test_styles_and_names_are_known(spark):
    texts = [(i, s.format(n) + "Rest: of it", r) for i, (s, (r, n)) in enumerate(itertools.product(
        transcripts.STYLES, [(r, n.capitalize()) for r, ns in transcripts.NAMES.items() for n in ns]))]
    rows = spark.createDataFrame(texts, "i long, t string, role string").select(
        "role", transcripts.without_marker(F.col("t")).alias("rest"), transcripts.observation(F.col("t")).alias("o"))
    per_kind = (len(transcripts.LENGTHS) + 1) * 2
    for r in rows.collect():
        assert r.rest == "Rest: of it" and transcripts.ROLES[r.o // per_kind - 1] == r.role


def test_transcript_edges(spark):
    rows = [(None, 1, "User: a"), (None, None, None), (1, 1, ""), (1, 1, ""), (1, None, "x"), (2, 5, "Bot: y\nz"),
            (2, 5, "Bot: y\nz")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn long, raw string, state int")
    model = transcripts.fit(*[stored(transcripts.lines_of(df, "conv_id", "turn", "raw", F.lit("user").alias("role")), "t")
                              .where("false").withColumn("n_lines", F.lit(1))] * 2)
    assert all(not np.isnan(m).any() for m in model)
    lines = stored(transcripts.lines_of(df, "conv_id", "turn", "raw"), "t")
    out = transcripts.parse(lines, model)
    assert out.count() == 9 and out.where("conv is null").count() == 2
    assert transcripts.render(out).agg(F.sum("n_lines")).head()[0] == 9
    assert transcripts.render(transcripts.parse(stored(lines.limit(0), "t"), model)).count() == 0


COLUMNS = {
    "op1": "doc_id held_out score predicted", "op3": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op4": "doc_id fingerprint component_id", "op5": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op6": "doc_id size source_size target taken", "op7": "doc_id keep_id group_size kept text_sha256",
    "op9": "doc_id start n_tokens ids_crc32",
    "op10": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept"}


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n != "op8_transcript_hmm"])
def test_queries_cover_every_document(spark, name):
    out = queries.QUERIES[name](spark, SF_SMALL)
    assert set(COLUMNS.get(name.split("_")[0], "doc_id").split()) <= set(out.columns)
    ids = sorted(r.doc_id for r in out.select("doc_id").collect())
    assert ids == sorted(r.doc_id for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id").collect())


def test_pipeline(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    at = docs
    sizes = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stored(stage(spark, at, SF_SMALL), "stage")
        sizes.append(out.count())
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
            assert out.exceptAll(at if i != 3 else at.union(at).union(at)).count() == 0  # only rows of the input
        at = out
    assert sizes[0] < docs.count() and sizes[1] < sizes[0] and sizes[2] <= sizes[1] and sizes[4] == sizes[3]


def test_pipeline_without_rows(spark, no_docs):
    import corpus_pipeline
    at = no_docs
    for _, stage in corpus_pipeline.STAGES:
        at = stored(stage(spark, at, SF_SMALL), "stage")
        assert at.count() == 0
