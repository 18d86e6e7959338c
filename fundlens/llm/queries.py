"""One registered query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.llm import (
    alignment,
    bpe,
    exact_dedup,
    frames,
    mixing,
    quality,
    repeats,
    rules,
    simhash,
    spelling,
    suffix_tree,
    toxicity,
    transcripts,
    wavelet,
)
from fundlens.session import shared_dir
from fundlens.sources.tables import table

#: Vocabulary file of the tokenizing queries.
TOKENIZER = "word_bpe_49k.json"
#: The two sides of the alignment query.
BYTE_TOKENIZER, PIECE_TOKENIZER = "byte_bpe_50k.json", "piece_bpe_32k.model"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_toxicity_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with crc32(doc_id as text) mod 3 = 1 are held out of training."""
    docs = documents(spark, sf_dir)
    net, calibration = toxicity.fit(docs, table(spark, sf_dir, "labels"), frames.remainder(F.col("id"), 3) != 1)
    rows = docs.select("doc_id", (frames.remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "text")
    return toxicity.score(rows, net, calibration).select("doc_id", "held_out", "score", "predicted")


def op2_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with crc32(doc_id as text) mod 3 = 1 are held out of training."""
    docs = documents(spark, sf_dir)
    model = quality.fit(docs, table(spark, sf_dir, "labels"), frames.remainder(F.col("id"), 3) != 1)
    rows = docs.withColumn("held_out", frames.remainder(F.col("doc_id"), 3) == 1)
    return quality.score(rows, model).select("doc_id", "held_out", "quality_score", "accepted")


def op3_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with crc32(doc_id as text) mod 7 = 2 are held out of training."""
    docs = documents(spark, sf_dir)
    held_out = frames.remainder(F.col("doc_id"), 7) == 2
    tree, words = suffix_tree.fit(docs.where(~held_out))
    return suffix_tree.score(docs, tree, words).select("doc_id", held_out.alias("held_out"), *[
        "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def op4_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def encoded_digests(df: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """Encode and decode every text; the ids and the decoded text come back
    as counts and SHA-256 digests."""
    both = bpe.decode(bpe.encode(df, path, "text", keep), path)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select(*keep, F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op5_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(documents(spark, sf_dir), tokenizer_path(), ["doc_id"])


def op6_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(documents(spark, sf_dir))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "positions")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(documents(spark, sf_dir))


def op8_transcript_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations as raw transcripts, parsed back.  Learns from those
    with crc32(conv_id as text) mod 3 <> 1."""
    raw = transcripts.raw_transcripts(table(spark, sf_dir, "conversations"))
    lines = frames.stored(transcripts.lines_of(raw, "conv_id", "turn", "raw", F.col("role")), "lines")
    learned = lines.where(frames.remainder(F.col("conv"), 3) != 1)
    turns = learned.groupBy("conv", "place", "role", "row").agg(F.count("*").alias("n_lines"))
    model = transcripts.fit(turns, learned)
    return transcripts.render(transcripts.parse(lines.drop("role"), model))


def op9_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = wavelet.write_shards(documents(spark, sf_dir), tokenizer_path(), shared_dir(spark, "wavelet"))
    return wavelet.stored_documents(spark, out)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document labelled 1 is trusted."""
    trusted = table(spark, sf_dir, "labels", ["doc_id", "quality"]).where("quality = 1").select("doc_id")
    return rules.quality_rules(documents(spark, sf_dir), trusted)


def op11_radix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeats.remove_repeats(documents(spark, sf_dir))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op12_variant_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.cross_alignment(documents(spark, sf_dir), tokenizer_path(BYTE_TOKENIZER),
                                     tokenizer_path(PIECE_TOKENIZER))


QUERIES = {
    "op1_toxicity_gru": op1_toxicity_gru,
    "op2_quality_cotraining": op2_quality_cotraining,
    "op3_suffix_tree": op3_suffix_tree,
    "op4_simhash_pivots": op4_simhash_pivots,
    "op5_bpe_tree": op5_bpe_tree,
    "op6_curriculum_mix": op6_curriculum_mix,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_transcript_hmm": op8_transcript_hmm,
    "op9_wavelet_shards": op9_wavelet_shards,
    "op10_quality_rules": op10_quality_rules,
    "op11_radix_repeats": op11_radix_repeats,
    "op12_variant_trie": op12_variant_trie,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE = {
    "op7_exact_dedup": r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
w AS (SELECT *, first_value(doc_id) OVER g AS keep_id, first_value(n) OVER g AS keep_n,
    count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d WINDOW g AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size,
  doc_id IS NOT DISTINCT FROM keep_id AND n = keep_n AS kept, text_sha256 FROM w
""",
}
