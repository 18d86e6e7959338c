"""The corpus pipeline: quality filter, exact and near deduplication, mixing
and tokenisation of ``documents``, one operator of ``fundlens.llm`` each.

A stage takes (spark, docs, sf_dir) and works on everything its predecessor
kept; its result is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from fundlens.llm import exact_dedup, frames, mixing, quality, queries, simhash
from fundlens.sources.tables import table

#: Classifiers and fingerprints have no SQL form; the stages are tested against
#: brute-force versions.
ORACLE_SQL = None


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the co-trained classifier rejects."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).where("accepted").select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and drops documents by their sources' targets; one row per
    copy, in training order."""
    return mixing.mix(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document and copy: its id, and what it encodes and decodes
    to."""
    return queries.encoded_digests(docs, queries.tokenizer_path(), ["doc_id"])


STAGES = [
    ("quality classifier", keep_good_quality),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode_texts),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES:
        docs = frames.stored(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
