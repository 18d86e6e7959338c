"""Word-count queries over ``documents.text`` (step 1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fundlens.operators import words as W
from fundlens.sources.tables import spread, table


def _docs(spark, sf, cols=("doc_id", "text")):
    """Documents, spread over the cores when the file is a single split."""
    return spread(table(spark, sf, "documents", ["doc_id", *[c for c in cols if c != "doc_id"]]),
                  "doc_id").select(*cols)


def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return W.word_count(_docs(spark, sf, ("text",)), "text")


def word_count_lower(spark: SparkSession, sf: str) -> DataFrame:
    return W.word_count_lower(word_count(spark, sf))


def top_words(spark: SparkSession, sf: str) -> DataFrame:
    return W.top_words(word_count(spark, sf), 10)


def top_words_lower(spark: SparkSession, sf: str) -> DataFrame:
    return W.top_words(word_count_lower(spark, sf), 10)


def line_and_token_totals(spark: SparkSession, sf: str) -> DataFrame:
    return W.text_totals(_docs(spark, sf, ("text",)), "text")
