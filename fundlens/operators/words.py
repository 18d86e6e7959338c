"""Word counts (P11, F1-F3, A5-A7, O3), the DataFrame form.

Plan: Generate(explode) feeds a partial hash aggregate in the same
codegen stage, so the shuffle carries one row per distinct word and map
task no matter how skewed the word frequencies are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fundlens.functions.text import split_blank


def explode_values(df: DataFrame, array_col, keep=(), name: str = "value") -> DataFrame:
    """Explode an array column into rows.

    Written as ``explode_outer`` + a null filter (equal to ``explode`` for
    arrays without null elements): a plain ``explode`` makes Catalyst infer
    a ``size(array) > 0`` filter below the Generate, which evaluates the
    array expression - a whole-text split - a second time.
    """
    return (df.select(*keep, F.explode_outer(array_col).alias(name))
              .where(F.col(name).isNotNull()))


def words(df: DataFrame, text_col: str = "value") -> DataFrame:
    """One row per blank-separated word (empty words kept)."""
    return explode_values(df, split_blank(text_col), name="word")


def word_count(df: DataFrame, text_col: str = "value") -> DataFrame:
    """``(word, count)``."""
    return words(df, text_col).groupBy("word").count()


def word_count_lower(counts: DataFrame) -> DataFrame:
    """A5: re-aggregate counts after lower-casing the word."""
    return (counts.groupBy(F.lower("word").alias("word"))
                  .agg(F.sum("count").alias("count")))


def top_words(counts: DataFrame, k: int = 10) -> DataFrame:
    """O3: the ``k`` most frequent words, ties broken by the word."""
    return counts.orderBy(F.col("count").desc(), F.col("word").asc()).limit(k)


def text_totals(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows, lines, words and distinct words of a text column, in one
    aggregate over the exploded words (the distinct count is planned as a
    two-phase distinct aggregate, never a collect)."""
    # Per-row values are projected below the Generate; in the same select
    # as the explode they would be evaluated once per word.
    per_row = df.select(F.when(F.col(text_col).isNotNull(),
                               F.size(F.split(text_col, "\n"))).alias("row_lines"),
                        split_blank(text_col).alias("words"))
    exploded = per_row.select("row_lines", F.posexplode_outer("words").alias("pos", "word"))
    first = (F.col("pos") == 0) | F.col("pos").isNull()
    return exploded.agg(
        F.count_if(first).alias("n_rows"),
        F.sum(F.when(first, F.col("row_lines"))).cast("long").alias("n_lines"),
        F.count("word").alias("n_words"),
        F.count_distinct("word").alias("n_distinct_words"))
