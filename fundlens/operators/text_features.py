"""Text and categorical features.

Two forms of each stage:

* the ``pyspark.ml`` stages the reference's pipeline uses (``ml_stages``),
  which produce vectors for the classifier;
* relational twins that produce long tables ``(doc, term, tf, idf, tfidf)``
  and ``(column, value, count, index)`` - inspectable, joinable and checked
  against SQL.

Scale notes.  Term counts are an explode feeding a partial hash aggregate
keyed on (doc, term): a document's repeats collapse map-side, so the shuffle
carries distinct (doc, term) pairs.  Document frequency is a second aggregate
on term; a frequent term is pre-aggregated per map task before the shuffle.
The join of pairs back to their term's frequency has one row per term on
the small side; terms in very many documents are joined by a bounded
broadcast and kept out of the shuffle (``joins.join_hot_split``), the rest
by a shuffle join that AQE may still turn into a broadcast at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from fundlens.functions.text import ENGLISH_STOP_WORDS, TOKEN_PATTERN, regex_tokens, remove_stop_words
from fundlens.operators.joins import HOT_BYTES, join_hot_split
from fundlens.operators.words import explode_values


# --- relational twins --------------------------------------------------------

def add_tokens(df: DataFrame, text_col: str = "text", out: str = "tokens",
               pattern: str = TOKEN_PATTERN, min_length: int = 1) -> DataFrame:
    """RegexTokenizer twin (lower-case, ``\\W+`` gaps, min length)."""
    return df.withColumn(out, regex_tokens(text_col, pattern, min_length))


def add_filtered(df: DataFrame, tokens_col: str = "tokens", out: str = "filtered",
                 words=ENGLISH_STOP_WORDS) -> DataFrame:
    """StopWordsRemover twin."""
    return df.withColumn(out, remove_stop_words(tokens_col, words))


def term_counts(df: DataFrame, id_col: str, tokens_col: str = "filtered") -> DataFrame:
    """``(id, term, tf)`` - term occurrences per document."""
    return (explode_values(df, F.col(tokens_col), keep=[id_col], name="term")
              .groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf")))


def document_frequency(tc: DataFrame, id_col: str) -> DataFrame:
    """``(term, df)``: documents containing each term (pairs are unique).

    Counted as ``count_if(tf > 0)`` (every pair has ``tf >= 1``) rather than
    ``count(*)``: depending on the value of ``tf`` keeps the optimizer from
    pruning the term-count aggregate in this branch, so its subtree stays
    identical to the one it is joined back to, Spark reuses that exchange
    and the corpus is tokenised once, not twice.
    """
    return tc.groupBy("term").agg(F.count_if(F.col("tf") > 0).alias("df"))


def tfidf(docs: DataFrame, id_col: str, tokens_col: str = "filtered",
          min_df: float = 1.0, hot_split: bool = True, max_bytes: int = HOT_BYTES,
          min_tf: float = 1.0, min_doc_freq: int = 0) -> DataFrame:
    """T3 + T4: ``(id, term, tf, df, idf, tfidf)``.

    ``idf = ln((N + 1) / (df + 1))`` with N the number of documents (rows of
    ``docs``, empty ones included), as Spark ML's IDF.  ``min_df`` keeps
    terms in at least that many documents, or that share of them if below 1
    (CountVectorizer's rule); ``min_tf`` likewise terms of a document by
    their count or share in it; terms in fewer than ``min_doc_freq``
    documents get weight 0 (IDF's rule).  N is a scalar subquery.

    With ``hot_split`` the pairs are joined to their term's frequency by
    ``joins.join_hot_split``: terms found in very many documents go by a
    bounded broadcast and never enter the shuffle, so one frequent term
    cannot load one reducer with a large share of all pairs.
    """
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    tc = term_counts(docs, id_col, tokens_col)
    dfreq = document_frequency(tc, id_col)
    if min_df != 1.0:
        bound = F.lit(min_df) if min_df >= 1.0 else F.lit(min_df) * n_docs
        dfreq = dfreq.where(F.col("df") >= bound)
    idf = F.log((n_docs + F.lit(1.0)) / (F.col("df") + F.lit(1.0)))
    if min_doc_freq > 0:
        idf = F.when(F.col("df") >= min_doc_freq, idf).otherwise(F.lit(0.0))
    joined = (join_hot_split(tc, dfreq, "term", "df", max_bytes) if hot_split
              else tc.join(dfreq, "term"))
    if min_tf >= 1.0:
        joined = joined.where(F.col("tf") >= min_tf)
    else:
        sizes = docs.select(F.col(id_col).alias("_doc"), F.size(tokens_col).alias("_size"))
        joined = (joined.join(sizes, F.col(id_col) == F.col("_doc"))
                  .where(F.col("tf") >= min_tf * F.col("_size")))
    return (joined
              .select(id_col, "term", "tf", "df", idf.alias("idf"))
              .withColumn("tfidf", F.col("tf") * F.col("idf")))


def category_index(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """T5: StringIndexer twin for several columns at once.

    ``(column_name, value, count, idx)``: the most frequent value gets 0,
    ties go to the smaller value; nulls are not indexed.  One aggregate for
    all columns (unpivot in the projection).  The ranking window is
    partitioned by column, so each window group holds one column's distinct
    categories, never its rows.  Use it for columns whose distinct values
    (not rows) fit one task, as StringIndexer asks of the driver.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"),
                               F.col(c).cast("string").alias("value")) for c in columns])
    counts = (df.select(F.inline(pairs)).where(F.col("value").isNotNull())
                .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count")))
    w = Window.partitionBy("column_name").orderBy(F.col("count").desc(), F.col("value").asc())
    return counts.withColumn("idx", (F.row_number().over(w) - 1).cast("int"))


def one_hot(df: DataFrame, id_col: str, columns: Sequence[str], index: DataFrame,
            drop_last: bool = True, max_bytes: int = HOT_BYTES) -> DataFrame:
    """T5 + T6: per row, each column's category index and the position of
    its 1 in the one-hot vector (null for the dropped last category), plus
    the vector size.  Rows with a null or unseen category are skipped, as
    with ``handleInvalid="skip"``.

    The index has one row per category.  Below ``max_bytes`` (checked) its
    columns' parts are broadcast, so the table is not shuffled on its few
    category values; a larger one is split by ``join_hot_split``, with a
    category's own count as its weight: only rare categories are shuffled.
    """
    # categories per column: a window over the index, which the ranking
    # window has already partitioned by column (no further exchange)
    idx = index.withColumn("n_cat", F.count(F.lit(1)).over(Window.partitionBy("column_name")))
    size = index.agg(F.sum(F.octet_length("value") + 64)).head()[0] or 0
    out = df.select(id_col, *columns)
    for c in columns:
        m = (idx.where(F.col("column_name") == c)
                .select(F.col("value").alias(c), F.col("idx").alias(f"{c}_idx"),
                        F.col("n_cat").alias(f"_{c}_n"), F.col("count").alias("_weight")))
        out = (out.join(F.broadcast(m), c) if size <= max_bytes
               else join_hot_split(out, m, c, "_weight", max_bytes)).drop("_weight")
        size_of = F.col(f"_{c}_n") - (1 if drop_last else 0)
        out = out.withColumns({
            f"{c}_hot": F.when(F.col(f"{c}_idx") < size_of, F.col(f"{c}_idx")),
            f"{c}_size": size_of.cast("int"),
        }).drop(f"_{c}_n")
    return out


# --- pyspark.ml stages -------------------------------------------------------

# The pipeline's thresholds, tolerance and vocabulary bound.
VOCABULARY = 1 << 18
THRESHOLDS = (0.7, 0.3)
TOLERANCE = 1e-6


def ml_stages(text_col: str = "text", label_col: str = "final_status",
              categorical: Sequence[str] = ("country2", "currency2"),
              numeric: Sequence[str] = ("days_campaign", "hours_prepa", "goal"),
              min_df: float = 1.0, reg_param: float = 0.0, max_iter: int = 20,
              vocab_size: int = VOCABULARY, tol: float = TOLERANCE):
    """The reference's nine stages: tokenizer, stop words, counts, IDF, two
    indexers, one-hot, assembler, logistic regression (thresholds 0.7/0.3:
    class 1 when p(1) > 0.3).  ``vocab_size``: terms kept, the most frequent."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import (IDF, CountVectorizer, OneHotEncoder, RegexTokenizer,
                                    StopWordsRemover, StringIndexer, VectorAssembler)

    tok = RegexTokenizer(inputCol=text_col, outputCol="tokens", pattern=TOKEN_PATTERN, gaps=True)
    stop = StopWordsRemover(inputCol="tokens", outputCol="filtered")
    cv = CountVectorizer(inputCol="filtered", outputCol="vectorized", minDF=min_df,
                         vocabSize=vocab_size)
    idf = IDF(inputCol="vectorized", outputCol="tfidf")
    indexed = [f"{c}_indexed" for c in categorical]
    indexers = [StringIndexer(inputCol=c, outputCol=o, handleInvalid="skip")
                for c, o in zip(categorical, indexed)]
    onehot_cols = [f"{c}_onehot" for c in categorical]
    ohe = OneHotEncoder(inputCols=indexed, outputCols=onehot_cols)
    assembler = VectorAssembler(inputCols=["tfidf", *numeric, *onehot_cols], outputCol="features")
    lr = LogisticRegression(elasticNetParam=0.0, fitIntercept=True, featuresCol="features",
                            labelCol=label_col, standardization=True,
                            predictionCol="predictions", rawPredictionCol="raw_predictions",
                            thresholds=list(THRESHOLDS), tol=tol, maxIter=max_iter, regParam=reg_param)
    return [tok, stop, cv, idf, *indexers, ohe, assembler, lr]
