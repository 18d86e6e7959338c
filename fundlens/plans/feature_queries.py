"""Text features, categorical features and evaluation queries (steps 4-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fundlens.operators import evaluate as EV
from fundlens.operators import ranking as RK
from fundlens.operators import text_features as TF
from fundlens.operators.words import word_count
from fundlens.plans.campaign_queries import campaign_prepare
from fundlens.plans.oracle import VOCABULARY_SIZE
from fundlens.session import shared_dir
from fundlens.sources import table
from fundlens.sources.files import materialize
from fundlens.sources.tables import spread

CATEGORICAL = ("country2", "currency2")


def _tokenized(spark, sf):
    docs = spread(table(spark, sf, "documents", ["doc_id", "text"]))
    return docs.transform(TF.add_tokens).transform(TF.add_filtered)


def tokens(spark: SparkSession, sf: str) -> DataFrame:
    d = _tokenized(spark, sf)
    return d.select("doc_id", F.size("tokens").alias("n_tokens"),
                    F.concat_ws(" ", "tokens").alias("token_text"))


def tokens_no_stop(spark: SparkSession, sf: str) -> DataFrame:
    d = _tokenized(spark, sf)
    return d.select("doc_id", F.size("filtered").alias("n_filtered"),
                    F.concat_ws(" ", "filtered").alias("filtered_text"))


def term_counts(spark: SparkSession, sf: str) -> DataFrame:
    return TF.term_counts(_tokenized(spark, sf), "doc_id", "filtered")


def tfidf(spark: SparkSession, sf: str) -> DataFrame:
    t = TF.tfidf(_tokenized(spark, sf), "doc_id", "filtered")
    return t.withColumns({"idf": F.round("idf", 9), "tfidf": F.round("tfidf", 9)})


def category_index(spark: SparkSession, sf: str) -> DataFrame:
    return TF.category_index(campaign_prepare(spark, sf), CATEGORICAL)


def category_index_large(spark: SparkSession, sf: str) -> DataFrame:
    """The words of the documents as the categories of one column."""
    docs = spread(table(spark, sf, "documents", ["doc_id", "text"]))
    counts = word_count(docs, "text").select(F.lit("word").alias("column_name"), F.col("word").alias("value"), "count")
    return RK.rank_categories(counts)


def vocabulary_bounded(spark: SparkSession, sf: str) -> DataFrame:
    """The terms in two or more documents, at most ``VOCABULARY_SIZE``, the
    most frequent, with their occurrences in all documents."""
    return RK.vocabulary(TF.term_counts(_tokenized(spark, sf), "doc_id", "filtered"), VOCABULARY_SIZE, 2)


def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Index pass + mapping pass over the prepared campaigns, as fitting and
    applying the indexers does; the prepared table is written once to the
    shared folder so both passes read it rather than recompute it."""
    prep = materialize(campaign_prepare(spark, sf).select("project_id", *CATEGORICAL),
                       shared_dir(spark, "prepared-categories"))
    index = materialize(TF.category_index(prep, CATEGORICAL), shared_dir(spark, "category-index"))
    return TF.one_hot(prep, "project_id", CATEGORICAL, index)


# --- step 5: split and evaluation --------------------------------------------

def _labelled(spark, sf):
    docs = table(spark, sf, "documents", ["doc_id", "n_chars"])
    labels = table(spark, sf, "labels", ["doc_id", "quality"])
    return docs.join(labels, "doc_id")


def rule_prediction(df: DataFrame) -> DataFrame:
    """A fixed rule standing in for a classifier: long documents are
    predicted to be of good quality."""
    return df.withColumn("prediction", (F.col("n_chars") >= 500).cast("int"))


def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels", ["doc_id", "quality", "toxic"])
    split = F.when(EV.hash_bucket("doc_id") < 1, F.lit("test")).otherwise(F.lit("train"))
    return (labels.groupBy(split.alias("split"))
                  .agg(F.count(F.lit(1)).alias("n"),
                       F.sum("quality").cast("long").alias("n_quality"),
                       F.sum("toxic").cast("long").alias("n_toxic")))


def confusion(spark: SparkSession, sf: str) -> DataFrame:
    return EV.confusion(rule_prediction(_labelled(spark, sf)), "quality", "prediction")


def f1(spark: SparkSession, sf: str) -> DataFrame:
    df = EV.weighted_f1(rule_prediction(_labelled(spark, sf)), "quality", "prediction")
    return df.select(F.round("f1", 9).alias("f1"))


def accuracy(spark: SparkSession, sf: str) -> DataFrame:
    df = EV.accuracy(rule_prediction(_labelled(spark, sf)), "quality", "prediction")
    return df.select(F.round("accuracy", 9).alias("accuracy"))
