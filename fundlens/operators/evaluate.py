"""Classifier evaluation (M7-M9, M1 twin) as aggregates.

All metrics are computed from the confusion table, whose size is
classes x classes; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def hash_bucket(key: Column | str, buckets: int = 10) -> Column:
    """Deterministic bucket from the md5 of the key: the first 8 hex digits
    as an integer, mod ``buckets``.  Unlike ``randomSplit`` it does not
    depend on partitioning, so a split is reproducible anywhere."""
    k = F.col(key) if isinstance(key, str) else key
    return (F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint")
            % buckets).cast("int")


def hash_split(df: DataFrame, key: str, test_buckets: int = 1, buckets: int = 10):
    """(train, test): rows whose bucket is below ``test_buckets`` go to test."""
    b = hash_bucket(key, buckets)
    return df.where(b >= test_buckets), df.where(b < test_buckets)


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """M7: ``(label, prediction, count)``."""
    return df.groupBy(label, prediction).count()


def per_class(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per label value: support, true positives, predicted count,
    precision, recall and f1 (0 when undefined, as Spark's metrics).

    One aggregate: each confusion cell counts once towards its label's
    support (and true positives) and once towards its prediction's
    predicted count, so no join of the table with itself is needed.
    """
    conf = confusion(df, label, prediction)
    lab, pred, n = F.col(label).cast("double"), F.col(prediction).cast("double"), F.col("count")
    zero = F.lit(0).cast("long")
    cells = conf.select(F.inline(F.array(
        F.struct(lab.alias("cls"), n.alias("support"),
                 F.when(lab == pred, n).otherwise(zero).alias("tp"), zero.alias("n_predicted")),
        F.struct(pred.alias("cls"), zero.alias("support"), zero.alias("tp"), n.alias("n_predicted")))))
    j = (cells.groupBy("cls").agg(F.sum("support").alias("support"), F.sum("tp").alias("tp"),
                                  F.sum("n_predicted").alias("n_predicted"))
              .where(F.col("support") > 0))
    p = F.when(F.col("n_predicted") > 0, F.col("tp") / F.col("n_predicted")).otherwise(F.lit(0.0))
    r = F.col("tp") / F.col("support")
    j = j.withColumns({"precision": p, "recall": r})
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(F.lit(0.0))
    return j.withColumn("f1", f1)


def weighted_f1(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """M8: support-weighted f1 (MulticlassClassificationEvaluator "f1")."""
    pc = per_class(df, label, prediction)
    return pc.agg((F.sum(F.col("support") * F.col("f1")) / F.sum("support")).alias("f1"))


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """M9: share of rows whose prediction equals the label."""
    return df.agg(F.avg((F.col(label).cast("double") == F.col(prediction).cast("double"))
                        .cast("double")).alias("accuracy"))
