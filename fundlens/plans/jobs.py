"""The reference's programs as whole jobs: preparation (CSV -> Parquet),
training (Parquet -> tuned, saved model + report) and word count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fundlens.operators import evaluate as EV
from fundlens.operators import train as TR
from fundlens.operators import words as W
from fundlens.operators.prepare import prepare
from fundlens.sources.files import read_csv, read_lines, write_table

# Columns of the raw campaign file, all read as text (the lenient casts
# type them); the file's ``desc`` is renamed ``descr`` on read.
CAMPAIGN_COLUMNS = ("project_id", "name", "desc", "goal", "keywords", "disable_communication",
                    "country", "currency", "deadline", "state_changed_at", "created_at",
                    "launched_at", "backers_count", "final_status")


def campaign_schema(columns=CAMPAIGN_COLUMNS) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def preprocess(spark: SparkSession, csv_path: str, out_path: str, label_policy: str = "recode",
               schema: StructType | None = None, infer_schema: bool = False,
               mode: str = "overwrite", through_double: bool = False,
               negative_preparation: str = "repair") -> DataFrame:
    """Preparation job: raw campaign CSV -> prepared Parquet, whose column
    ``desc`` is named as in the file.

    With neither ``schema`` nor ``infer_schema`` the header's columns are
    read as strings (no inference pass).  Returns the written table.
    """
    raw = read_csv(spark, csv_path, schema=schema, infer_schema=infer_schema)
    if "desc" in raw.columns and "descr" not in raw.columns:
        raw = raw.withColumnRenamed("desc", "descr")
    prepared = raw.transform(prepare, label_policy, through_double, negative_preparation)
    write_table(prepared.withColumnRenamed("descr", "desc"), out_path, "parquet", mode=mode)
    return spark.read.parquet(out_path)


def train(spark: SparkSession, parquet_path: str, model_path: str, tune: bool = True,
          **tune_args) -> dict:
    """Training job: prepared Parquet -> tuned nine-stage model, saved, and
    a report of the held-out 10 % (hash split on ``project_id``)."""
    df = spark.read.parquet(parquet_path)
    fit_part, test = EV.hash_split(df, "project_id")
    model = TR.tune(fit_part, **tune_args) if tune else TR.fit(fit_part)
    TR.save_model(model, model_path)
    grid = [({p.name: v for p, v in point.items()}, metric) for point, metric in zip(
        model.getEstimatorParamMaps(), model.validationMetrics)] if tune else []
    with TR.persisted(model.transform(test).select("final_status", "predictions")) as scored:
        confusion = {(int(r[0]), int(r[1])): r[2]
                     for r in EV.confusion(scored, "final_status", "predictions").collect()}
        f1 = EV.weighted_f1(scored, "final_status", "predictions").first()["f1"]
        acc = EV.accuracy(scored, "final_status", "predictions").first()["accuracy"]
    return {"model_path": model_path, "grid": grid, "confusion": confusion,
            "f1": f1, "accuracy": acc, "parameters": TR.parameter_report(model)}


def word_count(spark: SparkSession, text_path: str, k: int = 10, lower: bool = True) -> DataFrame:
    """Word-count job over text files: the ``k`` most frequent words."""
    counts = W.word_count(read_lines(spark, text_path), "value")
    if lower:
        counts = W.word_count_lower(counts)
    return W.top_words(counts, k)
