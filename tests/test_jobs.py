"""The reference's programs end to end: CSV -> prepared Parquet -> tuned,
saved model with a held-out report; word count over text files."""

import os

from paths import SF_SMALL
from fundlens.operators.train import grid_of
from fundlens.plans.jobs import CAMPAIGN_COLUMNS, preprocess, train, word_count
from fundlens.session import shared_dir
from fundlens.sources import campaigns, table
from fundlens.sources.files import write_table


def test_preprocess_then_train(spark):
    base = shared_dir(spark, "t-jobs")
    raw = campaigns(spark, SF_SMALL).withColumnRenamed("descr", "desc").select(*CAMPAIGN_COLUMNS)
    csv = write_table(raw, os.path.join(base, "csv"), "csv", header=True)
    prepared = preprocess(spark, csv, os.path.join(base, "prepared"))
    assert prepared.count() > 0 and "desc" in prepared.columns
    report = train(spark, os.path.join(base, "prepared"), os.path.join(base, "model"),
                   grid=grid_of(reg_param=(1e-7, 0.1), min_df=(1.0, 2.0)))
    assert (8, "LogisticRegressionModel", "thresholds", "[0.7, 0.3]") in report["parameters"]
    assert len(report["grid"]) == 4
    assert 0.0 <= report["f1"] <= 1.0 and 0.0 <= report["accuracy"] <= 1.0
    assert sum(report["confusion"].values()) > 0
    assert os.path.isdir(report["model_path"])


def test_word_count_job(spark):
    path = write_table(table(spark, SF_SMALL, "documents", ["text"]), shared_dir(spark, "t-text"), "text")
    top = word_count(spark, path, k=5).collect()
    assert len(top) == 5
    assert [r["count"] for r in top] == sorted((r["count"] for r in top), reverse=True)


def test_preprocess_with_inferred_types_matches_text_schema(spark):
    base = shared_dir(spark, "t-infer")
    raw = campaigns(spark, SF_SMALL).withColumnRenamed("descr", "desc").select(*CAMPAIGN_COLUMNS)
    csv = write_table(raw, os.path.join(base, "csv"), "csv", header=True)
    typed = preprocess(spark, csv, os.path.join(base, "a"), infer_schema=True)
    text = preprocess(spark, csv, os.path.join(base, "b"))
    assert typed.columns == text.columns
    assert sorted(typed.collect()) == sorted(text.collect())
