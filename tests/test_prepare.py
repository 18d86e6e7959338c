"""FIXTURES.md section 5 expectations and SURVEY section 5 invariants."""

import pytest
from pyspark.sql import functions as F

from paths import SF_MID
from fundlens.operators import profile
from fundlens.plans.campaign_queries import campaign_prepare
from fundlens.sources import campaigns


@pytest.fixture(scope="module")
def prep(spark):
    return campaign_prepare(spark, SF_MID).cache()


def test_expected_counts(prep):
    row = prep.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("final_status") == 0).alias("s0"),
        F.count_if(F.col("final_status") == 1).alias("s1"),
        F.count_if(F.col("country2") == "unknown").alias("cu"),
        F.count_if(F.col("currency2") == "unknown").alias("ku"),
        F.count_if(F.col("days_campaign") == -1).alias("d"),
        F.count_if(F.col("hours_prepa") == -1).alias("h"),
        F.count_if((F.col("hours_prepa") < 0) & (F.col("hours_prepa") != -1)).alias("hneg"),
        F.count_if(F.col("goal") == -1).alias("g"),
    ).first()
    assert tuple(row) == (14928, 10018, 4910, 165, 618, 255, 255, 0, 301)


def test_invariants(spark, prep):
    assert {r[0] for r in prep.select("final_status").distinct().collect()} <= {0, 1}
    nulls = profile.null_audit(prep, ["goal", "country2", "currency2", "days_campaign", "hours_prepa"]).first()
    assert set(nulls) == {0}
    raw = campaigns(spark, SF_MID)
    dropped = raw.where(F.col("final_status").isNull()).count()
    assert raw.count() == prep.count() + dropped


def test_schema(prep):
    assert profile.schema_report(prep) == [
        (1, "project_id", "string"), (2, "name", "string"), (3, "descr", "string"),
        (4, "goal", "int"), (5, "keywords", "string"), (6, "final_status", "int"),
        (7, "country2", "string"), (8, "currency2", "string"), (9, "days_campaign", "int"),
        (10, "hours_prepa", "double"), (11, "text", "string")]
