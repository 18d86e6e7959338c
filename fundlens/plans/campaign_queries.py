"""Queries over the ``campaigns`` and ``votes`` views (steps 2-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fundlens.functions.dates import epoch_to_string
from fundlens.operators import prepare as P
from fundlens.operators import profile
from fundlens.operators.votes import vote_tally
from fundlens.sources import campaigns, table, votes
from fundlens.sources.views import VOTE_COLUMNS


def _cast(spark, sf):
    return campaigns(spark, sf).transform(P.cast_campaigns)


def _located(spark, sf):
    return _cast(spark, sf).transform(P.drop_leakage).transform(P.clean_location)


def _durations(spark, sf, policy="recode"):
    return (_located(spark, sf).transform(P.clean_status, policy)
            .transform(P.add_durations))


def _before_fill(spark, sf):
    return (_durations(spark, sf).transform(P.repair_preparation)
            .transform(P.add_text))


def campaign_cast(spark: SparkSession, sf: str) -> DataFrame:
    return _cast(spark, sf)


def campaign_cast_truncating(spark: SparkSession, sf: str) -> DataFrame:
    """P4 with decimals truncated: order totals as text for goals."""
    orders = table(spark, sf, "orders", ["o_orderkey", "o_totalprice"])
    raw = orders.select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("goal"))
    return P.cast_campaigns(raw, through_double=True)


def campaign_prepare_drop_negative(spark: SparkSession, sf: str) -> DataFrame:
    """The preparation with negative-preparation rows dropped, not repaired."""
    return campaigns(spark, sf).transform(P.prepare, negative_preparation="drop")


def shortest_preparations(spark: SparkSession, sf: str) -> DataFrame:
    """O2 + O3: the 30 smallest known preparation times."""
    rows = _durations(spark, sf).where(F.col("hours_prepa").isNotNull())
    return profile.top_n(rows.select("project_id", "hours_prepa"), 30,
                         F.col("hours_prepa").asc(), F.col("project_id").asc())


def filled_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that hold a fill value after the preparation, per column."""
    prep = campaign_prepare(spark, sf)
    return prep.agg(*[F.count_if(F.col(c) == F.lit(v)).alias(f"{c}_filled") for c, v in P.FILL_VALUES.items()])


def campaign_country(spark: SparkSession, sf: str) -> DataFrame:
    df = _cast(spark, sf).transform(P.clean_location, keep_raw=True)
    return df.select("project_id", "country", "currency", "country2")


def campaign_currency(spark: SparkSession, sf: str) -> DataFrame:
    df = _cast(spark, sf).transform(P.clean_location, keep_raw=True)
    return df.select("project_id", "currency", "currency2")


def campaign_status_recode(spark: SparkSession, sf: str) -> DataFrame:
    return _located(spark, sf).transform(P.clean_status, "recode").select("project_id", "final_status")


def campaign_status_drop(spark: SparkSession, sf: str) -> DataFrame:
    return _located(spark, sf).transform(P.clean_status, "drop").select("project_id", "final_status")


def campaign_durations(spark: SparkSession, sf: str) -> DataFrame:
    return _durations(spark, sf).select(
        "project_id", "deadline", "launched_at", "created_at",
        epoch_to_string("launched_at").alias("launched_on"),
        epoch_to_string("deadline").alias("deadline_on"),
        "days_campaign", "hours_prepa")


def campaign_prep_repair(spark: SparkSession, sf: str) -> DataFrame:
    df = _durations(spark, sf).withColumnRenamed("hours_prepa", "hours_before")
    df = df.withColumn("hours_prepa", F.col("hours_before"))
    return (df.transform(P.repair_preparation, drop_dates=False)
              .select("project_id", "created_at", "launched_at", "hours_before", "hours_prepa"))


def campaign_text(spark: SparkSession, sf: str) -> DataFrame:
    return _before_fill(spark, sf).select("project_id", "name", "descr", "keywords", "text")


def campaign_fill(spark: SparkSession, sf: str) -> DataFrame:
    return (_before_fill(spark, sf).transform(P.fill_nulls)
            .select("project_id", "goal", "country2", "currency2", "days_campaign", "hours_prepa"))


def campaign_prepare(spark: SparkSession, sf: str, label_policy: str = "recode") -> DataFrame:
    return campaigns(spark, sf).transform(P.prepare, label_policy)


def campaign_prepare_drop(spark: SparkSession, sf: str) -> DataFrame:
    return campaign_prepare(spark, sf, "drop")


# --- step 3: profiles -------------------------------------------------------

def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.frequency(_cast(spark, sf), "final_status")


def _counts_of(column: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return profile.frequency(_cast(spark, sf), column)
    query.__name__ = f"{column}_counts"
    query.__doc__ = f"A1: rows per ``{column}`` value of the typed campaigns."
    return query


# The single-key frequency tables the reference looks at before cleaning.
disable_communication_counts = _counts_of("disable_communication")
country_counts = _counts_of("country")
currency_counts = _counts_of("currency")
backers_counts = _counts_of("backers_count")
state_changed_counts = _counts_of("state_changed_at")


def country_currency_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.frequency(_cast(spark, sf), "country", "currency")


def flag_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A3: a computed boolean as the key; null statuses form their own group."""
    return profile.frequency(_cast(spark, sf), (F.col("final_status") > 1).alias("status_above_1"))


def profile_all(spark: SparkSession, sf: str) -> DataFrame:
    """A1-A4: the frequency tables of the typed campaigns in one scan."""
    df = _cast(spark, sf).withColumns({"status_above_1": F.col("final_status") > 1,
                                       "is_false": F.col("country") == "False"})
    single = ["final_status", "country", "currency", "disable_communication", "backers_count", "state_changed_at"]
    flagged = "country is False, currency"
    found = profile.frequencies(df, {c: [c] for c in single} | {
        "country, currency": ["country", "currency"], "status_above_1": ["status_above_1"],
        flagged: ["is_false", "currency"]})
    rest = F.col("profile") != flagged
    return found.where(rest | (F.col("key") == "true")).select(
        "profile", F.when(rest, F.col("key")).otherwise(F.col("second_key")).alias("key"),
        F.when(rest, F.col("second_key")).alias("second_key"), "count")


def negative_prep_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Before/after check of U4: rows with negative preparation time."""
    df = _durations(spark, sf).withColumn("hours_before", F.col("hours_prepa"))
    df = df.transform(P.repair_preparation)
    return profile.flag_before_after(df, F.col("hours_before") < 0, F.col("hours_prepa") < 0,
                                     "negative_prep")


def false_country_currencies(spark: SparkSession, sf: str) -> DataFrame:
    return profile.filtered_frequency(_cast(spark, sf), F.col("country") == "False", "currency")


def describe_numeric(spark: SparkSession, sf: str) -> DataFrame:
    df = profile.describe_numeric(_cast(spark, sf), ["goal", "backers_count", "final_status"])
    return df.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


def null_audit(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["days_campaign", "hours_prepa", "goal", "country2", "currency2"]
    return profile.null_audit_before_after(_before_fill(spark, sf), cols, P.FILL_VALUES)


def distinct_deadlines(spark: SparkSession, sf: str) -> DataFrame:
    return profile.distinct_values(_cast(spark, sf), "deadline")


def largest_goals(spark: SparkSession, sf: str) -> DataFrame:
    return profile.top_n(_cast(spark, sf).select("project_id", "goal", "final_status"), 30,
                         F.col("goal").desc_nulls_last(), F.col("project_id").asc())


def class_balance(spark: SparkSession, sf: str) -> DataFrame:
    return profile.class_balance(campaign_prepare(spark, sf), "final_status")


def first_campaigns(spark: SparkSession, sf: str) -> DataFrame:
    return profile.top_n(campaign_prepare(spark, sf), 20, F.col("project_id").asc())


def one_campaign(spark: SparkSession, sf: str, project_id: str = "kk1") -> DataFrame:
    """P7 spot check of one key through the whole preparation; the key
    reaches the scans."""
    return campaigns(spark, sf, project_id).transform(P.prepare)


def vote_tally_query(spark: SparkSession, sf: str) -> DataFrame:
    return vote_tally(votes(spark, sf), VOTE_COLUMNS)
