"""Campaign preparation: raw campaign strings -> the training table.

Every stage is a ``DataFrame -> DataFrame`` function, so a caller composes
them with ``df.transform(...)`` and Catalyst collapses the chain into one
Project + Filter over the scan; no stage shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fundlens.functions.casts import cast_columns
from fundlens.functions.cleaning import (clean_country, clean_currency,
                                          recode_status, repair_created_at)
from fundlens.functions.dates import days_between, hours_between

INT_COLUMNS = ("goal", "deadline", "state_changed_at", "created_at",
               "launched_at", "backers_count", "final_status")
# Known only after the campaign ends (leakage), and a near-constant flag.
LEAK_COLUMNS = ("backers_count", "state_changed_at")
CONSTANT_COLUMNS = ("disable_communication",)
TEXT_COLUMNS = ("name", "descr", "keywords")
FILL_VALUES = {"currency2": "unknown", "country2": "unknown",
               "days_campaign": -1, "hours_prepa": -1, "goal": -1}
LABEL_POLICIES = ("recode", "drop")


def cast_campaigns(df: DataFrame, through_double: bool = False) -> DataFrame:
    """Lenient integer cast of the seven numeric columns."""
    return cast_columns(df, [c for c in INT_COLUMNS if c in df.columns],
                        "int", through_double)


def drop_leakage(df: DataFrame) -> DataFrame:
    """Drop columns known only after the outcome, and the constant flag."""
    return df.drop(*CONSTANT_COLUMNS, *LEAK_COLUMNS)


def clean_location(df: DataFrame, strict_country_len: int | None = None,
                   keep_raw: bool = False) -> DataFrame:
    """U1 + U2: ``country2`` and ``currency2`` from the raw pair."""
    out = df.withColumns({
        "country2": clean_country("country", "currency", strict_country_len),
        "currency2": clean_currency("currency"),
    })
    return out if keep_raw else out.drop("country", "currency")


def clean_status(df: DataFrame, policy: str = "recode", column: str = "final_status") -> DataFrame:
    """U3 + P5: keep labels 0 and 1.

    ``recode`` turns every non-1 status into 0 first (nulls are dropped);
    ``drop`` keeps only rows already labelled 0 or 1.
    """
    if policy not in LABEL_POLICIES:
        raise ValueError(f"label policy must be one of {LABEL_POLICIES}")
    if policy == "recode":
        df = df.withColumn(column, recode_status(column))
    return df.where(F.col(column).isin(0, 1))


def add_durations(df: DataFrame) -> DataFrame:
    """F7 + F8: campaign length in days and preparation time in hours."""
    return df.withColumns({
        "days_campaign": days_between("deadline", "launched_at"),
        "hours_prepa": hours_between("created_at", "launched_at"),
    })


def repair_preparation(df: DataFrame, drop_dates: bool = True) -> DataFrame:
    """U4: negative preparation -> creation := launch; hours recomputed."""
    created2 = repair_created_at("created_at", "launched_at", "hours_prepa")
    out = df.withColumn("hours_prepa", hours_between(created2, F.col("launched_at")))
    return out.drop("created_at", "launched_at", "deadline") if drop_dates else out


def drop_negative_preparation(df: DataFrame, drop_dates: bool = True) -> DataFrame:
    """The other policy: rows with a negative preparation go; unknown ones
    stay."""
    out = df.where(~F.coalesce(F.col("hours_prepa") < 0, F.lit(False)))
    return out.drop("created_at", "launched_at", "deadline") if drop_dates else out


def add_text(df: DataFrame, columns=TEXT_COLUMNS) -> DataFrame:
    """F3 + F4: lower-case the text columns and join them with blanks
    (nulls skipped) into ``text``."""
    lowered = df.withColumns({c: F.lower(c) for c in columns})
    return lowered.withColumn("text", F.concat_ws(" ", *columns))


def fill_nulls(df: DataFrame, values: dict | None = None) -> DataFrame:
    """Per-column null replacement."""
    return df.na.fill(values or FILL_VALUES)


PREPARED_COLUMNS = ("project_id", "name", "descr", "goal", "keywords",
                    "final_status", "country2", "currency2", "days_campaign",
                    "hours_prepa", "text")


def prepare(df: DataFrame, label_policy: str = "recode", through_double: bool = False,
            negative_preparation: str = "repair") -> DataFrame:
    """The full preparation, raw campaigns -> prepared table.

    ``through_double``: decimals in the integer columns are truncated, not
    null.  ``negative_preparation``: "repair" them or "drop" their rows."""
    if negative_preparation not in ("repair", "drop"):
        raise ValueError("negative_preparation must be repair or drop")
    fix = repair_preparation if negative_preparation == "repair" else drop_negative_preparation
    return (df.transform(cast_campaigns, through_double)
              .transform(drop_leakage)
              .transform(clean_location)
              .transform(clean_status, label_policy)
              .transform(add_durations)
              .transform(fix)
              .transform(add_text)
              .transform(fill_nulls)
              .select(*PREPARED_COLUMNS))
