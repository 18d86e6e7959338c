"""Ranked-choice vote tally.

The reference runs five separate ``groupBy(choice_k).count`` jobs; here the
five columns are unpivoted in the scan's projection (a Generate, no shuffle)
and counted by one aggregate keyed on (rank, sponsor).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def unpivot_choices(df: DataFrame, choice_columns: Sequence[str]) -> DataFrame:
    """One row per (voter, rank): ``choice_rank`` is the 1-based position of
    the column in ``choice_columns``."""
    pairs = F.array(*[F.struct(F.lit(i + 1).alias("choice_rank"),
                               F.col(c).cast("string").alias("sponsor"))
                      for i, c in enumerate(choice_columns)])
    return df.select(F.inline(pairs))


def vote_tally(df: DataFrame, choice_columns: Sequence[str]) -> DataFrame:
    """Votes per (rank, sponsor), ascending count within a rank as in the
    reference's report; sponsor breaks ties."""
    return (unpivot_choices(df, choice_columns)
            .groupBy("choice_rank", "sponsor").count()
            .orderBy("choice_rank", F.col("count").asc(), F.col("sponsor").asc()))
