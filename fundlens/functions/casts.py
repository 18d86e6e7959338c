"""Lenient casts.

Spark 2.4's cast gave null for malformed text and truncated ``"3.7"`` to 3.
With ANSI mode (the Spark 4 default) a plain cast raises instead, so the
lenient form is ``try_cast``; ``through_double`` keeps the old truncation.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F


def lenient_cast(c: Column | str, dtype: str = "int", through_double: bool = False) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    if through_double:
        return col.try_cast("double").try_cast(dtype)
    return col.try_cast(dtype)


def cast_columns(df: DataFrame, columns: Iterable[str], dtype: str = "int",
                 through_double: bool = False) -> DataFrame:
    """Cast several columns at once (one Project, not a chain)."""
    return df.withColumns({c: lenient_cast(c, dtype, through_double) for c in columns})
