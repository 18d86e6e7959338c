"""User functions (U5), Arrow-batched and null-safe.

A typed Scala UDF returns null when an argument is null; a Python function
would receive ``None`` and could return a value.  ``null_safe_udf`` hands a
vectorised pandas function only the rows without a null argument, in their own
type (a bigint with nulls stays a bigint, NaN is a value), and returns null for
the others, like the built-in expressions.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

# Ship this module's functions with the task (by value), so executors need
# no copy of the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def null_safe_udf(fn: Callable[..., pd.Series], return_type: str):
    """Build an Arrow UDF from ``fn(*series) -> series`` that yields null
    wherever any argument is null."""
    arrow_type = to_arrow_type(DataType.fromDDL(return_type))

    def wrapped(*cols):
        known = cols[0].is_valid()
        for c in cols[1:]:
            known = pc.and_(known, c.is_valid())
        out = fn(*[c.filter(known).to_pandas() for c in cols])
        values = pa.array(out, type=arrow_type, from_pandas=not pa.types.is_floating(arrow_type))
        # row numbers among the known rows; null elsewhere
        place = np.where(flags := known.to_numpy(zero_copy_only=False), np.cumsum(flags) - 1, 0)
        return values.take(pa.array(place, mask=~flags)) if len(values) else pa.nulls(len(flags), arrow_type)

    # the type hints choose the array-to-array form
    wrapped.__annotations__ = {"cols": pa.Array, "return": pa.Array}
    return F.arrow_udf(wrapped, return_type)


def _clean_currency(currency: pd.Series) -> pd.Series:
    return currency.where(currency.str.len() == 3, None)


def clean_currency_udf():
    """U2 as a user function, for comparison with the native expression."""
    return null_safe_udf(_clean_currency, "string")


def _same(values: pd.Series) -> pd.Series:
    return values


def identity_udf(return_type: str):
    """A user function that returns its argument."""
    return null_safe_udf(_same, return_type)
