"""The campaign cleaning rules (U1-U4) as native expressions.

Each rule keeps the null behaviour of the original typed UDFs: a null input
gives a null output.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_country(country: Column | str, currency: Column | str,
                  strict_len: int | None = None) -> Column:
    """A country shifted into the currency column reads ``"False"``; take
    the currency value then.  ``strict_len`` additionally nulls countries of
    another length (the exercise text's variant)."""
    country, currency = _c(country), _c(currency)
    out = F.when(country == "False", currency).otherwise(country)
    if strict_len is not None:
        out = F.when(F.length(out) == strict_len, out)
    return out


def clean_currency(currency: Column | str, length: int = 3) -> Column:
    """A currency code not of ``length`` characters becomes null."""
    currency = _c(currency)
    return F.when(F.length(currency) == length, currency)


def recode_status(status: Column | str) -> Column:
    """U3 "recode": 1 stays 1, any other value becomes 0, null stays null."""
    status = _c(status)
    return F.when(status.isNotNull(), (status == 1).cast("int"))


def repair_created_at(created_at: Column | str, launched_at: Column | str,
                      hours_prepa: Column | str) -> Column:
    """U4: a campaign launched before it was created gets its creation time
    set to its launch time (any negative preparation, not only below -1 h)."""
    return F.when(_c(hours_prepa) < 0, _c(launched_at)).otherwise(_c(created_at))
