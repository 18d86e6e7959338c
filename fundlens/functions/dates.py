"""Epoch-second arithmetic (F6-F8), written so the result does not depend on
the session time zone: epochs are read as UTC wall clock."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

def _epoch_day(seconds: Column) -> Column:
    """The UTC calendar date of an epoch second (date arithmetic has no zone)."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int"))


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_to_utc(seconds: Column | str) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ holding the UTC wall clock.

    Built from the UTC date and the second of the day: interval arithmetic
    on a TIMESTAMP_NTZ still applies the session zone's daylight-saving
    rules (a wall clock in a spring-forward gap moves by an hour), field
    construction does not.
    """
    x = _c(seconds)
    day = _epoch_day(x)
    sod = x - F.floor(x / 86400) * 86400
    return F.make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day),
                                F.floor(sod / 3600).cast("int"),
                                F.floor(sod % 3600 / 60).cast("int"),
                                (sod % 60).cast("decimal(8,6)"))


def epoch_to_string(seconds: Column | str, fmt: str | None = None) -> Column:
    """``from_unixtime`` in UTC, ``yyyy-MM-dd HH:mm:ss``.

    The default is a string cast of the UTC wall clock, which involves no
    zone.  ``date_format`` (used for a custom ``fmt``) first turns a
    TIMESTAMP_NTZ into a session-zone timestamp, so a wall clock in a
    daylight-saving gap of that zone would print an hour later.
    """
    if fmt is None:
        return epoch_to_utc(seconds).cast("string")
    return F.date_format(epoch_to_utc(seconds), fmt)


def days_between(end: Column | str, start: Column | str) -> Column:
    """whole days between the date parts (23:59:59 -> 00:00:00 is 1)."""
    return F.datediff(_epoch_day(_c(end)), _epoch_day(_c(start)))


def hours_between(start: Column | str, end: Column | str) -> Column:
    """F8: hours from ``start`` to ``end`` truncated toward zero at three
    decimals, ``((end - start) / 3.6).cast(int) / 1000``.  Null where the
    difference of two extreme values leaves the integer range."""
    seconds = _c(end).cast("bigint") - _c(start).cast("bigint")
    return (seconds / 3.6).try_cast("int") / 1000
