"""Timestamps, durations, period and hour labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats of the exports and of the marts.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
MONTH_FORMAT = "yyyy-MM"
ALL_PERIODS = "ALL"
WINDOW_HOURS = 2


def parse_ts(c: Column, fmt: str | None = TIMESTAMP_FORMAT) -> Column:
    """Text to timestamp; unreadable text such as ``0000-00-00 00:00:00`` is NULL.

    ``fmt=None`` accepts any ISO-like text.
    """
    if fmt is None:
        return F.try_to_timestamp(c)
    return F.try_to_timestamp(c, F.lit(fmt))


def is_reversed(start: Column, end: Column) -> Column:
    """True when both ends are known and the interval runs backwards. Never NULL."""
    return F.coalesce(end < start, F.lit(False))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds; NULL when an end is missing or the interval runs backwards."""
    return F.when(end >= start, F.unix_timestamp(end) - F.unix_timestamp(start))


def hours_between(start: Column, end: Column) -> Column:
    """``seconds_between`` in hours."""
    return hours(seconds_between(start, end))


def hours(seconds: Column) -> Column:
    """Whole seconds as hours."""
    return seconds.cast("double") / F.lit(3600.0).cast("double")


def month_start(ts: Column) -> Column:
    """First day of the month: the cheap grouping key behind a month label."""
    return F.trunc(ts, "MM")


def month_label(ts_or_date: Column) -> Column:
    """``yyyy-MM``."""
    return F.date_format(ts_or_date, MONTH_FORMAT)


def window_label(hour: Column, length: int = WINDOW_HOURS) -> Column:
    """``HH:00-HH:00`` label of the window that opens at ``hour``; wraps at midnight.

    The labels of neighbouring hours overlap: there are 24 of them, one per opening hour.
    """
    closes = (hour + F.lit(length)) % F.lit(24)
    return F.concat(
        F.lpad(hour.cast("string"), 2, "0"),
        F.lit(":00-"),
        F.lpad(closes.cast("string"), 2, "0"),
        F.lit(":00"),
    )


def run_stamp(run_ts: Column | None = None) -> Column:
    """The given run time, or the time the query starts."""
    return F.current_timestamp() if run_ts is None else run_ts
