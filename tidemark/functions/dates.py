"""Dates and times, independent of the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def epoch_to_iso(seconds: Column) -> Column:
    """Seconds since 1970 as ``yyyy-MM-ddTHH:mm:ss`` in UTC."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    moment = start + F.make_dt_interval(secs=seconds)
    return F.replace(moment.cast("string"), F.lit(" "), F.lit("T"))


def parse_date(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """Text as a date; unreadable text gives null."""
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")


def month_of(day: Column) -> Column:
    """First day of the month."""
    return F.trunc(day, "month")
