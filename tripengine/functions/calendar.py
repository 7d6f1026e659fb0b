"""Durations, calendar parts and date text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duration_minutes(start: str, end: str) -> Column:
    """Minutes from ``start`` to ``end``; negative when they are swapped."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / 60


PARTS = {
    "hour": F.hour,
    "day_of_week": F.dayofweek,  # 1 is Sunday, 7 is Saturday
    "month": F.month,
    "week_of_year": F.weekofyear,  # ISO week
}


def calendar_parts(df: DataFrame, ts: str, prefix: str, parts=tuple(PARTS)) -> DataFrame:
    """Add ``<prefix>_<part>`` for each named calendar part of ``ts``."""
    return df.withColumns({f"{prefix}_{part}": PARTS[part](ts) for part in parts})


def date_text(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def time_text(ts: str) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def in_year(ts: str, year: int) -> Column:
    """A range test on the raw column, so that it reaches the file scan."""
    return (F.col(ts) >= f"{year}-01-01") & (F.col(ts) < f"{year + 1}-01-01")


def two_digits(column: str) -> Column:
    """The first two-digit group of a text as an integer, null without one."""
    return F.regexp_extract(column, r"(\d{2})", 1).try_cast("int")
