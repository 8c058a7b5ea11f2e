"""Parsing of raw text that yields NULL instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def market_date(text: Column) -> Column:
    """Calendar date of a local timestamp text: its first ten characters."""
    return F.substring(text, 1, 10).try_cast("date")


# Days from 1970-01-01 to the first and the last day that a date text can name.
FIRST_DAY, LAST_DAY = -719162, 2932896


def epoch_ms_date(ms: Column) -> Column:
    """UTC date of epoch milliseconds, whatever the session time zone is.

    NULL where it lies outside the years 1 to 9999, as for nanoseconds.
    """
    days = F.floor((ms / F.lit(86_400_000)).cast("double")).try_cast("int")
    inside = F.when(days.between(FIRST_DAY, LAST_DAY), days)
    return F.date_add(F.lit("1970-01-01").cast("date"), inside)
