"""Date helpers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_day_first(text: Column) -> Column:
    """``'31/01/2024'`` to a date; NULL when it is none."""
    return F.try_to_date(text, "d/M/yyyy")


def iso_date(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def month_key(iso: Column) -> Column:
    """``yyyyMM`` of an ISO date string."""
    return F.substring(F.replace(iso, F.lit("-"), F.lit("")), 1, 6)


def version_key(ref: Column, dt_proc: Column) -> Column:
    """Load version of a row: month, then load stamp, compared as text."""
    return F.concat(ref.cast("string"), dt_proc.cast("string"))


def lookback_flag(day: Column, ref_date: date, months: int) -> Column:
    """1 when ``day`` is at most ``months`` months before ``ref_date``, else 0.

    Later dates count as inside, a missing date as outside.
    """
    age = F.months_between(F.lit(ref_date), day)
    return F.when(age <= months, 1).otherwise(0)
