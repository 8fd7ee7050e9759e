"""The month a job runs for, and how far back it looks."""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date

from .config import HISTORY_MONTHS


def month_end(day: date) -> date:
    return day.replace(day=calendar.monthrange(day.year, day.month)[1])


def months_before(day: date, months: int) -> date:
    """Same day ``months`` earlier, clamped to the length of that month."""
    total = day.year * 12 + day.month - 1 - months
    year, month = divmod(total, 12)
    last = calendar.monthrange(year, month + 1)[1]
    return date(year, month + 1, min(day.day, last))


def month_number(day: date) -> int:
    """``yyyyMM`` as an integer, the value of the partition column."""
    return day.year * 100 + day.month


@dataclass(frozen=True)
class RunWindow:
    ref_date: date
    first_date: date

    @classmethod
    def of(cls, as_of: date, history_months: int = HISTORY_MONTHS) -> RunWindow:
        end = month_end(as_of)
        return cls(end, months_before(end, history_months))

    @property
    def ref(self) -> int:
        return month_number(self.ref_date)

    @property
    def first_ref(self) -> int:
        return month_number(self.first_date)
