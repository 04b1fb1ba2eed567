"""Business dates: day-first input, offsets from a run date, text forms."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

Day = dt.date | str


def day(value: Day) -> Column:
    """A DATE literal from a date, an ISO string or a day-first string such as 31/5/2023."""
    if isinstance(value, str) and "/" in value:
        return F.to_date(F.lit(value), "d/M/yyyy")
    return F.lit(value).cast("date")


def business_date(as_of: Day | None = None, offset: int = -1) -> Column:
    """The day ``offset`` days from the run date; without one, from today."""
    return F.date_add(F.current_date() if as_of is None else day(as_of), offset)


def within(column: Column, start: Day | Column, end: Day | Column | None) -> Column:
    """``column`` from ``start`` to ``end``, both included; open-ended without ``end``."""
    low = start if isinstance(start, Column) else day(start)
    if end is None:
        return column >= low
    if end is start or (not isinstance(end, Column) and not isinstance(start, Column) and end == start):
        return column == low
    return column.between(low, end if isinstance(end, Column) else day(end))


def iso_text(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def compact_text(value: Column) -> Column:
    return F.date_format(value, "yyyyMMdd")


def age_in_days(as_of: Day, created: Column) -> Column:
    return F.datediff(day(as_of), created)
