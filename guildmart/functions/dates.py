"""Calendar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _month_day(day: Column) -> Column:
    return F.month(day) * 100 + F.dayofmonth(day)


def whole_years(birthday: Column, as_of: Column) -> Column:
    """Completed years from ``birthday`` to ``as_of``; counted backwards (negative) if it lies ahead."""
    first, last = F.least(birthday, as_of), F.greatest(birthday, as_of)
    years = (
        F.year(last)
        - F.year(first)
        - F.when(_month_day(last) < _month_day(first), 1).otherwise(0)
    )
    # least/greatest skip NULL, so an unknown birthday has to be kept unknown here.
    return F.when(birthday <= as_of, years).when(birthday > as_of, -years)


def days_between(start: Column, end: Column) -> Column:
    """Whole days from start to end; NULL while either is unknown."""
    return F.date_diff(end, start)


def month_of(day: Column) -> Column:
    """Calendar month as text, e.g. ``2001-07``."""
    return F.date_format(day, "yyyy-MM")
