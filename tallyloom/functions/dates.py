"""Date helpers. "Today" is always a parameter (``as_of``), never the wall clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def as_date(value) -> dt.date:
    """A ``date`` from a date, datetime or ISO text (driver-side parameter)."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


def lit_date(value) -> Column:
    """Date literal Column for a parameter."""
    return F.lit(as_date(value))


def week_of_year_sunday(col) -> Column:
    """Week number 0-53 where weeks start on Sunday (days before the first Sunday are week 0)."""
    d = _c(col)
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int")


def month_diff(later, earlier) -> Column:
    """Month boundaries crossed between two dates (year*12+month difference)."""
    a, b = _c(later), _c(earlier)
    return (F.year(a) * 12 + F.month(a)) - (F.year(b) * 12 + F.month(b))


def same_month(col, as_of) -> Column:
    """1 when the date falls in the same calendar month as ``as_of``, else 0."""
    return F.when(F.trunc(_c(col), "MM") == F.trunc(lit_date(as_of), "MM"), 1).otherwise(0)


def window_start(as_of, months_back: int = 3) -> dt.date:
    """First day of the month ``months_back`` months before ``as_of`` (driver-side constant)."""
    d = as_date(as_of)
    y, m = d.year, d.month - months_back
    while m <= 0:
        m += 12
        y -= 1
    return dt.date(y, m, 1)


def last_day_of_month(value) -> dt.date:
    """Last calendar day of the month of ``value``."""
    d = as_date(value)
    nxt = dt.date(d.year + (d.month == 12), d.month % 12 + 1, 1)
    return nxt - dt.timedelta(days=1)


def is_month_end(value) -> bool:
    """Whether ``value`` is the last day of its month."""
    d = as_date(value)
    return d == last_day_of_month(d)


def local_time(ts_col, zone: str) -> Column:
    """Wall-clock time in ``zone`` of a UTC wall-clock timestamp (TIMESTAMP_NTZ).

    Independent of the session time zone.
    """
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _c(ts_col))


def local_day(ts_col, zone: str) -> Column:
    """Calendar day in ``zone`` of a UTC wall-clock timestamp."""
    return F.to_date(local_time(ts_col, zone))
