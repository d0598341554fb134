"""Date helpers.

All helpers return Columns, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(value) -> Column:
    """Typed date literal from 'YYYY-MM-DD', date, or Column."""
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.date):
        value = value.isoformat()
    return F.to_date(F.lit(value))


def week_number(d, scheme: str = "iso") -> Column:
    """Week of year.

    ``iso``    ISO-8601 week (1-53; Monday start, week 1 holds the first Thursday).
    ``monday`` weeks start on Monday and days before the year's first Monday
               are week 0 (the "WEEK(MONDAY)" convention, H18).
    """
    d = as_col(d)
    if scheme == "iso":
        return F.weekofyear(d)
    if scheme == "monday":
        # weekday(): Monday=0 .. Sunday=6
        return F.floor((F.dayofyear(d) - 1 + 7 - F.weekday(d)) / 7).cast("int")
    raise ValueError(f"unknown week scheme {scheme!r}")


def week_year(d, scheme: str = "iso") -> Column:
    """The year that ``week_number`` counts in: the ISO year for ``iso`` (it
    differs from the calendar year around New Year), the calendar year for
    ``monday``."""
    d = as_col(d)
    return F.extract(F.lit("YEAROFWEEK"), d).cast("int") if scheme == "iso" else F.year(d)


def iso_weeks_in(year) -> Column:
    """52 or 53: the ISO week of 28 December."""
    return F.weekofyear(F.make_date(as_col(year), F.lit(12), F.lit(28)))


def iso_week_monday(year, week) -> Column:
    """The Monday of an ISO week; 4 January is always in week 1."""
    first = F.date_trunc("week", F.make_date(as_col(year), F.lit(1), F.lit(4))).cast("date")
    return F.date_add(first, ((as_col(week) - 1) * 7).cast("int"))


def month_start(d) -> Column:
    """First day of the month as DATE."""
    return F.trunc(as_col(d), "month")


def week_start(d) -> Column:
    """Monday of the week as DATE."""
    return F.date_trunc("week", as_col(d)).cast("date")


def anchored_week(d, anchor) -> Column:
    """Start of the 7-day bucket counted from ``anchor`` (H20, ruling X10)."""
    a = as_date(anchor)
    return F.date_add(a, (F.floor(F.datediff(as_col(d).cast("date"), a) / 7) * 7).cast("int"))


def period_start(d, period: str) -> Column:
    """Bucket a date/timestamp to the start DATE of its day/week/month/quarter/year,
    or (timestamps only) to the start TIMESTAMP of its hour/minute."""
    d = as_col(d)
    if period in ("hour", "minute"):
        return F.date_trunc(period, d)
    if period == "day":
        return d.cast("date")
    if period == "week":
        return week_start(d)
    if period in ("month", "quarter", "year"):
        return F.trunc(d.cast("date"), period)
    raise ValueError(f"unknown period {period!r}")


def day_name(d) -> Column:
    """Unpadded English weekday name (H15/H16, ruling X14)."""
    return F.date_format(as_col(d), "EEEE")


def month_name(d) -> Column:
    return F.date_format(as_col(d), "MMMM")
