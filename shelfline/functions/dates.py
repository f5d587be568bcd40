"""Date windows relative to an explicit anchor, never the wall clock."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(column: str | Column) -> Column:
    return F.to_date(column)


def anchor(as_of: date, offset_days: int = 0) -> Column:
    """A literal date; folding the offset in Python keeps the predicate pushable."""
    return F.lit(as_of + timedelta(days=offset_days))


def in_days(column: str, first: date | Column, last: date | None = None) -> Column:
    """Rows of the days ``first`` to ``last`` of a timestamp column.

    Compares the bare column with midnights, which reaches the file scan; a
    comparison on ``to_date(column)`` would not.
    """
    c = F.col(column)
    inside = c >= (first if isinstance(first, Column) else F.lit(first))
    return inside if last is None else inside & (c < F.lit(last + timedelta(days=1)))


def months_before(as_of: date, months: int) -> Column:
    return F.add_months(F.lit(as_of), -months)


def week_start(column: Column) -> Column:
    return F.trunc(F.to_date(column), "week")


def month_start(column: Column) -> Column:
    return F.trunc(F.to_date(column), "month")


def quarter_label(year: Column, quarter: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-Q"), quarter.cast("string"))


def weekday_name(column: Column) -> Column:
    return F.date_format(column, "EEEE")


def compact_date(column: Column) -> Column:
    return F.date_format(column, "yyyyMMdd")


def business_days(first: date | Column, last: date, holidays: list[date]) -> Column:
    """Sorted array of weekdays that are not holidays; between two fixed dates Catalyst folds it to one literal."""
    days = F.sequence(first if isinstance(first, Column) else F.lit(first), F.lit(last))
    closed = F.array(*[F.lit(h) for h in holidays]) if holidays else F.array().cast("array<date>")
    return F.filter(days, lambda d: (F.weekday(d) < 5) & ~F.array_contains(closed, d))
