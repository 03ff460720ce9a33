"""Day arithmetic and day-range predicates.

Ranges are half-open comparisons on the bare column. They hold for DATE and for
both timestamp types, reach the file scan as pushed filters, and prune a table
that is partitioned by a date column.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

Day = date | str


def as_date(value: Day) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def in_days(column: str, start: Day, end: Day) -> Column:
    """Closed range of calendar days: both ends count."""
    first, after = as_date(start), as_date(end) + timedelta(days=1)
    return (F.col(column) >= F.lit(first)) & (F.col(column) < F.lit(after))


def trailing_days(column: str, as_of: Day, days: int) -> Column:
    """``as_of - days`` up to and including ``as_of``: days + 1 calendar days."""
    as_of = as_date(as_of)
    return in_days(column, as_of - timedelta(days=days), as_of)


def days_before(as_of: Day, days: int) -> Column:
    return F.lit(as_date(as_of) - timedelta(days=days))


def month_days(month: str, years_back: int = 0) -> tuple[date, date]:
    """First and last day of a ``YYYY-MM`` month, optionally years earlier."""
    first = as_date(f"{month}-01")
    first = first.replace(year=first.year - years_back)
    following = (first + timedelta(days=31)).replace(day=1)
    return first, following - timedelta(days=1)


def week_start(column: str) -> Column:
    """Monday of the row's week."""
    return F.date_trunc("week", F.col(column)).cast("date")
