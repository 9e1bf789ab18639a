"""Calendar-month helpers.

Months travel as DATE values of the first day, so that month filters are plain
ranges on the order date and reach the file scan.
"""

from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

ALL_MONTHS = "ALL"

_YEAR_MONTH = re.compile(r"\d{4}-\d{2}")


def parse_month(value: str | date | datetime) -> date:
    """First day of the month given as a date, ``YYYY-MM`` or ``YYYY-MM-DD...``."""
    if isinstance(value, date):
        return date(value.year, value.month, 1)
    text = value.strip()
    if _YEAR_MONTH.fullmatch(text):
        text += "-01"
    try:
        return datetime.fromisoformat(text).date().replace(day=1)
    except ValueError:
        raise ValueError(f"not a month: {value!r}, expected YYYY-MM or YYYY-MM-DD") from None


def next_month(month: date) -> date:
    return date(month.year + month.month // 12, month.month % 12 + 1, 1)


def previous_month(month: date) -> date:
    return date(month.year - (month.month == 1), (month.month - 2) % 12 + 1, 1)


def month_of(day: Column) -> Column:
    """First day of the month of a date or timestamp column, as DATE."""
    return F.trunc(day, "month")


def in_month_range(day: str, first: date, last: date) -> Column:
    """Whether a day lies in the months ``first`` to ``last``, both included."""
    return F.expr(f"{day} >= DATE '{first}' AND {day} < DATE '{next_month(last)}'")


def from_month_on(day: Column, first: Column) -> Column:
    """Whether a day lies in the month ``first``, a scalar subquery, or later.

    ``first`` is NULL for a table without any date; all its rows are kept then. The
    first conjunct alone is a range that a file scan can use, provided ``first`` is
    the bare subquery.
    """
    return ((day >= first) | day.isNull()) & (day.isNotNull() | first.isNull())
