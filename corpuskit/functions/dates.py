"""Date predicates that reach the file scan whenever the pattern allows it."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_YEAR = re.compile(r"\d{4}")
_MONTH = re.compile(r"\d{4}-\d{2}")
_DAY = re.compile(r"\d{4}-\d{2}-\d{2}")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _span(pattern: str) -> tuple[dt.date, dt.date] | None:
    """[first, last) dates of a full year, month or day pattern, if it is one."""
    try:
        if _DAY.fullmatch(pattern):
            first = dt.date.fromisoformat(pattern)
            return first, first + dt.timedelta(days=1)
        if _MONTH.fullmatch(pattern):
            first = dt.date.fromisoformat(pattern + "-01")
            return first, (first + dt.timedelta(days=31)).replace(day=1)
        if _YEAR.fullmatch(pattern):
            year = int(pattern)
            return dt.date(year, 1, 1), dt.date(year + 1, 1, 1)
    except (ValueError, OverflowError):
        return None
    return None


def date_matches(column: Column | str, pattern: str) -> Column:
    """Rows whose yyyy-MM-dd date contains `pattern`.

    A whole year, month or day can only match at the start of the text, so it
    becomes a half-open range the Parquet reader can use. Any other pattern is
    a substring test on the text form.
    """
    column = _col(column)
    span = _span(pattern)
    if span is not None:
        return (column >= F.lit(span[0])) & (column < F.lit(span[1]))
    return column.cast("date").cast("string").contains(pattern)


def after(column: Column | str, date: str) -> Column:
    """Strictly later than the given yyyy-MM-dd day."""
    next_day = dt.date.fromisoformat(date) + dt.timedelta(days=1)
    return _col(column) >= F.lit(next_day)


def before(column: Column | str, date: str) -> Column:
    """Strictly earlier than the given yyyy-MM-dd day."""
    return _col(column) < F.lit(dt.date.fromisoformat(date))


def month_of(column: Column | str) -> Column:
    """yyyy-MM of a date."""
    return F.substring(_col(column).cast("date").cast("string"), 1, 7)
