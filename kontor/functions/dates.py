"""Date helpers, all built-in column expressions (codegen, no UDF)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

def as_date(value) -> Column:
    """A date, an ISO date string ('1998-03-03'), a column name or a column -> column."""
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, _dt.date):
        return F.lit(value)
    try:
        return F.lit(_dt.date.fromisoformat(str(value)))
    except ValueError:
        return F.col(str(value))


def py_date(value) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value))


def month_start(d) -> Column:
    """date_trunc('month', d) as a DATE (Spark's date_trunc gives a timestamp)."""
    return F.trunc(as_date(d), "MM")


def month_end(d) -> Column:
    """Month start + 1 month - 1 day."""
    return F.last_day(as_date(d))


def prev_month_end(d) -> Column:
    """Month start - 1 day: the balance date a monthly report opens with."""
    return F.date_sub(month_start(d), 1)


def valid_at(d, lo: str | Column, hi: str | Column) -> Column:
    """``d BETWEEN lo AND hi`` -- a closed validity interval."""
    lo = F.col(lo) if isinstance(lo, str) else lo
    hi = F.col(hi) if isinstance(hi, str) else hi
    return as_date(d).between(lo, hi)


def overlaps(lo: str | Column, hi: str | Column, start, end) -> Column:
    """Interval [lo, hi] intersects [start, end]; used to prune versions early."""
    lo = F.col(lo) if isinstance(lo, str) else lo
    hi = F.col(hi) if isinstance(hi, str) else hi
    return (lo <= as_date(end)) & (hi >= as_date(start))


def iso(d) -> Column:
    """to_char(d, 'yyyy-mm-dd')."""
    return F.date_format(as_date(d), "yyyy-MM-dd")


def parse_dotted(s: str | Column) -> Column:
    """dd.MM.yyyy text -> date; NULL when it does not parse."""
    s = F.col(s) if isinstance(s, str) else s
    return F.try_to_date(s, "dd.MM.yyyy")


def parse_iso(s: str | Column) -> Column:
    """yyyy-MM-dd text -> date, months and days also with one digit; NULL for text such as 2018-13-01."""
    s = F.col(s) if isinstance(s, str) else s
    return F.try_to_date(s, "yyyy-M-d")


def rejected(df, text: str):
    """The rows whose text is there but is no yyyy-MM-dd date: the reject set of a load."""
    return df.filter(F.col(text).isNotNull() & parse_iso(text).isNull())


def days_between(start, end) -> Column:
    """All days of [start, end] as an array; explode it for a day spine."""
    return F.sequence(as_date(start), as_date(end), F.expr("INTERVAL 1 DAY"))


def month_days(d) -> list[_dt.date]:
    """Driver-side list of the days of d's month (a parameter, never data)."""
    d = py_date(d)
    first = d.replace(day=1)
    nxt = (first.replace(day=28) + _dt.timedelta(days=4)).replace(day=1)
    return [first + _dt.timedelta(days=i) for i in range((nxt - first).days)]


def month_bounds(d) -> tuple[_dt.date, _dt.date]:
    days = month_days(d)
    return days[0], days[-1]
