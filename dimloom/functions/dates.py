"""Date rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
FIRST_WATERMARK = dt.date(1900, 1, 1)
OPEN_END = dt.date(9999, 12, 31)


def as_date(value: dt.date | dt.datetime | str) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value)[:10])


def as_moment(value: dt.date | dt.datetime | str) -> dt.datetime:
    """The value with its time of day; midnight for a date."""
    if isinstance(value, str):
        return dt.datetime.fromisoformat(value)
    return value if isinstance(value, dt.datetime) else dt.datetime.combine(value, dt.time())


def as_bound(value: dt.date | dt.datetime | str) -> dt.date | dt.datetime:
    """A date where there is no time of day, so that a date column is compared with a date."""
    moment = as_moment(value)
    return moment.date() if moment.time() == dt.time() else moment


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def period_key(day: Column) -> Column:
    """Six-digit year and month.  Integer arithmetic stays in generated code; a formatter does not."""
    return F.lpad((F.year(day) * 100 + F.month(day)).cast("string"), 6, "0")


def within_day(moment: Column, day: dt.date | str) -> Column:
    """Half-open day range, so the filter reaches the file scan for dates and timestamps."""
    start = as_date(day)
    return (moment >= F.lit(start)) & (moment < F.lit(start + dt.timedelta(days=1)))


def elapsed_seconds(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)
