"""Time keys derived from the pickup time (session time zone pinned to UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridepulse.schema import DATE_FORMAT, MONTH_FORMAT, WEEKDAY_NAMES


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def hour_of_day(ts: str | Column = "pickup_datetime") -> Column:
    """0..23."""
    return F.hour(_c(ts))


def day_of_week(ts: str | Column = "pickup_datetime") -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_c(ts))


def month_key(ts: str | Column = "pickup_datetime") -> Column:
    """``yyyy-MM`` text; group on ``month_start`` and format the aggregated rows."""
    return F.date_format(_c(ts), MONTH_FORMAT)


def in_months(ts: str | Column, first: str, last: str) -> Column:
    """Time within an inclusive range of ``yyyy-MM`` months, as bounds on the time
    itself, which reach the scan as pushed filters."""
    start = F.to_timestamp(F.lit(f"{first}-01"))
    end = F.to_timestamp(F.add_months(F.lit(f"{last}-01").cast("date"), 1))
    return (_c(ts) >= start) & (_c(ts) < end)


def date_key(ts: str | Column = "pickup_datetime") -> Column:
    """``yyyy-MM-dd`` text; group on ``calendar_date`` and format the aggregated rows."""
    return F.date_format(_c(ts), DATE_FORMAT)


def duration_seconds(
    start: str | Column = "pickup_datetime", end: str | Column = "dropoff_datetime"
) -> Column:
    """Whole seconds between two times (fractions of a second dropped)."""
    return F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))


def duration_minutes(
    start: str | Column = "pickup_datetime", end: str | Column = "dropoff_datetime"
) -> Column:
    """Whole seconds between two times, in minutes (DOUBLE)."""
    return duration_seconds(start, end) / 60


def weekday_name(dow: str | Column = "day_of_week") -> Column:
    """Name of a ``dayofweek`` number (1 = Sunday); used on aggregated rows."""
    pairs = []
    for i, name in enumerate(WEEKDAY_NAMES, start=1):
        pairs += [F.lit(i), F.lit(name)]
    return F.create_map(*pairs)[_c(dow)]


def month_start(ts: str | Column = "pickup_datetime") -> Column:
    """First instant of the month: a cheap per-row grouping key."""
    return F.date_trunc("month", _c(ts))


def calendar_date(ts: str | Column = "pickup_datetime") -> Column:
    """Calendar date (session time zone): a cheap per-row grouping key."""
    return F.to_date(_c(ts))
