"""Calendar helpers. Nothing here reads the clock: callers pass ``as_of``."""

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAINS = ("day", "week", "month", "year")


def as_ntz(moment) -> Column:
    """Zone-less timestamp literal from text, a date or a datetime."""
    if isinstance(moment, (dt.date, dt.datetime)):
        moment = moment.isoformat(sep=" ") if isinstance(moment, dt.datetime) else moment.isoformat()
    return F.lit(moment).cast("timestamp_ntz")


def period_start(column, grain: str = "month") -> Column:
    """First day of the period a timestamp or date falls in (weeks start on Monday)."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")
    day = F.col(column) if isinstance(column, str) else column
    day = day.cast("date")
    return day if grain == "day" else F.trunc(day, grain)


def month_number(start: Column, end: Column) -> Column:
    """Month boundaries between two dates, as bigint."""
    months = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    return months.cast("bigint")
