"""Date and time column expressions on zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_zone(ts: Column, source: Column | str, target: Column | str) -> Column:
    """Wall-clock time in another zone; the session zone plays no part."""
    source = F.lit(source) if isinstance(source, str) else source
    target = F.lit(target) if isinstance(target, str) else target
    return F.convert_timezone(source, target, ts)


def epoch(ts: Column) -> Column:
    """Seconds since 1970 of a zone-less time read as UTC."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts)


def season(ts: Column, first_month: int = 10) -> Column:
    """Year a season ends in, when seasons start in ``first_month``."""
    return F.year(ts) + (F.month(ts) >= first_month).cast("int")


def month_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "month")


def year_ending(ts: Column, last_month: int) -> Column:
    """Last day of the 12-month period, ending with ``last_month``, that holds the time."""
    year = F.year(ts) + (F.month(ts) > last_month).cast("int")
    return F.last_day(F.make_date(year, F.lit(last_month), F.lit(1)))


def month_block(ts: Column, first: Column, size: int) -> Column:
    """Start of the block of ``size`` months, counted from the month of ``first``."""
    start = month_start(first)
    passed = (F.year(ts) - F.year(start)) * 12 + F.month(ts) - F.month(start)
    return F.add_months(start, (F.floor(passed / size) * size).cast("int"))
