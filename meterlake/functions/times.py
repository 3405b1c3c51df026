"""Durations and keys on zone-less timestamps.

``unix_timestamp`` and ``date_trunc`` go through the session zone, so a daylight-saving
zone would shift results. Subtracting two zone-less timestamps does not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``, fractions cut toward zero."""
    return (end - start).cast("interval second").cast("bigint")


def minute_floor(ts: Column) -> Column:
    """Minutes since 1970, counted on the wall clock."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.floor(elapsed_seconds(epoch, ts) / F.lit(60))


def fractional_minutes(start: Column, end: Column) -> Column:
    """Elapsed minutes with a fraction, as decimal(27,6)."""
    return (elapsed_seconds(start, end) / F.lit("60.0").cast("decimal(3,1)")).cast("decimal(27,6)")


def minute_boundaries(start: Column, end: Column) -> Column:
    """How many clock minutes were crossed."""
    return minute_floor(end) - minute_floor(start)


def whole_minutes(start: Column, end: Column) -> Column:
    """Complete minutes elapsed, cut toward zero."""
    seconds = elapsed_seconds(start, end)
    return F.call_function("div", seconds, F.lit(60))


def date_key(ts: Column) -> Column:
    """The day as a yyyyMMdd number, without formatting text per row."""
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def at(text: str) -> Column:
    """A zone-less timestamp literal."""
    return F.lit(text).cast("timestamp_ntz")


def days_before(ts: Column, days: int) -> Column:
    return ts - F.make_dt_interval(F.lit(days), F.lit(0), F.lit(0), F.lit(0))


def hours_before(ts: Column, hours: int) -> Column:
    return ts - F.make_dt_interval(F.lit(0), F.lit(hours), F.lit(0), F.lit(0))


def text_timestamp(c: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text to a zone-less timestamp, NULL when it does not parse."""
    return F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz")
