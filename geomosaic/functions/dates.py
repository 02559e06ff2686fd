"""Dates, time windows and epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OVERVIEW_MARGIN_HOURS = 8
RANGE_WEEKS = 52
EXTENT_WEEKS = 3
BUFFER_DAYS = 1


def whole_second(when: Column) -> Column:
    return F.date_trunc("second", when).cast("timestamp_ntz")


def epoch_ms(when: Column) -> Column:
    """Milliseconds since 1970 of a zone-free time read as UTC."""
    return F.unix_millis(when.cast("timestamp"))


def overview_start(first: Column) -> Column:
    return whole_second(first) - F.expr(f"interval {OVERVIEW_MARGIN_HOURS} hours")


def overview_end(last: Column) -> Column:
    return whole_second(last) + F.expr(f"interval {OVERVIEW_MARGIN_HOURS} hours")


def range_end(as_of: Column) -> Column:
    return as_of + F.expr(f"interval {BUFFER_DAYS} day")


def range_start(as_of: Column) -> Column:
    return range_end(as_of) - F.expr(f"interval {RANGE_WEEKS * 7} days")


def extent_start(as_of: Column) -> Column:
    return range_end(as_of) - F.expr(f"interval {EXTENT_WEEKS * 7} days")


def overlaps(start: Column, end: Column, low: Column, high: Column) -> Column:
    """Closed intervals ``[start, end]`` and ``[low, high]`` share a moment."""
    return (start <= high) & (end >= low)
