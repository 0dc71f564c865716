"""Date and time columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(ts: Column) -> Column:
    """yyyymmdd as an int."""
    return F.date_format(ts, "yyyyMMdd").cast("int")


def seconds_between(start: Column, end: Column) -> Column:
    """Fractional seconds from start to end at millisecond precision, null if either is."""
    return (F.unix_millis(end) - F.unix_millis(start)) / 1000.0


def whole_seconds(start: Column, end: Column) -> Column:
    """Difference of the two times cut to the second, never below zero."""
    return F.greatest(F.lit(0), F.unix_seconds(end) - F.unix_seconds(start)).cast("bigint")


def as_timestamp(value) -> Column:
    """Literal timestamp from text or datetime; columns pass through."""
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("timestamp")
