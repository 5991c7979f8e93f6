"""Epoch nanoseconds, time ranges and day partitions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NANOS = 1_000_000_000

Instant = int | float | dt.datetime


def epoch_seconds(moment: Instant) -> int:
    """Whole seconds since the epoch; a datetime without zone is UTC."""
    if isinstance(moment, dt.datetime):
        if moment.tzinfo is None:
            moment = moment.replace(tzinfo=dt.timezone.utc)
        return int(moment.timestamp() // 1)
    return int(moment // 1)


def utc_day(seconds: int) -> dt.date:
    return (dt.datetime(1970, 1, 1) + dt.timedelta(seconds=seconds)).date()


def time_range(df: DataFrame, start: Instant, end: Instant) -> Column:
    """Both bounds inclusive, cut to whole seconds.

    The nanosecond column is compared with plain integers, which Parquet min/max statistics can use; ``day`` adds
    partition pruning, which Spark cannot derive by itself.
    """
    first, last = epoch_seconds(start), epoch_seconds(end)
    condition = F.col("TimestampNano").between(first * NANOS, last * NANOS)
    if "day" in df.columns:
        condition &= day_range(first, last)
    return condition


def day_range(first: int, last: int) -> Column:
    return F.col("day").between(F.lit(utc_day(first)), F.lit(utc_day(last)))


def whole(nanos: Column, unit: int) -> Column:
    """Integer division; dividing nanoseconds as doubles would lose the last digits."""
    return F.call_function("div", nanos, F.lit(unit))


def timestamp_of(nanos: Column) -> Column:
    """The instant as TIMESTAMP, cut to microseconds."""
    return F.timestamp_micros(whole(nanos, 1000))


def seconds_of(nanos: Column) -> Column:
    return whole(nanos, NANOS)
