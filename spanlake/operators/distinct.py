"""Distinct label values, shared by logs, spans and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from spanlake.functions.times import Instant, time_range

# How many label values are listed unless the caller says otherwise.
MAX_VALUES = 1000


def distinct_values(
    df: DataFrame, value: Column, start: Instant | None, end: Instant | None, limit: int | None = MAX_VALUES
) -> DataFrame:
    """Column ``value``, at most ``limit`` rows (None: all); the time range applies only when both bounds are given."""
    if start is not None and end is not None:
        df = df.where(time_range(df, start, end))
    values = df.select(value.alias("value")).where("value != ''").distinct().orderBy("value")
    return values if limit is None else values.limit(limit)
