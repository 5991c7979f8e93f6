"""The newest rows of a match, reading wide columns only where those rows are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlake.functions.times import timestamp_of


def newest(matched: DataFrame, n: int, columns: list[str], ties: list[str]) -> DataFrame:
    """The ``n`` newest rows, newest first, equal times ordered by ``ties``.

    A first pass over the filter columns finds the time of the ``n``-th newest match. As a scalar subquery that time
    becomes a scan filter of the second pass: it prunes day partitions and row groups at run time, so bodies and attribute
    maps are read from the end of the range only, however long the range is.
    """
    oldest = matched.select("TimestampNano").orderBy(F.desc("TimestampNano")).limit(n).agg(F.min("TimestampNano")).scalar()
    tail = matched.where(F.col("TimestampNano") >= oldest)
    if "day" in matched.columns:
        tail = tail.where(F.col("day") >= F.to_date(timestamp_of(oldest)))
    return tail.select(*columns).orderBy(F.desc("TimestampNano"), *ties).limit(n)
