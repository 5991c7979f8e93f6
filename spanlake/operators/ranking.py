"""Top groups and their presentation, shared by the raw scan and the rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlake.functions.attributes import carried_name
from spanlake.plans.queries import SpanAggregation, SpanSort

# a side is broadcast only when it is known to have no more rows than this
BROADCAST_ROWS = 10_000

MS = 1_000_000

_ORDER = {
    SpanSort.TOTAL: lambda: F.col("total"),
    SpanSort.AVG: lambda: F.col("total") / F.col("calls"),
    SpanSort.P95: lambda: F.col("quantile"),
    SpanSort.MAX: lambda: F.col("longest"),
    SpanSort.CALLS: lambda: F.col("calls"),
}


def ranked(stats: DataFrame, aggregation: SpanAggregation) -> DataFrame:
    """The top ``limit`` groups of ``key, calls, total, quantile, longest`` by the wanted statistic, ties by key."""
    return stats.orderBy(F.desc(_ORDER[aggregation.sort]()), "key").limit(max(1, aggregation.limit))


def in_order(top: DataFrame, aggregation: SpanAggregation) -> DataFrame:
    """The already chosen top groups, at most ``limit`` rows, back in ranking order after further work on them."""
    return top.repartition(1).orderBy(F.desc(_ORDER[aggregation.sort]()), "key")


def statistics(stats: DataFrame, aggregation: SpanAggregation) -> DataFrame:
    """Nanoseconds to milliseconds, and the carried values as one map without the empty ones."""
    carried = [
        entry
        for i, field in enumerate(aggregation.carry)
        for entry in (F.lit(carried_name(field)), F.col(f"carry_{i}"))
    ]
    carried_map = F.map_filter(F.create_map(*carried), lambda _, v: v.isNotNull()) if carried else F.create_map()
    return stats.select(
        "key",
        F.col("calls").alias("count"),
        (F.col("total") / F.col("calls") / MS).alias("avg_ms"),
        (F.col("quantile") / MS).alias("p95_ms"),
        (F.col("longest") / MS).alias("max_ms"),
        (F.col("total") / MS).alias("total_ms"),
        carried_map.cast("map<string,string>").alias("attributes"),
    )
