"""Instant and range metric queries over the sum, gauge and histogram tables.

Known and kept properties of the semantics: an increase is the largest minus the smallest value of a whole label group
(no counter resets, series in one group are not told apart); an instant rate without window looks back an hour and
divides by 60; the instant delta of a histogram count or sum is never divided, the range one is divided by the step;
histogram buckets are summed over the time span, not subtracted. Queries can ask for increases series by series, for labels
that match keys with underscores, and for a table.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanlake.functions import attributes, literals, predicates, quantiles
from spanlake.functions.times import NANOS, Instant, epoch_seconds, time_range, whole
from spanlake.operators.distinct import MAX_VALUES, distinct_values
from spanlake.plans.queries import MetricFn, MetricQuery, UnsupportedQuery, reject_raw
from spanlake.plans.routing import metric_table, part_of, stored_name

# Seconds looked back without a window, seconds a rate without a window is divided by, the smallest
# automatic step and the number of points it aims at.
LOOKBACK = 3600
RATE_WINDOW = 60
MIN_STEP = 15
MAX_POINTS = 250

_HISTOGRAM_COLUMNS = {"count": "Count", "sum": "Sum"}


@dataclass(frozen=True)
class MetricTables:
    """The three point tables; a query reads one of them, so the others may be left out."""

    sum: DataFrame | None = None
    gauge: DataFrame | None = None
    histogram: DataFrame | None = None


def instant(tables: MetricTables, query: MetricQuery, at: Instant) -> DataFrame:
    """One row per label group: the ``by`` labels, ``timestamp`` and ``value``. Without labels, exactly one row."""
    reject_raw(query.raw, "PromQL")
    start, end = instant_range(query, at)
    points = _points(tables, query, start, end)
    values = _values(points, query, _label_columns(query), _instant_value)
    return values.select(*_named_labels(query), F.lit(float(end)).alias("timestamp"), "value")


def instant_range(query: MetricQuery, at: Instant) -> tuple[int, int]:
    """The points an instant query looks at: its window, or the default lookback, up to ``at``."""
    end = epoch_seconds(at)
    return end - max(1, literals.window_seconds(query.window, LOOKBACK)), end


def range_query(
    tables: MetricTables, query: MetricQuery, start: Instant, end: Instant, step: int | None = None
) -> DataFrame:
    """Long form: the ``by`` labels, ``t`` (start of the time bucket, epoch seconds) and ``value``."""
    reject_raw(query.raw, "PromQL")
    first, last = epoch_seconds(start), epoch_seconds(end)
    step = auto_step(first, last) if step is None else step
    if step < 1:
        raise UnsupportedQuery("a step has at least one second")
    points = _points(tables, query, first, last).withColumn("t", _time_bucket(step))
    values = _values(points, query, [*_label_columns(query), "t"], partial(_range_value, step=step))
    return values.select(*_named_labels(query), "t", "value")


def _values(
    points: DataFrame, query: MetricQuery, keys: list[str], aggregate: Callable[[MetricQuery], Column]
) -> DataFrame:
    if query.per_series and (query.quantile is not None or query.fn is MetricFn.NONE and part_of(query) is None):
        raise UnsupportedQuery("only increases and rates can be taken series by series")
    if query.quantile is not None:
        return quantiles.histogram_quantile(sum_buckets(points, keys), keys, query.quantile)
    if query.per_series:
        of_series = points.groupBy(*keys, "service", "attributes", "resource").agg(aggregate(query).alias("part"))
        value = F.coalesce(F.sum("part").cast("double"), F.lit(0.0))
        return of_series.groupBy(*keys).agg(_scaled(query, value).alias("value"))
    value = F.coalesce(aggregate(query).cast("double"), F.lit(0.0))
    return points.groupBy(*keys).agg(_scaled(query, value).alias("value"))


def _label_columns(query: MetricQuery) -> list[str]:
    """Working names of the labels; the labels themselves may hold dots or be called ``value``."""
    return [f"by_{i}" for i in range(len(query.by))]


def _named_labels(query: MetricQuery) -> list[Column]:
    return [F.col(column).alias(label) for column, label in zip(_label_columns(query), query.by)]


def auto_step(start: int, end: int) -> int:
    return max(MIN_STEP, math.ceil((end - start) / MAX_POINTS))


def to_series(points: DataFrame, by: list[str]) -> DataFrame:
    """One row per label set with its points in time order; a series has at most one point per step."""
    ordered = F.sort_array(F.collect_list(F.struct("t", "value")))
    return points.groupBy(*(F.col(f"`{label}`") for label in by)).agg(ordered.alias("points"))


def sum_buckets(points: DataFrame, keys: list[str]) -> DataFrame:
    """Element-wise sum of the bucket arrays per group: rows ``keys, pos, n, bounds``; shorter arrays count as zero.

    A group without any bucket keeps one row with a NULL position. Groups mixing several bounds use the smallest.
    """
    exploded = points.select(*keys, F.col("ExplicitBounds").alias("bounds"), F.posexplode_outer("BucketCounts"))
    # bounds are part of the grouping first: MIN over arrays would force a sort of all points
    partial = exploded.groupBy(*keys, "bounds", "pos").agg(F.sum("col").alias("n"))
    shared = F.min("bounds").over(Window.partitionBy(*keys))
    return (
        partial.withColumn("bounds", shared)
        .groupBy(*keys, "pos")
        .agg(F.sum("n").alias("n"), F.first("bounds").alias("bounds"))
    )


def metric_label_values(
    sums: DataFrame,
    label: str,
    start: Instant | None = None,
    end: Instant | None = None,
    limit: int | None = MAX_VALUES,
) -> DataFrame:
    """Distinct non-empty label values, ascending, at most ``limit`` (None: all); read from the sum table only."""
    return distinct_values(sums, attributes.metric_label(sums, label), start, end, limit)


def _points(tables: MetricTables, query: MetricQuery, start: int, end: int) -> DataFrame:
    table = getattr(tables, metric_table(query))
    if query.table and query.quantile is not None:
        raise UnsupportedQuery("quantiles are read from histograms")
    if query.normalized:
        table = attributes.normalized(table, "Attributes", "ResourceAttributes")
    if part_of(query) == "bucket" and query.quantile is None:
        raise UnsupportedQuery("a _bucket series can only be asked for a quantile")
    matchers = [*query.matchers, *map(literals.matcher_fragment, query.raw_matchers)]
    conditions = [
        F.col("MetricName") == stored_name(query),
        time_range(table, start, end),
        *(predicates.metric_matcher(table, m) for m in matchers),
    ]
    points = table.where(predicates.all_of(conditions))
    labels = zip(_label_columns(query), query.by)
    measured = [c for c in ("Value", "Count", "Sum", "BucketCounts", "ExplicitBounds") if c in points.columns]
    keys = [attributes.metric_label(points, label).alias(column) for column, label in labels]
    series = _series() if query.per_series else []
    return points.select(*keys, *series, "TimestampNano", *measured)


def _series() -> list[Column]:
    """What tells series apart, in a form that can be grouped by."""
    maps = {"attributes": "Attributes", "resource": "ResourceAttributes"}
    entries = [F.array_sort(F.map_entries(column)).alias(name) for name, column in maps.items()]
    return [F.col("ServiceName").alias("service"), *entries]


def _instant_value(query: MetricQuery) -> Column:
    part = part_of(query)
    if part is not None:
        return _delta(_HISTOGRAM_COLUMNS[part])
    if query.fn is MetricFn.NONE:
        return F.max_by("Value", "TimestampNano")
    if query.fn is MetricFn.RATE:
        return _delta("Value") / max(1, literals.window_seconds(query.window, RATE_WINDOW))
    return _delta("Value")


def _range_value(query: MetricQuery, step: int) -> Column:
    column = _HISTOGRAM_COLUMNS.get(part_of(query), "Value")
    if query.fn is MetricFn.NONE and not query.per_series:
        return F.avg(F.col(column).cast("double"))
    if query.fn is MetricFn.RATE:
        return _delta(column) / step
    return _delta(column)


def _delta(column: str) -> Column:
    return (F.max(column) - F.min(column)).cast("double")


def _scaled(query: MetricQuery, value: Column) -> Column:
    return value if query.scalar is None else value * F.lit(float(query.scalar))


def _time_bucket(step: int) -> Column:
    return whole(F.col("TimestampNano"), step * NANOS) * step
