"""Span aggregation: duration statistics per attribute value, ranked.

How the exact path stays bounded. Spans are counted per key, which Spark combines before the shuffle, so a key holding a
third of all spans arrives as one row per task. Only the ranked keys are looked at further, in two more scans that join
them by a broadcast: the first counts their spans per value bracket (at most about a thousand rows per key), the second
reads the one bracket each quantile lies in. A ranking by the quantile itself starts with the brackets of all keys instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlake.functions import attributes, quantiles
from spanlake.functions.times import Instant
from spanlake.operators import rollup
from spanlake.operators.ranking import BROADCAST_ROWS, in_order, ranked, statistics
from spanlake.operators.traces import match_spans
from spanlake.plans.queries import SpanAggregation, SpanSort, UnsupportedQuery
from spanlake.plans.routing import rollup_answers

# a sum of nanoseconds can outgrow BIGINT: the parts above and below this bit are summed apart
SPLIT = 20


def aggregate_spans(
    traces: DataFrame,
    aggregation: SpanAggregation,
    start: Instant,
    end: Instant,
    summary: DataFrame | None = None,
    exact: bool = True,
) -> DataFrame:
    """``key, count, avg_ms, p95_ms, max_ms, total_ms, attributes`` of the top groups.

    With a ``summary`` table the plain statement ranking is answered from it. ``exact=False`` estimates the quantile with
    a mergeable sketch in a single scan; everything else stays exact.
    """
    if summary is not None and rollup_answers(aggregation):
        return rollup.rollup_query(summary, aggregation, start, end)
    if aggregation.group_by == "duration":
        raise UnsupportedQuery("spans cannot be grouped by their duration")

    spans = _keyed_spans(traces, aggregation, start, end)
    return _exact(spans, aggregation) if exact else _sketched(spans, aggregation)


def _keyed_spans(traces: DataFrame, aggregation: SpanAggregation, start: Instant, end: Instant) -> DataFrame:
    matched = match_spans(traces, aggregation.where, start, end)
    present = attributes.span_field(matched, aggregation.group_by, nullable=True) != ""
    carried = [attributes.span_field(matched, f).alias(c) for c, f in zip(_carry(aggregation), aggregation.carry)]
    key = attributes.span_field(matched, aggregation.group_by)
    return matched.where(present).select(key.alias("key"), F.col("Duration").alias("d"), *carried)


def _carry(aggregation: SpanAggregation) -> list[str]:
    return [f"carry_{i}" for i in range(len(aggregation.carry))]


def _any_text(name: str) -> Column:
    """A representative non-empty value; the smallest one, so that results repeat."""
    return F.min(F.nullif(F.col(name), F.lit(""))).alias(name)


def _sketched(spans: DataFrame, aggregation: SpanAggregation) -> DataFrame:
    stats = spans.groupBy("key").agg(
        F.count("*").alias("calls"),
        *_split_sum(),
        F.max("d").alias("longest"),
        F.kll_sketch_agg_bigint("d", F.lit(rollup.SKETCH_K)).alias("sketch"),
        *map(_any_text, _carry(aggregation)),
    )
    quantile = F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(aggregation.quantile)))
    stats = stats.withColumn("total", _total())
    if aggregation.sort is not SpanSort.P95:
        # read the sketches of the ranked groups only
        stats = ranked(stats, aggregation)
    return statistics(ranked(stats.withColumn("quantile", quantile), aggregation), aggregation)


def _split_sum() -> list[Column]:
    return [
        F.sum(F.shiftright("d", SPLIT)).alias("high_sum"),
        F.sum(F.col("d").bitwiseAND((1 << SPLIT) - 1)).alias("low_sum"),
    ]


def _total() -> Column:
    return F.col("high_sum") * F.lit(float(1 << SPLIT)) + F.col("low_sum")


def _exact(spans: DataFrame, aggregation: SpanAggregation) -> DataFrame:
    carry = _carry(aggregation)
    kept = ["calls", "total", "longest", *carry]
    if aggregation.sort is SpanSort.P95:
        # how many keys may still win is not known: Spark chooses the join when it has counted them
        targets, few = _quantile_candidates(_all_located(spans, aggregation), aggregation), False
        final = ranked
    else:
        few = max(1, aggregation.limit) <= BROADCAST_ROWS
        top = ranked(_totals(spans, carry), aggregation)
        targets = _located(spans.select("key", "d"), F.broadcast(top) if few else top, aggregation, kept)
        final = in_order
    values = spans.select("key", "d")
    refined = quantiles.refine(values, "d", F.broadcast(targets) if few else targets, "key", kept)
    return statistics(final(refined, aggregation), aggregation)


def _totals(spans: DataFrame, carry: list[str]) -> DataFrame:
    """``key, calls, total, longest`` and the carried values, per key.

    Carried values are part of the grouping first: MIN over text would force a sort of all spans.
    """
    stats = spans.groupBy("key", *carry).agg(
        F.count("*").alias("calls"), *_split_sum(), F.max("d").alias("longest")
    )
    if carry:
        stats = stats.groupBy("key").agg(
            *(F.sum(c).alias(c) for c in ("calls", "high_sum", "low_sum")),
            F.max("longest").alias("longest"),
            *map(_any_text, carry),
        )
    return stats.withColumn("total", _total()).drop("high_sum", "low_sum")


def _located(spans: DataFrame, top: DataFrame, aggregation: SpanAggregation, kept: list[str]) -> DataFrame:
    """The ranked keys with the bracket their quantile lies in."""
    grouping = ["key", *kept, quantiles.coarse_bracket(F.col("d")).alias("bracket")]
    brackets = quantiles.rows_of(spans, top, "key").groupBy(*grouping).agg(*_bracket())
    return quantiles.locate_first(brackets, ["key"], aggregation.quantile, [F.max(c).alias(c) for c in kept])


def _all_located(spans: DataFrame, aggregation: SpanAggregation) -> DataFrame:
    """As ``_located`` over ``_totals``, for all keys in one scan."""
    carry = _carry(aggregation)
    sums = ["high_sum", "low_sum"]
    brackets = spans.groupBy("key", *carry, quantiles.coarse_bracket(F.col("d")).alias("bracket")).agg(
        *_bracket(), *_split_sum()
    )
    if carry:
        brackets = brackets.groupBy("key", "bracket").agg(
            *(F.sum(c).alias(c) for c in ("n", *sums)),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            *map(_any_text, carry),
        )
    whole = [F.sum("n").alias("calls"), *(F.sum(c).alias(c) for c in sums), F.max("high").alias("longest")]
    located = quantiles.locate_first(brackets, ["key"], aggregation.quantile, [*whole, *map(_any_text, carry)])
    return located.withColumn("total", _total()).drop(*sums)


def _bracket() -> list[Column]:
    return [F.count("*").alias("n"), F.min("d").alias("low"), F.max("d").alias("high")]


def _quantile_candidates(stats: DataFrame, aggregation: SpanAggregation) -> DataFrame:
    """Groups that can still be among the top ones, given the bracket their quantile lies in.

    The quantile is at least ``low``, so a group whose upper end lies below the ``limit``-th largest ``low`` is out. That threshold is
    a scalar subquery of the same plan, which reads the groups' shuffle again instead of the spans.
    """
    threshold = stats.orderBy(F.desc("low")).limit(max(1, aggregation.limit)).agg(F.min("low").alias("low"))
    upper = F.greatest("high", F.coalesce("after", "high"))
    return stats.where(upper >= threshold.scalar())
