"""Trace search, trace assembly and tag values over the ``otel_traces`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlake.functions import attributes, predicates
from spanlake.functions.times import Instant, seconds_of, time_range
from spanlake.operators.distinct import MAX_VALUES, distinct_values
from spanlake.operators.newest import newest
from spanlake.plans.queries import TraceQuery, reject_raw

# Spans fetched per wanted trace, spans shown per trace, span kinds known by name.
SPANS_PER_TRACE = 50
MAX_TRACE_SPANS = 5000
SPAN_KINDS = ("internal", "server", "client", "producer", "consumer")

MS = 1_000_000

SPAN_COLUMNS = [
    "TraceId",
    "SpanId",
    "ParentSpanId",
    "SpanName",
    "ServiceName",
    "TimestampNano",
    "Duration",
    "SpanAttributes",
]


def match_spans(traces: DataFrame, query: TraceQuery, start: Instant, end: Instant) -> DataFrame:
    """Every span in the time range that passes all conditions."""
    reject_raw(query.raw, "TraceQL")
    conditions = [
        time_range(traces, start, end),
        *(predicates.span_condition(traces, c) for c in query.conditions),
    ]
    return traces.where(predicates.all_of(conditions))


def search_traces(
    traces: DataFrame,
    query: TraceQuery,
    start: Instant,
    end: Instant,
    limit: int = 20,
    spans_per_trace: int | None = SPANS_PER_TRACE,
) -> DataFrame:
    """One summary row per matched trace, the trace with the newest matched span first.

    The newest ``spans_per_trace * limit`` matched spans are fetched (a top-N, so only that many rows leave the scan) and
    folded into traces; the first ``limit`` traces are returned. With ``spans_per_trace=None`` the ``limit`` traces are
    picked first, and all their matched spans are folded, however many they are.
    """
    matched = match_spans(traces, query, start, end)
    if spans_per_trace is None:
        last = matched.groupBy("TraceId").agg(F.max("TimestampNano").alias("last"))
        picked = last.orderBy(F.desc("last"), "TraceId").limit(max(0, limit)).select("TraceId")
        candidates = matched.join(picked, "TraceId", "left_semi").select(*SPAN_COLUMNS)
    else:
        candidates = newest(matched, max(1, limit * spans_per_trace), SPAN_COLUMNS, ["TraceId", "SpanId"])
    return fold_traces(candidates).orderBy(F.desc("last_nano"), "trace_id").limit(max(0, limit)).drop("last_nano")


def fold_traces(spans: DataFrame) -> DataFrame:
    """Summaries of the traces among ``spans``: the root's service, name, start and duration, and the spans in order.

    The root is the earliest span without a parent, or else the earliest one. A trace's spans are gathered into one row, so
    this is meant for the bounded candidates of ``search_traces``.
    """
    span = F.struct(
        F.col("SpanId").alias("span_id"),
        F.col("SpanName").alias("name"),
        F.col("TimestampNano").alias("start_nano"),
        (F.col("Duration") / MS).alias("duration_ms"),
        F.col("SpanAttributes").alias("attributes"),
    )
    details = F.struct("ServiceName", "SpanName", "TimestampNano", "Duration")
    rootness = F.struct(F.col("ParentSpanId") != "", "TimestampNano", "SpanId")
    folded = (
        spans.where("TraceId != ''")
        .groupBy(F.col("TraceId").alias("trace_id"))
        .agg(
            F.min_by(details, rootness).alias("root"),
            F.array_sort(F.collect_list(span), _by_start).alias("matched_spans"),
            F.max("TimestampNano").alias("last_nano"),
        )
    )
    return folded.select(
        "trace_id",
        F.col("root.ServiceName").alias("root_service_name"),
        F.col("root.SpanName").alias("root_trace_name"),
        F.timestamp_seconds(seconds_of(F.col("root.TimestampNano"))).alias("started_at"),
        (F.col("root.Duration") / MS).alias("duration_ms"),
        "matched_spans",
        "last_nano",
    )


def _by_start(left: Column, right: Column) -> Column:
    return (
        F.when(left["start_nano"] < right["start_nano"], -1)
        .when(left["start_nano"] > right["start_nano"], 1)
        .when(left["span_id"] < right["span_id"], -1)
        .when(left["span_id"] > right["span_id"], 1)
        .otherwise(0)
    )


def trace_spans(
    traces: DataFrame,
    trace_id: str,
    start: Instant | None = None,
    end: Instant | None = None,
    max_spans: int | None = MAX_TRACE_SPANS,
) -> DataFrame:
    """The stored rows of one trace in start order, at most ``max_spans`` (None: all).

    With both bounds only spans in that range are looked for, in the days it covers.
    """
    spans = traces.where(F.col("TraceId") == trace_id)
    if start is not None and end is not None:
        spans = spans.where(time_range(traces, start, end))
    spans = spans.orderBy("TimestampNano", "SpanId")
    return spans if max_spans is None else spans.limit(max_spans)


def get_trace(
    traces: DataFrame,
    trace_id: str,
    start: Instant | None = None,
    end: Instant | None = None,
    max_spans: int | None = MAX_TRACE_SPANS,
) -> DataFrame:
    """The waterfall of one trace."""
    return trace_spans(traces, trace_id, start, end, max_spans).select(*waterfall_columns())


def waterfall_columns() -> list[Column]:
    kind = F.lower("SpanKind")
    return [
        F.col("SpanId").alias("span_id"),
        F.nullif(F.col("ParentSpanId"), F.lit("")).alias("parent_span_id"),
        F.col("SpanName").alias("name"),
        F.col("ServiceName").alias("service_name"),
        F.when(kind.isin(*SPAN_KINDS), kind).otherwise("unspecified").alias("kind"),
        F.col("TimestampNano").alias("start_nano"),
        (F.col("TimestampNano") + F.col("Duration")).alias("end_nano"),
        F.col("SpanAttributes").alias("attributes"),
        (F.col("StatusCode") == "Error").alias("has_error"),
        span_links().alias("links"),
    ]


def span_links() -> Column:
    """Links as (trace_id, span_id) pairs; those without a trace are dropped."""
    return F.transform(
        F.filter("Links", lambda link: link["TraceId"] != ""),
        lambda link: F.struct(link["TraceId"].alias("trace_id"), link["SpanId"].alias("span_id")),
    )


def trace_services(
    traces: DataFrame, trace_id: str, start: Instant | None = None, end: Instant | None = None
) -> DataFrame:
    """Per service of one trace, the resource attributes of its first span. All spans count, however many they are."""
    return first_resources(trace_spans(traces, trace_id, start, end, None))


def first_resources(spans: DataFrame) -> DataFrame:
    return (
        spans.where("ServiceName != ''")
        .groupBy(F.col("ServiceName").alias("service_name"))
        .agg(F.min_by("ResourceAttributes", F.struct("TimestampNano", "SpanId")).alias("attributes"))
    )


def tag_values(
    traces: DataFrame,
    tag: str,
    filter: TraceQuery | None = None,
    start: Instant | None = None,
    end: Instant | None = None,
    limit: int | None = 0,
) -> DataFrame:
    """Distinct non-empty values of a tag, ascending: ``limit`` of them, the usual number for 0, all for None.

    A filter given as a raw string is ignored.
    """
    if filter is not None and filter.raw is None:
        conditions = [predicates.span_condition(traces, c) for c in filter.conditions]
        traces = traces.where(predicates.all_of(conditions))
    value = attributes.span_tag(traces, tag)
    return distinct_values(traces, value, start, end, limit if limit is None or limit > 0 else MAX_VALUES)
