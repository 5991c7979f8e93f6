"""Every operator as a named query over the given tables. ``oracles`` holds the SQL with the same names."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanlake.checks import adapters
from spanlake.checks.adapters import END, START
from spanlake.functions import attributes
from spanlake.functions.naming import prom_name
from spanlake.operators import logs, metrics, rollup, spans, traces
from spanlake.plans.queries import (
    LabelMatcher,
    LineOp,
    LogQuery,
    MatchOp,
    MetricQuery,
    SpanAggregation,
    SpanSort,
    TraceCondition,
    TraceOp,
    TraceQuery,
)
from spanlake.session import configure, fresh_path
from spanlake.sources import index, otlp, tables
from spanlake.store import SignalStore

Query = Callable[[SparkSession, str], DataFrame]

DAY = 86400

_queries: dict[str, Query] = {}


def _register(name: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return query(configure(spark), sf_dir)

        _queries[name] = run
        return query

    return add


def queries() -> dict[str, Query]:
    return dict(_queries)


def _text(entries: Column) -> Column:
    """A map as one comparable line of text."""
    pairs = F.transform(F.map_entries(entries), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.concat_ws(";", F.array_sort(pairs))


# --- payloads -----------------------------------------------------------------------------------------------------


@_register("otlp_logs")
def _(spark, sf_dir):
    return otlp.parse_logs(adapters.log_payloads(spark, sf_dir)).select(
        F.col("TimestampNano").alias("ns"),
        F.unix_micros("Timestamp").alias("us"),
        F.col("TraceId").alias("trace_id"),
        F.col("SpanId").alias("span_id"),
        F.col("SeverityText").alias("severity"),
        F.col("SeverityNumber").cast("bigint").alias("severity_number"),
        F.col("ServiceName").alias("service"),
        F.col("Body").alias("body"),
        _text(F.col("ResourceAttributes")).alias("resource"),
        _text(F.col("LogAttributes")).alias("attributes"),
        F.col("day").cast("string").alias("day"),
    )


@_register("otlp_traces")
def _(spark, sf_dir):
    return otlp.parse_traces(adapters.span_payloads(spark, sf_dir)).select(
        F.col("TimestampNano").alias("ns"),
        F.col("TraceId").alias("trace_id"),
        F.col("SpanId").alias("span_id"),
        F.col("ParentSpanId").alias("parent_id"),
        F.col("SpanName").alias("name"),
        F.col("SpanKind").alias("kind"),
        F.col("ServiceName").alias("service"),
        F.col("Duration").alias("duration"),
        F.col("StatusCode").alias("status"),
        F.col("StatusMessage").alias("message"),
        _text(F.col("ResourceAttributes")).alias("resource"),
        _text(F.col("SpanAttributes")).alias("attributes"),
    )


@_register("otlp_span_events")
def _(spark, sf_dir):
    parsed = otlp.parse_traces(adapters.span_payloads(spark, sf_dir))
    return parsed.select(F.col("SpanId").alias("span_id"), F.explode("Events").alias("e")).select(
        "span_id",
        F.col("e.TimestampNano").alias("ns"),
        F.col("e.Name").alias("name"),
        _text(F.col("e.Attributes")).alias("attributes"),
    )


@_register("otlp_span_links")
def _(spark, sf_dir):
    parsed = otlp.parse_traces(adapters.span_payloads(spark, sf_dir))
    return parsed.select(F.col("SpanId").alias("span_id"), F.explode("Links").alias("l")).select(
        "span_id",
        F.col("l.TraceId").alias("link_trace_id"),
        F.col("l.SpanId").alias("link_span_id"),
        F.size("l.Attributes").cast("bigint").alias("attribute_count"),
    )


def _point_columns(table: DataFrame, *columns: Column) -> DataFrame:
    return table.select(
        F.col("TimestampNano").alias("ns"),
        F.col("StartTimestampNano").alias("start_ns"),
        F.col("MetricName").alias("name"),
        F.col("ServiceName").alias("service"),
        _text(F.col("Attributes")).alias("attributes"),
        *columns,
    )


@_register("otlp_metrics_sum")
def _(spark, sf_dir):
    return _point_columns(
        otlp.parse_metrics(adapters.metric_payloads(spark, sf_dir)).sum,
        F.col("Value").alias("value"),
        F.col("AggregationTemporality").cast("bigint").alias("temporality"),
        F.col("IsMonotonic").alias("monotonic"),
    )


@_register("otlp_metrics_gauge")
def _(spark, sf_dir):
    return _point_columns(
        otlp.parse_metrics(adapters.metric_payloads(spark, sf_dir)).gauge, F.col("Value").alias("value")
    )


@_register("otlp_metrics_hist")
def _(spark, sf_dir):
    return _point_columns(
        otlp.parse_metrics(adapters.metric_payloads(spark, sf_dir)).histogram,
        F.col("Count").alias("count"),
        F.round("Sum", 6).alias("sum"),
        F.array_join(F.col("BucketCounts").cast("array<string>"), ",").alias("buckets"),
        F.array_join(F.col("ExplicitBounds").cast("array<bigint>").cast("array<string>"), ",").alias("bounds"),
        F.col("AggregationTemporality").cast("bigint").alias("temporality"),
    )


ATTRIBUTE_PAYLOAD = """{"resourceLogs": [{"resource": {"attributes": [
  {"key": "service.name", "value": {"stringValue": "svc"}}]}, "scopeLogs": [{"logRecords": [{
  "timeUnixNano": "{ns}", "spanId": "s{id}", "body": {"intValue": "{k}"}, "attributes": [
  {"key": "twice", "value": {"stringValue": "first"}}, {"key": "text", "value": {"stringValue": "{type}"}},
  {"key": "flag", "value": {"boolValue": true}}, {"key": "count", "value": {"intValue": "{k}"}},
  {"key": "bare_count", "value": {"intValue": {k}}}, {"key": "ratio", "value": {"doubleValue": 1.50}},
  {"key": "bytes", "value": {"bytesValue": "AQID"}}, {"key": "bare", "value": "plain"},
  {"key": "none", "value": null}, {"key": "", "value": {"stringValue": "dropped"}}, "noise", {"value": "keyless"},
  {"key": 7, "value": "dropped"}, {"key": "twice", "value": {"stringValue": "last"}}]}]}]}]}"""


@_register("otlp_attr_flatten")
def _(spark, sf_dir):
    parsed = otlp.parse_logs(adapters.odd_payloads(spark, sf_dir, ATTRIBUTE_PAYLOAD))
    return parsed.select(
        F.col("SpanId").alias("span_id"),
        F.col("Body").alias("body"),
        _text(F.col("LogAttributes")).alias("attributes"),
    )


@_register("otlp_default_service")
def _(spark, sf_dir):
    template = """{"resourceLogs": [{"scopeLogs": [{"logRecords": [
      {"observedTimeUnixNano": {ns}, "spanId": "s{id}", "body": {"stringValue": "{type}"}}]}]}]}"""
    return otlp.parse_logs(adapters.odd_payloads(spark, sf_dir, template)).select(
        F.col("SpanId").alias("span_id"),
        F.col("TimestampNano").alias("ns"),
        F.col("ServiceName").alias("service"),
        F.col("Body").alias("body"),
    )


@_register("otlp_snake_case")
def _(spark, sf_dir):
    template = """{"resourceLogs": [{"resource": {"attributes": [{"key": "service.name", "value":
      {"stringValue": "svc"}}]}, "scopeLogs": null, "instrumentationLibraryLogs": [{"log_records": [
      {"timeUnixNano": "{ns}", "spanId": "s{id}", "severityNumber": "9"}, "noise"]}]}]}"""
    return otlp.parse_logs(adapters.odd_payloads(spark, sf_dir, template)).select(
        F.col("SpanId").alias("span_id"),
        F.col("TimestampNano").alias("ns"),
        F.col("ServiceName").alias("service"),
        F.col("SeverityNumber").cast("bigint").alias("severity_number"),
    )


@_register("otlp_enum_norm")
def _(spark, sf_dir):
    template = """{"resourceSpans": [{"scopeSpans": [{"spans": [
      {"spanId": "i{id}", "kind": 2, "startTimeUnixNano": "{ns}", "endTimeUnixNano": {ns}, "status": {"code": 2}},
      {"spanId": "n{id}", "kind": "SPAN_KIND_PRODUCER", "status": {"code": "STATUS_CODE_OK"}},
      {"spanId": "t{id}", "kind": "2", "startTimeUnixNano": "5", "endTimeUnixNano": "3", "status": {"code": "2"}},
      {"spanId": "x{id}", "kind": 9, "status": "broken"}, 17]}]}]}"""
    return otlp.parse_traces(adapters.odd_payloads(spark, sf_dir, template)).select(
        F.col("SpanId").alias("span_id"),
        F.col("SpanKind").alias("kind"),
        F.col("StatusCode").alias("status"),
        F.col("Duration").alias("duration"),
    )


@_register("otlp_quarantine")
def _(spark, sf_dir):
    """Every second payload is cut off; the wrong-typed branch of the others is valid JSON without rows."""
    template = """{"resourceLogs": "nonsense", "id": {id}}"""
    whole = adapters.odd_payloads(spark, sf_dir, template)
    even = F.get_json_object("raw", "$.id").cast("bigint") % 2 == 0
    cut = F.when(even, F.left("raw", F.lit(20))).otherwise(F.col("raw"))
    raw = whole.select(cut.alias("raw"))
    rejected = otlp.bad_payloads(raw).agg(F.count("*").alias("n")).select(F.lit("rejected").alias("what"), "n")
    parsed = otlp.parse_logs(raw).agg(F.count("*").alias("n")).select(F.lit("rows").alias("what"), "n")
    return rejected.unionAll(parsed)


@_register("metric_names")
def _(spark, sf_dir):
    units = F.array(*(F.lit(u) for u in ("ms", "s", "By", "bytes", "By/s", "%", "1", "")))
    named = adapters.events(spark, sf_dir).select(
        F.concat(F.col("service"), F.lit("."), F.col("event_type"), F.lit(".seen")).alias("name"),
        F.get(units, (F.col("k") % 8).cast("int")).alias("unit"),
        (F.col("k") % 2 == 0).alias("monotonic"),
    )
    name = prom_name(F.col("name"), F.col("unit"), F.col("monotonic"))
    return named.groupBy(name.alias("metric")).agg(F.count("*").alias("n"))


# --- tables -------------------------------------------------------------------------------------------------------


@_register("sink_roundtrip")
def _(spark, sf_dir):
    root = fresh_path(spark, "sink")
    tables.ensure_table(spark, root, "otel_traces")
    tables.append(adapters.spans(spark, sf_dir), root, "otel_traces", max_rows=5000)
    stored = tables.read_table(spark, root, "otel_traces")
    return stored.select(
        F.col("SpanId").alias("span_id"),
        F.col("TimestampNano").alias("ns"),
        F.col("Duration").alias("duration"),
        _text(F.col("SpanAttributes")).alias("attributes"),
        F.col("day").cast("string").alias("day"),
    )


@_register("retention")
def _(spark, sf_dir):
    kept = tables.surviving(adapters.logs(spark, sf_dir), days=20, now=END)
    return kept.groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("n"))


# --- logs ---------------------------------------------------------------------------------------------------------


def _matched_logs(query: LogQuery, spark: SparkSession, sf_dir: str, start=START, end=END) -> DataFrame:
    return logs.match_logs(adapters.logs(spark, sf_dir), query, start, end).select(
        F.col("TimestampNano").alias("ns"), F.col("SpanId").alias("span_id"), F.col("Body").alias("line")
    )


LOG_QUERIES = {
    "log_match_eq": LogQuery.stream(LabelMatcher.eq("service_name", "svc-3")),
    "log_match_neq": LogQuery.stream(LabelMatcher("exception_group", MatchOp.NEQ, "g3")),
    "log_match_re": LogQuery.stream(LabelMatcher("level", MatchOp.RE, "^(ERR|WARN)")),
    "log_match_nre": LogQuery.stream(LabelMatcher("exception_group", MatchOp.NRE, "g[0-4]")),
    "log_attr_fallback": LogQuery.stream(
        LabelMatcher.eq("deployment_environment_name", "prod"), LabelMatcher("session_id", MatchOp.NEQ, "u3")
    ),
    "log_line_contains": LogQuery().line(LineOp.CONTAINS, "purchase"),
    "log_line_not_contains": LogQuery().line(LineOp.NOT_CONTAINS, "view"),
    "log_line_regex": LogQuery().line(LineOp.REGEX, "user=1[0-9] props.*7"),
    "log_line_not_regex": LogQuery().line(LineOp.NOT_REGEX, "^(click|view)"),
    "log_label_or": LogQuery().where_any(LabelMatcher.eq("level", "ERROR"), LabelMatcher.eq("service_name", "svc-1")),
    "log_label_and": LogQuery().where_all(
        LabelMatcher.eq("detected_level", "ERROR"), LabelMatcher("exception_group", MatchOp.RE, "g[13579]")
    ),
}
for _name, _query in LOG_QUERIES.items():
    _register(_name)(partial(_matched_logs, _query))


@_register("log_time_range")
def _(spark, sf_dir):
    return _matched_logs(LogQuery(), spark, sf_dir, start=1704844800.9, end=1705708800.9)


@_register("log_search")
def _(spark, sf_dir):
    query = LogQuery.stream(LabelMatcher.eq("level", "ERROR")).line(LineOp.CONTAINS, "user=")
    found = logs.search_logs(adapters.logs(spark, sf_dir), query, START, END, limit=100)
    return found.select(
        F.col("timestamp_nano").alias("ns"), "line", F.col("labels")["exception_group"].alias("exception_group")
    )


@_register("log_labels")
def _(spark, sf_dir):
    return adapters.logs(spark, sf_dir).select(
        F.col("SpanId").alias("id"), _text(attributes.log_labels()).alias("labels")
    )


@_register("log_label_values")
def _(spark, sf_dir):
    return logs.log_label_values(adapters.logs(spark, sf_dir), "session_id", START, END)


@_register("log_label_values_all")
def _(spark, sf_dir):
    return logs.log_label_values(adapters.logs(spark, sf_dir), "trace_id", limit=None)


@_register("log_long_bodies")
def _(spark, sf_dir):
    """A line filter over whole, long texts."""
    query = LogQuery().line(LineOp.CONTAINS, "and").line(LineOp.NOT_REGEX, "the.of")
    found = logs.match_logs(adapters.document_logs(spark, sf_dir), query, START, START.replace(year=2262))
    return found.groupBy("ServiceName").agg(F.count("*").alias("n"), F.sum(F.length("Body")).alias("chars"))


# --- spans and traces ---------------------------------------------------------------------------------------------


def _matched_spans(condition: TraceCondition, spark: SparkSession, sf_dir: str) -> DataFrame:
    query = TraceQuery().where(condition)
    return traces.match_spans(adapters.spans(spark, sf_dir), query, START, END).select(
        F.col("TimestampNano").alias("ns"), F.col("SpanId").alias("span_id"), F.col("Duration").alias("duration")
    )


SPAN_CONDITIONS = {
    "span_duration_filter": TraceCondition.token("duration", TraceOp.GT, "50ms"),
    "span_attr_numeric": TraceCondition.token("span.http.response.status_code", TraceOp.GTE, "500"),
    "span_name_regex": TraceCondition("name", TraceOp.RE, "GET /(view|click)$"),
    "span_name_not_regex": TraceCondition("name", TraceOp.NRE, "^GET"),
    "span_attr_present": TraceCondition.present("span.db.query.text"),
    "span_attr_absent": TraceCondition.absent("db.query.text"),
    "span_attr_eq": TraceCondition.eq("span.http.route", "/signup"),
    "span_attr_neq": TraceCondition("span.db.system.name", TraceOp.NEQ, "mysql"),
    "span_resource_eq": TraceCondition.eq("resource.deployment.environment.name", "staging"),
    "span_service_eq": TraceCondition.eq("resource.service.name", "svc-2"),
    "span_status_error": TraceCondition.token("status", TraceOp.EQ, "error"),
    "span_kind_server": TraceCondition.token("kind", TraceOp.EQ, "server"),
}
for _name, _condition in SPAN_CONDITIONS.items():
    _register(_name)(partial(_matched_spans, _condition))


@_register("trace_search")
def _(spark, sf_dir):
    query = TraceQuery().where(TraceCondition.token("status", TraceOp.EQ, "error"))
    found = traces.search_traces(adapters.spans(spark, sf_dir), query, START, END, limit=20)
    return found.select("trace_id", F.size("matched_spans").cast("bigint").alias("spans"))


@_register("trace_search_all_spans")
def _(spark, sf_dir):
    query = TraceQuery().where(TraceCondition("name", TraceOp.NRE, "click"))
    found = traces.search_traces(adapters.spans(spark, sf_dir), query, START, END, limit=30, spans_per_trace=None)
    return found.select("trace_id", F.size("matched_spans").cast("bigint").alias("spans"))


@_register("trace_root")
def _(spark, sf_dir):
    """Conditions leave traces without their parentless span, so both ways of choosing the root occur."""
    query = TraceQuery().where(TraceCondition("name", TraceOp.NRE, "click"))
    found = traces.search_traces(adapters.spans(spark, sf_dir), query, START, END, limit=2000)
    return found.select("trace_id", "root_service_name", "root_trace_name")


@_register("trace_summary")
def _(spark, sf_dir):
    found = traces.search_traces(adapters.spans(spark, sf_dir), TraceQuery(), START, END, limit=2000)
    matched = F.transform(
        "matched_spans", lambda s: F.concat_ws(":", s["span_id"], s["name"], s["start_nano"].cast("string"))
    )
    return found.select(
        "trace_id",
        F.unix_seconds("started_at").alias("started"),
        "duration_ms",
        F.concat_ws(",", matched).alias("spans"),
    )


def _waterfall(spans: DataFrame) -> DataFrame:
    return spans.select(
        "span_id",
        F.coalesce("parent_span_id", F.lit("none")).alias("parent"),
        "name",
        "service_name",
        "kind",
        "start_nano",
        "end_nano",
        "has_error",
        F.size("links").cast("bigint").alias("links"),
    )


@_register("trace_waterfall")
def _(spark, sf_dir):
    return _waterfall(traces.get_trace(adapters.spans(spark, sf_dir), "t10"))


@_register("trace_services")
def _(spark, sf_dir):
    return traces.trace_services(adapters.spans(spark, sf_dir), "t10").select(
        "service_name", _text(F.col("attributes")).alias("attributes")
    )


@_register("trace_links")
def _(spark, sf_dir):
    linked = adapters.spans(spark, sf_dir).select("SpanId", F.explode(traces.span_links()).alias("link"))
    return linked.select(
        F.col("SpanId").alias("span"),
        F.col("link.trace_id").alias("link_trace_id"),
        F.col("link.span_id").alias("link_span_id"),
    )


@_register("tag_values")
def _(spark, sf_dir):
    return traces.tag_values(adapters.spans(spark, sf_dir), ".http.route")


@_register("tag_values_filtered")
def _(spark, sf_dir):
    slow = TraceQuery().where(TraceCondition.token("duration", TraceOp.GTE, "0.1s"))
    return traces.tag_values(adapters.spans(spark, sf_dir), "span.db.query.text", slow, START, END, limit=5)


STATEMENTS = SpanAggregation(
    where=TraceQuery().where(TraceCondition.present("span.db.query.text")), group_by="span.db.query.text"
)


def _flat(stats: DataFrame, *carried: str) -> DataFrame:
    return stats.select(
        "key",
        "count",
        "avg_ms",
        F.round("p95_ms", 9).alias("p95_ms"),
        "max_ms",
        "total_ms",
        *(F.col("attributes")[c].alias(c.replace(".", "_")) for c in carried),
    )


@_register("span_agg")
def _(spark, sf_dir):
    by_route = SpanAggregation(where=TraceQuery(), group_by="span.http.route", limit=1000)
    return _flat(spans.aggregate_spans(adapters.spans(spark, sf_dir), by_route, START, END))


@_register("span_agg_carry")
def _(spark, sf_dir):
    carrying = SpanAggregation(
        where=STATEMENTS.where.where(TraceCondition.token("duration", TraceOp.GT, "1ms")),
        group_by=STATEMENTS.group_by,
        carry=("span.db.system.name", "resource.deployment.environment.name"),
    )
    stats = spans.aggregate_spans(adapters.spans(spark, sf_dir), carrying, START, END)
    return _flat(stats, "db.system.name", "deployment.environment.name")


def _top(sort: SpanSort, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 25 of a high-cardinality attribute."""
    by_part = SpanAggregation(where=TraceQuery(), group_by="span.part", sort=sort, limit=25)
    rows = adapters.line_spans(spark, sf_dir)
    return _flat(spans.aggregate_spans(rows, by_part, 0, 4102444800))


for _sort in SpanSort:
    _register("span_top_" + _sort.name.lower())(partial(_top, _sort))


@_register("span_agg_sketch")
def _(spark, sf_dir):
    """The single-scan variant; its statistics other than the quantile are exact."""
    by_route = SpanAggregation(where=TraceQuery(), group_by="span.http.route", limit=1000)
    stats = spans.aggregate_spans(adapters.spans(spark, sf_dir), by_route, START, END, exact=False)
    return _flat(stats).drop("p95_ms")


# --- statement rollup ---------------------------------------------------------------------------------------------


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.rollup_partial(adapters.spans(spark, sf_dir))


def _minutes(rows: DataFrame) -> DataFrame:
    """One row per key, with the median of its durations."""
    keyed = rows.withColumn("key", F.struct("Bucket", "QueryText", "DbSystem"))
    medians = rollup.quantiles_of(keyed, "key", 0.5).select("key", F.col("quantile").alias("median"))
    return keyed.join(medians, "key").select(
        F.unix_seconds("Bucket").alias("minute"),
        F.col("QueryText").alias("statement"),
        F.col("DbSystem").alias("system"),
        F.col("Calls").alias("calls"),
        F.col("DurationSum").cast("bigint").alias("duration_sum"),
        F.col("DurationMax").alias("duration_max"),
        "median",
    )


@_register("rollup_minute")
def _(spark, sf_dir):
    return _minutes(_summary(spark, sf_dir))


@_register("rollup_rank")
def _(spark, sf_dir):
    ranking = SpanAggregation(where=TraceQuery(), group_by=STATEMENTS.group_by, carry=("span.db.system.name",), limit=5)
    stats = rollup.rollup_query(_summary(spark, sf_dir), ranking, START, END)
    return _flat(stats, "db.system.name").drop("p95_ms")


@_register("rollup_p95")
def _(spark, sf_dir):
    ranking = SpanAggregation(where=TraceQuery(), group_by=STATEMENTS.group_by, sort=SpanSort.P95)
    return _flat(rollup.rollup_query(_summary(spark, sf_dir), ranking, START, END))


@_register("rollup_route")
def _(spark, sf_dir):
    """The plain ranking comes from the rollup, the one with a further filter from the spans."""
    rows, summary = adapters.spans(spark, sf_dir), _summary(spark, sf_dir)
    filtered = SpanAggregation(
        where=STATEMENTS.where.where(TraceCondition.eq("resource.service.name", "svc-1")), group_by=STATEMENTS.group_by
    )
    plain = spans.aggregate_spans(rows, STATEMENTS, START, END, summary=summary)
    scanned = spans.aggregate_spans(rows, filtered, START, END, summary=summary)
    return (
        _flat(plain)
        .select(F.lit("rollup").alias("path"), "key", "count", "total_ms")
        .unionAll(_flat(scanned).select(F.lit("spans").alias("path"), "key", "count", "total_ms"))
    )


@_register("rollup_compact")
def _(spark, sf_dir):
    """Partial rows of two inserts (calls above and below 20 ms), merged to one row per key."""
    rows = adapters.spans(spark, sf_dir)
    fast, slow = rows.where("Duration < 20000000"), rows.where("Duration >= 20000000")
    return _minutes(rollup.compact_rollup(rollup.rollup_partial(fast).unionAll(rollup.rollup_partial(slow))))


@_register("rollup_retention")
def _(spark, sf_dir):
    kept = tables.surviving(_summary(spark, sf_dir), days=15, now=END)
    return kept.groupBy(F.col("day").cast("string").alias("day")).agg(F.sum("Calls").alias("calls"))


def _appended(spark: SparkSession, sf_dir: str, parts: int) -> tuple[SignalStore, list[DataFrame]]:
    """A new store, and the spans in parts to append to it."""
    store = SignalStore(spark, fresh_path(spark, "store"))
    store.install()
    rows = adapters.spans(spark, sf_dir)
    return store, [rows.where(F.pmod(F.xxhash64("SpanId"), F.lit(parts)) == i) for i in range(parts)]


def _follow(store: SignalStore, **options) -> None:
    """Run the rollup stream until it has read every stored file."""
    stream = store.follow_traces(fresh_path(store.spark, "progress"), trigger={"availableNow": True}, **options)
    stream.awaitTermination()


RANKED = SpanAggregation(
    where=STATEMENTS.where, group_by=STATEMENTS.group_by, carry=("span.db.system.name",), sort=SpanSort.P95
)


def _stored_ranking(store: SignalStore) -> DataFrame:
    return _flat(store.aggregate_spans(RANKED, START, END), "db.system.name")


@_register("rollup_stream")
def _(spark, sf_dir):
    """Spans appended in three parts, rolled up by a stream in several batches that are merged."""
    store, parts = _appended(spark, sf_dir, 3)
    for part in parts:
        store.write_traces(part)
    _follow(store, files_per_batch=40, merge_every=2)
    return _stored_ranking(store)


@_register("rollup_backfill")
def _(spark, sf_dir):
    """A fill of the first part, then a stream that leaves its files out."""
    store, parts = _appended(spark, sf_dir, 2)
    store.write_traces(parts[0])
    store.backfill_rollup()
    store.write_traces(parts[1])
    _follow(store)
    return _stored_ranking(store)


@_register("rollup_stitched")
def _(spark, sf_dir):
    """A fill of the first part only: the files of the second are answered from their spans."""
    store, parts = _appended(spark, sf_dir, 2)
    store.write_traces(parts[0])
    store.backfill_rollup()
    store.write_traces(parts[1])
    return _stored_ranking(store)


@_register("rollup_p95_bounds")
def _(spark, sf_dir):
    """Per statement: how far the stated ends of the p95 lie from the wanted rank among all spans, and how wide they are."""
    rows = adapters.spans(spark, sf_dir)
    ends = rollup.statement_quantiles(_summary(spark, sf_dir), 0.95, START, END)
    text = attributes.span_field(rows, rollup.STATEMENT_FIELD)
    durations = rows.where("SpanName = 'db.query'").select(text.alias("statement"), "Duration")
    held = durations.join(ends, "statement").groupBy("statement", "low", "high").agg(
        F.count("*").alias("calls"), F.count_if(F.col("Duration") < F.col("low")).alias("below"),
        F.count_if(F.col("Duration") <= F.col("high")).alias("upto"),
    )
    rank = F.ceil(F.col("calls") * 0.95)
    error = F.greatest(F.col("below") + 1 - rank, rank - F.col("upto"), F.lit(0))
    narrow = (F.col("high") - F.col("low")) * (1 << rollup.BITS) <= F.col("high")
    return held.select("statement", "calls", error.cast("bigint").alias("rank_error"), narrow.alias("within_bound"))


# --- stored tables: files, index ----------------------------------------------------------------------------------


def _indexed(spark: SparkSession, sf_dir: str, table: str) -> SignalStore:
    """A store of logs or spans in two appends, of which the first is indexed."""
    store = SignalStore(spark, fresh_path(spark, "store"))
    rows, write = {
        "otel_logs": (adapters.logs, store.write_logs),
        "otel_traces": (adapters.spans, store.write_traces),
    }[table]
    halves = [rows(spark, sf_dir).where(F.pmod(F.xxhash64("SpanId"), F.lit(2)) == i) for i in range(2)]
    write(halves[0])
    store.index(table)
    write(halves[1])
    return store


@_register("log_match_indexed")
def _(spark, sf_dir):
    """A line filter over the files that an index leaves, and those it does not cover."""
    store, query = _indexed(spark, sf_dir, "otel_logs"), LOG_QUERIES["log_line_contains"]
    rows = index.narrowed(spark, store.root, "otel_logs", index.log_conditions(query), START, END)
    found = logs.match_logs(rows, query, START, END)
    return found.select(F.col("TimestampNano").alias("ns"), F.col("SpanId").alias("span_id"), F.col("Body").alias("line"))


@_register("log_label_values_indexed")
def _(spark, sf_dir):
    return _indexed(spark, sf_dir, "otel_logs").log_label_values("session_id", START, END)


@_register("trace_by_id_indexed")
def _(spark, sf_dir):
    return _waterfall(_indexed(spark, sf_dir, "otel_traces").trace("t10"))


@_register("tag_values_indexed")
def _(spark, sf_dir):
    return _indexed(spark, sf_dir, "otel_traces").tag_values(".http.route")


def _by_day(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("n"))


def _points_by_kind(store: SignalStore) -> DataFrame:
    kinds = [(kind, store.table(f"otel_metrics_{kind}")) for kind in ("sum", "gauge", "histogram")]
    counts = [rows.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n") for kind, rows in kinds]
    return counts[0].unionAll(counts[1]).unionAll(counts[2])


@_register("sink_metrics")
def _(spark, sf_dir):
    """Payloads written to the three metric tables."""
    store = SignalStore(spark, fresh_path(spark, "store"))
    store.ingest(adapters.metric_payloads(spark, sf_dir), "metrics")
    return _points_by_kind(store)


@_register("sink_repeated_batches")
def _(spark, sf_dir):
    """Two named batches of metric payloads, each sent twice, are stored once."""
    store = SignalStore(spark, fresh_path(spark, "store"))
    payloads = adapters.metric_payloads(spark, sf_dir)
    for batch in (0, 1, 0, 1):
        part = payloads.where(F.pmod(F.xxhash64("raw"), F.lit(2)) == batch)
        store.ingest(part, "metrics", batch=f"part-{batch}")
    return _points_by_kind(store)


@_register("ingest_stream")
def _(spark, sf_dir):
    """Files of log payloads followed by a stream that takes one file a batch."""
    store, source = SignalStore(spark, fresh_path(spark, "store")), fresh_path(spark, "payloads")
    adapters.log_payloads(spark, sf_dir).repartition(3, "raw").write.text(source)
    stream = store.follow_payloads(
        source, "logs", fresh_path(spark, "progress"), trigger={"availableNow": True}, files_per_batch=1
    )
    stream.awaitTermination()
    return _by_day(store.table("otel_logs"))


@_register("sink_bounded_files")
def _(spark, sf_dir):
    """Rows per file stay within the bound asked for."""
    store = SignalStore(spark, fresh_path(spark, "store"))
    store.write_traces(adapters.spans(spark, sf_dir), max_rows=100)
    files = store.table("otel_traces").groupBy("day", F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("n"))
    return files.agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 100).alias("files_over"))


@_register("sink_empty_write")
def _(spark, sf_dir):
    """Empty appends and repeated installs change nothing."""
    store = SignalStore(spark, fresh_path(spark, "store"))
    store.install()
    rows = adapters.logs(spark, sf_dir)
    store.write_logs(rows.where("false"))
    store.write_logs(rows)
    store.install()
    store.write_logs(rows.where("false"))
    return _by_day(store.table("otel_logs"))


@_register("sink_clustered")
def _(spark, sf_dir):
    """Inside a file, rows come by service, span name and time."""
    store = SignalStore(spark, fresh_path(spark, "store"))
    store.write_traces(adapters.spans(spark, sf_dir))
    place = F.struct("ServiceName", "SpanName", "TimestampNano")
    rows = store.table("otel_traces").select("day", "_metadata.file_name", "_metadata.row_index", place.alias("place"))
    before = F.lag("place").over(Window.partitionBy("day", "file_name").orderBy("row_index"))
    rows = rows.withColumn("before", before)
    return rows.agg(F.count("*").alias("n"), F.count_if(F.col("before") > F.col("place")).alias("out_of_order"))


# --- metrics ------------------------------------------------------------------------------------------------------


def _instant(query: MetricQuery, spark: SparkSession, sf_dir: str) -> DataFrame:
    values = metrics.instant(adapters.metric_tables(spark, sf_dir), query, END)
    return values.withColumn("value", F.round("value", 6))


def _range(query: MetricQuery, step: int | None, spark: SparkSession, sf_dir: str) -> DataFrame:
    values = metrics.range_query(adapters.metric_tables(spark, sf_dir), query, START, END, step)
    return values.withColumn("value", F.round("value", 9))


GAUGE = MetricQuery("queue_depth", window="31d")
COUNTER = MetricQuery("events_total")
REQUESTS = "request_duration_milliseconds"

INSTANT_QUERIES = {
    "gauge_latest": GAUGE.grouped("event_type"),
    "gauge_latest_global": GAUGE,
    "counter_increase": COUNTER.increase("31d").grouped("service_name", "event_type"),
    "counter_rate": COUNTER.rate("31d").grouped("service_name", "event_type"),
    "hist_count_increase": MetricQuery(REQUESTS + "_count").rate("31d").grouped("service_name"),
    "hist_sum_increase": MetricQuery(REQUESTS + "_sum").increase("31d").grouped("service_name"),
    "hist_quantile": MetricQuery(REQUESTS + "_bucket").at_quantile(0.95, "31d").grouped("service_name"),
    "hist_quantile_global": MetricQuery(REQUESTS + "_bucket").at_quantile(0.5, "31d"),
    "metric_match_eq": COUNTER.increase("31d").grouped("event_type").match("service_name", MatchOp.EQ, "svc-4"),
    "metric_match_re": COUNTER.increase("31d").grouped("event_type").match("event_type", MatchOp.RE, "^(c|v)"),
    "metric_match_neq": COUNTER.increase("31d").grouped("event_type").match("event_type", MatchOp.NEQ, "view"),
    "metric_match_nre": COUNTER.increase("31d").grouped("event_type").match("missing", MatchOp.NRE, "x"),
    "metric_match_fragment": COUNTER.increase("31d").grouped("event_type").match_fragment('service_name!~"svc-[0-3]"'),
}
for _name, _metric in INSTANT_QUERIES.items():
    _register(_name)(partial(_instant, _metric))

RANGE_QUERIES = {
    "range_gauge_avg": (GAUGE.grouped("event_type"), 3600),
    "range_rate": (COUNTER.rate("5m").grouped("service_name", "event_type"), 7200),
    "range_increase": (COUNTER.increase().grouped("service_name"), 86400),
    "range_auto_step": (COUNTER.counter_increase().grouped("event_type"), None),
    "range_rate_scaled": (COUNTER.rate().grouped("event_type").times(60), 43200),
    "range_hist_count_rate": (MetricQuery(REQUESTS + "_count").rate("1m").grouped("service_name").times(60), 21600),
    "range_hist_sum": (MetricQuery(REQUESTS + "_sum").increase().grouped("service_name"), 21600),
    "range_hist_quantile": (MetricQuery(REQUESTS).at_quantile(0.9).grouped("service_name"), 14400),
}
for _name, (_metric, _step) in RANGE_QUERIES.items():
    _register(_name)(partial(_range, _metric, _step))


@_register("counter_increase_per_series")
def _(spark, sf_dir):
    query = COUNTER.increase("31d").grouped("event_type").each_series()
    return _instant(query, spark, sf_dir)


@_register("gauge_named_count")
def _(spark, sf_dir):
    """A gauge whose name ends like a part of a histogram."""
    gauge = adapters.metric_tables(spark, sf_dir).gauge
    named = metrics.MetricTables(gauge=gauge.withColumn("MetricName", F.concat("MetricName", F.lit("_count"))))
    query = MetricQuery("queue_depth_count", window="31d").grouped("event_type").from_table("gauge")
    return metrics.instant(named, query, END).withColumn("value", F.round("value", 6))


@_register("range_by_status_code")
def _(spark, sf_dir):
    """A label whose attribute key holds an underscore."""
    sums = adapters.metric_tables(spark, sf_dir).sum
    key = F.create_map(F.lit("http.response.status_code"), F.col("Attributes")["event.type"])
    coded = metrics.MetricTables(sum=sums.withColumn("Attributes", key))
    query = COUNTER.increase().grouped("http_response_status_code").normalized_labels()
    values = metrics.range_query(coded, query, START, END, DAY)
    return values.withColumn("value", F.round("value", 9))


@_register("hist_bucket_sum")
def _(spark, sf_dir):
    points = adapters.metric_tables(spark, sf_dir).histogram.withColumnRenamed("ServiceName", "service")
    return metrics.sum_buckets(points, ["service"]).select(
        "service",
        F.col("pos").cast("bigint").alias("pos"),
        "n",
        F.size("bounds").cast("bigint").alias("bounds"),
    )


@_register("range_series")
def _(spark, sf_dir):
    query = COUNTER.increase().grouped("service_name")
    points = metrics.range_query(adapters.metric_tables(spark, sf_dir), query, START, END, DAY)
    series = metrics.to_series(points, ["service_name"])
    text = F.transform(
        "points", lambda p: F.concat(p["t"].cast("string"), F.lit(":"), p["value"].cast("bigint").cast("string"))
    )
    return series.select("service_name", F.concat_ws(",", text).alias("points"))


@_register("metric_label_values")
def _(spark, sf_dir):
    return metrics.metric_label_values(adapters.metric_tables(spark, sf_dir).sum, "event_type", START, END)
