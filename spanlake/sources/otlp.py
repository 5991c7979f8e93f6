"""OTLP/JSON payloads (one JSON text per row in column ``raw``) to rows of the signal tables.

Each payload is parsed once into a VARIANT, read in one pass into the nested shape of its signal (members whose type
matters stay VARIANT) and exploded level by level, in one stage without a shuffle. The resource attributes are flattened once
per envelope, before its records are exploded, and carried along. Payloads of any shape give zero or more rows; those that
are no JSON are found by ``bad_payloads``.

Works on batch and streaming DataFrames alike.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlake import schemas
from spanlake.functions import json_values as j
from spanlake.functions.naming import prom_name
from spanlake.functions.times import timestamp_of
from spanlake.operators.metrics import MetricTables
from spanlake.session import configure

# Service of a resource that names none.
DEFAULT_SERVICE = "unknown_service"

# The metric kinds that are stored, in the order they are looked for.
KINDS = ("sum", "gauge", "histogram")

# Span kinds and status codes, by number and by name.
SPAN_KINDS = {
    "Internal": (1, "SPAN_KIND_INTERNAL"),
    "Server": (2, "SPAN_KIND_SERVER"),
    "Client": (3, "SPAN_KIND_CLIENT"),
    "Producer": (4, "SPAN_KIND_PRODUCER"),
    "Consumer": (5, "SPAN_KIND_CONSUMER"),
}
STATUS_CODES = {
    "Ok": (1, "STATUS_CODE_OK"),
    "Error": (2, "STATUS_CODE_ERROR"),
}

LOG_RECORD = j.shape(
    **j.leaves(
        "timeUnixNano", "observedTimeUnixNano", "traceId", "spanId", "severityText", "severityNumber", "body"
    ),
    attributes=j.ATTRIBUTES,
)

SPAN_EVENT = j.shape(**j.leaves("timeUnixNano", "name"), attributes=j.ATTRIBUTES)
SPAN_LINK = j.shape(**j.leaves("traceId", "spanId"), attributes=j.ATTRIBUTES)
SPAN = j.shape(
    **j.leaves(
        "traceId", "spanId", "parentSpanId", "name", "kind", "startTimeUnixNano", "endTimeUnixNano"
    ),
    status=j.shape(**j.leaves("code", "message")),
    attributes=j.ATTRIBUTES,
    events=f"array<{SPAN_EVENT}>",
    links=f"array<{SPAN_LINK}>",
)

POINT = j.shape(
    **j.leaves("timeUnixNano", "startTimeUnixNano", "asInt", "asDouble", "count", "sum"),
    attributes=j.ATTRIBUTES,
    bucketCounts="array<variant>",
    bucket_counts="array<variant>",
    explicitBounds="array<variant>",
    explicit_bounds="array<variant>",
)
POINTS = j.shape(
    **j.leaves("isMonotonic", "aggregationTemporality"), dataPoints=f"array<{POINT}>", data_points=f"array<{POINT}>"
)
METRIC = j.shape(**j.leaves("name", "unit"), **dict.fromkeys(KINDS, POINTS))


def with_payload(raw: DataFrame) -> DataFrame:
    """``raw`` with the parsed ``payload`` next to it, NULL where the text is no JSON. The parsers accept either form."""
    return raw if "payload" in raw.columns else raw.withColumn("payload", F.try_parse_json("raw"))


def bad_payloads(raw: DataFrame) -> DataFrame:
    """Payloads that are not JSON; the caller decides where to put them."""
    return with_payload(raw).where("payload IS NULL").select("raw")


def parse_logs(raw: DataFrame) -> DataFrame:
    scopes = ("scopeLogs", "instrumentationLibraryLogs")
    rows = _records(raw, "resourceLogs", scopes, ("logRecords", "log_records"), LOG_RECORD).where("r IS NOT NULL")
    nanos = j.integer(F.coalesce(j.present(F.col("r.timeUnixNano")), j.present(F.col("r.observedTimeUnixNano"))))
    return _typed(
        rows.select("resource", "service", "r", nanos.alias("nanos")),
        schemas.LOGS,
        {
            "TraceId": j.string(F.col("r.traceId")),
            "SpanId": j.string(F.col("r.spanId")),
            "SeverityText": j.string(F.col("r.severityText")),
            "SeverityNumber": _int32(j.integer(F.col("r.severityNumber"))),
            "Body": j.any_value(F.col("r.body")),
            "LogAttributes": j.attribute_map(F.col("r.attributes")),
        },
    )


def parse_traces(raw: DataFrame) -> DataFrame:
    scopes = ("scopeSpans", "instrumentationLibrarySpans")
    rows = _records(raw, "resourceSpans", scopes, ("spans",), SPAN).where("r IS NOT NULL")
    rows = rows.select(
        "resource",
        "service",
        "r",
        j.integer(F.col("r.startTimeUnixNano")).alias("nanos"),
        j.integer(F.col("r.endTimeUnixNano")).alias("end"),
    )
    return _typed(
        rows,
        schemas.TRACES,
        {
            "TraceId": j.string(F.col("r.traceId")),
            "SpanId": j.string(F.col("r.spanId")),
            "ParentSpanId": j.string(F.col("r.parentSpanId")),
            "SpanName": j.string(F.col("r.name")),
            "SpanKind": _enum(F.col("r.kind"), SPAN_KINDS, "Unspecified"),
            "SpanAttributes": j.attribute_map(F.col("r.attributes")),
            "Duration": F.greatest(F.try_subtract("end", "nanos"), F.lit(0).cast("bigint")),
            "StatusCode": _enum(F.col("r.status.code"), STATUS_CODES, "Unset"),
            "StatusMessage": j.string(F.col("r.status.message")),
            "Events": _span_events(F.col("r.events")),
            "Links": _span_links(F.col("r.links")),
        },
    )


def parse_metrics(raw: DataFrame) -> MetricTables:
    """The three point tables; a metric of any other kind gives no rows.

    The three results share the parsing plan: writing all three reads the payloads once per table. ``any_points`` gives
    all of them in one pass, as the ingest takes them.
    """
    points = metric_points(raw)
    return MetricTables(sum=sum_points(points), gauge=gauge_points(points), histogram=histogram_points(points))


def metric_points(raw: DataFrame) -> DataFrame:
    """One row per data point of any kind: ``resource, service, kind, name, temporality, monotonic, p`` (the point)."""
    scopes = ("scopeMetrics", "instrumentationLibraryMetrics")
    rows = _records(raw, "resourceMetrics", scopes, ("metrics",), METRIC)
    kind = F.coalesce(*(F.when(F.col(f"r.{kind}").isNotNull(), kind) for kind in KINDS))
    data = F.coalesce(*(F.col(f"r.{kind}") for kind in KINDS))
    rows = rows.select("*", kind.alias("kind"), data.alias("d")).where("kind IS NOT NULL")
    rows = rows.withColumn("monotonic", (F.col("kind") == "sum") & j.truthy(F.col("d.isMonotonic")))
    return rows.select(
        "resource",
        "service",
        "kind",
        prom_name(j.string(F.col("r.name")), j.string(F.col("r.unit")), F.col("monotonic")).alias("name"),
        _int32(j.integer(F.col("d.aggregationTemporality"))).alias("temporality"),
        "monotonic",
        F.explode(F.coalesce("d.dataPoints", "d.data_points")).alias("p"),
    )


# what a point of each kind has beside the common columns
_OF_SUM = ("Value", "AggregationTemporality", "IsMonotonic")
_OF_GAUGE = ("Value",)
_OF_HISTOGRAM = ("Count", "Sum", "BucketCounts", "ExplicitBounds", "AggregationTemporality")


def sum_points(points: DataFrame) -> DataFrame:
    return _points(points.where("kind = 'sum'"), schemas.METRICS_SUM, _own_columns(_OF_SUM))


def gauge_points(points: DataFrame) -> DataFrame:
    return _points(points.where("kind = 'gauge'"), schemas.METRICS_GAUGE, _own_columns(_OF_GAUGE))


def histogram_points(points: DataFrame) -> DataFrame:
    return _points(points.where("kind = 'histogram'"), schemas.METRICS_HISTOGRAM, _own_columns(_OF_HISTOGRAM))


def any_points(points: DataFrame) -> DataFrame:
    """The points of all kinds, each with its ``table`` and with nulls in the columns of other kinds."""
    columns = {"table": F.concat(F.lit("otel_metrics_"), F.col("kind"))}
    own = dict(zip(KINDS, (_OF_SUM, _OF_GAUGE, _OF_HISTOGRAM), strict=True))
    for name, value in _own_columns({name for names in own.values() for name in names}).items():
        columns[name] = F.when(F.col("kind").isin([kind for kind in KINDS if name in own[kind]]), value)
    return _points(points, schemas.METRICS_ANY, columns)


def _own_columns(wanted: Collection[str]) -> dict[str, Column]:
    columns = {
        "Value": _value(),
        "Count": j.integer(F.col("p.count")),
        "Sum": j.number(F.col("p.sum")),
        "BucketCounts": F.transform(_list("p.bucketCounts", "p.bucket_counts"), j.integer),
        "ExplicitBounds": F.transform(_list("p.explicitBounds", "p.explicit_bounds"), j.number),
        "AggregationTemporality": F.col("temporality"),
        "IsMonotonic": F.col("monotonic"),
    }
    return {name: value for name, value in columns.items() if name in wanted}


def _points(points: DataFrame, schema: schemas.T.StructType, columns: dict[str, Column]) -> DataFrame:
    rows = points.select(
        "*",
        j.integer(F.col("p.timeUnixNano")).alias("nanos"),
        j.integer(F.col("p.startTimeUnixNano")).alias("start"),
    )
    common = {
        "StartTimestamp": timestamp_of(F.col("start")),
        "StartTimestampNano": F.col("start"),
        "MetricName": F.col("name"),
        "Attributes": j.attribute_map(F.col("p.attributes")),
    }
    return _typed(rows, schema, common | columns)


def _value() -> Column:
    """``asInt`` whenever the key exists, even if it holds null; else ``asDouble``."""
    return F.when(F.col("p.asInt").isNotNull(), j.number(F.col("p.asInt"))).otherwise(j.number(F.col("p.asDouble")))


def _list(*spellings: str) -> Column:
    return F.coalesce(*spellings, F.array().cast("array<variant>"))


def _records(raw: DataFrame, envelope: str, scopes: tuple[str, ...], leaves: tuple[str, ...], record: str) -> DataFrame:
    """``resource`` (attribute map), ``service`` and ``r`` (of shape ``record``), one row per innermost list element."""
    configure(raw.sparkSession)
    scope = j.shape(**dict.fromkeys(leaves, f"array<{record}>"))
    kind = j.shape(resource=j.shape(attributes=j.ATTRIBUTES), **dict.fromkeys(scopes, f"array<{scope}>"))
    lists = j.read(F.col("payload"), f"$.{envelope}", f"array<{kind}>")
    envelopes = with_payload(raw).select(F.explode(lists).alias("e"))
    resources = envelopes.select(
        j.attribute_map(F.col("e.resource.attributes")).alias("resource"),
        F.explode(F.coalesce(*(f"e.{s}" for s in scopes))).alias("s"),
    )
    return resources.select(
        "resource",
        F.coalesce(F.col("resource")["service.name"], F.lit(DEFAULT_SERVICE)).alias("service"),
        F.explode(F.coalesce(*(f"s.{leaf}" for leaf in leaves))).alias("r"),
    )


def _typed(rows: DataFrame, schema: schemas.T.StructType, columns: dict[str, Column]) -> DataFrame:
    """The table's columns in order; time, service, resource and day are the same for every signal."""
    shared = {
        "Timestamp": timestamp_of(F.col("nanos")),
        "TimestampNano": F.col("nanos"),
        "ServiceName": F.col("service"),
        "ResourceAttributes": F.col("resource"),
        "day": F.to_date(timestamp_of(F.col("nanos"))),
    }
    values = shared | columns
    return rows.select(*(values[f.name].alias(f.name) for f in schema.fields))


def _int32(value: Column) -> Column:
    return F.coalesce(value.try_cast("int"), F.lit(0))


def _enum(value: Column, codes: dict[str, tuple[int, str]], otherwise: str) -> Column:
    """A JSON integer or a name; numbers written as text are not recognised."""
    code = F.when(j.kind(value) == "BIGINT", F.try_variant_get(value, "$", "bigint"))
    name = F.when(j.kind(value) == "STRING", F.try_variant_get(value, "$", "string"))
    branches = [F.when((code == number) | (name == text), label) for label, (number, text) in codes.items()]
    return F.coalesce(*branches, F.lit(otherwise))


def _span_events(events: Column) -> Column:
    def event(e: Column) -> Column:
        nanos = j.integer(e["timeUnixNano"])
        return F.struct(
            timestamp_of(nanos).alias("Timestamp"),
            nanos.alias("TimestampNano"),
            j.string(e["name"]).alias("Name"),
            j.attribute_map(e["attributes"]).alias("Attributes"),
        )

    return F.transform(_objects(events, SPAN_EVENT), event)


def _span_links(links: Column) -> Column:
    def link(e: Column) -> Column:
        return F.struct(
            j.string(e["traceId"]).alias("TraceId"),
            j.string(e["spanId"]).alias("SpanId"),
            j.attribute_map(e["attributes"]).alias("Attributes"),
        )

    return F.transform(_objects(links, SPAN_LINK), link)


def _objects(elements: Column, kind: str) -> Column:
    return F.filter(F.coalesce(elements, F.array().cast(f"array<{kind}>")), lambda e: e.isNotNull())
