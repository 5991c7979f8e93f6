"""The fixed table schemas: five signal tables and the per-minute statement rollup.

Absent values are stored as ``''`` / ``0`` / empty collections, never NULL. Time has two columns: ``Timestamp``
(microseconds, for people) and ``TimestampNano`` (exact epoch nanoseconds, the one operators filter and sort by).
``day`` is the partition column.
"""

from __future__ import annotations

from pyspark.sql import types as T

STRING, BIGINT, INT, DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
BOOLEAN, TIMESTAMP, DATE = T.BooleanType(), T.TimestampType(), T.DateType()
ATTRIBUTES = T.MapType(STRING, STRING)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


LOGS = _struct(
    Timestamp=TIMESTAMP,
    TimestampNano=BIGINT,
    TraceId=STRING,
    SpanId=STRING,
    SeverityText=STRING,
    SeverityNumber=INT,
    ServiceName=STRING,
    Body=STRING,
    ResourceAttributes=ATTRIBUTES,
    LogAttributes=ATTRIBUTES,
    day=DATE,
)

SPAN_EVENT = _struct(Timestamp=TIMESTAMP, TimestampNano=BIGINT, Name=STRING, Attributes=ATTRIBUTES)
SPAN_LINK = _struct(TraceId=STRING, SpanId=STRING, Attributes=ATTRIBUTES)

TRACES = _struct(
    Timestamp=TIMESTAMP,
    TimestampNano=BIGINT,
    TraceId=STRING,
    SpanId=STRING,
    ParentSpanId=STRING,
    SpanName=STRING,
    SpanKind=STRING,
    ServiceName=STRING,
    ResourceAttributes=ATTRIBUTES,
    SpanAttributes=ATTRIBUTES,
    Duration=BIGINT,
    StatusCode=STRING,
    StatusMessage=STRING,
    Events=T.ArrayType(SPAN_EVENT),
    Links=T.ArrayType(SPAN_LINK),
    day=DATE,
)

_POINT = {
    "Timestamp": TIMESTAMP,
    "TimestampNano": BIGINT,
    "StartTimestamp": TIMESTAMP,
    "StartTimestampNano": BIGINT,
    "MetricName": STRING,
    "ServiceName": STRING,
    "ResourceAttributes": ATTRIBUTES,
    "Attributes": ATTRIBUTES,
}

METRICS_SUM = _struct(**_POINT, Value=DOUBLE, AggregationTemporality=INT, IsMonotonic=BOOLEAN, day=DATE)
METRICS_GAUGE = _struct(**_POINT, Value=DOUBLE, day=DATE)
METRICS_HISTOGRAM = _struct(
    **_POINT,
    Count=BIGINT,
    Sum=DOUBLE,
    BucketCounts=T.ArrayType(BIGINT),
    ExplicitBounds=T.ArrayType(DOUBLE),
    AggregationTemporality=INT,
    day=DATE,
)

# points of every kind in one form, as they are written in one job; columns of other kinds are null
METRICS_ANY = _struct(
    **_POINT,
    Value=DOUBLE,
    Count=BIGINT,
    Sum=DOUBLE,
    BucketCounts=T.ArrayType(BIGINT),
    ExplicitBounds=T.ArrayType(DOUBLE),
    AggregationTemporality=INT,
    IsMonotonic=BOOLEAN,
    day=DATE,
    table=STRING,
)

DURATION_COUNT = _struct(low=BIGINT, high=BIGINT, n=BIGINT)

SUMMARY = _struct(
    Bucket=TIMESTAMP,
    QueryText=STRING,
    DbSystem=STRING,
    Calls=BIGINT,
    DurationSum=T.DecimalType(38, 0),
    DurationMax=BIGINT,
    DurationCounts=T.ArrayType(DURATION_COUNT),
    day=DATE,
)

# Table names with their schema and the columns rows are clustered by inside a day.
TABLES = {
    "otel_logs": (LOGS, ("ServiceName", "TimestampNano")),
    "otel_traces": (TRACES, ("ServiceName", "SpanName", "TimestampNano")),
    "otel_metrics_sum": (METRICS_SUM, ("MetricName", "ServiceName", "TimestampNano")),
    "otel_metrics_gauge": (METRICS_GAUGE, ("MetricName", "ServiceName", "TimestampNano")),
    "otel_metrics_histogram": (METRICS_HISTOGRAM, ("MetricName", "ServiceName", "TimestampNano")),
    "otel_db_query_summary": (SUMMARY, ("Bucket", "DbSystem", "QueryText")),
}
