"""Signal tables derived from the given ``events`` (and ``lineitem``, ``documents``) tables.

Each adapter has a SQL twin in ``oracles``; both are written from the same description in ``FIXTURES.md``. Running totals
are taken over pre-aggregated minutes or hours, so that no window holds more rows per service than there are time slots.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanlake import schemas
from spanlake.functions.times import timestamp_of
from spanlake.operators.metrics import MetricTables
from spanlake.session import configure

# the period of the events table
START = dt.datetime(2024, 1, 1)
END = dt.datetime(2024, 2, 1)

# Histogram bounds in milliseconds; one service reports coarser ones.
BOUNDS = [5.0, 10.0, 25.0, 50.0, 100.0, 250.0]
COARSE_BOUNDS = [10.0, 100.0]
COARSE_SERVICE = "svc-6"

# a payload holds the events of one resource among this many consecutive ones
PAYLOAD_EVENTS = 1024


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    nanos = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    return _read(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        "props",
        nanos.alias("ns"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("bigint").alias("k"),
        _service().alias("service"),
        F.concat(F.lit("t"), F.floor(F.col("event_id") / 8).cast("string")).alias("trace_id"),
        F.concat(F.lit("s"), F.col("event_id").cast("string")).alias("span_id"),
    )


def _service() -> Column:
    return F.concat(F.lit("svc-"), (F.col("user_id") % 7).cast("string"))


def _resource() -> Column:
    environment = F.when(F.col("user_id") % 3 == 0, "prod").when(F.col("user_id") % 3 == 1, "staging").otherwise("dev")
    return F.create_map(
        F.lit("service.name"), F.col("service"), F.lit("deployment.environment.name"), environment
    )


def _no_attributes() -> Column:
    return F.create_map().cast("map<string,string>")


def _some(condition: Column, value: Column) -> Column:
    """The value, or an empty collection of its type."""
    return F.when(condition, F.array(value)).otherwise(F.filter(F.array(value), lambda _: F.lit(False)))


def _table(rows: DataFrame, schema: schemas.T.StructType, columns: dict[str, Column]) -> DataFrame:
    shared = {
        "Timestamp": timestamp_of(F.col("ns")),
        "TimestampNano": F.col("ns"),
        "ServiceName": F.col("service"),
        "day": F.to_date(timestamp_of(F.col("ns"))),
    }
    values = shared | columns
    return rows.select(*(values[f.name].cast(f.dataType).alias(f.name) for f in schema.fields))


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    error = F.col("event_type") == "error"
    session = F.create_map(F.lit("session.id"), F.concat(F.lit("u"), F.col("user_id").cast("string")))
    group = F.create_map(F.lit("exception.group"), F.concat(F.lit("g"), (F.col("k") % 10).cast("string")))
    body = F.concat(F.col("event_type"), F.lit(" user="), F.col("user_id"), F.lit(" props="), F.col("props"))
    return _table(
        events(spark, sf_dir),
        schemas.LOGS,
        {
            "TraceId": F.col("trace_id"),
            "SpanId": F.col("span_id"),
            "SeverityText": F.when(error, "ERROR").when(F.col("event_type") == "signup", "WARN").otherwise("INFO"),
            "SeverityNumber": F.when(error, 17).when(F.col("event_type") == "signup", 13).otherwise(9),
            "Body": body,
            "ResourceAttributes": _resource(),
            "LogAttributes": F.when(error, F.map_concat(session, group)).otherwise(session),
        },
    )


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    purchase, error = kind == "purchase", kind == "error"
    event_id, k = F.col("event_id"), F.col("k")
    http = F.create_map(
        F.lit("http.route"), F.concat(F.lit("/"), kind),
        F.lit("http.response.status_code"), F.when(error, "500").otherwise("200"),
    )
    db = F.create_map(
        F.lit("db.query.text"), F.concat(F.lit("select * from t"), (k % 10).cast("string"), F.lit(" where id = ?")),
        F.lit("db.system.name"), F.when(k % 2 == 0, "mysql").otherwise("postgresql"),
    )
    exception = F.struct(
        timestamp_of(F.col("ns") + 1000).alias("Timestamp"),
        (F.col("ns") + 1000).alias("TimestampNano"),
        F.lit("exception").alias("Name"),
        F.create_map(F.lit("exception.type"), F.concat(F.lit("E"), (k % 10).cast("string"))).alias("Attributes"),
    )
    previous = F.concat(F.lit("t"), (F.floor(event_id / 8) - 1).cast("string"))
    link = F.struct(
        F.when(event_id % 10 == 0, previous).otherwise("").alias("TraceId"),
        F.concat(F.lit("s"), (event_id - 8).cast("string")).alias("SpanId"),
        _no_attributes().alias("Attributes"),
    )
    parent = F.concat(F.lit("s"), (event_id - event_id % 8).cast("string"))
    return _table(
        events(spark, sf_dir),
        schemas.TRACES,
        {
            "TraceId": F.col("trace_id"),
            "SpanId": F.col("span_id"),
            "ParentSpanId": F.when(event_id % 8 == 0, "").otherwise(parent),
            "SpanName": F.when(purchase, "db.query").otherwise(F.concat(F.lit("GET /"), kind)),
            "SpanKind": F.when(purchase, "Client").otherwise("Server"),
            "ResourceAttributes": _resource(),
            "SpanAttributes": F.when(purchase, F.map_concat(http, db)).otherwise(http),
            "Duration": F.round(F.col("value") * 1_000_000).cast("bigint"),
            "StatusCode": F.when(error, "Error").when(kind == "signup", "Ok").otherwise("Unset"),
            "StatusMessage": F.when(error, "failed").otherwise(""),
            "Events": _some(error, exception),
            "Links": _some(event_id % 5 == 0, link),
        },
    )


def line_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many spans with a high-cardinality attribute, from the order lines."""
    rows = _read(spark, sf_dir, "lineitem").select(
        "*",
        (F.unix_micros(F.col("l_shipdate").cast("timestamp")) * 1000).alias("ns"),
        F.concat(F.lit("supp-"), (F.col("l_suppkey") % 7).cast("string")).alias("service"),
    )
    empty = {
        f.name: F.array().cast(f.dataType) for f in schemas.TRACES.fields if isinstance(f.dataType, schemas.T.ArrayType)
    }
    key = F.col("l_orderkey").cast("string")
    return _table(
        rows,
        schemas.TRACES,
        empty
        | {
            "TraceId": key,
            "SpanId": F.concat(key, F.lit("-"), F.col("l_linenumber").cast("string")),
            "ParentSpanId": F.lit(""),
            "SpanName": F.concat("l_returnflag", "l_linestatus"),
            "SpanKind": F.lit("Internal"),
            "ResourceAttributes": _no_attributes(),
            "SpanAttributes": F.create_map(F.lit("part"), F.col("l_partkey").cast("string")),
            "Duration": F.round(F.col("l_extendedprice") * 1000).cast("bigint"),
            "StatusCode": F.lit("Unset"),
            "StatusMessage": F.lit(""),
        },
    )


def document_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long log bodies, one per document, a second apart."""
    rows = _read(spark, sf_dir, "documents").select(
        "*",
        ((F.lit(1704067200) + F.col("doc_id")) * 1_000_000_000).alias("ns"),
        F.col("source").alias("service"),
    )
    return _table(
        rows,
        schemas.LOGS,
        {
            "TraceId": F.lit(""),
            "SpanId": F.concat(F.lit("d"), F.col("doc_id").cast("string")),
            "SeverityText": F.lit("INFO"),
            "SeverityNumber": F.lit(9),
            "Body": F.col("text"),
            "ResourceAttributes": _no_attributes(),
            "LogAttributes": F.create_map(F.lit("lang"), F.col("lang")),
        },
    )


def _slots(rows: DataFrame, seconds: int) -> DataFrame:
    """The start of the time slot an event falls into, as ``ns``."""
    width = seconds * 1_000_000_000
    return rows.withColumn("ns", F.col("ns") - F.pmod(F.col("ns"), F.lit(width)))


def metric_tables(spark: SparkSession, sf_dir: str) -> MetricTables:
    rows = events(spark, sf_dir)
    return MetricTables(sum=_counter(rows), gauge=_gauge(rows), histogram=_histogram(rows))


def _point(name: str, attributes: Column, **columns: Column) -> dict[str, Column]:
    start = F.lit(int(START.replace(tzinfo=dt.timezone.utc).timestamp()) * 1_000_000_000)
    return {
        "StartTimestamp": timestamp_of(start),
        "StartTimestampNano": start,
        "MetricName": F.lit(name),
        "ResourceAttributes": F.create_map(F.lit("service.name"), F.col("service")),
        "Attributes": attributes,
    } | columns


def _event_type() -> Column:
    return F.create_map(F.lit("event.type"), F.col("event_type"))


def _counter(rows: DataFrame) -> DataFrame:
    """``events_total``: events seen so far per service and type, reported every minute."""
    minutes = _slots(rows, 60).groupBy("service", "event_type", "ns").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("service", "event_type").orderBy("ns"))
    return _table(
        minutes.withColumn("total", total),
        schemas.METRICS_SUM,
        _point(
            "events_total",
            _event_type(),
            Value=F.col("total").cast("double"),
            AggregationTemporality=F.lit(2),
            IsMonotonic=F.lit(True),
        ),
    )


def _gauge(rows: DataFrame) -> DataFrame:
    """``queue_depth``: the value of every event."""
    return _table(rows, schemas.METRICS_GAUGE, _point("queue_depth", _event_type(), Value=F.col("value")))


def _histogram(rows: DataFrame) -> DataFrame:
    """``request_duration_milliseconds``: hourly buckets per service, count and sum running."""
    hours = _slots(rows, 3600).groupBy("service", "ns").agg(
        F.count("*").alias("n"),
        F.sum(F.round(F.col("value") * 1_000_000).cast("bigint")).alias("nanos"),
        *(F.count_if(_in_bucket(i, BOUNDS)).alias(f"b{i}") for i in range(len(BOUNDS) + 1)),
        *(F.count_if(_in_bucket(i, COARSE_BOUNDS)).alias(f"c{i}") for i in range(len(COARSE_BOUNDS) + 1)),
    )
    so_far = Window.partitionBy("service").orderBy("ns")
    coarse = F.col("service") == COARSE_SERVICE
    fine_buckets = F.array(*(f"b{i}" for i in range(len(BOUNDS) + 1)))
    coarse_buckets = F.array(*(f"c{i}" for i in range(len(COARSE_BOUNDS) + 1)))
    hours = hours.select(
        "service",
        "ns",
        F.sum("n").over(so_far).alias("count"),
        (F.sum("nanos").over(so_far) / 1_000_000).alias("total"),
        F.when(coarse, coarse_buckets).otherwise(fine_buckets).alias("buckets"),
        F.when(coarse, F.array(*map(F.lit, COARSE_BOUNDS))).otherwise(F.array(*map(F.lit, BOUNDS))).alias("bounds"),
    )
    return _table(
        hours,
        schemas.METRICS_HISTOGRAM,
        _point(
            "request_duration_milliseconds",
            F.create_map(F.lit("job"), F.lit("api")),
            Count=F.col("count"),
            Sum=F.col("total"),
            BucketCounts=F.col("buckets"),
            ExplicitBounds=F.col("bounds"),
            AggregationTemporality=F.lit(2),
        ),
    )


def _in_bucket(i: int, bounds: list[float]) -> Column:
    above = F.lit(True) if i == 0 else F.col("value") > bounds[i - 1]
    below = F.lit(True) if i == len(bounds) else F.col("value") <= bounds[i]
    return above & below


# --- OTLP/JSON payloads -------------------------------------------------------------------------------------------


def _attributes(attributes: Column) -> Column:
    """A map as an OTLP attribute list."""
    return F.transform(
        F.map_entries(attributes),
        lambda e: F.struct(e["key"].alias("key"), F.struct(e["value"].alias("stringValue")).alias("value")),
    )


def _payloads(rows: DataFrame, envelope: str, scope: str, leaf: str, item: Column) -> DataFrame:
    """One payload per resource and block of consecutive events, which bounds its size."""
    grouped = rows.groupBy(F.to_json("ResourceAttributes").alias("res"), "block")
    packed = grouped.agg(F.collect_list(item).alias(leaf))
    resource = F.struct(_attributes(F.from_json("res", "map<string,string>")).alias("attributes"))
    envelopes = F.array(F.struct(resource.alias("resource"), F.array(F.struct(leaf)).alias(scope)))
    return packed.select(F.to_json(F.struct(envelopes.alias(envelope))).alias("raw"))


def _block(column: str) -> Column:
    return F.floor(F.regexp_replace(column, "^[a-z]+", "").cast("bigint") / PAYLOAD_EVENTS)


def log_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = F.struct(
        F.col("TimestampNano").cast("string").alias("timeUnixNano"),
        F.col("TraceId").alias("traceId"),
        F.col("SpanId").alias("spanId"),
        F.col("SeverityText").alias("severityText"),
        F.col("SeverityNumber").alias("severityNumber"),
        F.struct(F.col("Body").alias("stringValue")).alias("body"),
        _attributes(F.col("LogAttributes")).alias("attributes"),
    )
    rows = logs(spark, sf_dir).withColumn("block", _block("SpanId"))
    return _payloads(rows, "resourceLogs", "scopeLogs", "logRecords", record)


def span_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("SpanKind") == "Client", 3).otherwise(2)
    status = F.when(F.col("StatusCode") == "Error", 2).when(F.col("StatusCode") == "Ok", 1).otherwise(0)
    event = F.transform(
        "Events",
        lambda e: F.struct(
            e["TimestampNano"].cast("string").alias("timeUnixNano"),
            e["Name"].alias("name"),
            _attributes(e["Attributes"]).alias("attributes"),
        ),
    )
    link = F.transform(
        "Links",
        lambda e: F.struct(
            e["TraceId"].alias("traceId"), e["SpanId"].alias("spanId"), _attributes(e["Attributes"]).alias("attributes")
        ),
    )
    span = F.struct(
        F.col("TraceId").alias("traceId"),
        F.col("SpanId").alias("spanId"),
        F.col("ParentSpanId").alias("parentSpanId"),
        F.col("SpanName").alias("name"),
        kind.alias("kind"),
        F.col("TimestampNano").cast("string").alias("startTimeUnixNano"),
        (F.col("TimestampNano") + F.col("Duration")).cast("string").alias("endTimeUnixNano"),
        F.struct(status.alias("code"), F.col("StatusMessage").alias("message")).alias("status"),
        _attributes(F.col("SpanAttributes")).alias("attributes"),
        event.alias("events"),
        link.alias("links"),
    )
    rows = spans(spark, sf_dir).withColumn("block", _block("SpanId"))
    return _payloads(rows, "resourceSpans", "scopeSpans", "spans", span)


def metric_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload per point. Counts are text and sums numbers, as emitters write them."""
    tables = metric_tables(spark, sf_dir)
    times = (
        F.col("TimestampNano").cast("string").alias("timeUnixNano"),
        F.col("StartTimestampNano").cast("string").alias("startTimeUnixNano"),
        _attributes(F.col("Attributes")).alias("attributes"),
    )
    counter = F.struct(
        F.lit("events").alias("name"),
        F.struct(
            F.lit(True).alias("isMonotonic"),
            F.lit(2).alias("aggregationTemporality"),
            F.array(F.struct(*times, F.col("Value").cast("bigint").cast("string").alias("asInt"))).alias("dataPoints"),
        ).alias("sum"),
    )
    gauge = F.struct(
        F.lit("queue.depth").alias("name"),
        F.struct(F.array(F.struct(*times, F.col("Value").alias("asDouble"))).alias("dataPoints")).alias("gauge"),
    )
    histogram = F.struct(
        F.lit("request.duration").alias("name"),
        F.lit("ms").alias("unit"),
        F.struct(
            F.lit(2).alias("aggregationTemporality"),
            F.array(
                F.struct(
                    *times,
                    F.col("Count").cast("string").alias("count"),
                    F.col("Sum").alias("sum"),
                    F.col("BucketCounts").cast("array<string>").alias("bucketCounts"),
                    F.col("ExplicitBounds").alias("explicitBounds"),
                )
            ).alias("dataPoints"),
        ).alias("histogram"),
    )

    def payloads(rows: DataFrame, metric: Column) -> DataFrame:
        resource = F.struct(_attributes(F.col("ResourceAttributes")).alias("attributes"))
        scopes = F.array(F.struct(F.array(metric).alias("metrics")))
        envelopes = F.array(F.struct(resource.alias("resource"), scopes.alias("scopeMetrics")))
        return rows.select(F.to_json(F.struct(envelopes.alias("resourceMetrics"))).alias("raw"))

    return (
        payloads(tables.sum, counter)
        .unionAll(payloads(tables.gauge, gauge))
        .unionAll(payloads(tables.histogram, histogram))
    )


def odd_payloads(spark: SparkSession, sf_dir: str, template: str) -> DataFrame:
    """One hand-written payload per event: ``template`` with ``{id}``, ``{ns}``, ``{k}`` and ``{type}`` filled in."""
    text = F.lit(template)
    for name, column in (("id", "event_id"), ("ns", "ns"), ("k", "k"), ("type", "event_type")):
        text = F.replace(text, F.lit("{" + name + "}"), F.col(column).cast("string"))
    return events(spark, sf_dir).select(text.alias("raw"))
