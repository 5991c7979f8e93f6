"""OTLP/JSON payloads: golden rows, tolerance for odd shapes, and nothing that fails a job."""

import json

import pytest
from pyspark.sql import functions as F

from spanlake.functions.naming import prom_name
from spanlake.sources import otlp


def payloads(spark, *texts):
    rows = [(t if isinstance(t, str) else json.dumps(t),) for t in texts]
    return spark.createDataFrame(rows, "raw string")


def attribute(key, value):
    return {"key": key, "value": value}


def text(key, value):
    return attribute(key, {"stringValue": value})


def log_payload(**record):
    return {
        "resourceLogs": [
            {
                "resource": {"attributes": [text("service.name", "checkout"), text("env", "prod")]},
                "scopeLogs": [{"logRecords": [record]}],
            }
        ]
    }


def log_row(spark, **record):
    return otlp.parse_logs(payloads(spark, log_payload(**record))).collect()[0]


def span_row(spark, **span):
    body = {"resourceSpans": [{"scopeSpans": [{"spans": [span]}]}]}
    return otlp.parse_traces(payloads(spark, body)).collect()[0]


def test_log_record(spark):
    row = log_row(
        spark,
        timeUnixNano="1712345678123456789",
        severityText="ERROR",
        traceId="abc123",
        body={"stringValue": "page_view"},
        attributes=[text("session.id", "s-1"), text("exception.group", "g-9")],
    )
    assert (row.ServiceName, row.Body, row.SeverityText, row.TraceId) == ("checkout", "page_view", "ERROR", "abc123")
    assert row.TimestampNano == 1712345678123456789
    assert str(row.day) == "2024-04-05"
    assert row.ResourceAttributes == {"service.name": "checkout", "env": "prod"}
    assert row.LogAttributes == {"session.id": "s-1", "exception.group": "g-9"}
    assert (row.SpanId, row.SeverityNumber) == ("", 0)


def test_timestamp_is_utc_to_the_microsecond(spark):
    rows = otlp.parse_logs(payloads(spark, log_payload(timeUnixNano="1712345678123456789")))
    assert rows.select(F.date_format("Timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0] == "2024-04-05 19:34:38.123456"


@pytest.mark.parametrize(
    ("times", "nanos"),
    [
        ({"timeUnixNano": "0", "observedTimeUnixNano": "7"}, 0),
        ({"timeUnixNano": None, "observedTimeUnixNano": "7"}, 7),
        ({"observedTimeUnixNano": 8}, 8),
        ({}, 0),
        ({"timeUnixNano": "12.9"}, 12),
        ({"timeUnixNano": " 12 "}, 12),
        ({"timeUnixNano": "1e3"}, 1000),
        ({"timeUnixNano": 1.0}, 0),
        ({"timeUnixNano": True}, 0),
        ({"timeUnixNano": "12d"}, 0),
        ({"timeUnixNano": "soon"}, 0),
        ({"timeUnixNano": ["1"]}, 0),
        ({"timeUnixNano": "99999999999999999999"}, 9223372036854775807),
    ],
)
def test_times_are_read_tolerantly(spark, times, nanos):
    assert log_row(spark, **times).TimestampNano == nanos


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ({"stringValue": "x"}, "x"),
        ({"stringValue": ""}, ""),
        ({"stringValue": 7}, "7"),
        ({"stringValue": True}, "1"),
        ({"stringValue": ["x"]}, ""),
        ({"stringValue": "x", "intValue": 1}, "x"),
        ({"boolValue": True}, "true"),
        ({"boolValue": False}, "false"),
        ({"boolValue": "false"}, "true"),
        ({"boolValue": "0"}, "false"),
        ({"intValue": "42"}, "42"),
        ({"intValue": 42}, "42"),
        ({"doubleValue": 1.5}, "1.5"),
        ({"doubleValue": 1.0}, "1"),
        ({"bytesValue": "AQID"}, "AQID"),
        ({"stringValue": None, "intValue": 1}, ""),
        ({"other": 1}, ""),
        ({}, ""),
        ("bare", "bare"),
        (7, "7"),
        (True, "1"),
        (False, ""),
        (None, ""),
        ([1, 2], ""),
    ],
)
def test_any_value(spark, value, expected):
    row = log_row(spark, body=value, attributes=[attribute("k", value)])
    assert row.Body == expected
    assert row.LogAttributes == {"k": expected}


@pytest.mark.parametrize(
    "value",
    [
        {"arrayValue": {"values": [{"stringValue": "a/b"}, {"intValue": "1"}]}},
        {"kvlistValue": {"values": [{"key": "k", "value": {"boolValue": True}}]}},
    ],
)
def test_nested_values_keep_their_wrapper(spark, value):
    assert json.loads(log_row(spark, body=value).Body) == value


def test_attributes_skip_noise_and_keep_the_last_of_equal_keys(spark):
    row = log_row(
        spark, attributes=[text("a", "1"), "noise", None, {"value": 1}, attribute("", {}), attribute(5, {}), text("a", "2")]
    )
    assert row.LogAttributes == {"a": "2"}
    assert log_row(spark, attributes="none").LogAttributes == {}


@pytest.mark.parametrize(
    "payload",
    ["{}", "[]", "null", "17", '"text"', '{"resourceLogs": "nonsense"}', '{"resourceLogs": [1, null, {"scopeLogs": 3}]}'],
)
def test_other_shapes_give_no_rows(spark, payload):
    raw = payloads(spark, payload)
    assert otlp.parse_logs(raw).count() == 0
    assert otlp.parse_traces(raw).count() == 0
    assert [t.count() for t in vars(otlp.parse_metrics(raw)).values()] == [0, 0, 0]
    assert otlp.bad_payloads(raw).count() == 0


def test_text_that_is_no_json_is_set_aside(spark):
    raw = payloads(spark, "{broken", log_payload(body="fine"), "")
    assert sorted(r.raw for r in otlp.bad_payloads(raw).collect()) == ["", "{broken"]
    assert otlp.parse_logs(raw).count() == 1


def test_missing_service_and_alternate_names(spark):
    body = {
        "resourceLogs": [
            {"scopeLogs": 3, "instrumentationLibraryLogs": [{"log_records": [{"body": "x"}, "noise", {}]}]},
        ]
    }
    rows = otlp.parse_logs(payloads(spark, body)).collect()
    assert sorted(r.Body for r in rows) == ["", "x"]
    assert {r.ServiceName for r in rows} == {"unknown_service"}


def test_repeated_json_key_keeps_the_last(spark):
    text = '{"resourceLogs": 1, "resourceLogs": [{"scopeLogs": [{"logRecords": [{}]}]}]}'
    assert otlp.parse_logs(payloads(spark, text)).count() == 1


def test_span(spark):
    row = span_row(
        spark,
        traceId="t1",
        spanId="s1",
        name="GET /",
        kind=2,
        startTimeUnixNano="1000",
        endTimeUnixNano="3000",
        status={"code": 2, "message": "boom"},
        attributes=[text("http.route", "/")],
        events=[{"timeUnixNano": "5", "name": "e", "attributes": [text("a", "b")]}, "noise"],
        links=[{"traceId": "t0", "spanId": "s0"}, {"attributes": [text("c", "d")]}],
    )
    assert (row.SpanKind, row.StatusCode, row.StatusMessage, row.Duration) == ("Server", "Error", "boom", 2000)
    assert row.SpanAttributes == {"http.route": "/"}
    assert [(e.TimestampNano, e.Name, e.Attributes) for e in row.Events] == [(5, "e", {"a": "b"})]
    assert [(link.TraceId, link.SpanId, link.Attributes) for link in row.Links] == [("t0", "s0", {}), ("", "", {"c": "d"})]


def test_durations_are_never_negative(spark):
    assert span_row(spark, startTimeUnixNano="9", endTimeUnixNano="3").Duration == 0
    assert span_row(spark, startTimeUnixNano=str(-(2**63)), endTimeUnixNano=str(2**63 - 1)).Duration == 0


@pytest.mark.parametrize(
    ("kind", "expected"),
    [
        (1, "Internal"), (2, "Server"), (3, "Client"), (4, "Producer"), (5, "Consumer"),
        ("SPAN_KIND_INTERNAL", "Internal"), ("SPAN_KIND_SERVER", "Server"), ("SPAN_KIND_CLIENT", "Client"),
        ("SPAN_KIND_PRODUCER", "Producer"), ("SPAN_KIND_CONSUMER", "Consumer"),
        (0, "Unspecified"), (9, "Unspecified"), ("2", "Unspecified"), (None, "Unspecified"), (2.0, "Unspecified"),
    ],
)
def test_span_kinds(spark, kind, expected):
    assert span_row(spark, kind=kind).SpanKind == expected


@pytest.mark.parametrize(
    ("status", "expected"),
    [
        ({"code": 1}, "Ok"), ({"code": 2}, "Error"), ({"code": "STATUS_CODE_OK"}, "Ok"),
        ({"code": "STATUS_CODE_ERROR"}, "Error"), ({"code": 0}, "Unset"), ({"code": "2"}, "Unset"), ({}, "Unset"),
        ("broken", "Unset"), (None, "Unset"),
    ],
)
def test_status_codes(spark, status, expected):
    assert span_row(spark, status=status).StatusCode == expected


def metrics(spark, *definitions):
    body = {
        "resourceMetrics": [
            {"resource": {"attributes": [text("service.name", "api")]}, "scopeMetrics": [{"metrics": list(definitions)}]}
        ]
    }
    return otlp.parse_metrics(payloads(spark, body))


def test_metric_points(spark):
    out = metrics(
        spark,
        {
            "name": "queue.jobs.processed",
            "sum": {
                "isMonotonic": True,
                "aggregationTemporality": 2,
                "dataPoints": [{"timeUnixNano": "1000000000", "asInt": "42", "attributes": [text("queue", "default")]}],
            },
        },
        {"name": "queue.depth", "gauge": {"data_points": [{"timeUnixNano": "1000000000", "asInt": "7"}]}},
        {
            "name": "http.server.request.duration",
            "unit": "ms",
            "histogram": {
                "dataPoints": [
                    {
                        "timeUnixNano": "1000000000",
                        "startTimeUnixNano": "500",
                        "count": "3",
                        "sum": 12.0,
                        "bucketCounts": ["1", "2"],
                        "explicit_bounds": [10.0],
                    }
                ]
            },
        },
        {"name": "dropped", "summary": {"dataPoints": [{}]}},
    )
    (total,), (gauge,), (hist,) = out.sum.collect(), out.gauge.collect(), out.histogram.collect()
    assert (total.MetricName, total.Value, total.IsMonotonic) == ("queue_jobs_processed_total", 42.0, True)
    assert (total.Attributes, total.AggregationTemporality, total.ServiceName) == ({"queue": "default"}, 2, "api")
    assert (gauge.MetricName, gauge.Value) == ("queue_depth", 7.0)
    assert (hist.MetricName, hist.Count, hist.Sum) == ("http_server_request_duration_milliseconds", 3, 12.0)
    assert (hist.BucketCounts, hist.ExplicitBounds, hist.StartTimestampNano) == ([1, 2], [10.0], 500)


@pytest.mark.parametrize(
    ("point", "value"),
    [
        ({"asInt": 3, "asDouble": 9.5}, 3.0),
        ({"asInt": None, "asDouble": 9.5}, 0.0),
        ({"asInt": "x", "asDouble": 9.5}, 0.0),
        ({"asDouble": 9.5}, 9.5),
        ({"asDouble": "1e2"}, 100.0),
        ({"asDouble": "NaN"}, 0.0),
        ({"asDouble": True}, 0.0),
        ({}, 0.0),
        ("noise", 0.0),
    ],
)
def test_number_points(spark, point, value):
    (row,) = metrics(spark, {"name": "m", "gauge": {"dataPoints": [point]}}).gauge.collect()
    assert row.Value == value


@pytest.mark.parametrize(
    ("flag", "expected"),
    [(True, True), (False, False), (1, True), (0, False), (0.0, False), (0.5, True), ("true", True), ("false", True),
     ("0", False), ("", False), (None, False), ([], False), ([0], True), ({}, False), ({"a": 0}, True)],
)
def test_monotonic_flag_is_read_loosely(spark, flag, expected):
    (row,) = metrics(spark, {"name": "m", "sum": {"isMonotonic": flag, "dataPoints": [{}]}}).sum.collect()
    assert (row.IsMonotonic, row.MetricName) == (expected, "m_total" if expected else "m")


def test_first_metric_kind_wins_and_only_sums_are_totals(spark):
    both = {"name": "m", "sum": {"isMonotonic": False, "dataPoints": [{}]}, "gauge": {"dataPoints": [{}]}}
    out = metrics(spark, both)
    assert [r.MetricName for r in out.sum.collect()] == ["m"]
    assert out.gauge.count() == 0


@pytest.mark.parametrize(
    ("name", "unit", "monotonic", "expected"),
    [
        ("db.queries", "", True, "db_queries_total"),
        ("http.server.request.duration", "ms", False, "http_server_request_duration_milliseconds"),
        ("http.server.memory.peak", "By", False, "http_server_memory_peak_bytes"),
        ("system.cpu.utilization", "1", False, "system_cpu_utilization"),
        ("queue.size", "{jobs}", False, "queue_size"),
        ("io", "By/s", True, "io_bytes_per_second_total"),
        ("load", "%", False, "load_percent"),
        ("wait", "s", False, "wait_seconds"),
        ("size", "bytes", False, "size_bytes"),
    ],
)
def test_prometheus_names(spark, name, unit, monotonic, expected):
    column = prom_name(F.lit(name), F.lit(unit), F.lit(monotonic))
    assert spark.range(1).select(column).first()[0] == expected
