import pytest

import rows
from rows import S
from spanlake.operators.logs import log_label_values, match_logs, search_logs
from spanlake.plans.queries import LabelMatcher, LineOp, LogQuery, MatchOp


@pytest.fixture(scope="module")
def table(spark):
    return rows.logs(
        spark,
        {"TimestampNano": 10 * S, "ServiceName": "web", "Body": "first\nline", "SeverityText": "INFO", "SpanId": "a"},
        {
            "TimestampNano": 11 * S + 1,
            "ServiceName": "web",
            "Body": "boom",
            "SeverityText": "ERROR",
            "SpanId": "b",
            "TraceId": "t",
            "ResourceAttributes": {"deployment.environment.name": "prod", "exception.group": "resource"},
            "LogAttributes": {"exception.group": "g1", "empty": "", "snake_case": "x"},
        },
        {
            "TimestampNano": 12 * S,
            "ServiceName": "api",
            "Body": "Boom",
            "SpanId": "c",
            "ResourceAttributes": {"exception.group": "resource"},
        },
    )


def found(table, query, start=0, end=100):
    return sorted(r.SpanId for r in match_logs(table, query, start, end).collect())


def test_bounds_are_inclusive_whole_seconds(table):
    assert found(table, LogQuery(), 10, 11) == ["a"]
    assert found(table, LogQuery(), 10.9, 12.9) == ["a", "b", "c"]
    assert found(table, LogQuery(), 11, 12) == ["b", "c"]


@pytest.mark.parametrize(
    ("label", "op", "value", "expected"),
    [
        ("service_name", MatchOp.EQ, "web", ["a", "b"]),
        ("exception_group", MatchOp.EQ, "resource", ["c"]),
        ("exception_group", MatchOp.EQ, "", ["a"]),
        ("exception_group", MatchOp.NEQ, "", ["b", "c"]),
        ("exception_group", MatchOp.NEQ, "g1", ["a", "c"]),
        ("exception_group", MatchOp.RE, "^$", ["a"]),
        ("exception_group", MatchOp.RE, "sou", ["c"]),
        ("exception_group", MatchOp.NRE, "g", ["a", "c"]),
        ("level", MatchOp.EQ, "ERROR", ["b"]),
        ("detected_level", MatchOp.NEQ, "ERROR", ["a", "c"]),
        ("severity_text", MatchOp.EQ, "INFO", ["a"]),
        ("trace_id", MatchOp.EQ, "t", ["b"]),
        ("span_id", MatchOp.EQ, "c", ["c"]),
        ("snake_case", MatchOp.EQ, "x", []),
    ],
)
def test_matchers(table, label, op, value, expected):
    matcher = LabelMatcher(label, op, value)
    assert found(table, LogQuery.stream(matcher)) == expected
    assert found(table, LogQuery().where_label(label, op, value)) == expected


@pytest.mark.parametrize(
    ("op", "value", "expected"),
    [
        (LineOp.CONTAINS, "oom", ["b", "c"]),
        (LineOp.CONTAINS, "Boom", ["c"]),
        (LineOp.CONTAINS, "b%", []),
        (LineOp.NOT_CONTAINS, "oom", ["a"]),
        (LineOp.REGEX, "first.line", ["a"]),
        (LineOp.REGEX, "^b", ["b"]),
        (LineOp.NOT_REGEX, "[bB]oom", ["a"]),
    ],
)
def test_line_filters(table, op, value, expected):
    assert found(table, LogQuery().line(op, value)) == expected


def test_stages_combine(table):
    api, error = LabelMatcher.eq("service_name", "api"), LabelMatcher.eq("level", "ERROR")
    assert found(table, LogQuery().where_any(api, error)) == ["b", "c"]
    assert found(table, LogQuery().where_all(api, error)) == []
    assert found(table, LogQuery.stream(error).line(LineOp.CONTAINS, "boom").where_any(api, error)) == ["b"]


def test_search_keeps_the_newest_and_returns_them_ascending(table):
    entries = search_logs(table, LogQuery(), 0, 100, limit=2).collect()
    assert [(e.timestamp_nano, e.line) for e in entries] == [(11 * S + 1, "boom"), (12 * S, "Boom")]
    assert entries[0].labels == {
        "service_name": "web",
        "trace_id": "t",
        "span_id": "b",
        "level": "ERROR",
        "deployment.environment.name": "prod",
        "deployment_environment_name": "prod",
        "exception.group": "g1",
        "exception_group": "g1",
        "snake_case": "x",
    }
    assert search_logs(table, LogQuery(), 0, 100, limit=0).count() == 1


def test_label_values(table):
    assert [r.value for r in log_label_values(table, "exception_group").collect()] == ["g1", "resource"]
    assert [r.value for r in log_label_values(table, "exception_group", 12, 13).collect()] == ["resource"]
    assert [r.value for r in log_label_values(table, "exception_group", 100).collect()] == ["g1", "resource"]
