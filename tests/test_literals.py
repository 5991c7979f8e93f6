"""Literals, routing and refused queries: all plain Python, decided before a plan is built."""

import datetime as dt

import pytest

from spanlake.functions import literals
from spanlake.functions.times import epoch_seconds
from spanlake.operators import logs, metrics, spans, traces
from spanlake.plans import routing
from spanlake.plans.queries import (
    LabelFilter,
    LabelMatcher,
    LogQuery,
    MatchOp,
    MetricQuery,
    SpanAggregation,
    TraceCondition,
    TraceOp,
    TraceQuery,
    UnsupportedQuery,
)


@pytest.mark.parametrize(
    ("text", "nanos"),
    [
        ("100ms", 100_000_000), ("5s", 5_000_000_000), ("250us", 250_000), ("250µs", 250_000), ("7ns", 7),
        ("2m", 120_000_000_000), ("1.5h", 5_400_000_000_000), ("3", 3_000_000), (" 4 ms ", 4_000_000),
        ("0.5ns", 1), ("1.2.3ms", 1_200_000), (".", 0), ("fast", 0), ("-1ms", 0), ("", 0),
    ],
)
def test_durations(text, nanos):
    assert literals.duration_ns(text) == nanos


@pytest.mark.parametrize(
    ("text", "value"),
    [("500", 500), ("1.9", 1), ("-1.9", -1), ("5e2", 500), (" 7 ", 7), (".5", 0), ("x", 0), ("1x", 0), ("", 0)],
)
def test_integers(text, value):
    assert literals.integer(text) == value


@pytest.mark.parametrize(
    ("window", "seconds"),
    [("30s", 30), ("5m", 300), ("2h", 7200), ("1d", 86400), ("", 60), ("5", 60), ("5w", 60), ("1.5m", 60)],
)
def test_windows(window, seconds):
    assert literals.window_seconds(window, 60) == seconds


@pytest.mark.parametrize(
    ("fragment", "matcher"),
    [
        ('service_name="web"', LabelMatcher("service_name", MatchOp.EQ, "web")),
        (' env != "prod" ', LabelMatcher("env", MatchOp.NEQ, "prod")),
        ('route=~"/a.*"', LabelMatcher("route", MatchOp.RE, "/a.*")),
        ('route!~"x"', LabelMatcher("route", MatchOp.NRE, "x")),
        (r'path="a\"b\\c\n\x41\101"', LabelMatcher("path", MatchOp.EQ, 'a"b\\c\nAA')),
    ],
)
def test_matcher_fragments(fragment, matcher):
    assert literals.matcher_fragment(fragment) == matcher


@pytest.mark.parametrize("fragment", ["service_name", 'a>"b"', "a='b'", 'a.b="c"', ""])
def test_other_fragments_are_refused(fragment):
    with pytest.raises(UnsupportedQuery):
        literals.matcher_fragment(fragment)


@pytest.mark.parametrize(
    ("name", "part", "base"),
    [
        ("http_duration_milliseconds_bucket", "bucket", "http_duration_milliseconds"),
        ("http_duration_count", "count", "http_duration"),
        ("http_duration_sum", "sum", "http_duration"),
        ("queue_depth", None, "queue_depth"),
        ("account", None, "account"),
    ],
)
def test_histogram_names(name, part, base):
    assert routing.histogram_part(name) == part
    assert routing.base_name(name) == base


@pytest.mark.parametrize(
    ("query", "table"),
    [
        (MetricQuery("h_bucket").rate("1m"), "histogram"),
        (MetricQuery("h_count"), "histogram"),
        (MetricQuery("jobs_total").rate("1m"), "sum"),
        (MetricQuery("jobs_total").increase("1m"), "sum"),
        (MetricQuery("jobs_total").counter_increase("1m"), "sum"),
        (MetricQuery("queue_depth"), "gauge"),
        (MetricQuery("h").at_quantile(0.9), "histogram"),
    ],
)
def test_metric_tables(query, table):
    assert routing.metric_table(query) == table


PRESENT = TraceCondition.present("span.db.query.text")


@pytest.mark.parametrize(
    ("conditions", "group_by", "carry", "applies"),
    [
        ((PRESENT,), "span.db.query.text", ("span.db.system.name",), True),
        ((), "span.db.query.text", (), True),
        ((PRESENT, TraceCondition.token("duration", TraceOp.GT, "50ms")), "span.db.query.text", (), False),
        ((TraceCondition("span.db.query.text", TraceOp.NEQ, "nil"),), "span.db.query.text", (), False),
        ((PRESENT,), "span.http.route", (), False),
        ((PRESENT,), "span.db.query.text", ("span.http.route",), False),
    ],
)
def test_rollup_routing(conditions, group_by, carry, applies):
    assert routing.rollup_answers(SpanAggregation(TraceQuery(conditions), group_by, carry)) is applies


def test_auto_step():
    assert metrics.auto_step(0, 60) == 15
    assert metrics.auto_step(0, 86400) == 346
    assert metrics.auto_step(0, 86500) == 346


def test_instants():
    assert epoch_seconds(dt.datetime(1970, 1, 2)) == 86400
    assert epoch_seconds(dt.datetime(1970, 1, 2, 1, tzinfo=dt.timezone(dt.timedelta(hours=1)))) == 86400
    assert epoch_seconds(12.9) == 12


def test_raw_queries_are_refused():
    with pytest.raises(UnsupportedQuery):
        logs.search_logs(None, LogQuery(raw='{a="b"}'), 0, 1)
    with pytest.raises(UnsupportedQuery):
        traces.search_traces(None, TraceQuery(raw="{}"), 0, 1)
    with pytest.raises(UnsupportedQuery):
        metrics.instant(None, MetricQuery("up", raw="up"), 1)
    with pytest.raises(UnsupportedQuery):
        metrics.range_query(None, MetricQuery("up", raw="up"), 0, 1)


def test_unsupported_stages_are_refused(spark):
    from spanlake import schemas

    table = spark.createDataFrame([], schemas.LOGS)
    with pytest.raises(UnsupportedQuery):
        logs.search_logs(table, LogQuery(pipeline=("json",)), 0, 1)
    with pytest.raises(UnsupportedQuery):
        logs.search_logs(table, LogQuery(pipeline=(LabelFilter(()),)), 0, 1)
    table = spark.createDataFrame([], schemas.TRACES)
    with pytest.raises(UnsupportedQuery):
        spans.aggregate_spans(table, SpanAggregation(TraceQuery(raw="{}"), "name"), 0, 1)
    with pytest.raises(UnsupportedQuery):
        spans.aggregate_spans(table, SpanAggregation(TraceQuery(), "duration"), 0, 1)
    with pytest.raises(UnsupportedQuery):
        traces.match_spans(table, TraceQuery().where(TraceCondition.eq("duration", "100ms")), 0, 1)
