"""The file index: the same results with it, without it and with one that lags behind, from fewer files."""

import pytest
from pyspark.sql import functions as F

import rows
from conftest import DATA
from rows import S
from spanlake import SignalStore
from spanlake.checks import adapters
from spanlake.checks.adapters import END, START
from spanlake.plans.queries import LabelMatcher, LineOp, LogQuery, MatchOp, TraceCondition, TraceOp, TraceQuery
from spanlake.sources import index, tables

DAY = 86_400


def log(i, body, day=0, **attributes):
    return {
        "TimestampNano": (day * DAY + i) * S, "SpanId": str(i), "TraceId": f"t{i % 5}", "ServiceName": f"svc{i % 3}",
        "SeverityText": "ERROR" if i % 2 else "INFO", "Body": body, "LogAttributes": attributes,
        "ResourceAttributes": {"zone": f"z{day}", "session.id": "none"},
    }


@pytest.fixture(scope="module")
def stores(spark, tmp_path_factory):
    """The same logs with an index of all files, of some, and without."""
    made = []
    for covered in (4, 2, 0):
        store = SignalStore(spark, str(tmp_path_factory.mktemp("index") / "store"))
        store.install()
        for day in range(4):
            words = ["alpha", "beta", "gammaray", "delta-x"][day]
            held = [log(i, f"{words} user={100 * day + i} done", day, **({"session.id": f"s{day}{i % 4}"} if i % 3 else {})) for i in range(12)]
            held.append(log(20, "tail " + "y" * 300, day, long="v" * (300 if day == 2 else 3), empty=""))
            store.write_logs(rows.logs(spark, *held))
            if day + 1 == covered:
                assert store.index("otel_logs") > 0 and store.index("otel_logs") == 0
        made.append(store)
    return made


QUERIES = {
    "token": LogQuery().line(LineOp.CONTAINS, "alpha"),
    "part of a token": LogQuery().line(LineOp.CONTAINS, "mmar"),
    "across tokens": LogQuery().line(LineOp.CONTAINS, "ta user=1"),
    "whole inner token": LogQuery().line(LineOp.CONTAINS, " user="),
    "separators only": LogQuery().line(LineOp.CONTAINS, "="),
    "long": LogQuery().line(LineOp.CONTAINS, "y" * 280),
    "empty": LogQuery().line(LineOp.CONTAINS, ""),
    "absent": LogQuery().line(LineOp.CONTAINS, "omega"),
    "not": LogQuery().line(LineOp.NOT_CONTAINS, "alpha"),
    "label": LogQuery.stream(LabelMatcher.eq("session_id", "s12")),
    "fallback": LogQuery.stream(LabelMatcher.eq("session_id", "none"), LabelMatcher.eq("zone", "z3")),
    "columns": LogQuery.stream(LabelMatcher.eq("service_name", "svc1"), LabelMatcher.eq("level", "ERROR")),
    "trace": LogQuery.stream(LabelMatcher.eq("trace_id", "t3"), LabelMatcher("zone", MatchOp.NEQ, "z0")),
    "span": LogQuery.stream(LabelMatcher.eq("span_id", "7")),
    "missing": LogQuery.stream(LabelMatcher.eq("nothing", "")),
    "long value": LogQuery.stream(LabelMatcher.eq("long", "v" * 300)),
    "any": LogQuery().where_any(LabelMatcher.eq("zone", "z1"), LabelMatcher.eq("session_id", "s03")),
    "any with regex": LogQuery().where_any(LabelMatcher("zone", MatchOp.RE, "z1"), LabelMatcher.eq("session_id", "s03")),
    "all": LogQuery().where_all(LabelMatcher.eq("zone", "z1"), LabelMatcher.eq("session_id", "s13")),
}


@pytest.mark.parametrize("name", QUERIES)
def test_same_logs_with_and_without_index(stores, name):
    found = [s.search_logs(QUERIES[name], 0, 4 * DAY, limit=1000).collect() for s in stores]
    assert found[0] == found[2] and found[1] == found[2]
    part = [s.search_logs(QUERIES[name], DAY, 2 * DAY + 5, limit=3).collect() for s in stores]
    assert part[0] == part[2] and part[1] == part[2]


def log_files(df):
    return {f.rsplit("/", 2)[-2] for f in df.inputFiles() if "/otel_logs/day=" in f and "_index" not in f}


@pytest.mark.parametrize(
    "name, days",
    [("token", {0}), ("part of a token", {2}), ("across tokens", {1}), ("absent", set()), ("label", {1}), ("long value", {2}), ("fallback", {3}), ("all", {1}), ("any", {0, 1}), ("not", {0, 1, 2, 3})],
)
def test_only_files_that_can_match_are_planned(stores, name, days):
    whole, half, _ = (log_files(s.search_logs(QUERIES[name], 0, 4 * DAY)) for s in stores)
    named = {f"day=1970-01-0{d + 1}" for d in days}
    assert whole == named
    assert half == named | {"day=1970-01-03", "day=1970-01-04"}  # files that no run covers are read


@pytest.mark.parametrize("label", ["session_id", "zone", "service_name", "detected_level", "long", "empty", "none", "trace_id"])
@pytest.mark.parametrize("bounds", [(None, None), (0, 4 * DAY - 1), (DAY, 3 * DAY - 1), (5, 2 * DAY + 7), (DAY + 1, DAY + 2)])
def test_label_values(stores, label, bounds):
    found = [[r.value for r in s.log_label_values(label, *bounds, limit=None).collect()] for s in stores]
    assert found[0] == found[2] and found[1] == found[2]


def test_values_of_whole_days_open_no_log_file(stores):
    assert not log_files(stores[0].log_label_values("session_id"))
    assert not log_files(stores[0].log_label_values("session_id", DAY, 3 * DAY - 1))
    assert log_files(stores[0].log_label_values("session_id", DAY + 1, 3 * DAY - 1)) == {"day=1970-01-02"}
    assert log_files(stores[0].log_label_values("long")) == {"day=1970-01-03"}  # holds a value too long for the index


def test_traces_are_found_through_the_index(spark, root):
    store = SignalStore(spark, root, indexed=["otel_traces"])
    store.install()
    given = adapters.spans(spark, DATA)
    plain = SignalStore(spark, root + "-plain")
    for s in (store, plain):
        s.write_traces(given)
    found = store.trace("t10")
    assert found.collect() == plain.trace("t10").collect() and found.count() == 8
    opened = [f for f in found.inputFiles() if "_index" not in f]
    assert 0 < len(opened) <= 8 < len(plain.trace("t10").inputFiles())
    assert store.trace("nothing").count() == 0
    services = [sorted(s.trace_services("t10").collect(), key=str) for s in (store, plain)]
    assert services[0] == services[1]
    for conditions in (
        [TraceCondition.eq("span.http.route", "/signup")],
        [TraceCondition.token("status", TraceOp.EQ, "error"), TraceCondition.eq("http.route", "/error")],
        [TraceCondition.eq("resource.service.name", "svc-2"), TraceCondition.absent("db.query.text")],
        [TraceCondition.eq("kind", "client")],
    ):
        query = TraceQuery().where(*conditions)
        got = [s.search_traces(query, START, END).collect() for s in (store, plain)]
        assert got[0] == got[1] and got[0]
    for tag in (".http.route", "span.db.query.text", "resource.deployment.environment.name", "name", "service.name", "none"):
        assert store.tag_values(tag).collect() == plain.tag_values(tag).collect()


def test_metric_labels(spark, root):
    store = SignalStore(spark, root, indexed=["otel_metrics_sum"])
    store.write_metrics(adapters.metric_tables(spark, DATA))
    direct = SignalStore(spark, root + "-plain")
    direct.write_metrics(adapters.metric_tables(spark, DATA))
    for label in ("event_type", "service_name", "deployment_environment_name"):
        assert store.metric_label_values(label).collect() == direct.metric_label_values(label).collect()


def test_runs_are_merged_and_retention_is_followed(spark, root, monkeypatch):
    monkeypatch.setattr(index, "MERGE_RUNS", 3)
    store = SignalStore(spark, root, indexed=["otel_logs"])
    for day in range(5):
        store.write_logs(rows.logs(spark, log(1, f"word{day}", day)))
        assert len(index.runs(spark, root, "otel_logs")) == [1, 2, 1, 2, 1][day]
        assert [r.value for r in store.log_label_values("zone").collect()] == [f"z{d}" for d in range(day + 1)]
    store.apply_retention(now=5 * DAY, days=2)
    assert [r.value for r in store.log_label_values("zone").collect()] == ["z3", "z4"]
    assert store.search_logs(LogQuery().line(LineOp.CONTAINS, "word1"), 0, 5 * DAY).count() == 0
    assert store.search_logs(LogQuery().line(LineOp.CONTAINS, "word4"), 0, 5 * DAY).count() == 1
    index.merge(spark, root, "otel_logs")
    assert [r.value for r in store.log_label_values("zone").collect()] == ["z3", "z4"]


def test_streams_index_what_they_write(spark, root, tmp_path):
    store = SignalStore(spark, root, indexed=["otel_logs"])
    store.install()
    source = tmp_path / "in"
    source.mkdir()
    (source / "a").write_text('{"resourceLogs": [{"scopeLogs": [{"logRecords": [{"timeUnixNano": "5", "body": {"stringValue": "hello you"}}]}]}]}')
    store.follow_payloads(str(source), "logs", str(tmp_path / "progress"), trigger={"availableNow": True}).awaitTermination()
    assert not index.uncovered(spark, root, "otel_logs", index.runs(spark, root, "otel_logs"))
    assert store.search_logs(LogQuery().line(LineOp.CONTAINS, "hello"), 0, 10).count() == 1
    assert tables.names(spark, f"{root}/_index/otel_logs")
    assert store.table("otel_logs").agg(F.count("*")).first()[0] == 1
