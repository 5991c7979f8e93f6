"""Streams: the rollup in several micro-batches equals one batch, retries count nothing twice, payload files arrive."""

import json

import pytest
from pyspark.sql import functions as F

import rows
from conftest import DATA
from rows import S
from spanlake import SignalStore
from spanlake.checks import adapters
from spanlake.checks.adapters import END, START
from spanlake.operators.rollup import rollup_partial, rollup_query
from spanlake.plans.queries import SpanAggregation, SpanSort, TraceCondition, TraceOp, TraceQuery
from spanlake.sources import tables
from spanlake.streaming import rollup as rollup_stream

ONCE = {"availableNow": True}

RANKING = SpanAggregation(
    where=TraceQuery().where(TraceCondition.present("span.db.query.text")),
    group_by="span.db.query.text",
    carry=("span.db.system.name",),
    sort=SpanSort.P95,
)


def follow(store, checkpoint, **options):
    query = store.follow_traces(checkpoint, trigger=ONCE, **options)
    query.awaitTermination()
    assert query.exception() is None


def test_three_batches_rank_like_one(spark, root, tmp_path):
    store = SignalStore(spark, root)
    store.install()
    spans = adapters.spans(spark, DATA)
    checkpoint = str(tmp_path / "progress")
    for i in range(3):
        store.write_traces(spans.where(F.xxhash64("SpanId") % 3 == i - 1))
        store.write_traces(spans.where(F.xxhash64("SpanId") % 3 == 1 - i)) if i == 2 else None
        follow(store, checkpoint)
    total = store.table("otel_traces")
    streamed = store.aggregate_spans(RANKING, START, END)
    assert "otel_db_query_summary" in streamed.inputFiles()[0]

    once = SignalStore(spark, root + "-once")
    rollup_stream.write_batch(rollup_partial(total), once.root, rollup_stream.BACKFILL)
    expected = rollup_stream.read_summary(spark, once.root)
    assert streamed.collect() == rollup_query(expected, RANKING, START, END).collect()
    assert sum(r["count"] for r in streamed.collect()) == total.where("SpanName = 'db.query'").count()


def db_span(i, text="q", ms=1):
    return {
        "TimestampNano": 60 * S * i,
        "SpanName": "db.query",
        "SpanId": str(i),
        "Duration": ms * 1_000_000,
        "SpanAttributes": {"db.query.text": text, "db.system.name": "mysql"},
    }


def test_a_repeated_batch_replaces_itself(spark, root):
    partial = rollup_partial(rows.spans(spark, db_span(1), db_span(2)))
    for _ in range(2):
        rollup_stream.write_batch(partial, root, "0")
    rollup_stream.write_batch(partial, root, "1")
    assert rollup_stream.read_summary(spark, root).agg(F.sum("Calls")).first()[0] == 4


def calls(spark, root):
    return rollup_stream.read_summary(spark, root).agg(F.sum("Calls")).first()[0]


def test_merged_batches_count_once_at_every_step(spark, root, tmp_path):
    partial = rollup_partial(rows.spans(spark, db_span(1), db_span(2)))
    for batch in range(4):
        rollup_stream.write_batch(partial, root, str(batch))
    folder = tmp_path / "store" / rollup_stream.SUMMARY

    rollup_stream.merge_batches(spark, root, 0, 2)
    assert rollup_stream.visible_batches(spark, root) == ["0-2", "3"]
    assert calls(spark, root) == 8

    # the last batch of a merged run is written again after a crash
    rollup_stream.write_batch(partial, root, "2")
    assert calls(spark, root) == 8
    rollup_stream.merge_batches(spark, root, 0, 2)
    assert sorted(p.name for p in folder.glob("batch=*")) == ["batch=0-2", "batch=3"]
    assert calls(spark, root) == 8

    # a merge that did not commit is not read, and made again
    (folder / "batch=3-3").mkdir()
    assert calls(spark, root) == 8
    rollup_stream.merge_batches(spark, root, 3, 3)
    assert rollup_stream.visible_batches(spark, root) == ["0-2", "3-3"]
    assert calls(spark, root) == 8


def test_readers_planned_before_a_merge_finish(spark, root):
    partial = rollup_partial(rows.spans(spark, db_span(1), db_span(2)))
    for batch in range(4):
        rollup_stream.write_batch(partial, root, str(batch))
    planned = rollup_stream.read_summary(spark, root)
    rollup_stream.merge_batches(spark, root, 0, 1)
    assert sum(r.Calls for r in planned.collect()) == 8

    # the next merge drops what this one replaced
    later = rollup_stream.read_summary(spark, root)
    rollup_stream.merge_batches(spark, root, 2, 3)
    assert sum(r.Calls for r in later.collect()) == 8
    left = tables.names(spark, f"{root}/{rollup_stream.SUMMARY}")
    assert sorted(n for n in left if n.startswith("batch=")) == ["batch=0-1", "batch=2", "batch=2-3", "batch=3"]


def test_the_stream_merges_its_batches(spark, root, tmp_path):
    store = SignalStore(spark, root)
    store.install()
    for i in range(5):
        store.write_traces(rows.spans(spark, db_span(1, ms=i + 1)))
        query = store.follow_traces(str(tmp_path / "progress"), trigger=ONCE, merge_every=2)
        query.awaitTermination()
    assert rollup_stream.visible_batches(spark, root) == ["0-1", "2-3", "4"]
    (row,) = store.aggregate_spans(RANKING, 0, 600).collect()
    assert (row["count"], row.max_ms, row.total_ms) == (5, 5.0, 15.0)


def test_late_spans_still_count(spark, root, tmp_path):
    store = SignalStore(spark, root)
    store.install()
    checkpoint = str(tmp_path / "progress")
    for batch in ((db_span(5000),), (db_span(1, ms=9),)):
        store.write_traces(rows.spans(spark, *batch))
        follow(store, checkpoint)
    (row,) = store.aggregate_spans(RANKING, 0, 400_000).collect()
    assert (row["count"], row.max_ms, row.attributes) == (2, 9.0, {"db.system.name": "mysql"})


def test_rollup_covers_statement_spans_and_whole_minutes(spark, root):
    other = db_span(3) | {"SpanName": "cache.get"}
    blank = db_span(3) | {"SpanAttributes": {}}
    store = SignalStore(spark, root)
    store.write_traces(rows.spans(spark, db_span(1), db_span(2), other, blank))
    store.backfill_rollup()
    store.backfill_rollup()
    counts = lambda start, end: [r["count"] for r in store.aggregate_spans(RANKING, start, end).collect()]
    assert counts(0, 600) == [2]
    assert counts(60, 119) == [1]
    assert counts(61, 119) == []
    filtered = SpanAggregation(
        RANKING.where.where(TraceCondition.token("duration", TraceOp.GT, "0ms")), RANKING.group_by, RANKING.carry
    )
    assert [r["count"] for r in store.aggregate_spans(filtered, 0, 600).collect()] == [3]


def test_compaction_and_retention(spark, root):
    store, compacted = SignalStore(spark, root), SignalStore(spark, root + "-compact")
    store.install()
    compacted.install()
    day = 24 * 60
    for batch, spans in enumerate(([db_span(1), db_span(day)], [db_span(1, ms=7), db_span(3 * day)])):
        rollup_stream.write_batch(rollup_partial(rows.spans(spark, *spans)), root, str(batch))
    rollup_stream.compact_into(spark, root, compacted.root)
    merged = [(r.Calls, r.DurationMax) for r in compacted.summary().orderBy("Bucket").collect()]
    assert merged == [(2, 7_000_000), (1, 1_000_000), (1, 1_000_000)]
    before = store.aggregate_spans(RANKING, 0, 10 * 86400).collect()
    assert compacted.aggregate_spans(RANKING, 0, 10 * 86400).collect() == before

    assert rollup_stream.apply_retention(spark, root, 1, 3 * 86400) == [
        "batch=0/day=1970-01-01", "batch=0/day=1970-01-02", "batch=1/day=1970-01-01"
    ]
    assert [r["count"] for r in store.aggregate_spans(RANKING, 0, 10 * 86400).collect()] == [1]


def test_payload_files_become_rows(spark, root, tmp_path):
    store = SignalStore(spark, root)
    store.install()
    record = {"timeUnixNano": "5", "body": {"stringValue": "hello"}}
    payload = json.dumps({"resourceLogs": [{"scopeLogs": [{"logRecords": [record, record]}]}]})
    source = tmp_path / "in"
    source.mkdir()
    for name, lines in (("a", [payload, "{broken"]), ("b", [payload])):
        (source / name).write_text("\n".join(lines))
        query = store.follow_payloads(str(source), "logs", str(tmp_path / "progress"), trigger=ONCE)
        query.awaitTermination()
    assert [r.Body for r in store.table("otel_logs").collect()] == ["hello"] * 4
    assert [r.value for r in spark.read.text(f"{root}/rejected_logs").collect()] == ["{broken"]


@pytest.mark.parametrize("signal", ["logs", "traces", "metrics"])
def test_no_payloads_at_all(spark, root, signal):
    store = SignalStore(spark, root)
    store.install()
    store.ingest(spark.createDataFrame([], "raw string"), signal)
    store.ingest(spark.createDataFrame([("{broken",)], "raw string").where("raw = 'x'"), signal)
    assert not (tables.names(spark, f"{root}/rejected_{signal}"))


def test_only_bad_payloads(spark, root):
    store = SignalStore(spark, root)
    store.install()
    store.ingest(spark.createDataFrame([("{broken",), ("[",)], "raw string").repartition(3), "logs")
    assert store.table("otel_logs").count() == 0
    assert spark.read.text(f"{root}/rejected_logs").count() == 2


def test_metric_payloads_are_parsed_once_for_three_tables(spark, root):
    store = SignalStore(spark, root)
    kinds = {
        "sum": {"dataPoints": [{"asInt": 1}]},
        "gauge": {"dataPoints": [{"asInt": 2}, {"asInt": 3}]},
        "histogram": {"dataPoints": [{"count": 4, "bucketCounts": [4]}]},
    }
    metrics = [{"name": k, k: v} for k, v in kinds.items()]
    payload = json.dumps({"resourceMetrics": [{"scopeMetrics": [{"metrics": metrics}]}]})
    store.ingest(spark.createDataFrame([(payload,)], "raw string"), "metrics")
    assert [store.table(f"otel_metrics_{k}").count() for k in kinds] == [1, 2, 1]


@pytest.mark.parametrize("first", ["backfill", "stream"])
def test_backfill_and_stream_count_once(spark, root, tmp_path, first):
    store = SignalStore(spark, root)
    store.install()
    store.write_traces(rows.spans(spark, db_span(1), db_span(2)))
    steps = [store.backfill_rollup, lambda: follow(store, str(tmp_path / "progress"))]
    for step in steps if first == "backfill" else steps[::-1]:
        step()
        assert [r["count"] for r in store.aggregate_spans(RANKING, 0, 600).collect()] == [2]
    store.write_traces(rows.spans(spark, db_span(3)))
    follow(store, str(tmp_path / "progress"))
    assert [r["count"] for r in store.aggregate_spans(RANKING, 0, 600).collect()] == [3]


def ranking(store):
    return store.aggregate_spans(RANKING, 0, 600).collect()


@pytest.mark.parametrize("filled", [0, 3, 6])
def test_every_moment_of_a_take_over_counts_all_spans(spark, root, tmp_path, filled):
    """Read after every batch of a stream that catches up, with a fill of none, some or all of the files."""
    store = SignalStore(spark, root)
    store.install()
    for i in range(6):
        spans = [db_span(i % 4, f"q{i % 2}", ms=i + 1), db_span(2 + i % 3, ms=50 + i)]
        store.write_traces(rows.spans(spark, *spans, db_span(1) | {"SpanName": "other", "SpanAttributes": {}}))
        if i + 1 == filled:
            store.backfill_rollup()
    expected = rollup_query(rollup_partial(store.table("otel_traces")), RANKING, 0, 600).collect()
    assert sum(r["count"] for r in expected) == 12
    seen = []

    written = rollup_stream.write_batch

    def write_and_read(*args):
        written(*args)
        seen.append(ranking(store))

    rollup_stream.write_batch = write_and_read
    try:
        # without any rollup the spans answer, with an interpolated quantile
        assert [(r.key, r["count"], r.total_ms) for r in ranking(store)] == [(r.key, r["count"], r.total_ms) for r in expected]
        follow(store, str(tmp_path / "progress"), files_per_batch=1, merge_every=(2, 4))
    finally:
        rollup_stream.write_batch = written
    assert len(seen) >= 6
    assert all(found == expected for found in seen)
    assert ranking(store) == expected
    # files that arrive later count before the stream has seen them, and once afterwards
    store.write_traces(rows.spans(spark, db_span(1, "late")))
    assert sum(r["count"] for r in ranking(store)) == 13
    follow(store, str(tmp_path / "progress"))
    assert sum(r["count"] for r in ranking(store)) == 13
    batches = rollup_stream.usable_batches(spark, root)
    assert not rollup_stream.uncovered(spark, root, batches)


def test_a_fill_that_overlaps_a_stream_is_left_out(spark, root, tmp_path):
    store = SignalStore(spark, root)
    store.install()
    store.write_traces(rows.spans(spark, db_span(1), db_span(2)))
    started = rollup_stream.stream_started
    rollup_stream.stream_started = lambda *_: False  # as if the stream began after this was asked
    try:
        follow(store, str(tmp_path / "progress"))
        store.write_traces(rows.spans(spark, db_span(3)))
        store.backfill_rollup()
    finally:
        rollup_stream.stream_started = started
    assert rollup_stream.visible_batches(spark, root) == ["0", "backfill"]
    assert rollup_stream.usable_batches(spark, root) == ["0"]
    assert [r["count"] for r in ranking(store)] == [3]
    follow(store, str(tmp_path / "progress"))
    assert [r["count"] for r in ranking(store)] == [3]


def test_covered_files_are_not_read_again(spark, root, tmp_path):
    store = SignalStore(spark, root)
    store.install()
    store.write_traces(rows.spans(spark, db_span(1)))
    store.backfill_rollup()
    assert not any("otel_traces" in f for f in store.aggregate_spans(RANKING, 0, 600).inputFiles())
    store.write_traces(rows.spans(spark, db_span(2000)))
    assert not any("otel_traces" in f for f in store.aggregate_spans(RANKING, 0, 600).inputFiles())
    assert len([f for f in store.aggregate_spans(RANKING, 0, 200_000).inputFiles() if "otel_traces" in f]) == 1


def test_a_year_of_batches_lists_few_folders():
    complete, levels = [], (60, 1440)
    for n in range(0, 525_600, 60):
        complete += [str(i) for i in range(n, n + 60)]
        for size in levels:
            if (n + 60) % size == 0:
                replaced = rollup_stream._replaced(complete)  # those of the merge before
                complete = [c for c in complete if c not in replaced]
                complete.append(f"{n + 60 - size}-{n + 59}")
    replaced = rollup_stream._replaced(complete)
    assert len([c for c in complete if c not in replaced]) < 400 and len(complete) < 500
    covered = [rollup_stream._run(c) for c in complete if c not in replaced]
    assert sum(last - first + 1 for first, last in covered) == 525_600


def test_retention_drops_empty_batches_with_nothing_left_to_cover(spark, root, tmp_path):
    store = SignalStore(spark, root)
    store.install()
    day = 24 * 60
    for i in (1, 2 * day, 5 * day):
        store.write_traces(rows.spans(spark, db_span(i)))
        follow(store, str(tmp_path / "progress"))
    store.write_traces(rows.spans(spark, db_span(5 * day) | {"SpanName": "other"}))
    follow(store, str(tmp_path / "progress"))
    store.apply_retention(now=5 * 86400, days=1)
    # the last one has no rows, but names a file that need not be read again
    assert rollup_stream.visible_batches(spark, root) == ["2", "3"]
    assert sorted(n for n in tables.names(spark, f"{root}/{rollup_stream.SUMMARY}") if n.startswith("batch=")) == ["batch=2", "batch=3"]
    assert [r["count"] for r in store.aggregate_spans(RANKING, 0, 10 * 86400).collect()] == [1]
