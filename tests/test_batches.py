"""Batches are stored once, whenever the writer stops, and all metric tables are written in one job."""

import json

import pytest
from pyspark.sql import functions as F

from spanlake.checks import adapters
from spanlake.sources import batches, otlp, tables
from spanlake.store import SignalStore
from spanlake.streaming import ingest
from tests.conftest import DATA

KINDS = ("sum", "gauge", "histogram")
DAY = 86_400_000_000_000
ONCE = {"availableNow": True}


def payloads(spark):
    """Three kinds of points on two days, and a payload that is no JSON."""

    def metric(name, day):
        point = {"timeUnixNano": str(day * DAY), "asInt": day, "count": 4, "bucketCounts": [4, day]}
        return {"name": name, name: {"dataPoints": [point]}}

    texts = [
        json.dumps({"resourceMetrics": [{"scopeMetrics": [{"metrics": [metric(k, day) for k in KINDS]}]}]})
        for day in (1, 2)
    ]
    return spark.createDataFrame([(t,) for t in [*texts, "{broken"]], "raw string").coalesce(1)


def stored(spark, store):
    rows = [store.table(f"otel_metrics_{k}").count() for k in KINDS]
    return [*rows, spark.read.text(f"{store.root}/rejected_metrics").count()]


def test_a_named_batch_is_stored_once(spark, root):
    store = SignalStore(spark, root)
    assert store.ingest(payloads(spark), "metrics", batch="monday")
    assert not store.ingest(payloads(spark), "metrics", batch="monday")
    assert stored(spark, store) == [2, 2, 2, 1]
    assert store.ingest(payloads(spark), "metrics", batch="tuesday")
    assert store.ingest(payloads(spark), "metrics")
    assert store.ingest(payloads(spark), "metrics")
    assert stored(spark, store) == [8, 8, 8, 4]
    assert all(name.startswith("named-") for name in tables.names(spark, f"{root}/{batches.ROOT}"))


@pytest.mark.parametrize("moved", range(7))
def test_a_batch_that_stopped_while_its_files_moved(spark, root, monkeypatch, moved):
    store, calls = SignalStore(spark, root), []
    move = tables.move_files

    def stopping(*args):
        if len(calls) == moved:
            raise RuntimeError("stopped")
        calls.append(args)
        move(*args)

    with monkeypatch.context() as patched:
        patched.setattr(tables, "move_files", stopping)
        with pytest.raises(RuntimeError, match="stopped"):
            store.ingest(payloads(spark), "metrics", batch="a")
    if moved % 2:
        assert store.resume_batches() == 1
        assert store.resume_batches() == 0
    assert store.ingest(payloads(spark), "metrics", batch="a") == (moved % 2 == 0)
    assert stored(spark, store) == [2, 2, 2, 1]


def test_a_batch_that_stopped_while_it_was_written(spark, root, monkeypatch):
    store = SignalStore(spark, root)
    touch = tables.touch

    def stopping(session, path):
        if path.endswith(batches.WRITTEN):
            raise RuntimeError("stopped")
        touch(session, path)

    with monkeypatch.context() as patched:
        patched.setattr(tables, "touch", stopping)
        with pytest.raises(RuntimeError, match="stopped"):
            store.ingest(payloads(spark), "metrics", batch="a")
    assert store.resume_batches() == 0
    assert store.ingest(payloads(spark), "metrics", batch="a")
    assert stored(spark, store) == [2, 2, 2, 1]


def test_a_stream_that_repeats_its_last_batch(spark, root, tmp_path):
    store = SignalStore(spark, root)
    source, progress = tmp_path / "in", tmp_path / "progress"
    source.mkdir()
    lines = [r.raw for r in payloads(spark).collect()]

    def follow(folder=progress):
        store.follow_payloads(str(source), "metrics", str(folder), trigger=ONCE).awaitTermination()

    for name in ("a", "b"):
        (source / name).write_text("\n".join(lines))
        follow()
    assert stored(spark, store) == [4, 4, 4, 2]
    # as if it had stopped between storing the batch and noting its progress
    last = max((progress / "commits").iterdir(), key=lambda p: int(p.name) if p.name.isdigit() else -1)
    last.unlink()
    (progress / "commits" / f".{last.name}.crc").unlink(missing_ok=True)
    follow()
    assert last.exists()
    assert stored(spark, store) == [4, 4, 4, 2]
    assert len(tables.names(spark, f"{root}/{batches.ROOT}")) == 1
    # another stream over the same files is no repetition
    follow(tmp_path / "other")
    assert stored(spark, store) == [8, 8, 8, 4]


@pytest.mark.parametrize("name", ["", "a/b", "..", "_x", "a b"])
def test_names_of_batches_are_plain(spark, root, name):
    with pytest.raises(ValueError, match="batch name"):
        batches.named(name)


@pytest.mark.parametrize("cluster", [False, True])
def test_one_job_stores_what_three_parsers_give(spark, root, cluster):
    raw = adapters.metric_payloads(spark, DATA.replace("0.01", "0.001")).persist()
    promoted = {"otel_metrics_sum": [("Attributes", "event_type")], "otel_metrics_gauge": [("ResourceAttributes", "service.name")]}
    store = SignalStore(spark, root, promote=promoted)
    store.ingest(raw, "metrics", cluster=cluster)
    parsed = vars(otlp.parse_metrics(raw))
    for kind in KINDS:
        found = store.table(f"otel_metrics_{kind}")
        extra = [name for name in found.columns if name not in parsed[kind].columns]
        assert len(extra) == len(promoted.get(f"otel_metrics_{kind}", []))
        text = F.to_json(F.struct(*sorted(parsed[kind].columns)))
        assert found.count() > 0
        assert found.drop(*extra).select(text.alias("t")).exceptAll(parsed[kind].select(text.alias("t"))).isEmpty()
        assert parsed[kind].count() == found.count()
        for (column, key), name in zip(promoted.get(f"otel_metrics_{kind}", []), extra, strict=True):
            assert found.where(~F.col(f"`{name}`").eqNullSafe(F.col(column)[key])).isEmpty()
    raw.unpersist()


def test_payloads_are_parsed_in_one_stage_without_shuffle(spark):
    rows = ingest.PARSERS["metrics"](payloads(spark))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "InMemory" not in plan
    assert plan.count("parse_json") + plan.count("parseJson") == 1
