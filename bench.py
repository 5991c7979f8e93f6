"""Headline timings over stored tables; prints one JSON line.

The tables are written first, from ``$BENCH_SF_DIR`` (default sf0.1): order lines as logs and spans (about 600,000 each at
sf0.1, spread over 30 days), events as statement spans, metric points and OTLP payloads. Every query then runs once to
warm up and ``REPEATS`` times for its best time. ``ingest_*`` parse payload files and write the table.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from functools import partial
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from spanlake import SignalStore  # noqa: E402
from spanlake.checks import adapters  # noqa: E402
from spanlake.checks.adapters import END, START  # noqa: E402
from spanlake.functions.times import timestamp_of  # noqa: E402
from spanlake.operators import spans  # noqa: E402
from spanlake.operators.metrics import metric_label_values  # noqa: E402
from spanlake.plans.queries import (  # noqa: E402
    LabelMatcher,
    LineOp,
    LogQuery,
    MetricQuery,
    SpanAggregation,
    TraceCondition,
    TraceOp,
    TraceQuery,
)
from spanlake.sources import otlp  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = 2
COPIES = 5
PARALLELISM_FIRST = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
PERIOD = 30 * 86400 * 1_000_000_000


def session(work: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        # no call sites recorded for every column expression: plans are built in half the time
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", work)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def in_period(rows: DataFrame) -> DataFrame:
    """Order lines moved into the 30 days of the events."""
    nanos = F.lit(1704067200_000_000_000) + F.pmod(F.xxhash64("SpanId"), F.lit(PERIOD))
    return (
        rows.withColumn("TimestampNano", nanos)
        .withColumn("Timestamp", timestamp_of(F.col("TimestampNano")))
        .withColumn("day", F.to_date("Timestamp"))
    )


def line_logs(rows: DataFrame) -> DataFrame:
    flag = F.left("SpanName", F.lit(1))
    part = F.col("SpanAttributes")["part"]
    session = F.concat(F.lit("u"), F.pmod(F.xxhash64("TraceId"), F.lit(900)).cast("string"))
    return rows.select(
        "Timestamp",
        "TimestampNano",
        "TraceId",
        "SpanId",
        F.when(flag == "R", "ERROR").when(flag == "A", "WARN").otherwise("INFO").alias("SeverityText"),
        F.lit(9).alias("SeverityNumber"),
        "ServiceName",
        F.concat(F.lit("order "), "TraceId", F.lit(" shipped part "), part, F.lit(" status "), "SpanName").alias("Body"),
        "ResourceAttributes",
        F.create_map(F.lit("session.id"), session).alias("LogAttributes"),
        "day",
    )


def prepare(spark: SparkSession, work: str) -> tuple[SignalStore, dict[str, str]]:
    promote = {"otel_traces": [("SpanAttributes", "db.query.text"), ("SpanAttributes", "db.system.name")]}
    store = SignalStore(spark, f"{work}/store", promote)
    store.install()
    # files of the advised size rather than one per core and day
    spark.conf.set(PARALLELISM_FIRST, "false")
    lines = in_period(adapters.line_spans(spark, SF_DIR))
    store.write_logs(line_logs(lines))
    store.write_traces(lines.unionByName(adapters.spans(spark, SF_DIR)))
    store.write_metrics(adapters.metric_tables(spark, SF_DIR))
    store.backfill_rollup()
    spark.conf.unset(PARALLELISM_FIRST)
    payloads = {}
    for signal, make in (
        ("logs", adapters.log_payloads),
        ("traces", adapters.span_payloads),
        ("metrics", adapters.metric_payloads),
    ):
        payloads[signal] = f"{work}/payloads/{signal}"
        # in order of time, as payloads arrive; several copies, so that fixed costs do not hide the throughput
        sent = F.regexp_extract("raw", 'imeUnixNano":"([0-9]+)', 1)
        arrived = make(spark, SF_DIR).repartitionByRange(int(CPUS), sent).persist()
        for _ in range(COPIES):
            arrived.write.mode("append").text(payloads[signal])
        arrived.unpersist()
    return store, payloads


STATEMENT = TraceCondition.present("span.db.query.text")
RANKING = SpanAggregation(
    where=TraceQuery().where(STATEMENT), group_by="span.db.query.text", carry=("span.db.system.name",)
)
BY_PART = SpanAggregation(where=TraceQuery(), group_by="span.part")
REQUESTS = "request_duration_milliseconds"


def read_queries(store: SignalStore) -> dict:
    traces = store.table("otel_traces")
    error = TraceQuery().where(TraceCondition.token("status", TraceOp.EQ, "error"))
    slow = TraceQuery().where(TraceCondition.token("duration", TraceOp.GT, "100ms"))
    errors = LogQuery.stream(LabelMatcher.eq("level", "ERROR"))
    return {
        "log_line_filter": lambda: store.search_logs(LogQuery().line(LineOp.CONTAINS, "part 17"), START, END),
        "log_label_search": lambda: store.search_logs(errors, START, END),
        "log_label_values": lambda: store.log_label_values("session_id", START, END),
        "trace_error_search": lambda: store.search_traces(error, START, END),
        "trace_duration_filter": lambda: store.search_traces(slow, START, END),
        "trace_by_id": lambda: store.trace("t777"),
        "tag_values": lambda: store.tag_values("span.db.query.text", None, START, END),
        "hist_p95_instant": lambda: store.metric(
            MetricQuery(REQUESTS + "_bucket").at_quantile(0.95, "31d").grouped("service_name"), END
        ),
        "hist_count_increase": lambda: store.metric(
            MetricQuery(REQUESTS + "_count").increase("31d").grouped("service_name"), END
        ),
        "hist_quantile_range": lambda: store.metric_range(
            MetricQuery(REQUESTS + "_bucket").at_quantile(0.95).grouped("service_name"), START, END, 14400
        ),
        "counter_rate_range": lambda: store.metric_range(
            MetricQuery("events_total").rate("5m").grouped("service_name"), START, END, 14400
        ),
        "gauge_latest": lambda: store.metric(MetricQuery("queue_depth", window="31d").grouped("event_type"), END),
        "metric_label_values": lambda: metric_label_values(store.table("otel_metrics_sum"), "event_type", START, END),
        "db_ranking_rollup": lambda: store.aggregate_spans(RANKING, START, END),
        "db_ranking_raw": lambda: spans.aggregate_spans(traces, RANKING, START, END),
        "db_ranking_sketch": lambda: spans.aggregate_spans(traces, RANKING, START, END, exact=False),
        "part_ranking_raw": lambda: spans.aggregate_spans(traces, BY_PART, START, END),
        "part_ranking_sketch": lambda: spans.aggregate_spans(traces, BY_PART, START, END, exact=False),
    }


def ingest_jobs(spark: SparkSession, payloads: dict[str, str], work: str) -> dict:
    def job(signal: str) -> None:
        store = SignalStore(spark, tempfile.mkdtemp(prefix="ingest-", dir=work))
        store.ingest(spark.read.text(payloads[signal]).toDF("raw"), signal, cluster=False)

    return {f"ingest_{signal}": partial(job, signal) for signal in payloads}


def best(run) -> float:
    times = []
    for _ in range(1 + REPEATS):
        began = time.perf_counter()
        result = run()
        if result is not None:
            result.collect()
        times.append(time.perf_counter() - began)
    return round(min(times[1:]), 4)


def main() -> None:
    work = tempfile.mkdtemp(prefix="run-")
    spark = session(work)
    store, payloads = prepare(spark, work)
    timings = {name: best(run) for name, run in {**read_queries(store), **ingest_jobs(spark, payloads, work)}.items()}
    rows = {
        "logs": store.table("otel_logs").count(),
        "spans": store.table("otel_traces").count(),
    }
    ingested = {
        "logs": otlp.parse_logs(spark.read.text(payloads["logs"]).toDF("raw")).count(),
        "traces": otlp.parse_traces(spark.read.text(payloads["traces"]).toDF("raw")).count(),
        "metrics": otlp.metric_points(spark.read.text(payloads["metrics"]).toDF("raw")).count(),
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "sf": Path(SF_DIR).name,
                "stored_rows": rows,
                "ingest_rows_per_sec": {k: int(n / timings[f"ingest_{k}"]) for k, n in ingested.items()},
            }
        )
    )


if __name__ == "__main__":
    main()
