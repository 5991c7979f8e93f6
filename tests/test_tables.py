"""Writing, reading, clustering, retention, promoted attributes."""

import datetime as dt
import glob
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import rows
from rows import S
from spanlake import SignalStore, schemas
from spanlake.plans.queries import LabelMatcher, LogQuery, SpanAggregation, TraceCondition, TraceOp, TraceQuery
from spanlake.sources import tables

DAY = 86400


def files(root, table):
    return glob.glob(f"{root}/{table}/**/*.parquet", recursive=True)


def some_logs(spark, n, days=1):
    return rows.logs(
        spark, *({"TimestampNano": (i % days) * DAY * S + i, "ServiceName": f"s{i % 3}", "Body": str(i)} for i in range(n))
    )


def test_install_is_repeatable_and_empty_tables_answer(spark, root):
    store = SignalStore(spark, root)
    store.install()
    store.write_logs(some_logs(spark, 3))
    store.install()
    assert store.table("otel_logs").count() == 3
    assert store.table("otel_metrics_gauge").count() == 0
    assert store.table("otel_traces").schema == schemas.TRACES
    assert store.search_traces(TraceQuery(), 0, 10).collect() == []
    assert store.summary() is None


def test_files_are_bounded_and_partitioned_by_day(spark, root):
    tables.append(some_logs(spark, 5).coalesce(1), root, "otel_logs", max_rows=2, cluster=False)
    assert len(files(root, "otel_logs")) == 3
    tables.append(some_logs(spark, 4, days=2), root, "otel_logs", max_rows=0)
    days = {f.split("day=")[1].split("/")[0] for f in files(root, "otel_logs")}
    assert days == {"1970-01-01", "1970-01-02"}
    assert tables.read_table(spark, root, "otel_logs").count() == 9


def test_an_empty_append_changes_nothing(spark, root):
    tables.append(some_logs(spark, 5), root, "otel_logs")
    before = files(root, "otel_logs")
    tables.append(some_logs(spark, 5).where("false"), root, "otel_logs")
    tables.append(some_logs(spark, 5).where("false"), root, "otel_logs", cluster=False)
    assert files(root, "otel_logs") == before


def test_rows_are_clustered_inside_a_file(spark, root):
    tables.append(some_logs(spark, 300), root, "otel_logs")
    for path in files(root, "otel_logs"):
        stored = [(r.ServiceName, r.TimestampNano) for r in spark.read.parquet(path).collect()]
        assert stored == sorted(stored)


def test_round_trip_keeps_every_column(spark, root):
    span = {
        "TimestampNano": 5,
        "TraceId": "t",
        "SpanAttributes": {"a": "b", "": "x"},
        "Events": [(dt.datetime(1970, 1, 1), 7, "e", {"k": "v"})],
        "Links": [("t", "s", {})],
        "Duration": 2**62,
    }
    written = rows.spans(spark, span)
    tables.append(written, root, "otel_traces")
    assert tables.read_table(spark, root, "otel_traces").collect() == written.collect()


def test_retention_drops_whole_days(spark, root):
    store = SignalStore(spark, root)
    store.install()
    store.write_logs(some_logs(spark, 40, days=10))
    now = 9 * DAY + 5000
    kept = tables.surviving(store.table("otel_logs"), 3, now)
    assert sorted(str(r.day) for r in kept.select("day").distinct().collect()) == [f"1970-01-{d:02}" for d in (7, 8, 9, 10)]
    expected = kept.count()
    dropped = store.apply_retention(now, days=3)
    assert dropped["otel_logs"] == [f"day=1970-01-{d:02}" for d in range(1, 7)]
    assert store.table("otel_logs").count() == expected
    assert store.apply_retention(now, days=3)["otel_logs"] == []


def test_only_the_asked_days_are_listed(spark, root):
    store = SignalStore(spark, root)
    store.write_logs(some_logs(spark, 40, days=4))
    whole, part = store.table("otel_logs"), store.table("otel_logs", DAY, 2 * DAY + 5)
    assert sorted(str(r.day) for r in part.select("day").distinct().collect()) == ["1970-01-02", "1970-01-03"]
    assert set(part.inputFiles()) < set(whole.inputFiles())
    assert part.schema == whole.schema
    nothing = store.table("otel_logs", 50 * DAY, 51 * DAY)
    assert (nothing.count(), nothing.schema) == (0, whole.schema)
    assert store.search_logs(LogQuery(), 50 * DAY, 51 * DAY).collect() == []
    assert store.log_label_values("service_name", 50 * DAY, 51 * DAY).collect() == []


def pushed(frame):
    text = frame._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.splitlines() if "FileScan" in line][0]


def test_time_and_day_reach_the_scan(spark, root):
    store = SignalStore(spark, root)
    store.write_logs(some_logs(spark, 20, days=4))
    query = LogQuery.stream(LabelMatcher.eq("service_name", "s1"))
    found = store.search_logs(query, DAY, 2 * DAY)
    scan = pushed(found)
    assert "PartitionFilters: [isnotnull(day" in scan and "1970-01-02" in scan
    assert "GreaterThanOrEqual(TimestampNano" in scan and "EqualTo(ServiceName,s1)" in scan
    assert "SeverityNumber" not in scan


def test_wide_columns_are_read_from_the_newest_days_only(spark, root):
    store = SignalStore(spark, root)
    store.write_logs(some_logs(spark, 400, days=4))
    found = store.search_logs(LogQuery(), 0, 10 * DAY, limit=3)
    assert [r.line for r in found.collect()] == ["391", "395", "399"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    wide = [s for s in scans if "Body:string" in s]
    narrow = [s for s in scans if "Body:string" not in s]
    assert narrow and all("ReadSchema: struct<TimestampNano:bigint>" in s for s in narrow)
    assert wide and all("ubquery" in s.split("PartitionFilters")[1].split("PushedFilters")[0] for s in wide)
    assert any("GreaterThanOrEqual(TimestampNano,ScalarSubquery" in s for s in wide)


def promoted_store(spark, root):
    store = SignalStore(spark, root, promote={"otel_traces": [("SpanAttributes", "db.query.text")]})
    store.install()
    texts = [{"db.query.text": f"q{i % 3}"} if i % 4 else {} for i in range(40)]
    spans = [
        {"TimestampNano": i, "SpanId": str(i), "Duration": i, "SpanAttributes": text} for i, text in enumerate(texts)
    ]
    store.write_traces(rows.spans(spark, *spans))
    return store


@pytest.mark.parametrize(
    "condition",
    [
        TraceCondition.eq("span.db.query.text", "q1"),
        TraceCondition.eq("span.db.query.text", ""),
        TraceCondition("span.db.query.text", TraceOp.NEQ, "q1"),
        TraceCondition("span.db.query.text", TraceOp.NRE, "q1"),
        TraceCondition.present("db.query.text"),
        TraceCondition.absent("db.query.text"),
    ],
)
def test_promoted_attributes_give_the_same_rows(spark, root, condition):
    store = promoted_store(spark, root)
    plain = SignalStore(spark, root)
    from spanlake.operators.traces import match_spans

    def ids(table):
        return sorted(r.SpanId for r in match_spans(table, TraceQuery().where(condition), 0, 10).collect())

    assert ids(store.table("otel_traces")) == ids(plain.table("otel_traces"))


def test_promoted_attributes_leave_the_map_unread(spark, root):
    store = promoted_store(spark, root)
    ranking = SpanAggregation(TraceQuery().where(TraceCondition.eq("span.db.query.text", "q1")), "span.db.query.text")
    scan = pushed(store.aggregate_spans(ranking, 0, 10))
    assert "map<" not in scan.split("ReadSchema")[1]
    assert "EqualTo(`SpanAttributes::db.query.text`,q1)" in scan or "EqualTo(SpanAttributes::db.query.text,q1)" in scan


def test_trace_ids_have_a_bloom_filter(spark, root):
    """Ids that differ from row to row; a column kept as a dictionary needs no filter."""
    values = {"TraceId": F.md5(F.col("id").cast("string")), "day": F.lit(dt.date(1970, 1, 1))}
    spans = spark.range(200_000).select(
        *(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.TRACES.fields)
    )
    tables.append(spans.coalesce(1), root, "otel_traces", cluster=False)
    (path,) = files(root, "otel_traces")
    parquet, hadoop = spark._jvm.org.apache.parquet.hadoop, spark._jvm.org.apache.hadoop
    source = parquet.util.HadoopInputFile.fromPath(hadoop.fs.Path(path), spark._jsc.hadoopConfiguration())
    reader = parquet.ParquetFileReader.open(source)
    columns = reader.getFooter().getBlocks().get(0).getColumns()
    filtered = {c.getPath().toDotString() for c in columns if c.getBloomFilterOffset() >= 0}
    reader.close()
    assert filtered == {"TraceId"}


def test_bloom_filters_of_small_files_are_small(spark, root):
    values = {"TraceId": F.md5(F.col("id").cast("string")), "day": F.lit(dt.date(1970, 1, 1))}
    spans = spark.range(2000).select(
        *(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.TRACES.fields)
    )
    tables.append(spans.coalesce(1), root, "otel_traces", max_rows=100, cluster=False)
    found = files(root, "otel_traces")
    assert len(found) == 20 and sum(Path(path).stat().st_size for path in found) < 20 * 20_000
    parquet, hadoop = spark._jvm.org.apache.parquet.hadoop, spark._jvm.org.apache.hadoop
    for path in found[:3]:
        source = parquet.util.HadoopInputFile.fromPath(hadoop.fs.Path(path), spark._jsc.hadoopConfiguration())
        reader = parquet.ParquetFileReader.open(source)
        block = reader.getFooter().getBlocks().get(0)
        (column,) = (c for c in block.getColumns() if c.getPath().toDotString() == "TraceId")
        bloom = reader.readBloomFilter(column)
        stored = [r.TraceId for r in spark.read.parquet(path).select("TraceId").collect()]
        held = lambda t: bloom.findHash(bloom.hash(parquet_binary(spark, t)))
        assert len(stored) == 100 and all(map(held, stored))
        assert sum(map(held, (f"other {i}" for i in range(300)))) < 30
        reader.close()


def parquet_binary(spark, text):
    return spark._jvm.org.apache.parquet.io.api.Binary.fromString(text)


def test_write_metrics(spark, root):
    store = SignalStore(spark, root)
    point = {"TimestampNano": S, "MetricName": "m", "Value": 1.0, "Count": 2, "BucketCounts": [1]}
    keep = lambda *names: {k: v for k, v in point.items() if k in names}
    common = keep("TimestampNano", "MetricName")
    store.write_metrics(
        rows.metrics(
            spark,
            sum=[common | keep("Value")],
            gauge=[common | keep("Value")] * 2,
            histogram=[common | keep("Count", "BucketCounts")] * 3,
        )
    )
    counts = [store.table(f"otel_metrics_{kind}").count() for kind in ("sum", "gauge", "histogram")]
    assert counts == [1, 2, 3]


def test_a_hot_service_is_split_by_size(spark, root):
    """Adaptive execution splits the rebalanced partition of one service that holds nearly all rows."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",)}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        values = {
            "TimestampNano": F.col("id") * 1000,
            "Body": F.md5(F.col("id").cast("string")),
            "ServiceName": F.lit("hot"),
            "day": F.lit(dt.date(1970, 1, 1)),
        }
        hot = spark.range(0, 60000, numPartitions=8).select(
            *(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.LOGS.fields)
        )
        tables.append(hot, root, "otel_logs")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(files(root, "otel_logs")) > 2
    assert tables.read_table(spark, root, "otel_logs").count() == 60000


def test_promoted_attributes_cannot_be_changed_later(spark, root):
    plain = SignalStore(spark, root)
    plain.install()
    plain.write_traces(rows.spans(spark, {"SpanAttributes": {"db.query.text": "q"}, "TimestampNano": 1}))
    other = SignalStore(spark, root, promote={"otel_traces": [("SpanAttributes", "db.query.text")]})
    for use in (other.install, lambda: other.table("otel_traces"), lambda: other.write_traces(plain.table("otel_traces"))):
        with pytest.raises(ValueError, match="promoted"):
            use()
    assert plain.table("otel_traces").count() == 1


def test_writers_fill_all_promoted_attributes(spark, root):
    promoted_store(spark, root)
    with pytest.raises(ValueError, match="promoted"):
        SignalStore(spark, root).write_traces(rows.spans(spark, {"TimestampNano": 1}))
