"""The whole store behind one object: install, write, query, stream, retain."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession

from spanlake.functions import attributes
from spanlake.functions.times import Instant
from spanlake.operators import logs, metrics, rollup, spans, traces
from spanlake.operators.distinct import MAX_VALUES, distinct_values
from spanlake.operators.metrics import MetricTables
from spanlake.plans.queries import LogQuery, MetricQuery, SpanAggregation, TraceQuery, reject_raw
from spanlake.plans.routing import metric_table, rollup_answers
from spanlake.schemas import TABLES
from spanlake.session import configure
from spanlake.sources import batches, index, tables
from spanlake.streaming import ingest
from spanlake.streaming import rollup as rollup_stream


class SignalStore:
    """Tables below ``root``.

    ``promote`` names map attributes kept a second time as columns, per table; ``indexed`` the tables whose files are indexed
    on every append. Searches use an index wherever there is one.
    """

    def __init__(
        self, spark: SparkSession, root: str, promote: tables.Promoted | None = None, indexed: Iterable[str] = ()
    ) -> None:
        self.spark = configure(spark)
        self.root = root.rstrip("/")
        self.promote = promote or {}
        self.indexed = set(indexed)

    def install(self) -> None:
        """Create missing tables; safe to repeat. The rollup is created by its first batch."""
        for table in TABLES:
            if table != rollup_stream.SUMMARY:
                tables.ensure_table(self.spark, self.root, table, self.promote)

    def table(self, name: str, start: Instant | None = None, end: Instant | None = None) -> DataFrame:
        """A stored table; with both bounds at least its rows of that range."""
        return tables.read_table(self.spark, self.root, name, self.promote, start, end)

    # writing

    def _append(self, rows: DataFrame, table: str, **options) -> None:
        tables.append(rows, self.root, table, self.promote, **options)
        self._index([table])

    def _index(self, written: Iterable[str]) -> None:
        for table in self.indexed.intersection(written):
            index.update(self.spark, self.root, table)

    def index(self, table: str) -> int:
        """Index the files of a table that are not indexed yet; their number."""
        return index.update(self.spark, self.root, table)

    def write_logs(self, rows: DataFrame, **options) -> None:
        self._append(rows, "otel_logs", **options)

    def write_traces(self, rows: DataFrame, **options) -> None:
        self._append(rows, "otel_traces", **options)

    def write_metrics(self, points: MetricTables, **options) -> None:
        self._append(points.sum, "otel_metrics_sum", **options)
        self._append(points.gauge, "otel_metrics_gauge", **options)
        self._append(points.histogram, "otel_metrics_histogram", **options)

    def ingest(self, raw: DataFrame, signal: str, batch: str | None = None, **options) -> bool:
        """OTLP/JSON payloads (column ``raw``) of ``logs``, ``traces`` or ``metrics`` into their tables.

        A sender that may repeat itself names its ``batch``: payloads under a name that is stored already are left out (False).
        """
        name = None if batch is None else batches.named(f"{signal}-{batch}")
        stored = ingest.write_payloads(raw, self.root, signal, self.promote, batch=name, **options)
        self._index(ingest.TABLES_OF[signal])
        return stored

    def resume_batches(self) -> int:
        """Finish batches whose sender stopped between writing and storing them; call it while no sender is at work."""
        finished = batches.resume(self.spark, self.root, [f"rejected_{signal}" for signal in ingest.TABLES_OF])
        if finished:
            self._index(self.indexed)
        return finished

    def follow_payloads(self, source: str, signal: str, checkpoint: str | None = None, **options):
        """Start the stream that ingests new payload files below ``source``."""
        return ingest.run_ingest_stream(
            self.spark, source, self.root, signal, checkpoint, promote=self.promote, indexed=self.indexed, **options
        )

    # searching

    def _narrowed(
        self, table: str, conditions: list[index.Condition], start: Instant | None, end: Instant | None
    ) -> DataFrame:
        """At least the rows of the range that can match, from the files an index names where there is one."""
        found = index.narrowed(self.spark, self.root, table, conditions, start, end, self.promote)
        return self.table(table, start, end) if found is None else found

    def _values(
        self, table: str, field: str, value: Callable[[DataFrame], Column], start: Instant | None, end: Instant | None, limit: int | None
    ) -> DataFrame:
        """Distinct values of a field: of indexed files from the index, of all others from their rows."""
        known = index.known_values(self.spark, self.root, table, field, start, end)
        if known is None:
            rows = self.table(table, start, end)
            return distinct_values(rows, value(rows), start, end, limit)
        values, files = known
        if files:
            rows = tables.read_files(self.spark, self.root, table, files, self.promote)
            values = values.unionByName(distinct_values(rows, value(rows), start, end, None)).distinct()
        values = values.orderBy("value")
        return values if limit is None else values.limit(limit)

    # logs

    def search_logs(self, query: LogQuery, start: Instant, end: Instant, limit: int = 100) -> DataFrame:
        rows = self._narrowed("otel_logs", index.log_conditions(query), start, end)
        return logs.search_logs(rows, query, start, end, limit)

    def log_label_values(
        self, label: str, start: Instant | None = None, end: Instant | None = None, limit: int | None = MAX_VALUES
    ) -> DataFrame:
        field = index.label_field(label)
        if field is None:
            return logs.log_label_values(self.table("otel_logs", start, end), label, start, end, limit)
        return self._values("otel_logs", field, lambda rows: attributes.log_label(rows, label), start, end, limit)

    # traces

    def search_traces(
        self, query: TraceQuery, start: Instant, end: Instant, limit: int = 20, **options
    ) -> DataFrame:
        reject_raw(query.raw, "TraceQL")
        rows = self._narrowed("otel_traces", index.trace_conditions(query), start, end)
        return traces.search_traces(rows, query, start, end, limit, **options)

    def trace(
        self, trace_id: str, start: Instant | None = None, end: Instant | None = None, **options
    ) -> DataFrame:
        """The waterfall of a trace; with an index only its files are read, with both bounds only their days."""
        rows = self._narrowed("otel_traces", index.trace_condition(trace_id), start, end)
        return traces.get_trace(rows, trace_id, start, end, **options)

    def trace_services(self, trace_id: str, start: Instant | None = None, end: Instant | None = None) -> DataFrame:
        rows = self._narrowed("otel_traces", index.trace_condition(trace_id), start, end)
        return traces.trace_services(rows, trace_id, start, end)

    def tag_values(
        self,
        tag: str,
        filter: TraceQuery | None = None,
        start: Instant | None = None,
        end: Instant | None = None,
        limit: int | None = 0,
    ) -> DataFrame:
        plain = filter is None or filter.raw is not None or not filter.conditions
        if not plain:
            return traces.tag_values(self.table("otel_traces", start, end), tag, filter, start, end, limit)
        most = limit if limit is None or limit > 0 else MAX_VALUES
        return self._values(
            "otel_traces", index.tag_field(tag), lambda rows: attributes.span_tag(rows, tag), start, end, most
        )

    def aggregate_spans(
        self, aggregation: SpanAggregation, start: Instant, end: Instant, exact: bool = True
    ) -> DataFrame:
        """The statement ranking comes from the rollup where one exists, everything else from the spans.

        Span files that the rollup does not cover yet are read beside it: the ranking counts every stored span.
        """
        reject_raw(aggregation.where.raw, "TraceQL")
        summary = None
        if rollup_answers(aggregation):
            summary = rollup_stream.stitched_summary(self.spark, self.root, start, end, self.promote)
        if summary is not None:
            return rollup.rollup_query(summary, aggregation, start, end)
        return spans.aggregate_spans(self.table("otel_traces", start, end), aggregation, start, end, exact=exact)

    # rollup

    def summary(self) -> DataFrame | None:
        """The partial rows of all batches."""
        return rollup_stream.read_summary(self.spark, self.root)

    def backfill_rollup(self) -> None:
        """One-time fill from the span files stored now. A stream started later leaves these files out."""
        rollup_stream.write_backfill(self.spark, self.root, self.promote)

    def follow_traces(self, checkpoint: str | None = None, **options):
        """Start the stream that adds every new span file to the rollup."""
        return rollup_stream.run_rollup_stream(self.spark, self.root, checkpoint, promote=self.promote, **options)

    # metrics

    def metric_tables(self, query: MetricQuery, start: Instant, end: Instant) -> MetricTables:
        """The one table the query reads, in its time range."""
        kind = metric_table(query)
        return MetricTables(**{kind: self.table(f"otel_metrics_{kind}", start, end)})

    def metric(self, query: MetricQuery, at: Instant) -> DataFrame:
        return metrics.instant(self.metric_tables(query, *metrics.instant_range(query, at)), query, at)

    def metric_range(self, query: MetricQuery, start: Instant, end: Instant, step: int | None = None) -> DataFrame:
        return metrics.range_query(self.metric_tables(query, start, end), query, start, end, step)

    def metric_label_values(
        self, label: str, start: Instant | None = None, end: Instant | None = None, limit: int | None = MAX_VALUES
    ) -> DataFrame:
        field = label if label == "service_name" else attributes.dotted(label)
        return self._values(
            "otel_metrics_sum", field, lambda rows: attributes.metric_label(rows, label), start, end, limit
        )

    # retention

    def apply_retention(self, now: Instant, days: int = tables.RETENTION_DAYS) -> dict[str, list[str]]:
        """Drop expired days of every table."""
        dropped = {
            table: tables.apply_retention(self.spark, self.root, table, days, now)
            for table in TABLES
            if table != rollup_stream.SUMMARY
        }
        dropped[rollup_stream.SUMMARY] = rollup_stream.apply_retention(self.spark, self.root, days, now)
        return dropped
