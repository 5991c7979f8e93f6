"""Log search and log label values over the ``otel_logs`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlake.functions import attributes, predicates
from spanlake.functions.times import Instant, time_range
from spanlake.operators.distinct import MAX_VALUES, distinct_values
from spanlake.operators.newest import newest
from spanlake.plans.queries import LogQuery, reject_raw

ENTRY_COLUMNS = [
    "TimestampNano",
    "TraceId",
    "SpanId",
    "SeverityText",
    "ServiceName",
    "Body",
    "ResourceAttributes",
    "LogAttributes",
]


def match_logs(logs: DataFrame, query: LogQuery, start: Instant, end: Instant) -> DataFrame:
    """Every row in the time range that passes the stream matchers and all pipeline stages."""
    reject_raw(query.raw, "LogQL")
    conditions = [
        time_range(logs, start, end),
        *(predicates.log_matcher(logs, m) for m in query.matchers),
        *(predicates.log_stage(logs, s) for s in query.pipeline),
    ]
    return logs.where(predicates.all_of(conditions))


def search_logs(logs: DataFrame, query: LogQuery, start: Instant, end: Instant, limit: int = 100) -> DataFrame:
    """The newest ``limit`` matching entries, oldest of them first: ``timestamp_nano, line, labels``."""
    matched = match_logs(logs, query, start, end)
    entries = newest(matched, max(1, limit), ENTRY_COLUMNS, ["TraceId", "SpanId", "Body"])
    # the label map is built for the kept rows only
    return entries.orderBy("TimestampNano", F.desc("TraceId"), F.desc("SpanId"), F.desc("Body")).select(
        F.col("TimestampNano").alias("timestamp_nano"),
        F.col("Body").alias("line"),
        attributes.log_labels().alias("labels"),
    )


def log_label_values(
    logs: DataFrame,
    label: str,
    start: Instant | None = None,
    end: Instant | None = None,
    limit: int | None = MAX_VALUES,
) -> DataFrame:
    """Distinct non-empty values of a label, ascending, at most ``limit`` (None: all)."""
    return distinct_values(logs, attributes.log_label(logs, label), start, end, limit)
