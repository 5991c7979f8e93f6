"""Payload files to signal tables, continuously.

Files below ``source`` hold one OTLP/JSON payload per line. Parsing is stateless, so a micro-batch is one narrow job, whose rows go to
all tables of the signal at once and whose bad payloads are counted on the way. A batch that is repeated after a crash is stored
once (``sources.batches``): its number and the stream's own mark beside its progress tell it from others.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spanlake.session import configure, shared_folder
from spanlake.sources import batches, index, otlp, tables

PARSERS = {
    "logs": otlp.parse_logs,
    "traces": otlp.parse_traces,
    "metrics": lambda raw: otlp.any_points(otlp.metric_points(raw)),
}

TABLES_OF = {
    "logs": ["otel_logs"],
    "traces": ["otel_traces"],
    "metrics": ["otel_metrics_sum", "otel_metrics_gauge", "otel_metrics_histogram"],
}


# the stream's mark in its progress folder
MARK = "_spanlake"


def write_payloads(
    raw: DataFrame,
    root: str,
    signal: str,
    promote: tables.Promoted | None = None,
    cluster: bool = True,
    batch: str | None = None,
) -> bool:
    """Parse payloads of one signal (``logs``, ``traces``, ``metrics``), store the rows, set bad payloads aside.

    A named batch (``batches.named``, ``batches.of_stream``) is stored once, however often and after whatever crash it is
    repeated; False if it was stored before.
    """
    spark, wanted, rejected = configure(raw.sparkSession), TABLES_OF[signal], f"rejected_{signal}"
    for table in wanted:
        tables.check_promoted(spark, root, table, promote, writing=True)

    def write(folder: str) -> None:
        bad = Observation()
        parsed = otlp.with_payload(raw).observe(bad, F.count_if(F.col("payload").isNull()).alias("n"))
        target = batches.staged_path(folder, wanted[0] if len(wanted) == 1 else None)
        tables.write_days(PARSERS[signal](parsed), target, wanted, promote, cluster=cluster)
        set_aside = otlp.bad_payloads(raw)
        # a job without any row may be cut short by adaptive execution, and its count with it
        if bad.get["n"] if batches.has_rows(spark, folder) else not set_aside.isEmpty():
            set_aside.write.text(f"{folder}/{rejected}")

    stored = batches.append_once(spark, root, batch, write, [rejected])
    for table in wanted:
        if not tables.exists(spark, f"{root}/{table}"):
            tables.ensure_table(spark, root, table, promote)
    return stored


def _stream_mark(spark: SparkSession, progress: str) -> str:
    """What tells this stream's batches from those of any other; a new progress folder makes a new stream."""
    found = tables.names(spark, f"{progress}/{MARK}")
    if not found:
        found = [uuid.uuid4().hex]
        tables.touch(spark, f"{progress}/{MARK}/{found[0]}")
    return found[0]


def run_ingest_stream(
    spark: SparkSession,
    source: str,
    root: str,
    signal: str,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    files_per_batch: int | None = None,
    promote: tables.Promoted | None = None,
    cluster: bool = False,
    indexed: Collection[str] = (),
):
    """Start the streaming query over new files below ``source``. Tables in ``indexed`` are indexed after every batch.

    Micro-batches are small, so they skip the shuffle that clusters rows; pass ``cluster=True`` for large ones.
    """
    configure(spark)
    reader = spark.readStream.schema("value STRING").format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    payloads = reader.load(source).withColumnRenamed("value", "raw")

    progress = checkpoint or f"{shared_folder(spark)}/ingest-{signal}-progress"
    mark = _stream_mark(spark, progress)

    def add(batch: DataFrame, number: int) -> None:
        write_payloads(batch, root, signal, promote, cluster, batches.of_stream(mark, number))
        # only the last batch can be repeated
        batches.forget(batch.sparkSession, root, batches.of_stream(mark, number - 1))
        for table in TABLES_OF[signal]:
            if table in indexed:
                index.update(batch.sparkSession, root, table)

    return (
        payloads.writeStream.foreachBatch(add)
        .option("checkpointLocation", progress)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
