"""Keeping the statement rollup current with a stream over the span table, and knowing which span files it covers.

Every micro-batch writes its own partial rows into a directory named after the batch, replacing it on a retry, so a lost
executor or a restarted query never counts a span twice. No watermark: late spans simply add partial rows.

Beside its rows a batch keeps a ledger, the span files it has read (``day`` and file name); both become visible with the batch's
marker. Readers take the rows of the visible batches and add partial rows of the files that no ledger names, straight from the
spans, so a ranking is whole at every moment: before the first batch, while a stream catches up, after late files. A one-time
fill is a batch like the others; the stream leaves out the files in its ledger. A fill and a stream that were
started at the same time may cover a file twice; readers then leave the fill out.

So that a rollup fed every minute does not end up in tens of thousands of small directories, batches are merged in levels:
each run of 60 into one directory named ``<first>-<last>``, each run of 24 of those (of 1440 batches) into a larger one. Readers take
the batches marked complete and leave out those a complete merge covers, so every state in between, a crash included, reads the
same. Merged batches stay until the next merge, so that readers planned before a merge can finish.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanlake.functions.times import Instant, epoch_seconds, utc_day
from spanlake.operators.rollup import compact_rollup, partial_rows, rollup_partial, statements
from spanlake.schemas import SUMMARY as SUMMARY_SCHEMA
from spanlake.schemas import TABLES
from spanlake.session import configure, shared_folder
from spanlake.sources import tables

SUMMARY = "otel_db_query_summary"
SPANS = "otel_traces"
BACKFILL = "backfill"
COMPACTED = "compacted"

# one empty file per complete batch; a single listing shows them all
COMPLETE = "_complete"

# the span files each batch has read
LEDGER = "_ledger"
LEDGER_SCHEMA = T.StructType([T.StructField("day", T.StringType()), T.StructField("file", T.StringType())])

# batches per merge: an hour and a day of one-minute batches
MERGE_EVERY = (60, 1440)


def write_batch(partial: DataFrame, root: str, batch: str, files: DataFrame | None = None) -> None:
    """Write one batch's partial rows and its ledger; repeating a batch replaces it. Readers see both once it is complete."""
    spark = partial.sparkSession
    marker = f"{root}/{SUMMARY}/{COMPLETE}/{batch}"
    tables.drop(spark, marker)
    (
        partial.sortWithinPartitions("day", *TABLES[SUMMARY][1])
        .write.mode("overwrite")
        .partitionBy("day")
        .parquet(f"{root}/{SUMMARY}/batch={batch}")
    )
    files = spark.createDataFrame([], LEDGER_SCHEMA) if files is None else files
    files.coalesce(1).write.mode("overwrite").parquet(f"{root}/{SUMMARY}/{LEDGER}/batch={batch}")
    tables.touch(spark, marker)


def read_summary(spark: SparkSession, root: str) -> DataFrame | None:
    """All partial rows, or None before the first batch."""
    return _read(spark, root, usable_batches(spark, root))


def visible_batches(spark: SparkSession, root: str) -> list[str]:
    """The complete batches that no complete merge covers."""
    complete = tables.names(spark, f"{root}/{SUMMARY}/{COMPLETE}")
    replaced = _replaced(complete)
    return [name for name in complete if name not in replaced]


def usable_batches(spark: SparkSession, root: str) -> list[str]:
    """The visible batches, without a fill that shares files with a stream's batch."""
    batches = visible_batches(spark, root)
    others = [name for name in batches if name != BACKFILL]
    if BACKFILL in batches and others:
        shared = read_ledger(spark, root, [BACKFILL]).join(read_ledger(spark, root, others), ["day", "file"], "left_semi")
        return others if not shared.isEmpty() else batches
    return batches


def _run(name: str) -> tuple[int, int] | None:
    """First and last number of a stream's batch or merge."""
    if not name[:1].isdigit():
        return None
    first, _, last = name.partition("-")
    return int(first), int(last or first)


def _replaced(complete: list[str]) -> set[str]:
    """The batches and merges among the complete ones that a wider merge among them covers."""
    runs = {name: run for name in complete if (run := _run(name))}
    out, reach = set(), -1
    # by first number, the widest first: what does not reach further than one before is covered by it
    for name, (first, last) in sorted(runs.items(), key=lambda item: (item[1][0], -item[1][1], "-" not in item[0])):
        if last <= reach:
            out.add(name)
        reach = max(reach, last)
    return out


def stream_started(spark: SparkSession, root: str) -> bool:
    """Whether a stream has written a batch, merged or not."""
    return any(_run(name) for name in visible_batches(spark, root))


def _read(spark: SparkSession, root: str, batches: list[str]) -> DataFrame | None:
    if not batches:
        return None
    schema = T.StructType([*SUMMARY_SCHEMA.fields, T.StructField("batch", T.StringType())])
    path = f"{root}/{SUMMARY}"
    reader = spark.read.schema(schema).option("basePath", path)
    return reader.parquet(*(f"{path}/batch={name}" for name in batches)).drop("batch")


def read_ledger(spark: SparkSession, root: str, batches: list[str]) -> DataFrame:
    """(day, file) of the span files that the batches have read."""
    if not batches:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    path = f"{root}/{SUMMARY}/{LEDGER}"
    return spark.read.schema(LEDGER_SCHEMA).parquet(*(f"{path}/batch={name}" for name in batches))


def uncovered(spark: SparkSession, root: str, batches: list[str], first: str = "", last: str = "9") -> dict[str, list[str]]:
    """The span files by day, of days between two, that no ledger of the batches names."""
    listed = tables.data_files(spark, root, SPANS, first, last)
    if listed and batches:
        known = read_ledger(spark, root, batches).where(F.col("day").between(first, last)).collect()
        for day, file in known:
            listed.get(day, set()).discard(file)
    return {day: sorted(files) for day, files in listed.items() if files}


def stitched_summary(
    spark: SparkSession, root: str, start: Instant, end: Instant, promote: tables.Promoted | None = None
) -> DataFrame | None:
    """Rollup rows that stand for every stored span of the range, or None where nothing is rolled up yet.

    Files that the batches cover are answered from them, all others from their spans. The list of batches is taken before the list
    of files, so a batch that completes meanwhile is read from its spans.
    """
    batches = usable_batches(spark, root)
    rolled = _read(spark, root, batches)
    if rolled is None:
        return None
    first, last = (utc_day(epoch_seconds(moment)).isoformat() for moment in (start, end))
    rest = uncovered(spark, root, batches, first, last)
    if not rest:
        return rolled
    spans = tables.read_files(spark, root, SPANS, rest, promote)
    return rolled.unionByName(rollup_partial(spans))


def write_backfill(spark: SparkSession, root: str, promote: tables.Promoted | None = None) -> None:
    """One-time fill from the span files stored now; once a stream has written a batch there is nothing to fill."""
    if stream_started(spark, root):
        return
    files = {day: sorted(found) for day, found in tables.data_files(spark, root, SPANS).items()}
    rows = spark.createDataFrame([(day, file) for day, found in files.items() for file in found], LEDGER_SCHEMA)
    write_batch(rollup_partial(tables.read_files(spark, root, SPANS, files, promote)), root, BACKFILL, rows)


def merge_batches(spark: SparkSession, root: str, first: int, last: int) -> None:
    """Merge the batches of a run into one directory, and drop those that earlier merges replaced. Safe to repeat."""
    merged = f"{first}-{last}"
    complete = tables.names(spark, f"{root}/{SUMMARY}/{COMPLETE}")
    replaced = _replaced(complete)
    if merged not in complete:
        parts = [n for n in complete if n not in replaced and (run := _run(n)) and first <= run[0] and run[1] <= last]
        rows = _read(spark, root, parts)
        if rows is None:
            return
        write_batch(compact_rollup(rows), root, merged, read_ledger(spark, root, parts))
    for name in replaced:
        _drop_batch(spark, root, name)


def _drop_batch(spark: SparkSession, root: str, name: str) -> None:
    for path in (f"{COMPLETE}/{name}", f"batch={name}", f"{LEDGER}/batch={name}"):
        tables.drop(spark, f"{root}/{SUMMARY}/{path}")


def compact_into(spark: SparkSession, root: str, target_root: str) -> None:
    """Merge all partial rows into one row per key below another root, which readers can then switch to."""
    batches = usable_batches(spark, root)
    summary = _read(spark, root, batches)
    if summary is not None:
        write_batch(compact_rollup(summary), target_root, COMPACTED, read_ledger(spark, root, batches))


def apply_retention(spark: SparkSession, root: str, days: int, now: Instant) -> list[str]:
    """Drop the expired day directories of every batch, and the batches that neither hold rows nor cover a file of a day left."""
    found = [name for name in tables.names(spark, f"{root}/{SUMMARY}") if name.startswith("batch=")]
    dropped = [
        f"{batch}/{day}" for batch in found for day in tables.apply_retention(spark, f"{root}/{SUMMARY}", batch, days, now)
    ]
    kept = tables.cutoff_day(days, now).isoformat()
    for batch in visible_batches(spark, root):
        held = tables.names(spark, f"{root}/{SUMMARY}/batch={batch}")
        if not any(name.startswith("day=") for name in held):
            if read_ledger(spark, root, [batch]).where(F.col("day") >= kept).isEmpty():
                _drop_batch(spark, root, batch)
    return dropped


def run_rollup_stream(
    spark: SparkSession,
    root: str,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    files_per_batch: int | None = None,
    merge_every: int | tuple[int, ...] = MERGE_EVERY,
    promote: tables.Promoted | None = None,
):
    """Start the streaming query. Its progress is kept in ``checkpoint``, by default below the shared folder.

    Batch numbers belong to one checkpoint: a stream that starts over needs an empty rollup.
    """
    configure(spark)
    reader = spark.readStream.schema(tables.table_schema(SPANS, promote))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    spans = reader.parquet(f"{root}/{SPANS}")
    # every span, so that files without a statement are known to be read, but few of its columns
    rows = statements(
        spans.select("*", F.col("day").cast("string").alias("of_day"), F.col("_metadata.file_name").alias("file")).drop("day")
        .withColumnRenamed("of_day", "day"),
        "day",
        "file",
    )
    levels = (merge_every,) if isinstance(merge_every, int) else merge_every

    def add(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        files = batch.select("day", "file").distinct()
        if BACKFILL in visible_batches(session, root):
            filled = read_ledger(session, root, [BACKFILL])
            batch, files = (rows.join(filled, ["day", "file"], "left_anti") for rows in (batch, files))
        write_batch(partial_rows(batch), root, str(number), files)
        for size in levels:
            if (number + 1) % size == 0:
                merge_batches(session, root, number + 1 - size, number)

    return (
        rows.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint or f"{shared_folder(spark)}/rollup-progress")
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
