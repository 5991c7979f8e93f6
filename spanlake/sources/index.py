"""Which data files hold a value: an inverted index beside a table, for searches that would open every file.

An index row says that a file of the table holds a value of a field: a label or attribute (``label``), a token of a log's
body (``token``), a trace (``trace``). ``update`` adds the files that are not indexed yet as a new run, range-partitioned and sorted by
field and value, so a lookup reads few row groups. A run keeps a ledger of its files and becomes visible with its marker.

Before a search plans its scan, ``narrowed`` looks up the conditions that name a value and reads only the files that can
match all of them, besides files no run covers. Distinct values of a label come from the index alone on whole days
(``known_values``). Results are the same with and without an index, and with one that lags behind.

Tokens beyond ``LONGEST`` characters are kept in overlapping pieces, values as NULL, which matches every value: files with such
a value stay candidates.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanlake.functions import attributes
from spanlake.functions.times import Instant, epoch_seconds, utc_day
from spanlake.plans.queries import (
    LabelFilter,
    LabelMatcher,
    LineFilter,
    LineOp,
    LogQuery,
    MatchOp,
    TraceOp,
    TraceQuery,
)
from spanlake.session import configure
from spanlake.sources import tables

ROOT = "_index"
COMPLETE, LEDGER = "_complete", "_ledger"
ROWS = T.StructType([T.StructField(n, T.StringType()) for n in ("field", "value", "day", "file", "kind")])
FILES = T.StructType([T.StructField(n, T.StringType()) for n in ("day", "file")])

LABEL, TOKEN, TRACE = "label", "token", "trace"

# longer values are known to exist only
LONGEST = 256

# runs after which they are merged into one
MERGE_RUNS = 32

# what separates the tokens of a body: ASCII that is no letter or digit
SEPARATORS = r"[\x00-/:-@\[-`{-\x7f]+"

DAY = 86_400


def _labels(rows: DataFrame, table: str) -> list[Column]:
    """Arrays of (field, value) for the labels that queries can name, resolved as they resolve them."""

    def entries(found: Column, prefix: str = "") -> Column:
        return F.transform(F.map_entries(found), lambda e: F.struct(F.concat(F.lit(prefix), e["key"]).alias("field"), e["value"].alias("value")))

    def column(field: str, name: str) -> Column:
        return F.array(F.struct(F.lit(field).alias("field"), F.col(name).alias("value")))

    if table == "otel_logs":
        # record attributes win over those of the resource
        return [entries(F.map_concat("ResourceAttributes", "LogAttributes")), column("service_name", "ServiceName"), column("level", "SeverityText")]
    if table == "otel_traces":
        columns = {"name": "SpanName", "status": "StatusCode", "kind": "SpanKind", "resource.service.name": "ServiceName"}
        maps = [entries(F.col("SpanAttributes"), "span."), entries(F.col("ResourceAttributes"), "resource.")]
        return maps + [column(field, name) for field, name in columns.items()]
    environment = "deployment.environment.name"
    fallback = F.map_filter("ResourceAttributes", lambda key, _: key == environment)
    return [entries(F.map_concat(fallback, "Attributes")), column("service_name", "ServiceName")]


def _pieces(token: Column) -> Column:
    """The token, or overlapping pieces of a long one: any ``LONGEST // 2`` characters of it lie in one piece."""
    half = LONGEST // 2
    starts = F.sequence(F.lit(0), F.floor((F.char_length(token) - 1) / half).cast("int"))
    cut = F.transform(starts, lambda i: F.substring(token, i * half + 1, F.lit(LONGEST)))
    return F.when(F.char_length(token) <= LONGEST, F.array(token)).otherwise(cut)


def entries_of(rows: DataFrame, table: str) -> DataFrame:
    """(kind, field, value, day, file) of every value in the rows, once per file."""
    kinds = {LABEL: F.concat(*_labels(rows, table))}
    if "Body" in rows.columns:
        tokens = F.flatten(F.transform(F.array_distinct(F.split("Body", SEPARATORS)), _pieces))
        kinds[TOKEN] = F.transform(tokens, lambda t: F.struct(F.lit("Body").alias("field"), t.alias("value")))
    if "TraceId" in rows.columns:
        kinds[TRACE] = F.array(F.struct(F.lit("TraceId").alias("field"), F.col("TraceId").alias("value")))

    def named(kind: str) -> Column:
        return F.transform(kinds[kind], lambda e: F.struct(F.lit(kind).alias("kind"), e["field"].alias("field"), e["value"].alias("value")))

    found = rows.select(
        F.explode(F.concat(*map(named, kinds))).alias("e"), F.col("day").cast("string").alias("day"), F.col("_metadata.file_name").alias("file")
    )
    value = F.when(F.char_length("e.value") <= LONGEST, F.col("e.value"))
    return found.where("e.value <> ''").select("e.kind", "e.field", value.alias("value"), "day", "file").distinct()


def _path(root: str, table: str) -> str:
    return f"{root}/{ROOT}/{table}"


def runs(spark: SparkSession, root: str, table: str) -> list[str]:
    """The complete runs, without those that a complete merge stands for."""
    found = tables.names(spark, f"{_path(root, table)}/{COMPLETE}")
    merges = [name for name in found if name.startswith("merge-")]
    if not merges:
        return found
    replaced = {r.run for r in spark.read.schema("run STRING").parquet(*(f"{_path(root, table)}/_replaces/run={m}" for m in merges)).collect()}
    return [name for name in found if name not in replaced]


def ledger(spark: SparkSession, root: str, table: str, found: list[str]) -> DataFrame:
    if not found:
        return spark.createDataFrame([], FILES)
    return spark.read.schema(FILES).parquet(*(f"{_path(root, table)}/{LEDGER}/run={name}" for name in found))


def _rows(spark: SparkSession, root: str, table: str, found: list[str]) -> DataFrame:
    path = _path(root, table)
    reader = spark.read.schema(T.StructType([*ROWS.fields, T.StructField("run", T.StringType())])).option("basePath", path)
    return reader.parquet(*(f"{path}/run={name}" for name in found)).drop("run")


def _write(rows: DataFrame, files: DataFrame, root: str, table: str, name: str) -> None:
    path = _path(root, table)
    ordered = rows.select("field", "value", "day", "file", "kind").repartitionByRange("kind", "field", "value")
    ordered.sortWithinPartitions("kind", "field", "value").write.partitionBy("kind").parquet(f"{path}/run={name}")
    files.coalesce(1).write.parquet(f"{path}/{LEDGER}/run={name}")
    tables.touch(rows.sparkSession, f"{path}/{COMPLETE}/{name}")


def uncovered(spark: SparkSession, root: str, table: str, found: list[str], first: str = "", last: str = "9") -> dict[str, list[str]]:
    """The data files by day that no run covers."""
    listed = tables.data_files(spark, root, table, first, last)
    if listed and found:
        for day, file in ledger(spark, root, table, found).where(F.col("day").between(first, last)).collect():
            listed.get(day, set()).discard(file)
    return {day: sorted(files) for day, files in listed.items() if files}


def update(spark: SparkSession, root: str, table: str) -> int:
    """Index the files that are new; their number. One caller at a time."""
    configure(spark)
    found = runs(spark, root, table)
    files = uncovered(spark, root, table, found)
    pairs = [(day, file) for day, names in files.items() for file in names]
    if pairs:
        rows = entries_of(tables.read_files(spark, root, table, files), table)
        _write(rows, spark.createDataFrame(pairs, FILES), root, table, uuid.uuid4().hex)
        if len(found) + 1 >= MERGE_RUNS:
            merge(spark, root, table)
    return len(pairs)


def merge(spark: SparkSession, root: str, table: str) -> None:
    """Merge all runs into one, without files that are gone, and drop those that earlier merges replaced."""
    path, found = _path(root, table), runs(spark, root, table)
    complete = tables.names(spark, f"{path}/{COMPLETE}")
    days = list(tables.data_files(spark, root, table))
    if len(found) > 1:
        name = f"merge-{uuid.uuid4().hex}"
        spark.createDataFrame([(r,) for r in complete], "run STRING").coalesce(1).write.parquet(f"{path}/_replaces/run={name}")
        left = [rows.where(F.col("day").isin(days)) for rows in (_rows(spark, root, table, found), ledger(spark, root, table, found))]
        _write(*left, root, table, name)
    for name in set(complete) - set(found):
        for part in (f"{COMPLETE}/{name}", f"run={name}", f"{LEDGER}/run={name}"):
            tables.drop(spark, f"{path}/{part}")


@dataclass(frozen=True)
class Condition:
    """A value that a matching row must hold, in one of several ways: kind, field, and how the value compares."""

    ways: tuple[tuple[str, str, str, str], ...]

    def test(self) -> Column:
        def way(kind: str, field: str, how: str, value: str) -> Column:
            held = F.col("value")
            fits = {"is": held == value, "starts": held.startswith(value), "ends": held.endswith(value), "has": held.contains(value)}[how]
            return (F.col("kind") == kind) & (F.col("field") == field) & (fits | held.isNull())

        return reduce(or_, (way(*w) for w in self.ways))


def label_field(label: str) -> str | None:
    """The field of the index that holds a log label; none for ids, which are no labels there."""
    column = attributes.LOG_LABEL_COLUMNS.get(label)
    if column is None:
        return attributes.dotted(label)
    return {"ServiceName": "service_name", "SeverityText": "level"}.get(column)


def tag_field(tag: str) -> str:
    """The field of the index that holds a span's tag."""
    tag = tag.lstrip(".")
    if tag in attributes.TAG_COLUMNS:
        return {"ServiceName": "resource.service.name", "SpanName": "name"}[attributes.TAG_COLUMNS[tag]]
    return tag if tag.startswith(("span.", "resource.")) else f"span.{tag}"


def _label_way(matcher: LabelMatcher) -> tuple[str, str, str, str] | None:
    if matcher.op is not MatchOp.EQ or not matcher.value:
        return None
    if matcher.label == "trace_id":
        return TRACE, "TraceId", "is", matcher.value
    field = label_field(matcher.label)
    return None if field is None else (LABEL, field, "is", matcher.value)


def _line_conditions(needle: str) -> list[Condition]:
    """The tokens of a text looked for inside a body; those at its ends may be parts of longer ones."""
    pieces = re.split(SEPARATORS, needle)
    found = []
    for i, piece in enumerate(pieces):
        if piece:
            # a separator at an end of the text leaves an empty first or last piece
            first, last = i == 0, i == len(pieces) - 1
            how = "ends" if first else "starts" if last else "is"
            if first and last or len(piece) > LONGEST // 2:
                how = "has"
            found.append(Condition(((TOKEN, "Body", how, piece[: LONGEST // 2]),)))
    return found


def log_conditions(query: LogQuery) -> list[Condition]:
    """What every matching log must hold, as far as the index can tell."""
    found = [Condition((way,)) for m in query.matchers if (way := _label_way(m))]
    for stage in query.pipeline:
        if isinstance(stage, LineFilter) and stage.op is LineOp.CONTAINS:
            found += _line_conditions(stage.value)
        elif isinstance(stage, LabelFilter):
            ways = [_label_way(m) for m in stage.matchers]
            if stage.any_of and ways and all(ways):
                found.append(Condition(tuple(ways)))
            elif not stage.any_of:
                found += [Condition((way,)) for way in ways if way]
    return found


def trace_conditions(query: TraceQuery) -> list[Condition]:
    """What every matching span must hold, as far as the index can tell."""
    found = []
    for c in query.conditions:
        if c.op is not TraceOp.EQ or not c.value or c.field == "duration" or c.value == "nil" and not c.quoted:
            continue
        # stored in title case
        value = c.value[:1].upper() + c.value[1:] if c.field in ("status", "kind") else c.value
        scoped = c.field in attributes.SPAN_FIELD_COLUMNS or c.field.startswith(("span.", "resource."))
        found.append(Condition(((LABEL, c.field if scoped else f"span.{c.field}", "is", value),)))
    return found


def trace_condition(trace_id: str) -> list[Condition]:
    return [Condition(((TRACE, "TraceId", "is", trace_id),))] if trace_id else []


def narrowed(
    spark: SparkSession,
    root: str,
    table: str,
    conditions: list[Condition],
    start: Instant | None,
    end: Instant | None,
    promote: tables.Promoted | None = None,
) -> DataFrame | None:
    """The rows of the files that can match all conditions; None where an index cannot tell."""
    found = runs(spark, root, table) if conditions else []
    if not found:
        return None
    tables.check_promoted(spark, root, table, promote)
    first, last = ("", "9") if start is None or end is None else (utc_day(epoch_seconds(m)).isoformat() for m in (start, end))
    files = uncovered(spark, root, table, found, first, last)
    tests = [c.test() for c in conditions]
    held = _rows(spark, root, table, found).where(F.col("day").between(first, last) & reduce(or_, tests))
    held = held.groupBy("day", "file").agg(*(F.bool_or(F.coalesce(t, F.lit(False))).alias(f"c{i}") for i, t in enumerate(tests)))
    every = reduce(and_, (F.col(f"c{i}") for i in range(len(tests))))
    present = tables.data_files(spark, root, table, first, last)
    for day, file in held.where(every).select("day", "file").collect():
        if file in present.get(day, ()):
            files.setdefault(day, []).append(file)
    return tables.read_files(spark, root, table, files, promote)


def known_values(
    spark: SparkSession, root: str, table: str, field: str, start: Instant | None, end: Instant | None
) -> tuple[DataFrame, dict[str, list[str]]] | None:
    """(values of a field, files to be scanned for more): the values of whole days' indexed files, and all other files.

    None without an index. Files that hold a value too long for the index are scanned as well.
    """
    found = runs(spark, root, table)
    if not found:
        return None
    first, last, bounds = "", "9", ("", "9")
    if start is not None and end is not None:
        seconds = epoch_seconds(start), epoch_seconds(end)
        bounds = tuple(utc_day(s).isoformat() for s in seconds)
        # a day counts as whole from its first to its last second
        first = utc_day(seconds[0] + DAY - 1).isoformat()
        last = utc_day(seconds[1] + 1 - DAY).isoformat()
    listed = tables.data_files(spark, root, table, *bounds)
    days = [day for day in listed if first <= day <= last]
    files = {day: sorted(names) for day, names in listed.items() if day not in days}
    files |= {day: names for day, names in uncovered(spark, root, table, found, *bounds).items() if day in days}
    rows = _rows(spark, root, table, found).where((F.col("kind") == LABEL) & (F.col("field") == field) & F.col("day").isin(days))
    for day, file in rows.where("value IS NULL").select("day", "file").distinct().collect():
        if file in listed[day]:
            files.setdefault(day, []).append(file)
    return rows.where("value IS NOT NULL").select("value").distinct(), files
