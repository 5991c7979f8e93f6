"""The per-minute rollup of database statements: building, merging, compacting and querying it.

Partial rows of one key may exist any number of times (one per insert); counts and sums add up, the maximum and the
duration counts merge, so every read re-aggregates and the result does not depend on how spans were dealt into partial rows.

Durations are counted per bracket: a power of two is cut into 2^BITS brackets, and a bracket keeps its count with the smallest
and the largest duration in it. A quantile is exact where its bracket holds one value or the rank is the bracket's first or
last, and otherwise lies between the two: less than one part in 2^BITS off. ``statement_quantiles`` returns these ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanlake.functions import attributes
from spanlake.functions.times import NANOS, Instant, day_range, epoch_seconds, whole
from spanlake.operators.ranking import BROADCAST_ROWS, in_order, ranked, statistics
from spanlake.plans.queries import SpanAggregation, SpanSort, UnsupportedQuery

# The spans the rollup covers.
STATEMENT_SPAN = "db.query"
STATEMENT_FIELD = "span.db.query.text"
SYSTEM_FIELD = "span.db.system.name"

# size of the sketch of single-scan rankings over spans: exact up to about this many rows per key, afterwards a rank error of
# about 0.3 %
SKETCH_K = 1024

# bits of a duration that tell brackets apart
BITS = 10

# a sum of nanoseconds can outgrow BIGINT: the parts above and below this bit are summed apart
SPLIT = 20

MINUTE = 60 * NANOS
STATEMENT = ("Bucket", "QueryText", "DbSystem")
KEYS = (*STATEMENT, "day")

WIDE = "decimal(38,0)"


def bracket(value: str) -> Column:
    """The smallest duration of the bracket that ``value``, a column's name, lies in. Integers only, so exact everywhere."""
    # the logarithm may round up or down to a power of two
    near = f"CAST(floor(log2({value})) AS INT)"
    power = f"({near} + CASE WHEN shiftright({value}, {near}) = 0 THEN -1 WHEN shiftright({value}, {near}) > 1 THEN 1 ELSE 0 END)"
    cut = f"greatest({power} - {BITS}, 0)"
    return F.expr(f"IF({value} < {1 << BITS}, {value}, shiftleft(shiftright({value}, {cut}), {cut}))")


def statements(traces: DataFrame, *keep: str) -> DataFrame:
    """(Bucket, QueryText, DbSystem, Duration) of every span, with further columns; the text is empty where no rollup covers it."""
    minute = F.timestamp_seconds(whole(F.col("TimestampNano"), MINUTE) * 60)
    covered = F.col("SpanName") == STATEMENT_SPAN
    return traces.select(
        minute.alias("Bucket"),
        F.when(covered, attributes.span_field(traces, STATEMENT_FIELD)).otherwise("").alias("QueryText"),
        attributes.span_field(traces, SYSTEM_FIELD).alias("DbSystem"),
        "Duration",
        *keep,
    )


def rollup_partial(traces: DataFrame) -> DataFrame:
    """Rollup rows of the given spans; also the one-time backfill when run over the whole table."""
    present = attributes.span_field(traces, STATEMENT_FIELD, nullable=True) != ""
    return partial_rows(statements(traces.where((F.col("SpanName") == STATEMENT_SPAN) & present)))


def partial_rows(keyed: DataFrame) -> DataFrame:
    """Rollup rows of ``statements``."""
    counted = keyed.where("QueryText <> ''").groupBy(*STATEMENT, bracket("Duration").alias("bracket")).agg(
        F.min("Duration").alias("low"),
        F.max("Duration").alias("high"),
        F.count("*").alias("n"),
        (
            F.sum(F.shiftright("Duration", SPLIT)).cast(WIDE) * F.lit(1 << SPLIT)
            + F.sum(F.col("Duration").bitwiseAND((1 << SPLIT) - 1))
        ).alias("total"),
    )
    return _gathered(counted, STATEMENT).withColumn("day", F.to_date("Bucket")).select(*COLUMNS)


COLUMNS = (*STATEMENT, "Calls", "DurationSum", "DurationMax", "DurationCounts", "day")


def _gathered(counted: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One row per key from one row per key and bracket; the number of brackets bounds the list."""
    return counted.groupBy(*keys).agg(
        F.sum("n").alias("Calls"),
        F.sum("total").cast(WIDE).alias("DurationSum"),
        F.max("high").alias("DurationMax"),
        F.sort_array(F.collect_list(F.struct("low", "high", "n"))).alias("DurationCounts"),
    )


def compact_rollup(summary: DataFrame) -> DataFrame:
    """One row per key, from any number of partial rows."""
    counts = summary.select(*KEYS, "DurationSum", F.posexplode("DurationCounts").alias("pos", "c"))
    # a partial row's sum counts with its first bracket
    total = F.when(F.col("pos") == 0, F.col("DurationSum")).otherwise(F.lit(0).cast(WIDE))
    counts = counts.select(*KEYS, "c.*", total.alias("total"))
    merged = counts.groupBy(*KEYS, bracket("low").alias("bracket")).agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"), F.sum("total").alias("total")
    )
    return _gathered(merged, KEYS).select(*COLUMNS)


def in_range(summary: DataFrame, start: Instant, end: Instant) -> DataFrame:
    """The rows whose minute starts inside the range (both ends included)."""
    first, last = epoch_seconds(start), epoch_seconds(end)
    return summary.where(
        F.col("Bucket").between(F.timestamp_seconds(F.lit(first)), F.timestamp_seconds(F.lit(last)))
        & day_range(first, last)
        & (F.col("QueryText") != "")
    )


def quantiles_of(rows: DataFrame, key: str, q: float) -> DataFrame:
    """(key, ``low``, ``high``, ``quantile``) of rollup rows: the wanted rank's duration, and the ends it lies between."""
    counts = rows.select(F.col(key), F.explode("DurationCounts").alias("c")).select(key, "c.*")
    merged = counts.groupBy(key, bracket("low").alias("bracket")).agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")
    )
    of_key = Window.partitionBy(key)
    upto = F.sum("n").over(of_key.orderBy("bracket"))
    rank = F.greatest(F.lit(1), F.ceil(F.sum("n").over(of_key) * F.lit(float(q))))
    # the rank's place inside its bracket, from 1 to n
    placed = merged.withColumn("place", rank - upto + F.col("n")).where(F.col("place").between(1, F.col("n")))
    steps = F.greatest(F.col("n") - 1, F.lit(1))
    inside = F.floor((F.col("high") - F.col("low")).cast("double") * (F.col("place") - 1) / steps)
    value = F.when(F.col("place") == F.col("n"), F.col("high")).otherwise(F.col("low") + inside)
    exact = F.col("place").isin(1) | (F.col("place") == F.col("n"))
    return placed.select(
        key,
        F.when(exact, value).otherwise(F.col("low")).alias("low"),
        F.when(exact, value).otherwise(F.col("high")).alias("high"),
        value.alias("quantile"),
    )


def statement_quantiles(summary: DataFrame, q: float, start: Instant, end: Instant) -> DataFrame:
    """(statement, low, high, quantile) in nanoseconds of every statement: the true quantile lies between low and high."""
    rows = in_range(summary, start, end).withColumnRenamed("QueryText", "statement")
    return quantiles_of(rows, "statement", q)


def rollup_query(summary: DataFrame, aggregation: SpanAggregation, start: Instant, end: Instant) -> DataFrame:
    """The statement ranking from rollup rows whose minute starts inside the range (both ends included)."""
    if any(field != SYSTEM_FIELD for field in aggregation.carry):
        raise UnsupportedQuery(f"the rollup carries {SYSTEM_FIELD} only")
    rows = in_range(summary, start, end).withColumnRenamed("QueryText", "key")
    # the system joins the grouping first: MIN over text would force a sort of all rows
    stats = rows.groupBy("key", "DbSystem").agg(
        F.sum("Calls").alias("calls"), F.sum("DurationSum").alias("total"), F.max("DurationMax").alias("longest")
    )
    system = F.min(F.nullif(F.col("DbSystem"), F.lit("")))
    stats = stats.groupBy("key").agg(
        F.sum("calls").alias("calls"),
        F.sum("total").cast("double").alias("total"),
        F.max("longest").alias("longest"),
        *(system.alias(f"carry_{i}") for i in range(len(aggregation.carry))),
    )
    if aggregation.sort is SpanSort.P95:
        found = stats.join(quantiles_of(rows, "key", aggregation.quantile).drop("low", "high"), "key")
        return statistics(ranked(found, aggregation), aggregation)
    # the lists are read for the ranked statements only
    top = ranked(stats, aggregation)
    few = aggregation.limit <= BROADCAST_ROWS
    wanted = rows.join(F.broadcast(top.select("key")) if few else top.select("key"), "key", "left_semi")
    found = top.join(quantiles_of(wanted, "key", aggregation.quantile).drop("low", "high"), "key")
    return statistics(in_order(found, aggregation), aggregation)
