"""Exact quantiles per group, and histogram quantiles, without gathering a group's rows in one task.

``percentile`` keeps every distinct value of a group in one buffer, so one hot key can outgrow a task. Here a group is
first counted into value brackets (a fixed number per power of two), which bounds what any task holds per group; only the
bracket that contains the wanted rank is looked at value by value.

A *bracket table* has the key columns plus ``bracket``, ``n`` (rows), ``low`` and ``high`` (smallest and largest value).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# brackets per power of two in the first cut: at most 63 * 16 rows per group
COARSE = 16
# equal-width brackets the located one is split into
FINE = 4096


def coarse_bracket(value: Column) -> Column:
    """A number that never decreases with a non-negative value; each step is about 4.4 % wide."""
    return F.floor(F.log2(value + F.lit(1.0)) * COARSE).cast("int")


def rows_of(rows: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """The rows whose text ``key`` is among the targets, with the targets' columns.

    Joined by a 64-bit hash, several times as fast as by text; the two comparisons settle collisions (written as an equality
    they would become part of the join key). How targets travel is left to the caller's hint on them.
    """
    wanted = targets.withColumnRenamed(key, "wanted").withColumn("wanted_hash", F.xxhash64("wanted"))
    hashed = rows.withColumn("row_hash", F.xxhash64(key))
    same = (
        (F.col("row_hash") == F.col("wanted_hash")) & (F.col(key) >= F.col("wanted")) & (F.col(key) <= F.col("wanted"))
    )
    return hashed.join(wanted, same).drop("wanted", "wanted_hash", "row_hash")


def _fine_bracket(value: Column) -> Column:
    # never NULL: an inferred IS NOT NULL filter would make the two uses of the counted values differ, and with that
    # cost the reuse of their shuffle
    width = (F.col("high") - F.col("low") + 1) / F.lit(float(FINE))
    return F.coalesce(F.floor((value - F.col("low")) / width), F.lit(0))


def locate_first(brackets: DataFrame, keys: list[str], q: float, extra: list[Column]) -> DataFrame:
    """One row per group: the bracket that holds rank ``q * (rows - 1)``, plus ``extra`` aggregates over its brackets.

    ``skip`` is the rank inside the bracket, ``share`` the interpolation weight of the next value, and ``after`` the
    smallest value behind the bracket.
    """
    group = Window.partitionBy(*keys)
    ordered = group.orderBy("bracket")
    rank = (F.sum("n").over(group) - 1) * F.lit(float(q))
    whole = F.floor(rank)
    running = F.sum("n").over(ordered)
    ranked = brackets.select(
        "*",
        whole.alias("rank"),
        (rank - whole).alias("share_all"),
        (running - F.col("n")).alias("before"),
        F.lead("low").over(ordered).alias("next_low"),
    )
    return ranked.groupBy(*keys).agg(*_located(), F.max("share_all").alias("share"), *extra)


def _located() -> list[Column]:
    holds = (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n"))

    def picked(column: Column, name: str) -> Column:
        return F.max(F.when(holds, column)).alias(name)

    return [
        picked(F.col("low"), "low"),
        picked(F.col("high"), "high"),
        picked(F.col("n"), "n"),
        picked(F.col("rank") - F.col("before"), "skip"),
        picked(F.col("next_low"), "after"),
    ]


def refine(values: DataFrame, value: str, targets: DataFrame, key: str, keep: list[str]) -> DataFrame:
    """The interpolated quantile of every target, from the rows that fall into its bracket.

    ``values`` has ``key`` and ``value``; ``targets`` is the outcome of ``locate_first`` with one row per ``key``. ``keep``
    names further target columns to return.
    """
    wanted = targets.select(key, "low", "high", "skip", "share", "after", *keep)
    inside = rows_of(values, wanted, key).where(F.col(value).between(F.col("low"), F.col("high")))
    by_target = [key, "low", "high", "skip", "share", "after", *keep]

    # the value is part of the shuffle key, so a hot group spreads over all tasks
    counted = inside.groupBy(*by_target, F.col(value).alias("v")).agg(F.count("*").alias("n"))
    fine = counted.withColumn("bracket", _fine_bracket(F.col("v")))

    # find the fine bracket: at most FINE rows per group
    group = Window.partitionBy(key).orderBy("bracket")
    sums = fine.groupBy(*by_target, "bracket").agg(F.sum("n").alias("n"), F.min("v").alias("first"))
    sums = sums.select(
        *by_target,
        "bracket",
        "n",
        (F.sum("n").over(group) - F.col("n")).alias("before"),
        F.coalesce(F.lead("first").over(group), F.col("after")).alias("next_low"),
    )
    holding = sums.where((F.col("skip") >= F.col("before")) & (F.col("skip") < F.col("before") + F.col("n")))
    holding = holding.select(
        key, "bracket", "share", *keep, (F.col("skip") - F.col("before")).alias("rest"), "next_low"
    )

    # and the value inside it
    last = fine.select(key, "bracket", "v", "n").join(holding, [key, "bracket"])
    upto = F.sum("n").over(Window.partitionBy(key).orderBy("v"))
    last = last.withColumn("upto", upto)
    exact = F.min(F.when(F.col("upto") > F.col("rest"), F.col("v")))
    following = F.coalesce(F.min(F.when(F.col("upto") > F.col("rest") + 1, F.col("v"))), F.max("next_low"), exact)
    return last.groupBy(key, "share", *keep).agg((exact + (following - exact) * F.col("share")).alias("quantile"))


def histogram_quantile(buckets: DataFrame, keys: list[str], q: float) -> DataFrame:
    """Quantile of bucketed counts, linear inside the bucket that crosses the rank.

    ``buckets`` has the key columns plus ``pos`` (0-based, NULL for a group without buckets), ``n`` and the group's
    ``bounds``; a group holds one row per bucket. Empty groups and groups without bounds give NaN.
    """
    group = Window.partitionBy(*keys)
    total = F.sum("n").over(group).cast("double")
    running = F.sum("n").over(group.orderBy("pos")).cast("double")
    ranked = buckets.select(
        *keys, "pos", "bounds", F.col("n").cast("double").alias("n"), total.alias("total"), running.alias("running")
    )
    rank = F.col("total") * F.lit(float(q))
    # where a bound is missing the lower edge is 0 and the upper edge the lower one
    lower = F.when(F.col("pos") == 0, F.lit(0.0)).otherwise(F.coalesce(F.get("bounds", F.col("pos") - 1), F.lit(0.0)))
    upper = F.coalesce(F.get("bounds", F.col("pos")), lower)
    inside = F.when(F.col("n") > 0, (rank - (F.col("running") - F.col("n"))) / F.col("n")).otherwise(0.0)
    usable = (F.col("total") > 0) & (F.size("bounds") > 0)
    crossing = F.when(
        usable & (F.col("running") >= rank),
        F.struct(F.col("pos"), (lower + (upper - lower) * inside).alias("value")),
    )
    overflow = F.max(F.when(usable, F.element_at("bounds", -1)))
    return ranked.groupBy(*keys).agg(
        F.coalesce(F.min(crossing)["value"], overflow, F.lit(float("nan"))).alias("value")
    )
