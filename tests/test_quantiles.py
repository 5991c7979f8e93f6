"""The bracket-wise exact quantile against brute force, on skewed and awkward values."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import rows
from rows import S
from spanlake.functions import quantiles
from spanlake.operators import spans as span_operators
from spanlake.operators.spans import aggregate_spans
from spanlake.plans.queries import SpanAggregation, SpanSort, TraceQuery


def groups():
    """One group holding most rows; small ones with ties, single values, zeros and far-apart values."""
    rng = random.Random(7)
    return {
        "hot": [rng.randrange(1, 10**10) for _ in range(6000)],
        "narrow": [10**9 + rng.randrange(50) for _ in range(500)],
        "ties": [5] * 40 + [7] * 3,
        "two": [1, 10**15],
        "one": [123456789],
        "zeros": [0] * 10 + [1],
        "wide": [rng.randrange(2**k, 2 ** (k + 1)) for k in range(60)],
    }


@pytest.fixture(scope="module")
def table(spark):
    data = [(key, value) for key, values in groups().items() for value in values]
    random.Random(1).shuffle(data)
    return rows.spans(
        spark,
        *({"TimestampNano": S, "SpanName": key, "Duration": value, "SpanId": str(i)} for i, (key, value) in enumerate(data)),
    ).repartition(8)


def interpolated(values, q):
    """Linear interpolation between neighbours, as exact integers wherever possible."""
    ordered = sorted(values)
    rank = (len(ordered) - 1) * q
    low = math.floor(rank)
    high = min(low + 1, len(ordered) - 1)
    return ordered[low] + (ordered[high] - ordered[low]) * (rank - low)


@pytest.mark.parametrize("q", [0.0, 0.01, 0.25, 0.5, 0.9, 0.95, 0.999, 1.0])
@pytest.mark.parametrize("sort", [SpanSort.TOTAL, SpanSort.P95])
def test_exact_quantiles(table, q, sort):
    ranking = SpanAggregation(TraceQuery(), "name", quantile=q, sort=sort, limit=100)
    got = {r.key: r for r in aggregate_spans(table, ranking, 0, 10).collect()}
    assert set(got) == set(groups())
    for key, values in groups().items():
        assert got[key].p95_ms == pytest.approx(interpolated(values, q) / 1e6, rel=1e-12, abs=1e-12)
        assert got[key]["count"] == len(values)
        assert got[key].max_ms == max(values) / 1e6
        assert got[key].total_ms == pytest.approx(sum(values) / 1e6, rel=1e-15)


@pytest.mark.parametrize("limit", [1, 2, 3, 5])
def test_quantile_ranking_drops_no_group_too_early(table, limit):
    ranking = SpanAggregation(TraceQuery(), "name", sort=SpanSort.P95, limit=limit)
    got = [r.key for r in aggregate_spans(table, ranking, 0, 10).collect()]
    want = sorted(groups(), key=lambda k: (-interpolated(groups()[k], 0.95), k))[:limit]
    assert got == want


def test_brackets_never_decrease(spark):
    values = sorted({0, 1, 2, 3, *(2**k + d for k in range(2, 63) for d in (-1, 0, 1)), 2**63 - 1})
    data = spark.createDataFrame([(v,) for v in values], "v bigint").coalesce(1)
    brackets = [r.b for r in data.orderBy("v").select(quantiles.coarse_bracket(F.col("v")).alias("b")).collect()]
    assert brackets == sorted(brackets)
    assert max(brackets) <= 63 * quantiles.COARSE


def test_totals_beyond_bigint(spark):
    huge = rows.spans(
        spark, *({"TimestampNano": S, "SpanName": "n", "Duration": 2**62, "SpanId": str(i)} for i in range(8))
    )
    for exact in (True, False):
        (row,) = aggregate_spans(huge, SpanAggregation(TraceQuery(), "name"), 0, 10, exact=exact).collect()
        assert row.total_ms == pytest.approx(8 * 2**62 / 1e6)


def test_sketch_stays_within_its_rank_error(table):
    ranking = SpanAggregation(TraceQuery(), "name", limit=100)
    got = {r.key: r.p95_ms * 1e6 for r in aggregate_spans(table, ranking, 0, 10, exact=False).collect()}
    for key, values in groups().items():
        # milliseconds and back are not exact to the last digit
        low, high = got[key] * (1 - 1e-12), got[key] * (1 + 1e-12)
        below, upto = np.mean(np.array(values) < low), np.mean(np.array(values) <= high)
        assert below - 0.01 <= 0.95 <= upto + 0.01


def test_plan_spreads_a_hot_group(table):
    """The ranking may not gather a group: value or bracket is part of every shuffle of unaggregated rows."""
    plan = aggregate_spans(table, SpanAggregation(TraceQuery(), "name"), 0, 10)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    exchanges = [line for line in text.splitlines() if "hashpartitioning" in line]
    assert any("bracket" in line for line in exchanges)
    assert any("d#" in line for line in exchanges)
    assert "percentile" not in text and "CartesianProduct" not in text


HISTOGRAMS = [
    ([10, 10, 0], [10.0, 20.0], 0.5, 10.0),
    ([10, 10, 0], [10.0, 20.0], 0.75, 15.0),
    ([], [], 0.95, math.nan),
    ([0, 0, 0], [10.0, 20.0], 0.5, math.nan),
    ([5], [], 0.5, math.nan),
    ([0, 0, 4], [10.0, 20.0], 0.5, 20.0),
    ([0, 4], [10.0, 20.0], 0.0, 0.0),
    ([1, 1], [10.0, 20.0], 1.5, 20.0),
    ([1, 1, 1, 1], [10.0], 1.0, 0.0),
    ([4, 0, 4], [10.0, 20.0], 0.25, 5.0),
]


@pytest.mark.parametrize(("buckets", "bounds", "q", "expected"), HISTOGRAMS)
def test_histogram_quantile(spark, buckets, bounds, q, expected):
    from spanlake.operators.metrics import sum_buckets

    point = {"BucketCounts": buckets, "ExplicitBounds": bounds, "MetricName": "m"}
    table = rows.metrics(spark, histogram=[point]).histogram
    summed = sum_buckets(table, ["MetricName"])
    (row,) = quantiles.histogram_quantile(summed, ["MetricName"], q).collect()
    assert row.value == expected or (math.isnan(row.value) and math.isnan(expected))


def test_equal_hashes_of_different_keys_do_no_harm(table, monkeypatch):
    ranking = SpanAggregation(TraceQuery(), "name", limit=4)
    expected = aggregate_spans(table, ranking, 0, 10).collect()
    monkeypatch.setattr(quantiles.F, "xxhash64", lambda *_: F.lit(1).cast("bigint"))
    assert aggregate_spans(table, ranking, 0, 10).collect() == expected


def test_broadcast_needs_a_known_size(table, monkeypatch):
    """Beyond the bound the same result comes from a plain join."""
    ranking = SpanAggregation(TraceQuery(), "name", limit=100)
    few = aggregate_spans(table, ranking, 0, 10).collect()
    monkeypatch.setattr(span_operators, "BROADCAST_ROWS", 0)
    plain = aggregate_spans(table, ranking, 0, 10)
    assert "strategy=broadcast" not in plain._jdf.queryExecution().analyzed().toString()
    assert plain.collect() == few
