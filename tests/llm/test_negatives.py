"""Hard negatives against all pairs, with small shards and blocks, odd vectors and lists that end early."""

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanlake.llm import negatives
import brute

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
        T.StructField("label", T.IntegerType()),
    ]
)

def anchor():
    return F.col("vec_id") % 10 == 0


def mined(spark, rows, **options):
    found = negatives.mine(spark.createDataFrame(rows, SCHEMA), anchor(), **options)
    return sorted(map(tuple, found.collect()))


def plain(rows, **options):
    held = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        new = (label, [int(np.floor(x * 256)) for x in v])
        held[i] = min(held.get(i, new), new)
    return brute.hard_negatives(held, lambda i: i % 10 == 0, **options)


def gathered(n, dim=8, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    return [(i, (centres[i % 6] + 0.4 * rng.normal(size=dim)).tolist(), int(rng.integers(4))) for i in range(n)]


def test_equal_to_all_pairs_over_many_shards_and_blocks(spark):
    rows = gathered(600)
    expected = plain(rows)
    assert len(expected) > 1000
    assert mined(spark, rows) == expected
    assert mined(spark, rows, shard=50, block=7) == expected
    options = {"positives": 2, "negatives": 3, "band": (50, 80)}
    assert mined(spark, rows, shard=64, block=16, **options) == plain(rows, **options)


def test_odd_rows(spark):
    good = gathered(60, 3)
    rows = good + good[:5]  # repeated rows
    rows += [(100, [1.0, None, 0.0], 1), (110, [float("nan"), 1.0, 0.0], 1), (120, None, 1), (130, [1.0, 1.0, 1.0], None)]
    rows += [(None, [1.0, 1.0, 1.0], 1), (140, [0.0, 0.0, 0.0], 1), (150, [], 2), (151, [], 2), (152, [], 3), (160, [1.0, 2.0], 0)]
    rows += [(170, [3.0, 1.0, 2.0], 9), (180, [1.0, 1.0, 1.0], 3), (180, [1.0, 0.0, 1.0], 2)]
    rows += [(200 + i, [0.5, 0.5, 0.5], i % 2) for i in range(40)]  # ties
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, rows, shard=16, block=2) == plain(rows)
    assert mined(spark, []) == []


def test_large_components_are_exact_and_saturate(spark):
    rows = [(0, [1e7, 1.0], 0), (1, [3e6, 1.0], 0), (2, [3e6, 5.0], 0), (3, [1e6, 3.0], 1), (4, [1e6, 4.0], 1)]
    expected = plain(rows)
    assert expected and expected[0][-1] > 2**53
    assert mined(spark, rows) == expected
    huge = [(0, [1e200], 0), (1, [1e200], 0), (2, [1e-190], 1), (3, [1e250], 1)]
    assert mined(spark, huge) == []


def test_extra_columns_are_ignored(spark):
    rows = gathered(80)
    frame = spark.createDataFrame(rows, SCHEMA)
    clashing = frame.selectExpr("*", *(f"'x' AS {c}" for c in ("id", "dim", "vec", "v", "cluster", "shard", "block", "score", "rank")))
    assert sorted(map(tuple, negatives.mine(clashing, anchor()).collect())) == plain(rows)


def test_walks_end_where_the_bound_certifies_it():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 16))
    x = np.floor(256 * (centres[np.arange(20_000) % 20] + 0.1 * rng.normal(size=(20_000, 16))))
    labels, ids = np.arange(20_000) % 3, np.arange(20_000)
    members = x[::20][:50]
    shared = negatives.SharedList(members, ids, labels, x, negatives._norms(x))
    found = negatives.best_positives(shared, members, ids[::20][:50], labels[::20][:50], 5)
    assert shared.walked < 0.5 * members.shape[0] * len(x)
    for i in range(50):
        scores = (x @ members[i]).astype(int)
        fits = (labels == labels[::20][i]) & (ids != ids[::20][i])
        best = sorted(zip(-scores[fits], ids[fits]))[:5]
        assert [(-s, o) for s, o in best] == [(s, o) for m, o, s in found if m == i]
