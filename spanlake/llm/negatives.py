"""Hard negatives of anchor vectors by exact inner products, with candidate lists that the anchors of a cluster share.

Anchors are clustered by direction. For a cluster, every candidate has one bound on its product with any member: the product of
the norms and the cosine of the angle to the cluster's centroid less the widest angle of a member to it. Candidates are sorted by it
once; each member walks the list in blocks and ends where the bound of all that follows certifies that nothing there can
enter its result. A first walk finds each anchor's positives, the best rows of its own label; a second one, per positive, the best
rows of other labels whose scores lie in the band that the positive's score spans.

On Spark the list is cut: rows are dealt by hash into shards of about ``SHARD`` rows, anchors into blocks of about ``BLOCK``, clusters
together as far as they fit. A task holds one shard and one block, sorts the shard for each cluster and walks it; per anchor only the
best of a shard leave the task and are ranked over all shards. This is the stated set of anchors against all rows, in blocks.
Centroids come from a sample of ``SAMPLE`` anchors, picked by hash; they only order the work, results are exact with any.

Scores are inner products of integers, the floors of 256 times the components. They are computed in doubles where these hold them
exactly, else in integers of any size; scores beyond a long are returned as the nearest long.

Defined results: rows with a null id, label or vector or with a null or non-finite component take no part; repeated rows of an id count once, of
different ones the smallest label and vector; vectors of different lengths are not compared; empty and zero vectors score 0; equal scores are
ordered by id; an anchor without positives or a positive without negatives gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanlake.llm.common import prepare, staged

POSITIVES = 5
NEGATIVES = 10

# The band of a negative's score, in hundredths of the positive's.
BAND = (30, 90)

# Fixed value: components are scaled by it before they are cut to integers.
SCALE = 256

SHARD = 4096
BLOCK = 1024

# anchors the centroids are fitted on, anchors for each of them, and rounds
SAMPLE = 2048
PER_CENTROID = 64
ROUNDS = 8

# rows of the shared list looked at in one go
STEP = 256

# allowance for rounding in norms and angles
SLACK = 1e-7

# largest score, in hundredths, that doubles and longs hold exactly
EXACT = 2.0**53 / 128

LONG = 2**63 - 1


def read_vectors(rows: DataFrame, id: str, vector: str, label: Column) -> DataFrame:
    """(id, label, dim, vec) of the rows that take part, once per id; vec has the integer components as doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for id_, label_, value in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if None in value:
                    continue
                x = np.array(value, np.float64)
                if np.isfinite(x).all():
                    scaled = np.floor(np.clip(x, -1e300, 1e300) * SCALE) + 0.0  # one zero, not two
                    out.append((id_, label_, len(x), scaled.tobytes()))
            columns = list(zip(*out)) or [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["id", "label", "dim", "vec"])

    usable = rows.select(rows[id].cast("bigint").alias("id"), label.cast("bigint").alias("label"), rows[vector].alias("v"))
    found = usable.where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").mapInArrow(
        run, "id bigint, label bigint, dim int, vec binary"
    )
    return found.groupBy("id").agg(F.min(F.struct("label", "dim", "vec")).alias("r")).select("id", "r.*")


def _matrix(raw: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)


def _norms(x: np.ndarray) -> np.ndarray:
    largest = np.abs(x).max(axis=1, initial=0, keepdims=True)
    return (largest * np.linalg.norm(x / np.where(largest > 0, largest, 1), axis=1, keepdims=True))[:, 0]


def _directions(x: np.ndarray) -> np.ndarray:
    norms = _norms(x)[:, None]
    return x / np.where(norms > 0, norms, 1)


def centroids_of(x: np.ndarray, count: int) -> np.ndarray:
    """Unit vectors that the rows of ``x`` gather around, by spherical k-means from evenly spaced rows."""
    unit = _directions(x)
    found = unit[np.linspace(0, len(unit) - 1, min(count, len(unit))).astype(int)]
    for _ in range(ROUNDS):
        nearest = (unit @ found.T).argmax(axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, unit)
        found = np.where(sums.any(axis=1, keepdims=True), _directions(sums), found)
    return found


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products, exact: as longs, or as integers of any size where a hundredfold could leave the range of doubles."""
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1])
    if most < EXACT:
        return np.rint(a @ b.T).astype(np.int64)
    whole, near = np.frompyfunc(int, 1, 1), np.frompyfunc(lambda v: max(-LONG - 1, min(LONG, v)), 1, 1)
    return near(whole(a).astype(object) @ whole(b).T.astype(object)) if a.shape[1] else np.zeros((len(a), len(b)), np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The first rows by descending score, then id."""
    if scores.dtype == object:
        order = np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i])), int)
    else:
        order = np.lexsort((ids, -scores))
    return scores[order[:limit]], ids[order[:limit]]


class SharedList:
    """The rows of a shard in the order of a cluster's bound."""

    def __init__(self, members: np.ndarray, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, norms: np.ndarray):
        centre = _directions(_directions(members).sum(axis=0, keepdims=True))[0]
        reach = np.arccos(np.clip(_directions(members) @ centre, -1, 1)).max()
        angles = np.arccos(np.clip(_directions(x) @ centre, -1, 1))
        # a centre of zero says nothing about directions
        cosines = np.cos(np.maximum(0, angles - reach - SLACK)) if centre.any() else np.ones(len(x))
        bounds = norms * cosines + norms * SLACK
        order = np.argsort(-bounds, kind="stable")
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]
        self.bounds = np.append(bounds[order], -np.inf)
        self.walked = 0

    def walk(self, members: np.ndarray, take, done) -> None:
        """Each member meets blocks of the list until ``done(member, limit)``, limit bounding every score to come."""
        norms = _norms(members)
        waiting = np.arange(len(members))
        for first in range(0, len(self.ids), STEP):
            block = slice(first, first + STEP)
            scores = products(members[waiting], self.x[block])
            self.walked += scores.size
            for i, own in zip(waiting.tolist(), scores):
                take(i, own, self.ids[block], self.labels[block])
            bound = self.bounds[min(first + STEP, len(self.ids))]
            waiting = np.array([i for i in waiting.tolist() if not done(i, norms[i] * bound if norms[i] else min(bound, 0.0))], int)
            if not len(waiting):
                break


def best_positives(shared: SharedList, members: np.ndarray, ids: np.ndarray, labels: np.ndarray, limit: int) -> list[tuple]:
    """(member, id, score) of the rows with the member's label and the highest scores."""
    found = [(np.array([], np.int64), np.array([], np.int64)) for _ in ids]

    def take(i: int, scores: np.ndarray, others: np.ndarray, own: np.ndarray) -> None:
        fits = (own == labels[i]) & (others != ids[i])
        if len(found[i][0]) == limit:
            fits &= (scores >= found[i][0][-1]).astype(bool)
        if fits.any():
            found[i] = _best(np.concatenate([found[i][0], scores[fits]]), np.concatenate([found[i][1], others[fits]]), limit)

    shared.walk(members, take, lambda i, most: len(found[i][0]) == limit and found[i][0][-1] > most)
    return [(i, int(o), int(s)) for i, (scores, others) in enumerate(found) for s, o in zip(scores, others)]


def best_negatives(
    shared: SharedList, members: np.ndarray, labels: np.ndarray, wanted: list[list[int]], limit: int, band: tuple[int, int]
) -> list[tuple]:
    """(member, positive's score, id, score) of the rows of other labels with the highest scores inside a positive's band."""
    found = [{p: (np.array([], np.int64), np.array([], np.int64)) for p in own} for own in wanted]

    def take(i: int, scores: np.ndarray, others: np.ndarray, own: np.ndarray) -> None:
        different = own != labels[i]
        for p, (best, ids) in found[i].items():
            fits = different & ((100 * scores >= band[0] * p) & (100 * scores <= band[1] * p)).astype(bool)
            if len(best) == limit:
                fits &= (scores >= best[-1]).astype(bool)
            if fits.any():
                found[i][p] = _best(np.concatenate([best, scores[fits]]), np.concatenate([ids, others[fits]]), limit)

    def done(i: int, most: float) -> bool:
        return all(100 * most < band[0] * p or len(best) == limit and best[-1] > most for p, (best, _) in found[i].items())

    shared.walk(members, take, done)
    return [(i, p, int(o), int(s)) for i, own in enumerate(found) for p, (scores, others) in own.items() for s, o in zip(scores, others)]


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    columns = list(zip(*rows)) or [()] * len(names)
    return pd.DataFrame({name: np.array(values, np.int64) for name, values in zip(names, columns)})


def _clusters(anchors: DataFrame, sample: int) -> DataFrame:
    """The anchors with ``cluster``, the nearest centroid of a bounded sample."""
    # bounded by ``sample``
    picked = anchors.orderBy(F.xxhash64(F.lit(11), "id"), "id").limit(sample).select("dim", "vec").toPandas()
    fitted: dict[int, np.ndarray] = {}
    for dim, rows in picked.groupby("dim"):
        x = _matrix(rows["vec"])
        fitted[int(dim)] = centroids_of(x, math.ceil(len(x) / PER_CENTROID))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for dim, vec in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                near = fitted.get(dim)
                out.append(0 if near is None or not dim else int((near @ np.frombuffer(vec, np.float64)).argmax()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int32())], [*batch.schema.names, "cluster"])

    return anchors.mapInArrow(run, "id bigint, label bigint, dim int, vec binary, cluster int")


def _dealt(rows: DataFrame, anchors: DataFrame, shard: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Rows and anchors with their place (dim, shard, block): each row in every block, each anchor in every shard."""
    sizes = rows.groupBy("dim").agg(F.ceil(F.count("*") / shard).cast("int").alias("shards"))
    of_cluster = anchors.groupBy("dim", "cluster").agg(F.count("*").alias("m"))
    all_of = Window.partitionBy("dim")
    of_cluster = of_cluster.select(
        "dim",
        "cluster",
        F.ceil(F.col("m") / block).cast("int").alias("parts"),
        F.ceil(F.sum("m").over(all_of) / block).cast("int").alias("blocks"),
    )
    blocks = of_cluster.select("dim", "blocks").distinct()
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    placed = rows.join(sizes.join(blocks, "dim"), "dim").withColumn("shard", F.pmod(F.xxhash64(F.lit(3), "id"), F.col("shards")).cast("int"))
    placed = placed.withColumn("block", every("blocks")).select("dim", "shard", "block", "id", "label", "vec")
    # a cluster of more anchors than a block holds goes to several
    part = F.pmod(F.xxhash64(F.lit(4), "id"), F.col("parts"))
    asking = anchors.join(of_cluster, ["dim", "cluster"]).withColumn("block", F.pmod(F.col("cluster") + part, F.col("blocks")).cast("int"))
    asking = asking.join(sizes, "dim").withColumn("shard", every("shards")).drop("parts", "blocks", "shards")
    return placed, asking


def mine(
    rows: DataFrame,
    anchor: Column,
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    band: tuple[int, int] = BAND,
    id: str = "vec_id",
    vector: str = "embedding",
    shard: int = SHARD,
    block: int = BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where ``anchor`` holds of ``id``."""
    prepare(rows.sparkSession)
    vectors = staged(read_vectors(rows, id, vector, F.col("label") if label is None else label), "vectors")
    chosen = vectors.join(rows.where(anchor).select(rows[id].cast("bigint").alias("id")).distinct(), "id", "left_semi")
    anchors = staged(_clusters(chosen.select("id", "label", "dim", "vec"), SAMPLE), "anchors")
    keys = ["dim", "shard", "block"]

    def lists(here: pd.DataFrame, asking: pd.DataFrame) -> Iterator[tuple[SharedList, pd.DataFrame, np.ndarray]]:
        if len(here) and len(asking):
            x, ids, labels = _matrix(here["vec"]), here["id"].to_numpy(), here["label"].to_numpy()
            norms = _norms(x)
            for _, members in asking.groupby("cluster"):
                own = _matrix(members["vec"])
                yield SharedList(own, ids, labels, x, norms), members, own

    def find_positives(here: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        out = []
        for shared, members, x in lists(here, asking):
            ids = members["id"].to_numpy()
            found = best_positives(shared, x, ids, members["label"].to_numpy(), positives)
            out += [(ids[i], o, s) for i, o, s in found]
        return _frame(out, ["anchor", "id", "score"])

    def find_negatives(here: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        out = []
        for shared, members, x in lists(here, asking):
            ids, wanted = members["id"].to_numpy(), [[int(p) for p in own] for own in members["scores"]]
            found = best_negatives(shared, x, members["label"].to_numpy(), wanted, negatives, band)
            out += [(ids[i], p, o, s) for i, p, o, s in found]
        return _frame(out, ["anchor", "of", "id", "score"])

    def first(found: DataFrame, limit: int, *of: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*of).orderBy(F.desc("score"), "id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= limit)

    placed, asking = _dealt(vectors, anchors, shard, block)
    placed = placed.groupBy(*keys)
    near = placed.cogroup(asking.groupBy(*keys)).applyInPandas(find_positives, "anchor bigint, id bigint, score bigint")
    near = staged(first(near, positives, "anchor"), "positives")
    wanted = near.groupBy(F.col("anchor").alias("id")).agg(F.sort_array(F.collect_set("score")).alias("scores"))
    asking = asking.join(wanted, "id")
    far = placed.cogroup(asking.groupBy(*keys)).applyInPandas(find_negatives, "anchor bigint, of bigint, id bigint, score bigint")
    far = first(far, negatives, "anchor", "of")
    named = near.select(F.col("anchor").alias("anchor_id"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    negative = far.select(
        F.col("anchor").alias("anchor_id"),
        F.col("of").alias("positive_score"),
        "rank",
        F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    return named.join(negative, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
