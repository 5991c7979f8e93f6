"""Mixing to target weights with soft membership.

A classifier trained on a labelled table gives every document a probability for each domain. A document sampled at rate r
then contributes r times its tokens times these probabilities to the domains' expected token totals. The nonnegative
rates closest to the targets, by half the squared distance, are found by projected gradient steps: each step needs sums over the
documents alone (a handful of numbers per task), moves each document's free rate along its probabilities and cuts it off at its
floor (``solve``). Rates start at 1, so a document is changed no more than the targets ask.

The classifier is a softmax regression on the words that tell the domains apart the most and a few shape measures, trained
on at most ``TRAIN_DOCUMENTS`` labelled documents picked by hash. The model, of fixed size, is sent to the tasks; texts are
read once, and what the steps read (ids, tokens, probabilities, floors) is a table in the shared folder.

A document with a label has the floor of its label. One without has the floor of a domain if that is its likeliest, or if its
probability is at least the lowest that a document labelled so got from a model trained without it (``FOLDS`` parts).

Defined results: a null or empty text has no tokens, and a rate like others of its probabilities; repeated rows get equal
rates; without labels every document belongs to the first target's domain; a domain that no document can reach is left
out and the other targets are scaled up; extra columns are ignored in rates and stay in the mixed rows; an empty table
stays empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanlake.llm.common import prepare, staged, whole, words
from spanlake.llm.labelled import MASK, codes, sample

TRAIN_DOCUMENTS = 3_000
WORDS = 256
MIN_DOCUMENTS = 5
FOLDS = 5
EPOCHS = 300
RATE = 0.02
DECAY = 0.03

SHAPE = 6

# what the documents' rates weigh beside the distance, against the number of tokens; steps; and when the step counts as exact
RIDGE = 1e-8
MAX_STEPS = 100
TOLERANCE = 1e-9

# lengths of a step that are tried at once
LENGTHS = (1.0, 0.5, 0.25, 0.1, 0.03, 0.01, 0.001, 1e-5)


@dataclass
class Classifier:
    names: list[str]
    columns: np.ndarray  # place of a word's code among the words that count, or -1
    weights: np.ndarray  # features x domains
    mean: np.ndarray
    spread: np.ndarray
    least: np.ndarray | None = None  # per domain, the lowest probability of its own documents when held out

    def posteriors(self, rows: list[tuple[tuple, np.ndarray]]) -> np.ndarray:
        z = ((features(rows, self.columns) - self.mean) / self.spread) @ self.weights[:-1] + self.weights[-1]
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def measure(text: str) -> tuple[tuple, np.ndarray]:
    """Shape measures of a text, and the codes of its words."""
    code = codes.of(text)
    codes.trim()
    raw = np.frombuffer(text.encode(), np.uint8)
    seen, n = np.bincount(raw, minlength=128), max(1, len(code))
    distinct = np.unique(code & MASK)
    shape = (
        np.log1p(len(code)),
        seen[list(b"#*$%&|<>")].sum() / n,
        seen[list(b"!?")].sum() / n,
        seen[65:91].sum() / max(1, len(raw)),
        len(raw) / n / 10,
        len(distinct) / n,
    )
    return shape, distinct.astype(np.int32)


def features(rows: list[tuple[tuple, np.ndarray]], columns: np.ndarray) -> np.ndarray:
    """Shape measures and presence of the words that count, a row per text."""
    out = np.zeros((len(rows), SHAPE + int(columns.max()) + 1), np.float32)
    for row, (shape, distinct) in zip(out, rows):
        row[:SHAPE] = shape
        found = columns[distinct]
        row[SHAPE + found[found >= 0]] = 1
    return out


def choose(rows: list[tuple[tuple, np.ndarray]], y: np.ndarray) -> np.ndarray:
    """The place of each code among the ``WORDS`` whose documents are spread over the domains least by chance."""
    none = [np.zeros(0, np.int32)]
    held = np.array(
        [np.bincount(np.concatenate(none + [w for (_, w), k in zip(rows, y[:, d]) if k]), minlength=MASK + 1) for d in range(y.shape[1])]
    )
    expected = held.sum(axis=0) * y.mean(axis=0)[:, None]
    score = ((held - expected) ** 2 / np.maximum(expected, 1e-9)).sum(axis=0)
    score[held.sum(axis=0) < MIN_DOCUMENTS] = 0
    best = np.argsort(-score, kind="stable")[:WORDS]
    best = best[score[best] > 0]
    columns = np.full(MASK + 1, -1, np.int16)
    columns[best] = np.arange(len(best))
    return columns


def _fit(rows: list[tuple[tuple, np.ndarray]], y: np.ndarray, names: list[str]) -> Classifier:
    """Softmax regression by adaptive gradient steps over all rows."""
    columns = choose(rows, y)
    x = features(rows, columns)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 0.05
    x = np.hstack([(x - mean) / spread, np.ones((len(x), 1), np.float32)])
    w = np.zeros((x.shape[1], len(names)), np.float32)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, EPOCHS + 1):
        z = x @ w
        e = np.exp(z - z.max(axis=1, keepdims=True))
        grad = x.T @ (e / e.sum(axis=1, keepdims=True) - y) / len(x) + DECAY * w
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        w -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Classifier(names, columns, w, mean, spread)


def train(texts: list[str], labels: list[str], names: list[str]) -> Classifier:
    """A model of the whole sample; ``least`` comes from models that have not seen the documents they judge."""
    rows = [measure(text) for text in texts]
    codes.clear()  # the driver needs them no more
    y = np.array([[name == label for name in names] for label in labels], np.float32)
    model = _fit(rows, y, names)
    part = np.random.default_rng(1).permutation(len(rows)) % FOLDS
    p = np.zeros(y.shape)
    for fold in range(FOLDS):
        held, rest = np.flatnonzero(part == fold), np.flatnonzero(part != fold)
        if len(held) and len(rest):
            p[held] = _fit([rows[i] for i in rest], y[rest], names).posteriors([rows[i] for i in held])
    model.least = np.where(y > 0, p, 1).min(axis=0)
    return model


def domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of a table of quality and toxicity labels: toxic, else low, else clean."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "clean")
    return labels.select("doc_id", domain.alias("domain"))


def fit(docs: DataFrame, labelled: DataFrame, names: list[str], limit: int = TRAIN_DOCUMENTS) -> Classifier | None:
    """Train on at most ``limit`` rows of (doc_id, domain) whose document is there."""
    prepare(docs.sparkSession)
    here = labelled.join(docs.select("doc_id"), "doc_id", "left_semi")
    rows = sample(docs.select("doc_id", "text"), here, limit, F.col("domain").isin(names)).toArrow()
    if not rows.num_rows:
        return None
    rows = rows.sort_by("doc_id")
    found = rows["domain"].to_pylist()
    return train([t or "" for t in rows["text"].to_pylist()], found, [n for n in names if n in found])


def posteriors(docs: DataFrame, model: Classifier, text: str = "text") -> DataFrame:
    """The input with ``n_tokens`` (words) and ``p``, the probabilities in the order of the model's names."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    keep = [f for f in docs.schema.fields if f.name.lower() not in ("n_tokens", "p")]
    names = [f.name for f in keep]
    added = [T.StructField("n_tokens", T.LongType()), T.StructField("p", T.ArrayType(T.DoubleType()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 128):
                part = batch.slice(first, 128)
                texts = [t or "" for t in part.column(part.num_columns - 1).to_pylist()]
                p = sent.value.posteriors([measure(t) for t in texts]).astype(np.float64)
                counts = pa.array([len(t.split()) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], counts, pa.array(p.tolist(), pa.list_(pa.float64()))], [*names, "n_tokens", "p"]
                )

    return docs.select(*names, docs[text].alias("_body")).mapInArrow(run, T.StructType([*keep, *added]))


@dataclass
class Solution:
    """The move along the probabilities that leads from rates of 1 to the fitted ones, and what it reaches.

    ``objective``: half the squared distance of the totals from their goal; ``reached``: whether this is the least possible.
    """

    move: np.ndarray
    reached: bool = True
    objective: float = 0.0

    def rates(self, p: np.ndarray, floor: np.ndarray) -> np.ndarray:
        return np.maximum(floor, 1 - p @ self.move)


def _read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, probabilities and floors of a batch."""
    tokens, floor = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in (0, 2))
    return tokens, batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1), floor


def _sums(members: DataFrame, count: int, of: Callable[..., np.ndarray]) -> np.ndarray:
    """Sums of ``of(tokens, p, floor)``, ``count`` numbers for a batch, over all members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(count)
        for batch in batches:
            if batch.num_rows:
                total += of(*_read(batch))
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in total.tolist()], [f"s{i}" for i in range(count)])

    partial = members.select("n_tokens", "p", "floor").mapInArrow(run, ", ".join(f"s{i} double" for i in range(count)))
    row = partial.agg(*(F.sum(f"s{i}") for i in range(count))).first()
    return np.array([x or 0.0 for x in row])


def solve(
    members: DataFrame,
    names: list[str],
    targets: dict[str, float],
    budget: float | None = None,
    keep: str | None = None,
) -> Solution:
    """The rates that bring the expected token totals of ``members`` (n_tokens, p, floor) closest to their targets.

    A projected gradient step moves each rate from 1 along its probabilities, by the distance of the totals over ``RIDGE``, and cuts
    it off at its floor. Taken implicitly, by the distance that is left *after* the step, a single long one ends at the closest
    totals, up to the ridge; its direction has one number per domain, found by Newton steps on the convex function whose
    gradient is what the equation lacks. Of several lengths of a Newton step the best is taken; one pass sums up what all of them need.
    """
    n = len(names)
    weight = np.array([max(0.0, targets[name]) for name in names])

    def sums(moves: list[np.ndarray]) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """For each move: the function without its linear and quadratic terms, the totals, and the free documents' second moments."""

        def of(t: np.ndarray, p: np.ndarray, f: np.ndarray) -> np.ndarray:
            found = []
            for move in moves:
                wanted = 1 - p @ move
                free = wanted > f
                part = np.where(free, wanted * wanted / 2, f * wanted - f * f / 2)
                found += [[t @ part], (t * np.maximum(f, wanted)) @ p, ((p * (t * free)[:, None]).T @ p).ravel()]
            return np.concatenate(found)

        size = 1 + n + n * n
        rows = _sums(members, size * len(moves), of).reshape(len(moves), size)
        return [(row[0], row[1 : 1 + n], row[1 + n :].reshape(n, n)) for row in rows]

    move = np.zeros(n)
    (value, totals, moments), = sums([move])
    weight = np.where(totals > 0, weight, 0)
    if not weight.sum():
        return Solution(move)
    weight /= weight.sum()
    if keep in names and weight[names.index(keep)] > 0:
        budget = totals[names.index(keep)] / weight[names.index(keep)]
    goal = weight * (budget if budget is not None else totals.sum())
    ridge = RIDGE * max(float(totals.sum()), 1.0)
    reached = False
    for _ in range(MAX_STEPS):
        lacking = totals - goal - ridge * move
        if np.abs(lacking).sum() <= TOLERANCE * goal.sum():
            reached = True
            break
        step = np.linalg.solve(moments + ridge * np.eye(n), lacking)
        moves = [move + length * step for length in LENGTHS]
        found = sums(moves)
        values = [v + goal @ m + ridge * (m @ m) / 2 for m, (v, *_) in zip(moves, found)]
        best = int(np.argmin(values))
        move, (value, totals, moments) = moves[best], found[best]
    off = totals - goal
    return Solution(move, reached, float(off @ off) / 2)


def floor_of(names: list[str], floors: dict[str, float], least: np.ndarray | None = None) -> Column:
    """The least rate of a document with ``p`` and ``known``, the domains it is labelled with (null without a label)."""
    p, known = F.col("p"), F.col("known")
    guessed = labelled = F.lit(0.0)
    for name, floor in floors.items():
        if floor:
            labelled = F.when(F.array_contains(known, name), F.greatest(labelled, F.lit(float(floor)))).otherwise(labelled)
        if floor and name in names:
            d = names.index(name)
            enough = F.array_max(p) if least is None else F.least(F.array_max(p), F.lit(float(least[d])))
            guessed = F.when(p[d] >= enough, F.greatest(guessed, F.lit(float(floor)))).otherwise(guessed)
    return F.when(known.isNotNull(), labelled).otherwise(guessed)


def rates(
    docs: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float],
    budget: float | None = None,
    floors: dict[str, float] | None = None,
    keep: str | None = None,
    limit: int = TRAIN_DOCUMENTS,
) -> DataFrame:
    """Per row of the input: ``doc_id``, ``n_tokens``, ``p_<domain>``, ``rate``, ``reached`` (the optimum) and ``copies``.

    ``targets``: weight of each domain; ``budget``: tokens asked for in all (as many as there are, if none is given);
    ``keep``: a domain whose tokens are to stay as many as they are, which settles the budget;
    ``floors``: least rate of documents that are, or may be, of a named domain. ``copies`` is the rate rounded up or down
    by a hash of the id, right in expectation.
    """
    prepare(docs.sparkSession)
    asked = [name for name, weight in targets.items() if weight > 0]
    texts = docs.select("doc_id", "text")
    model = fit(texts, labelled, asked, limit)
    if model is None:
        names = asked[:1]
        members = texts.select("doc_id", F.size(words(whole())).cast("bigint").alias("n_tokens"))
        members = members.withColumn("p", F.array(F.lit(1.0)))
    else:
        names = model.names
        members = posteriors(texts, model)
    floor = F.lit(0.0)
    if floors:
        known = labelled.where("domain IS NOT NULL").groupBy("doc_id").agg(F.collect_set("domain").alias("known"))
        members = members.join(known, "doc_id", "left")
        floor = floor_of(names, floors, None if model is None else model.least)
    members = staged(members.select("n_tokens", "p", floor.alias("floor"), "doc_id"), "members")
    solution = solve(members, names, targets, budget, keep)

    moved = F.lit(1.0) - sum((F.col("p")[d] * float(v) for d, v in enumerate(solution.move)), F.lit(0.0))
    members = members.withColumn("rate", F.greatest("floor", moved))
    chance = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 30)) / (1 << 30)
    rated = members.select(
        "doc_id",
        "n_tokens",
        *((F.col("p")[names.index(n)] if n in names else F.lit(0.0)).alias(f"p_{n}") for n in targets),
        "rate",
        F.lit(solution.reached).alias("reached"),
    )
    more = (chance < F.col("rate") - F.floor("rate")).cast("int")
    return rated.withColumn("copies", (F.floor("rate") + more).cast("int"))


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], **options) -> DataFrame:
    """The rows of the input, each as often as its ``copies`` say."""
    once = rates(docs, labelled, targets, **options).select(F.col("doc_id").alias("id"), "copies")
    once = once.groupBy("id").agg(F.max("copies").alias("copies"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), docs["doc_id"].alias("own"))
    joined = rows.join(once, F.col("own").eqNullSafe(F.col("id")))
    repeated = F.explode(F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies"))))
    return joined.select("row", repeated.alias("copy")).select("row.*")
