"""Near-duplicate documents by min-max hashing.

Each permutation of the shingles gives two signature values, the smallest and the largest hash, so a signature of 128
values costs 64 hash evaluations per shingle. Bands of five values make candidates; links are confirmed on the full sets
of shingles.

1. Documents with equal shingle sets form a class (aggregated before the shuffle); its smallest id stands for it.
2. A band value that several representatives share is a bucket. Each member is compared with the smallest id of the bucket it
   shares most bands with; the links found are joined to components.
3. Where a bucket still holds several components, the members outside its largest component are compared with all of that
   component, and then with each other. A pair of one component needs no comparison, as it cannot change the result.

With 25 bands of five, a pair at the similarity of 0.8 shares no bucket in 5 of 100,000 cases, one at 0.9 in fewer than one
of 10^9. Nothing is capped: comparisons run in groups of bounded size (blocks of members against blocks of a component), so
a bucket of any size is spread over tasks, texts travel once per group, and no table of pairs is made.

Defined results: a text without words, or null, has no shingles and no links; a text of one word has that word as its
shingle; rows without id are linked with nothing and kept, with a null component; repeated rows get equal results; extra
columns stay, unless they have the name of a result column.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlake.llm.common import prepare, staged
from spanlake.llm.components import connected

PERMUTATIONS = 64
ROWS = 5
BANDS = 2 * PERMUTATIONS // ROWS
PERCENT = 80

# members and component members compared in one group
BLOCK = 256

# words whose hashes a worker remembers, and shingles hashed at a time
REMEMBERED = 400_000
SLICE = 200_000

_random = np.random.default_rng(20)
FACTORS = _random.integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _random.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
# the signature values of each band: neighbours in a band come from different permutations
PICKS = (np.arange(BANDS * ROWS) * 37 % (2 * PERMUTATIONS)).reshape(BANDS, ROWS)
MIX = _random.integers(1, 2**63, (3, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_words(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case."""
    return (text or "").encode().lower().split()


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = WordHashes()


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a shorter text is one shingle."""
    words = shingle_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    if len(_hashes) > REMEMBERED:
        _hashes.clear()
    n = max(1, len(h) - size + 1)
    out = np.zeros(n, np.uint64) if len(h) >= size else np.full(n, np.uint64(len(h)))
    for k in range(min(size, len(h))):
        out = _scramble(out + h[k : k + n])
    return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest and the largest value of each permutation."""
    low = np.full(PERMUTATIONS, ~np.uint64(0))
    high = np.zeros(PERMUTATIONS, np.uint64)
    for first in range(0, len(shingles), SLICE // PERMUTATIONS):
        values = np.multiply.outer(FACTORS, shingles[first : first + SLICE // PERMUTATIONS]) + SHIFTS[:, None]
        values ^= values >> np.uint64(32)
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return np.concatenate([low, high])


def bands(values: np.ndarray) -> np.ndarray:
    """A key per band, which tells bands apart."""
    picked = values[PICKS]
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        key = _scramble(key * MIX[0, k] + picked[:, k] * MIX[1, k])
    return key.view(np.int64)


def sign(docs: DataFrame, size: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n, k1, k2, bands) of each row; k1 and k2 are a 128-bit hash of the shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                counts, keys, found = [], [], []
                for value in part.column(1):
                    shingles = shingle_hashes(value.as_py(), size)
                    counts.append(len(shingles))
                    keys.append(np.frombuffer(xxhash.xxh128_digest(shingles.tobytes()), np.int64))
                    found.append(bands(signature(shingles)) if len(shingles) else None)
                lists = pa.array(found, pa.list_(pa.int64()))
                key = np.array(keys).reshape(-1, 2)
                columns = [part.column(0), pa.array(counts, pa.int64()), pa.array(key[:, 0]), pa.array(key[:, 1]), lists]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n", "k1", "k2", "bands"])

    columns = docs.select(docs[id].cast("bigint").alias("id"), docs[text].alias("text"))
    return columns.mapInArrow(run, "id bigint, n bigint, k1 bigint, k2 bigint, bands array<bigint>")


def similar(x: list[list[bytes]], y: list[list[bytes]], size: int, percent: int) -> list[tuple[int, int]]:
    """Positions of the pairs of word lists whose shingle sets are similar enough, compared in full."""
    numbers: dict[tuple, int] = {}

    def ids(words: list[bytes]) -> np.ndarray:
        grams = zip(*(words[k:] for k in range(size))) if len(words) >= size else [tuple(words)] if words else []
        return np.array([numbers.setdefault(g, len(numbers)) for g in set(grams)], np.int64)

    few, many = ([ids(w) for w in side] for side in ((x, y) if len(x) <= len(y) else (y, x)))
    sizes = np.array([len(m) for m in many])
    full = np.flatnonzero(sizes)
    if not len(full):
        return []
    joined = np.concatenate([many[i] for i in full])
    starts = np.cumsum(sizes[full]) - sizes[full]
    mark = np.zeros(len(numbers), np.int64)
    pairs = []
    for i, own in enumerate(few):
        if len(own):
            mark[own] = 1
            common = np.add.reduceat(mark[joined], starts)
            mark[own] = 0
            hit = 100 * common >= percent * (len(own) + sizes[full] - common)
            pairs += [(i, int(j)) for j in full[hit]]
    return pairs if len(x) <= len(y) else [(j, i) for i, j in pairs]


def _confirm(groups: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) found in groups (g, x, id, part): rows with x against rows without, one link per x and part."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        x, y = rows[rows["x"]], rows[~rows["x"]]
        words = [[shingle_words(t) for t in side["text"]] for side in (x, y)]
        a, b, part = x["id"].to_numpy(), y["id"].to_numpy(), y["part"].to_numpy()
        found: dict[tuple[int, int], int] = {}
        for i, j in similar(*words, size, percent):
            if a[i] != b[j]:
                found.setdefault((int(a[i]), int(part[j])), int(b[j]))
        return pd.DataFrame({"a": [k[0] for k in found], "b": list(found.values())}, dtype="int64")

    rows = groups.join(texts, "id").select("g", "x", "id", "part", "text")
    return rows.groupBy("g").applyInPandas(run, "a bigint, b bigint")


def _blocks(x: DataFrame, y: DataFrame) -> DataFrame:
    """Groups that compare all x (c, id) with all y (c, id, part) of equal c, in blocks of bounded size."""

    def blocks(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy("c").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(f"n_{name}"))

    sizes = blocks(x, "x").join(blocks(y, "y"), "c")

    def deal(side: DataFrame, own: str, other: str) -> DataFrame:
        at = F.pmod(F.xxhash64(F.lit(5), "id"), F.col(f"n_{own}")).cast("int")
        rows = side.join(sizes, "c").withColumn(f"b_{own}", at)
        return rows.withColumn(f"b_{other}", F.explode(F.sequence(F.lit(0), F.col(f"n_{other}") - 1)))

    columns = ["c", "b_x", "b_y", "x", "id", "part"]
    both = deal(x, "x", "y").withColumns({"x": F.lit(True), "part": F.lit(0).cast("bigint")}).select(*columns)
    both = both.unionByName(deal(y, "y", "x").withColumn("x", F.lit(False)).select(*columns))
    return both.select(F.struct("c", "b_x", "b_y").alias("g"), "x", "id", "part")


def find_components(
    docs: DataFrame, size: int = 5, percent: int = PERCENT, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, n, component) of each row of the input."""
    prepare(docs.sparkSession)
    signed = staged(sign(docs, size, id, text), "signatures")
    classes = signed.where("n > 0 AND id IS NOT NULL").groupBy("k1", "k2").agg(F.min("id").alias("rep"))
    classes = staged(classes, "classes")
    reps = signed.join(classes, ["k1", "k2"]).where("id = rep").dropDuplicates(["id"])
    keyed = staged(reps.select("id", F.explode("bands").alias("key")), "bands")
    hubs = keyed.groupBy("key").agg(F.min("id").alias("hub"), F.count("*").alias("n")).where("n > 1")
    shared = staged(keyed.join(hubs, "key").select("key", "id", "hub"), "buckets")

    ids = shared.select("id").distinct()
    all_texts = docs.select(docs[id].cast("bigint").alias("id"), docs[text].alias("text")).where("id IS NOT NULL")
    texts = staged(all_texts.join(ids, "id", "left_semi").dropDuplicates(["id"]), "texts")

    # each member against the hub it shares most bands with
    best = shared.where("id <> hub").groupBy("id", "hub").agg(F.count("*").alias("n"))
    best = best.groupBy("id").agg(F.max(F.struct("n", (-F.col("hub")).alias("hub"))).alias("m"))
    x = staged(best.select((-F.col("m.hub")).alias("c"), "id"), "members")
    y = x.select("c").distinct().select("c", F.col("c").alias("id"), F.col("c").alias("part"))
    links = staged(_confirm(_blocks(x, y), texts, size, percent), "stars")
    stars = connected(links)

    # members outside the largest component of a bucket against that component
    named = _named(shared, stars)
    counts = stars.groupBy("component").agg(F.count("*").alias("size"))
    sized = named.join(counts, "component", "left").fillna(1, ["size"])
    most = F.max(F.struct("size", "component"))["component"].alias("major")
    mixed = sized.groupBy("key").agg(most, F.min("component").alias("low"), F.max("component").alias("high"))
    minor = sized.join(mixed.where("low < high").select("key", "major"), "key").where("component <> major")
    minor = staged(minor.select("key", "id", "major"), "outside")
    x = minor.select(F.col("major").alias("c"), "id").distinct()
    members = ids.join(stars, "id", "left").select("id", F.coalesce("component", "id").alias("c"))
    y = members.join(x.select("c").distinct(), "c", "left_semi").select("c", "id", F.col("c").alias("part"))
    more = staged(_confirm(_blocks(x, y), texts, size, percent), "links")
    linked = stars.select(F.col("id").alias("a"), F.col("component").alias("b"))
    stars = connected(linked.unionByName(more))

    # and those of one bucket against each other
    named = _named(minor.select("key", "id"), stars)
    mixed = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    rest = named.join(mixed.where("low < high").select("key"), "key", "left_semi")
    rest = staged(rest.select(F.col("key").alias("c"), "id", F.col("component").alias("part")), "rest")
    more = staged(_confirm(_blocks(rest.select("c", "id"), rest), texts, size, percent), "links")
    linked = stars.select(F.col("id").alias("a"), F.col("component").alias("b"))
    stars = connected(linked.unionByName(more))

    tops = classes.join(stars, F.col("rep") == F.col("id"), "left")
    tops = tops.select("k1", "k2", F.coalesce("component", "rep").alias("component"))
    placed = signed.select("id", "n", "k1", "k2").join(tops, ["k1", "k2"], "left")
    component = F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")))
    return placed.select("id", "n", component.alias("component"))


def _named(shared: DataFrame, stars: DataFrame) -> DataFrame:
    joined = shared.select("key", "id").join(stars, "id", "left")
    return joined.select("key", "id", F.coalesce("component", "id").alias("component"))


def mark(docs: DataFrame, size: int = 5, percent: int = PERCENT) -> DataFrame:
    """One row per row of documents: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``."""
    found = find_components(docs, size, percent)
    kept = F.coalesce(F.col("id") == F.col("component"), F.lit(True))
    return found.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), kept.alias("kept")
    )


def drop_copies(docs: DataFrame, size: int = 5, percent: int = PERCENT) -> DataFrame:
    """One document of each component, the one with the smallest id; rows without id stay."""
    gone = mark(docs, size, percent).where("NOT kept").select("doc_id").distinct()
    once = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    return once.join(gone, "doc_id", "left_anti").select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))
