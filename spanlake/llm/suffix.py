"""Removal of repeated passages through an enhanced suffix array and its tree of common-prefix intervals.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else, in the same document or another.

1. Anchors. Of the hashes of all 32-byte strings that lie in a 200-byte string, the smallest marks its anchor. Equal
   200-byte strings have equal anchors at equal places, so strings that repeat meet at anchors that repeat. There is an
   anchor about every 85 bytes; it knows the run of starts it stands for.
2. Contexts. Of the anchors found twice or more (counted before the shuffle), the bytes around are read that the strings
   of the run can cover. Equal contexts fold into one: all strings of their runs are repeated.
3. Suffix array. The different contexts of an anchor are sorted by what follows the anchor, which gives the suffix array of
   its occurrences with the common prefixes of neighbours. A stack scan yields the intervals of the prefix tree. In each,
   the members are tested for what they share to the left: where two of them share enough to make up the length, the
   interval is a repeat group, and each of its occurrences is covered as far as it agrees with another to both sides.
4. Hot anchors. An anchor with more than ``GROUP`` contexts is split by the starts that it stands for, in ranges: the
   strings of a range share a longer core, and only cores found twice go on, each as an anchor of its own; what is still too
   large is split to single starts, whose strings are counted by hash, combined before the shuffle.

No task holds more than ``GROUP`` contexts of an anchor, or more than one document's text. Matches are exact comparisons
of bytes, but for contexts, cores and strings found equal by 128-bit hashes.

Defined results: a null or empty text has no bytes; texts shorter than the length keep all; rows without id are left as
they are and are not matched; repeated rows of an id count as one document; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlake.llm.common import discard, prepare, staged

LENGTH = 200
CORE = 32
# contexts of one anchor in a task, some 400 bytes each
GROUP = 4096

# starts per range as hot anchors are split further and further
RANGES = (84, 21, 5, 1)

# bytes of text looked at together
SLICE = 4_000_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def core_hashes(data: np.ndarray, core: int) -> np.ndarray:
    """A hash of the ``core`` (a power of two) bytes from each place on; places too near the end have other values."""
    h = _mix(data.astype(np.uint64) + np.uint64(1))
    step = 1
    while step < core:
        h[:-step] = _mix(h[:-step] * np.uint64(0x9E3779B97F4A7C15) + h[step:])
        step *= 2
    return h


def find_anchors(texts: list[bytes], length: int = LENGTH, core: int = CORE):
    """(text number, place, smallest and largest distance of a start before it, core hash) of all anchors, as arrays."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(texts), np.uint8)
    empty = np.zeros(0, np.int64)
    if not len(data) or sizes.max() < length:
        return empty, empty, empty, empty, empty
    h = core_hashes(data, core)
    place = np.uint64((1 << 28) - 1)
    least = (h & ~place) | np.arange(len(h), dtype=np.uint64)
    width, span = 1, length - core + 1
    while 2 * width <= span:
        least[:-width] = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least[: width - span] = np.minimum(least[: width - span], least[span - width :])
    starts = np.concatenate([np.arange(b, b + s - length + 1) for b, s in zip(begins, sizes) if s >= length])
    anchor = (least[starts] & place).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    last = np.concatenate([first[1:], [len(anchor)]]) - 1
    at = anchor[first]
    text = np.searchsorted(begins, at, "right") - 1  # of texts with one begin, the last is not empty
    return text, at - begins[text], at - starts[last], at - starts[first], h[at].view(np.int64)


def _slices(sizes: list[int], limit: int) -> Iterator[slice]:
    first = total = 0
    for i, n in enumerate(sizes):
        if i > first and total + n > limit:
            yield slice(first, i)
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield slice(first, len(sizes))


def anchors(docs: DataFrame, length: int = LENGTH, core: int = CORE) -> DataFrame:
    """(id, x, lo, hi, a) of the anchors of documents (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            texts = [t.encode() for t in batch.column(1).to_pylist()]
            for part in _slices([len(t) for t in texts], SLICE):
                text, x, lo, hi, a = find_anchors(texts[part], length, core)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[part][text], pa.int64()),
                        *(pa.array(v, pa.int32()) for v in (x, lo, hi)),
                        pa.array(a, pa.int64()),
                    ],
                    ["id", "x", "lo", "hi", "a"],
                )

    return docs.mapInArrow(run, "id bigint, x int, lo int, hi int, a bigint")


def contexts(marked: DataFrame, length: int = LENGTH, core: int = CORE) -> DataFrame:
    """(id, x, lo, hi, a, c1, c2, before, after) of documents (id, text, items): the bytes before, reversed, and after an anchor."""
    reach = length - core

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "x", "lo", "hi", "a", "c1", "c2", "before", "after"]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), *[pa.int64()] * 3, pa.binary(), pa.binary()]
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * len(names)
            done = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
            out.clear()
            return done

        for batch in batches:
            for id_, text, items in zip(*(batch.column(i) for i in range(3))):
                raw, number = text.as_py().encode(), id_.as_py()
                for item in items.as_py():
                    x = item["x"]
                    before, after = raw[max(0, x - reach) : x][::-1], raw[x : x + length]
                    digest = xxhash.xxh128_digest(len(before).to_bytes(4, "little") + before + after)
                    c1, c2 = np.frombuffer(digest, np.int64).tolist()
                    out.append((number, x, item["lo"], item["hi"], item["a"], c1, c2, before, after))
                if len(out) > 4000:
                    yield flush()
        yield flush()

    schema = "id bigint, x int, lo int, hi int, a bigint, c1 bigint, c2 bigint, before binary, after binary"
    return marked.select("id", "text", "items").mapInArrow(run, schema)


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    if a == b:
        return n
    differing = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return n - (differing.bit_length() + 7) // 8


def intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of the intervals of the prefix tree; lcp[i] is that of suffixes i and i + 1."""
    stack: list[tuple[int, int]] = []
    for i, value in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > value:
            height, first = stack.pop()
            yield height, first, i
        if value >= 0 and (not stack or stack[-1][0] < value):
            stack.append((value, first))


def repeats(before: list[bytes], after: list[bytes], length: int) -> list[tuple[int, int] | None]:
    """How far each occurrence is covered to the left and right of its anchor; ``after`` is sorted.

    An interval whose members agree on r bytes from the anchor on holds a repeat if two of them agree on enough bytes before
    it; sorted by what stands before, such members are neighbours.
    """
    reached: list[tuple[int, int] | None] = [None] * len(after)
    for right, first, last in intervals([common(after[i], after[i + 1]) for i in range(len(after) - 1)]):
        need = max(0, length - right)
        order = sorted(range(first, last + 1), key=before.__getitem__)
        shared = [common(before[a], before[b]) for a, b in zip(order, order[1:])]
        for i, member in enumerate(order):
            left = max(shared[i - 1] if i else -1, shared[i] if i < len(shared) else -1)
            if left >= need:
                l, r = reached[member] or (0, 0)
                reached[member] = max(l, left), max(r, right)
    return reached


def _scan(groups: DataFrame, length: int) -> DataFrame:
    """(id, s, e) covered in groups (g, id, x, known, before, after) dealt by g and sorted by g and after."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        group = None
        out: list[tuple[int, int, int]] = []

        def close() -> None:
            places: dict[tuple[int, int], tuple] = {(row[1], row[2]): row for row in held}
            rows = list(places.values())
            if len(rows) > 1:
                found = repeats([row[4] for row in rows], [row[5] for row in rows], length)
                for (_, id_, x, known, _, _), span in zip(rows, found):
                    if span and not known:
                        out.append((id_, x - span[0], x + span[1]))
            held.clear()

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [(), (), ()]
            kinds = [pa.int64(), pa.int32(), pa.int32()]
            done = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["id", "s", "e"])
            out.clear()
            return done

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                key = tuple(row[0].values())
                if key != group:
                    close()
                    group = key
                held.append(row)
            yield flush()
        close()
        yield flush()

    rows = groups.select("g", "id", "x", "known", "before", "after")
    rows = rows.repartition("g").sortWithinPartitions("g", "after", "id", "x")
    return rows.mapInArrow(run, "id bigint, s int, e int")


def _hash(*columns: Column) -> Column:
    return F.struct(F.xxhash64(*columns).alias("h1"), F.xxhash64(F.lit(7), *columns).alias("h2"))


def _split(hot: DataFrame, width: int, length: int) -> DataFrame:
    """Items (id, x, lo, hi, a, before, after) once per range of ``width`` starts, with ``low``, ``high`` and the core's hash.

    The strings that start from ``high`` to ``low`` bytes before the anchor all hold the bytes from ``low`` before it to
    ``length - high`` after it.
    """
    ranges = F.sequence(F.expr(f"lo div {width}"), F.expr(f"hi div {width}"))
    rows = hot.withColumn("range", F.explode(ranges))
    rows = rows.withColumn("first", F.col("range") * width).withColumn("final", F.expr(f"first + {width - 1}"))
    cut = rows.withColumns(
        {
            "low": F.greatest("lo", F.col("first")),
            "high": F.least("hi", F.col("final")),
            "inner": F.expr("substring(before, 1, first)"),
            "outer": F.expr(f"substring(after, 1, greatest(0, {length} - final))"),
        }
    )
    return cut.withColumn("core", _hash(F.col("a"), F.col("range"), F.col("inner"), F.col("outer"))).drop("inner", "outer", "first", "final")


def find_spans(docs: DataFrame, length: int = LENGTH, core: int = CORE, group: int = GROUP) -> DataFrame:
    """(id, s, e): covered bytes, in overlapping spans, of documents (id, text) without nulls."""
    prepare(docs.sparkSession)
    found = staged(anchors(docs, length, core), "anchors")
    # a table of its own: a join of two plain tables can split an anchor that many places share
    again = staged(found.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a"), "again")
    items = found.join(again, "a").groupBy("id").agg(F.collect_set(F.struct("x", "lo", "hi", "a")).alias("items"))
    around = staged(contexts(docs.join(items, "id"), length, core), "contexts")
    discard(found)
    discard(again)

    place = F.struct("id", "x")
    folded = around.groupBy("a", "c1", "c2").agg(F.min(place).alias("one"), F.max(place).alias("other"))
    folded = staged(folded, "folded")
    equal = around.join(folded.where("one <> other").select("c1", "c2").distinct(), ["c1", "c2"])
    spans = staged(equal.select("id", F.expr("x - hi AS s"), F.expr(f"x - lo + {length} AS e")), "equal")

    sizes = staged(folded.groupBy("a").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    firsts = folded.join(sizes, "a").select(
        F.col("one.id").alias("id"), F.col("one.x").alias("x"), "n", (F.col("one") != F.col("other")).alias("known")
    )
    different = staged(around.drop("c1", "c2").join(firsts, ["id", "x"]), "different")
    discard(around)
    few = different.where(F.col("n") <= group).withColumn("g", F.struct("a"))
    spans = spans.unionByName(_scan(few, length))

    # hot anchors: by smaller and smaller ranges of starts, at last by single ones
    hot = different.where(F.col("n") > group).drop("n")
    for width in RANGES:
        if hot.isEmpty():
            break
        split = staged(_split(hot, width, length), "ranges")
        places = split.groupBy("core").agg(F.count("*").alias("n"), F.min(place).alias("one"), F.max(place).alias("other"))
        split = split.join(places.where("one <> other").select("core", "n"), "core")
        if width == 1:
            whole = split.where("NOT known").select("id", F.expr("x - high AS s"), F.expr(f"x - low + {length} AS e"))
            spans = spans.unionByName(whole)
            break
        split = staged(split, "cores")
        spans = spans.unionByName(_scan(split.where(F.col("n") <= group).withColumn("g", F.col("core")), length))
        hot = split.where(F.col("n") > group).select("id", "x", "a", "known", "before", "after", F.col("low").alias("lo"), F.col("high").alias("hi"))
    return spans


def cut(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What is left of a text, and the number of runs taken out."""
    kept, at, runs, end = [], 0, 0, -1
    for s, e in sorted(spans):
        if s > end:
            kept.append(text[at:s])
            runs += 1
        end = max(end, e)
        at = max(at, e)
    return b"".join([*kept, text[at:]]), runs


def remove_repeats(docs: DataFrame, length: int = LENGTH, core: int = CORE, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, kept, n_bytes, n_removed, n_spans) of every row: ``kept`` is what is left, as bytes."""
    rows = docs.select(docs[id].cast("bigint").alias("id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    spans = staged(find_spans(rows.where("id IS NOT NULL"), length, core), "spans")
    lists = spans.groupBy("id").agg(F.collect_set(F.struct("s", "e")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                out = []
                for value, found in zip(part.column(1), part.column(2)):
                    raw = value.as_py().encode()
                    kept, runs = cut(raw, [(f["s"], f["e"]) for f in found.as_py() or []])
                    out.append((kept, len(raw), len(raw) - len(kept), runs))
                columns = list(zip(*out))
                kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                    ["id", "kept", "n_bytes", "n_removed", "n_spans"],
                )

    joined = rows.join(lists, "id", "left").select("id", "text", "spans")
    return joined.mapInArrow(run, "id bigint, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint")
