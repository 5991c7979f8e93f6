"""Line deduplication: lines found in many documents stay in one of them.

Lines are exploded as two 64-bit hashes of their key with their position. Documents are counted per hash in two steps, by
(hash, document) and then by hash, so a line that a third of all documents hold reaches the final count as one row per
task. Frequent hashes, a table of their own, are joined back to the lines (adaptive execution splits a frequent one); the positions to
drop are gathered per document and taken out of all its positions at once. The text itself is shuffled once.

Defined results: a null or empty text is one empty line; a row without id is not counted and keeps all its lines;
repeated rows of an id count as one document, equal texts get the same lines; a tie cannot occur, as one id is the largest; other
columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlake.llm.common import SPACES, lower_ascii, prepare, staged, whole

MIN_CHARS = 40
MIN_DOCUMENTS = 5


def _hash(key: Column) -> Column:
    """128 bits of a trimmed line with A-Z in lower case, as two hashes with different seeds."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2"))


def frequent_lines(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS
) -> tuple[DataFrame, DataFrame]:
    """(document, text, hash, position) of every long line, and the hashes found in enough documents with the largest id.

    Both uses read the hashes from a table in the shared folder, so that the text is parsed once. A text goes by its hash, which
    tells different texts of one id apart.
    """
    prepare(docs.sparkSession)
    placed = F.transform(F.split(whole(docs[text]), "\n"), lambda line, i: F.struct(line.alias("key"), i.alias("pos")))

    def with_key(of: Callable[[Column], Column]) -> Callable[[Column], Column]:
        return lambda line: F.struct(of(line["key"]).alias("key"), line["pos"].alias("pos"))

    # each step names its result once, as nothing is shared inside a lambda
    placed = F.filter(placed, lambda line: F.char_length(line["key"]) >= min_chars)
    placed = F.transform(placed, with_key(lambda key: F.btrim(key, F.lit(SPACES))))
    placed = F.transform(F.filter(placed, lambda line: F.char_length(line["key"]) >= min_chars), with_key(lower_ascii))
    lines = (
        docs.where(docs[id].isNotNull())
        .select(docs[id].alias("id"), F.xxhash64(whole(docs[text])).alias("t"), F.explode(F.transform(placed, with_key(_hash))).alias("line"))
        .select("id", "t", "line.key.*", "line.pos")
    )
    lines = staged(lines, "line-hashes")
    counts = lines.groupBy("h1", "h2").agg(F.count_distinct("id").alias("n"), F.max("id").alias("keeper"))
    # a table of its own: a join with plain tables can split a frequent hash
    return lines, staged(counts.where(F.col("n") >= min_documents), "frequent-lines")


def _marked(docs: DataFrame, id: str, text: str, min_chars: int, min_documents: int) -> DataFrame:
    """(row, lines, kept): each row as it came, its lines, and the positions of those that stay."""
    lines, frequent = frequent_lines(docs, id, text, min_chars, min_documents)
    drops = (
        lines.join(frequent, ["h1", "h2"])
        .where(F.col("id") < F.col("keeper"))
        .groupBy("id", "t")
        .agg(F.collect_set("pos").alias("drops"))
    )
    rows = docs.select(F.struct(*docs.columns).alias("row"), docs[id].alias("id"), F.xxhash64(whole(docs[text])).alias("t"))
    joined = rows.join(drops, ["id", "t"], "left").withColumn("lines", F.split(whole(F.col("row").getField(text)), "\n"))
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    return joined.withColumn("kept", F.when(F.col("drops").isNull(), every).otherwise(F.array_except(every, "drops")))


def _rest() -> Column:
    return F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n")


def without_lines(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """The input with the remaining text."""
    marked = _marked(docs, id, text, min_chars, min_documents)
    return marked.select(*(F.col("row").getField(c).alias(c) if c != text else _rest().alias(text) for c in docs.columns))


def drop_lines(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """As ``without_lines``, with ``_n_lines`` (before) and ``_n_dropped`` in place of input columns of these names."""
    marked = _marked(docs, id, text, min_chars, min_documents)
    n_lines = F.size("lines").cast("bigint")
    names = [c for c in docs.columns if c.lower() not in ("_n_lines", "_n_dropped")]
    return marked.select(
        *(F.col("row").getField(c).alias(c) if c != text else _rest().alias(text) for c in names),
        n_lines.alias("_n_lines"),
        (n_lines - F.size("kept").cast("bigint")).alias("_n_dropped"),
    )
