"""Bounded samples of labelled documents, and words as hash codes, for the classifiers."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 18
MASK = (1 << BITS) - 1

# words whose codes a worker remembers
REMEMBERED = 400_000

PUNCTUATION = ".,;:!?\"'()[]{}«»„“”…-"


class WordCodes(dict):
    """Three hash codes of a lower-case word in one integer: of the word, of its first five and of its first four letters."""

    def __missing__(self, raw: str) -> int:
        word = raw.strip(PUNCTUATION) or raw
        whole, five, four = (zlib.crc32(part.encode()) & MASK for part in (word, "5" + word[:5], "4" + word[:4]))
        code = self[raw] = whole | five << BITS | four << 2 * BITS
        return code

    def of(self, text: str) -> np.ndarray:
        words = text.lower().split()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def trim(self) -> None:
        if len(self) > REMEMBERED:
            self.clear()


codes = WordCodes()


def unpack(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return code & MASK, code >> BITS & MASK, code >> 2 * BITS


def coded(docs: DataFrame, text: str = "text") -> DataFrame:
    """The other columns with ``words``: the codes of the whole text, eight bytes each. Null text has none."""
    names = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [codes.of(t.as_py() or "").tobytes() for t in batch.column(batch.num_columns - 1)]
            codes.trim()
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(values, pa.binary())], [*names, "words"])

    kept = docs.select(*names)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return docs.select(*names, text).mapInArrow(run, f"{schema}, words binary")


def sample(docs: DataFrame, labels: DataFrame, limit: int, where: Column | None = None, id: str = "doc_id") -> DataFrame:
    """At most ``limit`` documents that have a label, picked by a hash of their id: (id, label columns, text)."""
    named = labels if where is None else labels.where(where)
    picked = named.where(F.col(id).isNotNull()).dropDuplicates([id]).orderBy(F.xxhash64(F.lit(5), id), id).limit(limit)
    texts = docs.where(F.col(id).isNotNull()).select(id, *(c for c in ("text", "lang") if c in docs.columns))
    # the picked labels are bounded by the limit; a repeated row of documents counts once
    return texts.join(F.broadcast(picked), id).dropDuplicates([id])
