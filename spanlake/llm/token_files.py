"""Token ids in files: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

Format. A folder holds three tables. ``ranks`` maps each token id that occurs to its rank by frequency (ties by id). ``data``
has one row per document in ascending order of id: ``control`` holds two bits per token, four tokens to a byte from the low
bits up, that tell how many bytes its rank takes (1 to 4); ``data`` holds these bytes, little-endian. ``part`` is the run of
documents a file belongs to and ``part_offset`` the tokens before the document in its run; ``parts`` holds the tokens
before each run. Frequent tokens take one byte, and a reader finds all token starts by one table lookup per control
byte and a running sum, without looking at the data.

Texts are encoded once, without a shuffle, into a staged table of raw ids; the frequencies come from that table (one
row per id and task), and only ids are sorted by document, not texts. Words recur, so a worker remembers the ids of words it
has met, up to a bound: once there are too many or they are too long, those that the texts at hand do not use are forgotten.

Defined results: a null or empty text has the end id alone; a null id sorts first; repeated rows stay, one after the
other; an empty table gives an empty folder; extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import string
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanlake.llm.common import prepare, staged
from spanlake.session import fresh_path

END_ID = 2

# words a worker remembers, the bytes they take with their ids, and bytes that are worked on at a time; a document stays whole
REMEMBERED = 400_000
REMEMBERED_BYTES = 64 << 20
SLICE_BYTES = 4 << 20

# The pre-tokenizer whose cuts are known here; others encode whole texts.
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}

# a text with such white space is not cut: any but single spaces and line feeds between words
ODD_SPACE = (
    r"[\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    r"|\A[ \n]|[ \n]\z|[ \n][ \n]"
)

# Bytes by kind: letters of ASCII, first bytes of two-byte letters (Latin, phonetic, Cyrillic), punctuation; an apostrophe may
# begin a part that goes on with letters ('s).
SPACE, FEED, LETTER, LEAD, STOP, APOSTROPHE = range(1, 7)
KINDS = np.zeros(256, np.uint8)
KINDS[list(string.ascii_letters.encode())] = LETTER
KINDS[[*range(0xC3, 0xCB), 0xD0, 0xD1]] = LEAD
KINDS[list(string.punctuation.encode())] = STOP
KINDS[list(b" \n'")] = SPACE, FEED, APOSTROPHE

_encoders: dict[str, WordEncoder] = {}


class WordEncoder:
    """Encodes texts through a tokenizer, part by part, and remembers the parts' ids.

    A byte-level tokenizer always cuts before a space that a non-space follows, around a single line feed, and between
    letters and punctuation, so these parts are encoded alone. Words of letters go to its model without the detour over
    its pattern. Parts are found, told apart and replaced by their ids as whole Arrow columns.
    """

    def __init__(self, path: str):
        # a task has one core
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        known = spec.get("pre_tokenizer") or {}
        self.by_word = BYTE_LEVEL.items() <= known.items() and not spec.get("normalizer")
        # texts that hold an added token are encoded whole, as it may begin or end inside a word
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.whole = "|".join([ODD_SPACE, *added])
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.model = self.tokenizer.model
        letters = set(pre_tokenizers.ByteLevel.alphabet())
        others = [b for b in range(256) if chr(b) not in letters]
        self.letters = dict(zip(others, sorted(c for c in letters if ord(c) > 255)))
        # remembered parts, and the ids of each
        self.known, self.ids = pa.array([], pa.string()), pa.array([], pa.binary())

    def _map(self, word: str) -> str:
        """The bytes of a word in the letters of the model."""
        if word.isascii():
            return self.letters[32] + word[1:] if word[0] == " " else word
        return word.encode().decode("latin-1").translate(self.letters)

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]

    def _learn(self, parts: list[str]) -> pa.Array:
        """The ids of parts: of words of letters, with or without a space before them, from the model."""
        tokenize, pack, code = self.model.tokenize, struct.pack, np.dtype(self.kind).char
        ids: list[bytes | None] = []
        others = []
        for part in parts:
            if part.isalpha() or part[0] == " " and part[1:].isalpha():
                found = [t.id for t in tokenize(self._map(part))]
                ids.append(pack(f"<{len(found)}{code}", *found))
            else:
                ids.append(None)
                others.append(part)
        rest = iter(self._encode(others))
        return pa.array([next(rest) if x is None else x for x in ids], pa.binary())

    def _recall(self, parts: pa.Array) -> pa.Array:
        """The ids of parts, all different; new ones are learnt."""
        place = pc.index_in(parts, value_set=self.known)
        unknown = place.is_null().to_numpy(zero_copy_only=False)
        place = place.fill_null(0).to_numpy().copy()
        place[unknown] = len(self.known) + np.arange(unknown.sum())
        new = parts.filter(pa.array(unknown))
        self.known = pa.concat_arrays([self.known, new])
        self.ids = pa.concat_arrays([self.ids, self._learn(new.to_pylist())])
        ids = self.ids.take(pa.array(place))
        # texts without spaces are few parts, but long ones
        if len(self.known) > REMEMBERED or self.known.nbytes + self.ids.nbytes > REMEMBERED_BYTES:
            self.known, self.ids = parts, ids
        return ids

    def _encode_parts(self, texts: pa.Array) -> pa.Array:
        """Of texts that can be cut."""
        raw, ends = _buffers(texts)
        starts = cuts(raw, ends)
        parts = _column(np.append(starts, len(raw)), raw, pa.string()).dictionary_encode()
        ids = self._recall(parts.dictionary).take(parts.indices)
        raw, bounds = _buffers(ids)
        return _column(bounds[np.searchsorted(starts, ends)], raw, pa.binary())

    def encode_column(self, texts: pa.Array) -> pa.Array:
        """The ids of each text, little-endian; none of the texts is null."""
        if not self.by_word:
            return pa.array(self._encode(texts.to_pylist()), pa.binary())
        texts = texts.cast(pa.string())
        whole = pc.match_substring_regex(texts, self.whole)
        if not whole.true_count:
            return self._encode_parts(texts)
        ids = pa.array(self._encode(texts.filter(whole).to_pylist()), pa.binary())
        ids = pa.concat_arrays([self._encode_parts(texts.filter(pc.invert(whole))), ids])
        # back in the order of the texts
        order = np.argsort(np.argsort(whole.to_numpy(zero_copy_only=False), kind="stable"), kind="stable")
        return ids.take(pa.array(order))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, little-endian."""
        return self.encode_column(pa.array(texts, pa.string())).to_pylist()


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of strings or binaries, and the bounds of its values in them."""
    column = column.cast(pa.binary())
    _, bounds, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int32)
    bounds = np.frombuffer(bounds, np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data else np.zeros(0, np.uint8)
    return raw, bounds - bounds[0]


def _column(bounds: np.ndarray, raw: np.ndarray, kind: pa.DataType) -> pa.Array:
    buffers = [None, pa.py_buffer(np.ascontiguousarray(bounds, np.int32)), pa.py_buffer(raw)]
    return pa.Array.from_buffers(kind, len(bounds) - 1, buffers)


def cuts(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where parts begin in the UTF-8 bytes of texts whose white space is single spaces and line feeds between words."""
    if not len(raw):
        return np.zeros(0, np.int64)
    kind = KINDS[raw]
    lead = kind == LEAD
    # the signs of times and division among the letters
    lead[:-1] &= (raw[:-1] != 0xC3) | (raw[1:] != 0x97) & (raw[1:] != 0xB7)
    letter = kind == LETTER
    begin, end = letter | lead, letter
    end[1:] |= lead[:-1]
    cut = (kind == SPACE) | (kind == FEED)
    cut[1:] |= (kind[:-1] == FEED) | end[:-1] & (kind[1:] >= STOP) | (kind[:-1] == STOP) & begin[1:]
    cut[bounds[:-1][bounds[:-1] < len(raw)]] = True
    return np.flatnonzero(cut)


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, a few at a time by the bytes of a column."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy().astype(np.int64)
    before = (np.cumsum(sizes) - sizes) // SLICE_BYTES
    first = np.flatnonzero(np.diff(before, prepend=-1))
    for a, b in zip(first, [*first[1:], batch.num_rows]):
        yield batch.slice(a, b - a)


def encode_texts(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """(doc_id, n, width, raw): the ids of each text with the end id, ``width`` bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        end, width = np.array([end_id], coder.kind).tobytes(), np.dtype(coder.kind).itemsize
        for batch in batches:
            for part in slices(batch, 1):
                raw = pc.binary_join_element_wise(coder.encode_column(part.column(1).fill_null("")), end, b"")
                counts = pc.divide(pc.binary_length(raw).cast(pa.int64()), width)
                widths = pa.array(np.full(len(raw), width, np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), counts, widths, raw], ["doc_id", "n", "width", "raw"])

    columns = docs.select(docs[id].cast("bigint").alias("doc_id"), docs[text].alias("text"))
    return columns.mapInArrow(run, "doc_id bigint, n bigint, width int, raw binary")


def _ids(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{width}")


def rank_ids(encoded: DataFrame) -> DataFrame:
    """(token, rank, n) of the ids that occur; the commonest has rank 0. One row per id and task is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for part in slices(batch, 1):
                raw, _ = _buffers(part.column(1))
                found = np.bincount(_ids(raw, part.column(0)[0].as_py()))
                if len(found) > len(total):
                    found, total = total, found
                total[: len(found)] += found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["token", "n"])

    counts = encoded.select("width", "raw").mapInArrow(count, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    # at most the vocabulary: one small partition
    order = Window.orderBy(F.desc("n"), "token")
    return counts.withColumn("rank", F.row_number().over(order) - 1).select("token", "rank", "n")


def _places(counts: np.ndarray) -> np.ndarray:
    """Where the tokens of documents lie if each document is filled up to whole control bytes."""
    filled = -(-counts // 4) * 4
    gap = np.cumsum(filled) - filled - (np.cumsum(counts) - counts)
    return np.arange(counts.sum()) + np.repeat(gap, counts)


def pack_documents(ranks: np.ndarray, counts: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Control bytes and data bytes of documents whose ranks lie one after the other."""
    ranks = ranks.astype("<u4")
    more = [ranks > bound for bound in (0xFF, 0xFFFF, 0xFFFFFF)]
    used = np.stack([np.ones(len(ranks), bool), *(m for m in more if m.any())], axis=1)
    width = used.sum(axis=1, dtype=np.uint8)
    codes = np.zeros(4 * int((-(-counts // 4)).sum()), np.uint8)
    codes[_places(counts)] = width - 1
    control = codes[::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    data = ranks.view(np.uint8).reshape(-1, 4)[:, : used.shape[1]][used]
    ends = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])[np.cumsum(counts)]
    return (
        _column(np.concatenate([[0], np.cumsum(-(-counts // 4))]), control, pa.binary()),
        _column(np.concatenate([[0], ends]), data, pa.binary()),
    )


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of some ranks."""
    control, data = pack_documents(ranks, np.array([len(ranks)]))
    return control[0].as_py(), data[0].as_py()


# widths of the four tokens of a control byte
WIDTHS = (1 + ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3)).astype(np.uint8)


def unpack_documents(control: np.ndarray, data: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ranks of documents, one after the other, by a table lookup of the widths and a gather of the bytes."""
    width = WIDTHS[control].reshape(-1)[_places(counts)]
    start = np.cumsum(width, dtype=np.int64) - width
    ranks = data[start].astype(np.uint32)
    for k in range(1, int(width.max(initial=1))):
        more = np.flatnonzero(width > k)
        ranks[more] |= data[start[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return ranks


def unpack_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    return unpack_documents(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), np.array([n]))


def write_files(docs: DataFrame, tokenizer: str, path: str, id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> None:
    """Encode the documents into a new folder."""
    spark = prepare(docs.sparkSession)
    encoded = staged(encode_texts(docs, tokenizer, id, text, end_id), "raw-ids")
    rank_ids(encoded).coalesce(1).write.parquet(f"{path}/ranks")
    # bounded by the vocabulary
    table = spark.sparkContext.broadcast(_lookup(spark, path, "token", "rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, ranks = TaskContext.get().partitionId(), 0, table.value
        for whole in batches:
            for batch in slices(whole, 3):
                raw, _ = _buffers(batch.column(3))
                counts = batch.column(1).to_numpy()
                control, data = pack_documents(ranks[_ids(raw, batch.column(2)[0].as_py())], counts)
                offsets = before + np.cumsum(counts) - counts
                before += int(counts.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), batch.column(1), pa.array(np.full(len(counts), part), pa.int32()),
                        pa.array(offsets, pa.int64()), control, data,
                    ],
                    ["doc_id", "n", "part", "part_offset", "control", "data"],
                )

    schema = "doc_id bigint, n bigint, part int, part_offset bigint, control binary, data binary"
    by_id = F.col("doc_id").asc_nulls_first()
    ordered = encoded.repartitionByRange(by_id).sortWithinPartitions(by_id)
    ordered.mapInArrow(run, schema).write.parquet(f"{path}/data")
    totals = spark.read.parquet(f"{path}/data").groupBy("part").agg(F.sum("n").alias("n"))
    # a row for each file: as many as there are tasks
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    totals.select("part", F.coalesce(before, F.lit(0)).alias("before")).coalesce(1).write.parquet(f"{path}/parts")


def _lookup(spark: SparkSession, path: str, key: str, value: str) -> np.ndarray:
    """The table of ranks as an array, as long as the vocabulary at most."""
    rows = spark.read.parquet(f"{path}/ranks").select(key, value).toPandas()
    found = np.zeros(int(rows[key].max()) + 1 if len(rows) else 1, np.uint32)
    found[rows[key].to_numpy()] = rows[value].to_numpy()
    return found


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of a folder: the ids as little-endian unsigned 32-bit integers."""
    table = prepare(spark).sparkContext.broadcast(_lookup(spark, path, "rank", "token"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = table.value
        for whole in batches:
            for batch in slices(whole, 4):
                counts = batch.column(2).to_numpy()
                control, data = (_buffers(batch.column(i))[0] for i in (3, 4))
                ids = tokens[unpack_documents(control, data, counts)].astype("<u4", copy=False)
                ends = np.concatenate([[0], 4 * np.cumsum(counts)])
                ids = _column(ends, ids.view(np.uint8), pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], ids], ["doc_id", "start", "n_tokens", "ids"])

    rows = spark.read.parquet(f"{path}/data").join(F.broadcast(spark.read.parquet(f"{path}/parts")), "part")
    start = (F.col("before") + F.col("part_offset")).alias("start")
    columns = rows.select("doc_id", start, F.col("n").alias("n_tokens"), "control", "data")
    return columns.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def round_trip(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """Write the documents to a fresh folder below the shared one and read them back."""
    spark = docs.sparkSession
    path = fresh_path(spark, "token-files")
    write_files(docs, tokenizer, path, id, text, end_id)
    return read_files(spark, path)

