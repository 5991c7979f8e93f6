"""Best-fit packing of documents into training sequences of several permitted lengths.

Documents longer than the largest length are cut into pieces of that length; the rest of a document is one more piece.
Pieces are dealt by a hash of document, piece and row to shards of bounded size, and each shard is packed by itself, largest piece
first, into the open sequence with the least room that holds it. If none does, a sequence is opened. Which length to open
is settled jointly for the shard: the smallest length that holds a piece is its class, and every mix of a length to open
for each class (that or a larger one; 24 mixes of four lengths) is packed. Each sequence is then downsized to the smallest
length that holds its contents, and the mix with the least total cost stays. A sequence of length n costs n plus a fixed
overhead.

Only ids and lengths are shuffled. The number of shards follows from the number of pieces, so that a task holds a
bounded number of them whatever the size of the corpus, of a document, or of a group of rows with one id.

Defined results: a null or negative length counts as 0, and documents without tokens get one piece of length 0; rows
with a null id are packed like others; repeated rows are packed once each; equal lengths go by id; an empty table gives an
empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlake.llm.common import prepare, staged

LENGTHS = (512, 1024, 2048, 4096)
OVERHEAD = 16
SHARD_DOCUMENTS = 20_000

SCHEMA = (
    "doc_id bigint, piece int, piece_start bigint, n_tokens bigint, shard int, seq bigint, seq_offset int, "
    "seq_used int, seq_length int"
)


def _pack(sizes: Sequence[int], lengths: Sequence[int], opening: int | Sequence[int]) -> tuple[list[int], list[int], list[int]]:
    """Sequence and offset of each piece (largest first), and what each sequence holds.

    ``opening``: the length to open, or one for each of ``lengths``, the smallest that holds the piece. A piece that is
    longer than the chosen length opens the smallest that holds it.
    """
    chosen = [opening] * len(lengths) if isinstance(opening, int) else opening
    room: list[tuple[int, int]] = []  # (free, sequence), sorted
    used: list[int] = []
    where, offsets = [], []
    for size in sizes:
        at = bisect_left(room, (size, -1))
        if at < len(room) and size:
            free, seq = room.pop(at)
        elif used and not size:
            free, seq = 0, len(used) - 1  # an empty piece takes no room
        else:
            at = bisect_left(lengths, size)
            free, seq = max(chosen[at], lengths[at]), len(used)
            used.append(0)
        where.append(seq)
        offsets.append(used[seq])
        used[seq] += size
        if size and free > size:
            insort(room, (free - size, seq))
    return where, offsets, used


def pack_shard(sizes: Sequence[int], lengths: Sequence[int] = LENGTHS, overhead: int = OVERHEAD):
    """The cheapest of the mixes of openings: (sequence, offset) per piece and (used, length) per sequence."""
    lengths = sorted(lengths)
    best = None
    classes = sorted({bisect_left(lengths, size) for size in sizes})
    mixes = product(*(lengths[k:] if k in classes else lengths[k : k + 1] for k in range(len(lengths))))
    for opening in mixes:
        where, offsets, used = _pack(sizes, lengths, opening)
        final = np.asarray(lengths)[np.searchsorted(lengths, used)] if used else np.zeros(0, int)
        cost = int(final.sum()) + overhead * len(used)
        if best is None or cost < best[0]:
            best = cost, where, offsets, used, final
    return best[1:]


def pack(
    docs: DataFrame,
    id: str = "doc_id",
    tokens: str = "n_tokens",
    lengths: Sequence[int] = LENGTHS,
    overhead: int = OVERHEAD,
    shard_documents: int = SHARD_DOCUMENTS,
) -> DataFrame:
    """One row per piece: its place in the document and in a sequence, and the sequence's use and length."""
    lengths = tuple(sorted(set(lengths)))
    if not lengths or lengths[0] < 1:
        raise ValueError("lengths must be positive")
    largest = lengths[-1]
    prepare(docs.sparkSession)
    rows = docs.select(
        docs[id].cast("bigint").alias("doc_id"),
        F.greatest(F.coalesce(docs[tokens].cast("bigint"), F.lit(0)), F.lit(0)).alias("tokens"),
        F.monotonically_increasing_id().alias("row"),  # tells repeated rows apart
    )
    count = F.greatest(F.lit(1), F.ceil(F.col("tokens") / largest))
    rows = staged(rows, "lengths")
    shards = -(-max(1, rows.agg(F.sum(count)).first()[0] or 0) // shard_documents)
    pieces = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1)))
    start = F.col("piece") * largest
    pieces = pieces.select(
        # a null among large ids would turn them into doubles on the way to the task
        F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
        F.col("doc_id").isNotNull().alias("known"),
        F.col("piece").cast("int").alias("piece"),
        start.alias("piece_start"),
        F.least(F.lit(largest), F.col("tokens") - start).alias("n_tokens"),
        "row",
        F.pmod(F.xxhash64(F.lit(3), "doc_id", "piece", "row"), F.lit(shards)).cast("int").alias("shard"),
    )

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n_tokens", "known", "doc_id", "piece", "row"], ascending=[False, True, True, True, True])
        where, offsets, used, final = pack_shard(rows["n_tokens"].tolist(), lengths, overhead)
        where = np.asarray(where)
        shard = int(rows["shard"].iloc[0])
        ids = pd.array(rows["doc_id"], dtype="Int64")
        ids[~rows["known"].to_numpy()] = pd.NA
        return pd.DataFrame(
            {
                "doc_id": ids,
                "piece": rows["piece"].to_numpy(),
                "piece_start": rows["piece_start"].to_numpy(),
                "n_tokens": rows["n_tokens"].to_numpy(),
                "shard": shard,
                "seq": shard * 2**32 + where,
                "seq_offset": offsets,
                "seq_used": np.asarray(used)[where],
                "seq_length": final[where],
            }
        )

    return pieces.groupBy("shard").applyInPandas(run, SCHEMA)
