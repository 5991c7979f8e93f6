"""Appends that count once: a batch is written aside as a whole, then its files move into the tables.

A batch lives in ``_batches/<name>`` below the store: its rows by table and day, a mark once all are written, a mark once all
have moved. Repeating a batch that is done changes nothing; one that was written but not moved as a whole moves what is left;
one that was not written to its end is written anew. So each of its rows is stored once, in all of its tables, whenever the
writer stops, without a file list to keep: what has moved is gone from the batch.

A file appears in its table by one rename, as files of an ordinary append do, and as many renames are made. A batch is not visible
all at once: while its files move, readers see some of them.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Collection

from pyspark.sql import SparkSession

from spanlake.sources import tables

ROOT = "_batches"
WRITTEN, DONE = "_written", "_done"
STAGED = "tables"

NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def named(batch: str) -> str:
    """The folder of a batch that its sender names."""
    if not NAME.fullmatch(batch):
        raise ValueError(f"a batch name has letters, digits, dots, dashes and underscores only: {batch!r}")
    return f"named-{batch}"


def of_stream(stream: str, number: int) -> str:
    return f"stream-{stream}-{number}"


def staged_path(folder: str, table: str | None = None) -> str:
    """Where a batch's rows of one table go, or those of many tables, partitioned by ``table``."""
    return f"{folder}/{STAGED}" if table is None else f"{folder}/{STAGED}/table={table}"


def has_rows(spark: SparkSession, folder: str) -> bool:
    """Whether the batch has put any row aside."""
    found = tables.names(spark, staged_path(folder))
    found += [day for part in found if part.startswith("table=") for day in tables.names(spark, f"{staged_path(folder)}/{part}")]
    return any(name.startswith("day=") for name in found)


def append_once(
    spark: SparkSession, root: str, name: str | None, write: Callable[[str], None], beside: Collection[str] = ()
) -> bool:
    """Store what ``write`` puts into the folder it is given; False if the batch is stored already.

    ``beside`` names folders of plain files (set-aside payloads) that move along. Without a name nobody can repeat the batch, so
    nothing of it is kept once it is stored.
    """
    folder = f"{root}/{ROOT}/{name or 'unnamed-' + uuid.uuid4().hex}"
    if tables.exists(spark, f"{folder}/{DONE}"):
        return False
    if not tables.exists(spark, f"{folder}/{WRITTEN}"):
        tables.drop(spark, folder)
        write(folder)
        tables.touch(spark, f"{folder}/{WRITTEN}")
    _publish(spark, root, folder, beside)
    if name is None:
        tables.drop(spark, folder)
    return True


def resume(spark: SparkSession, root: str, beside: Collection[str] = ()) -> int:
    """Finish batches that were written but not moved as a whole, for senders that do not repeat theirs; their number.

    Folders of batches that were not written to their end stay for those that repeat them.
    """
    finished = 0
    for name in tables.names(spark, f"{root}/{ROOT}"):
        folder = f"{root}/{ROOT}/{name}"
        marks = set(tables.names(spark, folder)) & {WRITTEN, DONE}
        if marks == {WRITTEN}:
            _publish(spark, root, folder, beside)
            finished += 1
    return finished


def forget(spark: SparkSession, root: str, name: str) -> None:
    """Drop what is kept of a batch that nobody will repeat."""
    folder = f"{root}/{ROOT}/{name}"
    if tables.exists(spark, f"{folder}/{DONE}"):
        tables.drop(spark, folder)


def _publish(spark: SparkSession, root: str, folder: str, beside: Collection[str]) -> None:
    staged = staged_path(folder)
    for part in tables.names(spark, staged):
        table = part.removeprefix("table=")
        if table == part:
            continue
        for day in tables.names(spark, f"{staged}/{part}"):
            if day.startswith("day="):
                tables.move_files(spark, f"{staged}/{part}/{day}", f"{root}/{table}/{day}")
    for name in beside:
        tables.move_files(spark, f"{folder}/{name}", f"{root}/{name}")
    tables.touch(spark, f"{folder}/{DONE}")
    for name in (STAGED, *beside):
        tables.drop(spark, f"{folder}/{name}")
