"""What several text operators share: reading the given tables, words and keys as columns, staged results."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.session import configure
from spanlake.sources.tables import drop, write_fresh

# The white space that separates words.
SPACES = " \t\n\x0b\x0c\r"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings; the shuffle files of a finished job go at once, as its result is a written table."""
    configure(spark)
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    # texts are long: batches of fewer rows bound what a Python worker holds
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    _ship(spark)
    return spark


_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="package-")), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, str(source.relative_to(package.parent)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: cuts the lineage and survives lost executors."""
    return write_fresh(df, name)


def discard(df: DataFrame) -> None:
    """Remove a staged table that nothing to come reads any more."""
    for folder in {path.rsplit("/", 1)[0] for path in df.inputFiles()}:
        drop(df.sparkSession, folder)


def whole(text: str | Column = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """The words of a text that is not null, in order."""
    return F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))
