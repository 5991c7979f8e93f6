"""Day-partitioned Parquet tables: creation, appends, reads, retention.

Layout at scale. An append rebalances rows by day and leading clustering column (service or metric name): small groups
share a task, and adaptive execution splits a group that holds a large part of the rows over many tasks, by size. Inside
a task rows are sorted by day and the clustering columns, so each task writes few days and its row-group statistics prune
scans by service, name and time; a bloom filter on TraceId, as large as its values need, serves trace lookups.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanlake.functions.attributes import promoted_name
from spanlake.functions.times import Instant, epoch_seconds, utc_day
from spanlake.schemas import TABLES
from spanlake.session import configure, fresh_path

# upper bound of rows per file, so that one file never grows with the batch
MAX_ROWS_PER_FILE = 10_000_000

# Days kept.
RETENTION_DAYS = 30

# map attributes to be kept a second time as plain columns: {table: [(map column, key)]}
Promoted = dict[str, list[tuple[str, str]]]


def write_fresh(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts the lineage and survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_schema(table: str, promote: Promoted | None = None) -> T.StructType:
    schema = TABLES[table][0]
    extra = [T.StructField(promoted_name(*attr), T.StringType()) for attr in (promote or {}).get(table, [])]
    return T.StructType([*schema.fields, *extra])


def _promoted_marks(table: str, promote: Promoted | None) -> set[str]:
    return {promoted_name(*attr).encode().hex() for attr in (promote or {}).get(table, [])}


def check_promoted(spark: SparkSession, root: str, table: str, promote: Promoted | None, writing: bool = False) -> None:
    """Refuse promoted attributes the table was not made with: files without the column would read as if it were absent.

    Readers may leave some out; writers must fill them all. The list is kept beside the data when the table is made.
    """
    wanted, path = _promoted_marks(table, promote), f"{root}/{table}"
    marks = f"{path}/_promoted"
    if exists(spark, path):
        found = set(names(spark, marks))
        if wanted - found or writing and found != wanted:
            kept = sorted(bytes.fromhex(name).decode() for name in found)
            raise ValueError(f"{table} was made with the promoted attributes {kept}; write it anew to change them")
    elif writing:
        for name in sorted(wanted):
            touch(spark, f"{marks}/{name}")


def ensure_table(spark: SparkSession, root: str, table: str, promote: Promoted | None = None) -> None:
    """Create the table if it does not exist; an existing one is left alone, but must have the same promoted attributes."""
    configure(spark)
    path = f"{root}/{table}"
    check_promoted(spark, root, table, promote, writing=not exists(spark, path))
    if not any(name.startswith("day=") or name.startswith("_S") for name in names(spark, path)):
        empty = spark.createDataFrame([], table_schema(table, promote))
        empty.write.mode("append").partitionBy("day").parquet(path)


def read_table(
    spark: SparkSession,
    root: str,
    table: str,
    promote: Promoted | None = None,
    start: Instant | None = None,
    end: Instant | None = None,
) -> DataFrame:
    """The table, or with both bounds only its day directories in that range.

    Spark lists every file below the paths it is given before it prunes partitions; naming the days keeps that listing as
    short as the range. It does not filter rows, which stays with the operators.
    """
    configure(spark)
    path = f"{root}/{table}"
    check_promoted(spark, root, table, promote)
    reader = spark.read.schema(table_schema(table, promote))
    if start is None or end is None:
        return reader.parquet(path)
    first, last = utc_day(epoch_seconds(start)), utc_day(epoch_seconds(end))
    days = [name for name in names(spark, path) if name.startswith("day=") and first <= _day_of(name) <= last]
    if not days:
        return spark.createDataFrame([], table_schema(table, promote))
    return reader.option("basePath", path).parquet(*(f"{path}/{day}" for day in days))


def data_files(spark: SparkSession, root: str, table: str, first: str = "", last: str = "9") -> dict[str, set[str]]:
    """Names of the data files by day, of the days between two."""
    path, found = f"{root}/{table}", {}
    for name in names(spark, path):
        day = name.removeprefix("day=")
        if day != name and first <= day <= last:
            found[day] = {file for file in names(spark, f"{path}/{name}") if not file.startswith(("_", "."))}
    return found


def read_files(
    spark: SparkSession, root: str, table: str, files: dict[str, list[str]], promote: Promoted | None = None
) -> DataFrame:
    """The rows of some of the table's data files, named by day."""
    paths = [f"{root}/{table}/day={day}/{file}" for day, found in files.items() for file in found]
    schema = table_schema(table, promote)
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{root}/{table}").parquet(*paths)


def append(
    df: DataFrame,
    root: str,
    table: str,
    promote: Promoted | None = None,
    max_rows: int = MAX_ROWS_PER_FILE,
    cluster: bool = True,
) -> None:
    """Append rows. ``cluster=False`` skips the shuffle for small batches and only sorts inside the tasks."""
    configure(df.sparkSession)
    check_promoted(df.sparkSession, root, table, promote, writing=True)
    write_days(df, f"{root}/{table}", [table], promote, max_rows, cluster)


def write_days(
    df: DataFrame,
    path: str,
    wanted: list[str],
    promote: Promoted | None = None,
    max_rows: int = MAX_ROWS_PER_FILE,
    cluster: bool = True,
) -> None:
    """Append rows to day folders, promoted attributes filled.

    Rows of several tables, with the same clustering and a column ``table``, go to a folder per table in the same job. Their files
    hold the columns of all of them: those of other tables are null and cost next to nothing; readers ask for their own.
    """
    by = ["table", "day"] if len(wanted) > 1 else ["day"]
    clustering = TABLES[wanted[0]][1]
    looked_up = {}
    for table in wanted:
        for attribute in (promote or {}).get(table, []):
            looked_up.setdefault(attribute, []).append(table)
    for (map_column, key), promoting in looked_up.items():
        value = F.col(map_column)[key]
        if len(by) > 1:
            value = F.when(F.col("table").isin(promoting), value)
        df = df.withColumn(promoted_name(map_column, key), value)
    if cluster:
        df = df.hint("rebalance", *by, clustering[0])
    writer = (
        df.sortWithinPartitions(*by, *clustering)
        .write.mode("append")
        .partitionBy(*by)
        .option("maxRecordsPerFile", max(1, max_rows))
    )
    # a filter as small as its values allow, of 32 bytes to 1 MB: else each file holds 1 MB, however few its rows
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    for name in [*(promoted_name(*attr) for attr in looked_up), *(["TraceId"] if "TraceId" in df.columns else [])]:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        writer = writer.option(f"parquet.bloom.filter.candidates.number#{name}", "16")
    writer.parquet(path)


def surviving(df: DataFrame, days: int, now: Instant) -> DataFrame:
    """The rows retention keeps: whole days, the day holding the cut-off included."""
    return df.where(F.col("day") >= F.lit(cutoff_day(days, now)))


def apply_retention(spark: SparkSession, root: str, table: str, days: int, now: Instant) -> list[str]:
    """Drop the partition directories of expired days and return their names. No data file is read."""
    path = f"{root}/{table}"
    cutoff = cutoff_day(days, now)
    expired = [name for name in names(spark, path) if name.startswith("day=") and _day_of(name) < cutoff]
    for name in expired:
        drop(spark, f"{path}/{name}")
    return expired


def drop(spark: SparkSession, path: str) -> None:
    """Remove a file or directory, if it exists."""
    hadoop, target = _filesystem(spark, path)
    hadoop.delete(target, True)


def touch(spark: SparkSession, path: str) -> None:
    hadoop, target = _filesystem(spark, path)
    hadoop.create(target, True).close()


def move_files(spark: SparkSession, source: str, target: str) -> None:
    """Move the data files of a folder into another one; nothing if the folder does not exist."""
    found = [name for name in names(spark, source) if not name.startswith(("_", "."))]
    hadoop, folder = _filesystem(spark, target)
    if found:
        hadoop.mkdirs(folder)
    for name in found:
        if not hadoop.rename(_filesystem(spark, f"{source}/{name}")[1], _filesystem(spark, f"{target}/{name}")[1]):
            raise OSError(f"cannot move {source}/{name} to {target}")


def names(spark: SparkSession, path: str) -> list[str]:
    """What a directory holds; nothing if it does not exist."""
    hadoop, target = _filesystem(spark, path)
    if not hadoop.exists(target):
        return []
    return sorted(status.getPath().getName() for status in hadoop.listStatus(target))


def _day_of(partition: str) -> dt.date:
    try:
        return dt.date.fromisoformat(partition.removeprefix("day="))
    except ValueError:
        return dt.date.max


def cutoff_day(days: int, now: Instant) -> dt.date:
    """The oldest day that retention keeps."""
    return utc_day(epoch_seconds(now)) - dt.timedelta(days=days)


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, target = _filesystem(spark, path)
    return hadoop.exists(target)


def _filesystem(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target
