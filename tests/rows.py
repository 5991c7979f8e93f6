"""Small rows of the signal tables, with defaults for what a test does not care about."""

from pyspark.sql import functions as F

from spanlake import schemas
from spanlake.operators.metrics import MetricTables

S = 1_000_000_000

_EMPTY = {"string": "", "bigint": 0, "int": 0, "double": 0.0, "boolean": False}


def table(spark, schema, rows):
    """Rows as dicts; times follow from TimestampNano."""
    names = [f.name for f in schema.fields if f.name not in ("Timestamp", "StartTimestamp", "day")]

    def default(name):
        kind = schema[name].dataType.simpleString()
        return {} if kind.startswith("map") else [] if kind.startswith("array") else _EMPTY[kind]

    plain = schemas.T.StructType([schema[n] for n in names])
    data = spark.createDataFrame([tuple(r.get(n, default(n)) for n in names) for r in rows], plain)
    data = data.withColumn("Timestamp", F.timestamp_micros(F.expr("TimestampNano div 1000")))
    if "StartTimestamp" in schema.names:
        data = data.withColumn("StartTimestamp", F.timestamp_micros(F.expr("StartTimestampNano div 1000")))
    return data.withColumn("day", F.to_date("Timestamp")).select(*schema.names)


def logs(spark, *rows):
    return table(spark, schemas.LOGS, rows)


def spans(spark, *rows):
    return table(spark, schemas.TRACES, rows)


def metrics(spark, sum=(), gauge=(), histogram=()):
    return MetricTables(
        sum=table(spark, schemas.METRICS_SUM, sum),
        gauge=table(spark, schemas.METRICS_GAUGE, gauge),
        histogram=table(spark, schemas.METRICS_HISTOGRAM, histogram),
    )
