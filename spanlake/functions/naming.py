"""Metric names as the emitter's Prometheus endpoint would spell them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name suffix per unit; other units add nothing.
UNIT_SUFFIXES = {
    "ms": "_milliseconds",
    "s": "_seconds",
    "By": "_bytes",
    "bytes": "_bytes",
    "By/s": "_bytes_per_second",
    "%": "_percent",
}


def prom_name(name: Column, unit: Column, monotonic: Column) -> Column:
    """Dots become underscores, then the unit suffix, then ``_total`` for monotonic counters only."""
    suffixes = [F.when(unit == known, suffix) for known, suffix in UNIT_SUFFIXES.items()]
    return F.concat(
        F.replace(name, F.lit("."), F.lit("_")),
        F.coalesce(*suffixes, F.lit("")),
        F.when(monotonic, "_total").otherwise(""),
    )
