"""Which stored table answers a query."""

from __future__ import annotations

from spanlake.plans.queries import MetricFn, MetricQuery, SpanAggregation

# The only aggregation the minute rollup can answer.
ROLLUP_KEY = "span.db.query.text"
ROLLUP_CARRY = "span.db.system.name"
HISTOGRAM_SUFFIXES = ("_bucket", "_count", "_sum")


def rollup_answers(aggregation: SpanAggregation) -> bool:
    """True for the plain statement ranking: no filter but presence of the statement, at most the system carried."""
    return (
        aggregation.group_by == ROLLUP_KEY
        and all(c.field == ROLLUP_KEY and c.tests_presence for c in aggregation.where.conditions)
        and set(aggregation.carry) <= {ROLLUP_CARRY}
    )


def histogram_part(name: str) -> str | None:
    """``bucket`` / ``count`` / ``sum`` for an exploded histogram series name, else None."""
    return next((suffix[1:] for suffix in HISTOGRAM_SUFFIXES if name.endswith(suffix)), None)


def base_name(name: str) -> str:
    """The stored metric name: the queried one without its histogram suffix."""
    part = histogram_part(name)
    return name.removesuffix(f"_{part}") if part else name


def part_of(query: MetricQuery) -> str | None:
    """The histogram part a query asks for; none if it names its table."""
    return None if query.table else histogram_part(query.name)


def stored_name(query: MetricQuery) -> str:
    return query.name if query.table else base_name(query.name)


def metric_table(query: MetricQuery) -> str:
    if query.table:
        return query.table
    if query.quantile is not None or histogram_part(query.name):
        return "histogram"
    return "gauge" if query.fn is MetricFn.NONE else "sum"
