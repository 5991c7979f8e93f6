"""Filter conditions over the signal tables, as Spark columns."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlake.functions import attributes, literals
from spanlake.plans.queries import (
    LabelFilter,
    LabelMatcher,
    LineFilter,
    LineOp,
    MatchOp,
    TraceCondition,
    TraceOp,
    UnsupportedQuery,
)


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def regex(column: Column, pattern: str) -> Column:
    """Unanchored match in which a dot also matches a line break."""
    return column.rlike("(?s)" + pattern)


def matches(column: Column, matcher: LabelMatcher) -> Column:
    match matcher.op:
        case MatchOp.EQ:
            return column == matcher.value
        case MatchOp.NEQ:
            return column != matcher.value
        case MatchOp.RE:
            return regex(column, matcher.value)
        case MatchOp.NRE:
            return ~regex(column, matcher.value)


def _absent_fails(op: MatchOp | TraceOp, value: str) -> bool:
    """True where a row without the attribute can never pass, so the lookup needs no ``''`` default."""
    return (op.value == "=" and value != "") or (op.value == "!=" and value == "")


def log_matcher(df: DataFrame, matcher: LabelMatcher) -> Column:
    nullable = _absent_fails(matcher.op, matcher.value)
    return matches(attributes.log_label(df, matcher.label, nullable), matcher)


def log_stage(df: DataFrame, stage: object) -> Column:
    if isinstance(stage, LineFilter):
        return _line(stage)
    if isinstance(stage, LabelFilter):
        if not stage.matchers:
            raise UnsupportedQuery("a label filter needs at least one matcher")
        return reduce(or_ if stage.any_of else and_, [log_matcher(df, m) for m in stage.matchers])
    raise UnsupportedQuery(f"unsupported log stage: {type(stage).__name__}")


def _line(stage: LineFilter) -> Column:
    body = F.col("Body")
    match stage.op:
        case LineOp.CONTAINS:
            return body.contains(stage.value)
        case LineOp.NOT_CONTAINS:
            return ~body.contains(stage.value)
        case LineOp.REGEX:
            return regex(body, stage.value)
        case LineOp.NOT_REGEX:
            return ~regex(body, stage.value)


def metric_matcher(df: DataFrame, matcher: LabelMatcher) -> Column:
    nullable = _absent_fails(matcher.op, matcher.value)
    return matches(attributes.metric_label(df, matcher.label, nullable), matcher)


def span_condition(df: DataFrame, condition: TraceCondition) -> Column:
    if condition.op in (TraceOp.GT, TraceOp.GTE, TraceOp.LT, TraceOp.LTE):
        if condition.field == "duration":
            return _compare(F.col("Duration"), condition.op, literals.duration_ns(condition.value))
        number = integer_or_zero(attributes.span_field(df, condition.field))
        return _compare(number, condition.op, literals.integer(condition.value))

    if condition.field == "duration":
        if condition.op not in (TraceOp.EQ, TraceOp.NEQ) or not condition.value.isdecimal():
            raise UnsupportedQuery("duration can be compared by order, or for equality with whole nanoseconds")
        same = _compare(F.col("Duration"), TraceOp.EQ, int(condition.value))
        return same if condition.op is TraceOp.EQ else ~same

    if condition.op in (TraceOp.RE, TraceOp.NRE):
        matched = regex(attributes.span_field(df, condition.field), condition.value)
        return matched if condition.op is TraceOp.RE else ~matched

    value = condition.value
    if value == "nil" and not condition.quoted:
        value = ""
    elif condition.field in ("status", "kind"):
        # stored in title case: error -> Error, server -> Server
        value = value[:1].upper() + value[1:]
    column = attributes.span_field(df, condition.field, _absent_fails(condition.op, value))
    return column == value if condition.op is TraceOp.EQ else column != value


def integer_or_zero(text: Column) -> Column:
    """Text that is exactly an integer as BIGINT, anything else 0."""
    return F.when(text.rlike(r"^[+-]?[0-9]+\z"), F.coalesce(text.try_cast("bigint"), F.lit(0))).otherwise(F.lit(0))


def _compare(column: Column, op: TraceOp, value: int) -> Column:
    """A BIGINT against a number of any size; one beyond BIGINT is larger, or smaller, than every value."""
    if not -(2**63) <= value < 2**63:
        below = value > 0
        holds = op in (TraceOp.LT, TraceOp.LTE) if below else op in (TraceOp.GT, TraceOp.GTE)
        return column.isNotNull() & F.lit(holds)
    match op:
        case TraceOp.EQ:
            return column == value
        case TraceOp.GT:
            return column > value
        case TraceOp.GTE:
            return column >= value
        case TraceOp.LT:
            return column < value
        case _:
            return column <= value
