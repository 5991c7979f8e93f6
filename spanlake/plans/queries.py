"""Structured, backend-neutral queries. Raw query strings can be carried but every operator refuses to run them."""

from __future__ import annotations

from dataclasses import dataclass, replace
from enum import Enum


class UnsupportedQuery(ValueError):
    """The query cannot be expressed; raised before any Spark plan is built."""


class MatchOp(str, Enum):
    EQ = "="
    NEQ = "!="
    RE = "=~"
    NRE = "!~"


class LineOp(str, Enum):
    CONTAINS = "|="
    NOT_CONTAINS = "!="
    REGEX = "|~"
    NOT_REGEX = "!~"


class TraceOp(str, Enum):
    EQ = "="
    NEQ = "!="
    GT = ">"
    GTE = ">="
    LT = "<"
    LTE = "<="
    RE = "=~"
    NRE = "!~"


class MetricFn(str, Enum):
    NONE = "none"
    RATE = "rate"
    INCREASE = "increase"
    COUNTER_INCREASE = "counter_increase"


class SpanSort(str, Enum):
    TOTAL = "total_ms"
    AVG = "avg_ms"
    P95 = "p95_ms"
    MAX = "max_ms"
    CALLS = "count"


@dataclass(frozen=True)
class LabelMatcher:
    label: str
    op: MatchOp
    value: str

    @classmethod
    def eq(cls, label: str, value: str) -> LabelMatcher:
        return cls(label, MatchOp.EQ, value)


@dataclass(frozen=True)
class LineFilter:
    op: LineOp
    value: str


@dataclass(frozen=True)
class LabelFilter:
    matchers: tuple[LabelMatcher, ...]
    any_of: bool = False


@dataclass(frozen=True)
class LogQuery:
    matchers: tuple[LabelMatcher, ...] = ()
    pipeline: tuple[LineFilter | LabelFilter, ...] = ()
    raw: str | None = None

    @classmethod
    def stream(cls, *matchers: LabelMatcher) -> LogQuery:
        return cls(matchers=matchers)

    def line(self, op: LineOp, value: str) -> LogQuery:
        return self._then(LineFilter(op, value))

    def where_label(self, label: str, op: MatchOp, value: str) -> LogQuery:
        return self._then(LabelFilter((LabelMatcher(label, op, value),)))

    def where_all(self, *matchers: LabelMatcher) -> LogQuery:
        return self._then(LabelFilter(matchers))

    def where_any(self, *matchers: LabelMatcher) -> LogQuery:
        return self._then(LabelFilter(matchers, any_of=True))

    def _then(self, stage: LineFilter | LabelFilter) -> LogQuery:
        return replace(self, pipeline=(*self.pipeline, stage))


@dataclass(frozen=True)
class TraceCondition:
    field: str
    op: TraceOp
    value: str
    quoted: bool = True

    @classmethod
    def eq(cls, field: str, value: str) -> TraceCondition:
        return cls(field, TraceOp.EQ, value)

    @classmethod
    def token(cls, field: str, op: TraceOp, value: str) -> TraceCondition:
        """A bare token such as ``error``, ``server``, ``100ms`` or ``500``."""
        return cls(field, op, value, quoted=False)

    @classmethod
    def present(cls, field: str) -> TraceCondition:
        return cls(field, TraceOp.NEQ, "nil", quoted=False)

    @classmethod
    def absent(cls, field: str) -> TraceCondition:
        return cls(field, TraceOp.EQ, "nil", quoted=False)

    @property
    def tests_presence(self) -> bool:
        return self.op is TraceOp.NEQ and self.value == "nil" and not self.quoted


@dataclass(frozen=True)
class TraceQuery:
    conditions: tuple[TraceCondition, ...] = ()
    raw: str | None = None

    def where(self, *conditions: TraceCondition) -> TraceQuery:
        return replace(self, conditions=(*self.conditions, *conditions))


@dataclass(frozen=True)
class SpanAggregation:
    where: TraceQuery
    group_by: str
    carry: tuple[str, ...] = ()
    quantile: float = 0.95
    sort: SpanSort = SpanSort.TOTAL
    limit: int = 50


@dataclass(frozen=True)
class MetricQuery:
    name: str
    fn: MetricFn = MetricFn.NONE
    window: str = ""
    by: tuple[str, ...] = ()
    matchers: tuple[LabelMatcher, ...] = ()
    raw_matchers: tuple[str, ...] = ()
    quantile: float | None = None
    scalar: float | None = None
    raw: str | None = None
    table: str | None = None
    per_series: bool = False
    normalized: bool = False

    def rate(self, window: str = "") -> MetricQuery:
        return replace(self, fn=MetricFn.RATE, window=window)

    def increase(self, window: str = "") -> MetricQuery:
        return replace(self, fn=MetricFn.INCREASE, window=window)

    def counter_increase(self, window: str = "") -> MetricQuery:
        return replace(self, fn=MetricFn.COUNTER_INCREASE, window=window)

    def grouped(self, *labels: str) -> MetricQuery:
        """Label grouping; the aggregation verb (sum by, max by) never changes the result, so there is one method."""
        return replace(self, by=labels)

    def match(self, label: str, op: MatchOp, value: str) -> MetricQuery:
        return replace(self, matchers=(*self.matchers, LabelMatcher(label, op, value)))

    def match_fragment(self, fragment: str) -> MetricQuery:
        return replace(self, raw_matchers=(*self.raw_matchers, fragment))

    def at_quantile(self, q: float, window: str = "") -> MetricQuery:
        return replace(self, quantile=q, window=window or self.window)

    def times(self, scalar: float) -> MetricQuery:
        return replace(self, scalar=scalar)

    def from_table(self, table: str) -> MetricQuery:
        """Read ``sum`` or ``gauge`` whatever the name ends in, so that a plain metric may be called ``x_count``."""
        if table not in ("sum", "gauge"):
            raise UnsupportedQuery("a query can be sent to the sum or the gauge table")
        return replace(self, table=table)

    def each_series(self) -> MetricQuery:
        """Increases and rates series by series, added up per label group."""
        return replace(self, per_series=True)

    def normalized_labels(self) -> MetricQuery:
        """Labels find attribute keys that hold underscores themselves, as ``http.response.status_code``."""
        return replace(self, normalized=True)


def reject_raw(raw: str | None, language: str) -> None:
    if raw is not None:
        raise UnsupportedQuery(f"raw {language} strings cannot be run; describe the query with the structured API")
