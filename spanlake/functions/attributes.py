"""Label and attribute names resolved to columns.

A missing map key reads as ``''`` (never NULL), so that ``!=``, ``!~`` and ``= ''`` keep rows lacking the key. That
rule lives here and nowhere else. ``nullable=True`` leaves the ``''`` out, for comparisons that no absent value passes
anyway (``= 'x'``, ``!= ''``): the bare column can be pushed down to Parquet, the wrapped one cannot.

A table may hold chosen attributes a second time as plain columns (``promoted_name``). Lookups then read that column, so
Parquet prunes the map away and can skip row groups; results are the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Log labels answered by a column of their own.
LOG_LABEL_COLUMNS = {
    "service_name": "ServiceName",
    "trace_id": "TraceId",
    "span_id": "SpanId",
    "level": "SeverityText",
    "detected_level": "SeverityText",
    "severity_text": "SeverityText",
}

# Span fields answered by a column of their own.
SPAN_FIELD_COLUMNS = {
    "name": "SpanName",
    "status": "StatusCode",
    "kind": "SpanKind",
    "duration": "Duration",
    "resource.service.name": "ServiceName",
}

# Tags answered by a column of their own (no status, kind or duration here).
TAG_COLUMNS = {
    "service.name": "ServiceName",
    "resource.service.name": "ServiceName",
    "name": "SpanName",
}


def promoted_name(map_column: str, key: str) -> str:
    return f"{map_column}::{key}"


def attribute(df: DataFrame, map_column: str, key: str) -> Column:
    """The value under ``key``, NULL when absent."""
    promoted = promoted_name(map_column, key)
    if promoted in df.columns:
        return F.col(f"`{promoted}`")
    return F.col(map_column)[key]


def normalized(df: DataFrame, *map_columns: str) -> DataFrame:
    """The table with the keys of these maps spelled with dots throughout, as labels are looked up.

    The copies kept as columns are left out, since they go by the stored keys. Of keys that become equal the last one wins.
    """
    copies = [c for c in df.columns if any(c.startswith(promoted_name(m, "")) for m in map_columns)]
    spelled = {m: F.transform_keys(m, lambda key, _: F.replace(key, F.lit("_"), F.lit("."))) for m in map_columns}
    return df.drop(*copies).withColumns(spelled)


def _first(candidates: list[Column], nullable: bool) -> Column:
    if not nullable:
        return F.coalesce(*candidates, F.lit(""))
    return F.coalesce(*candidates) if len(candidates) > 1 else candidates[0]


def dotted(label: str) -> str:
    return label.replace("_", ".")


def log_label(df: DataFrame, label: str, nullable: bool = False) -> Column:
    """A promoted column, else the record attribute, else the resource attribute, under the dotted key."""
    if label in LOG_LABEL_COLUMNS:
        return F.col(LOG_LABEL_COLUMNS[label])
    key = dotted(label)
    return _first([attribute(df, "LogAttributes", key), attribute(df, "ResourceAttributes", key)], nullable)


def span_field(df: DataFrame, field: str, nullable: bool = False) -> Column:
    if field in SPAN_FIELD_COLUMNS:
        return F.col(SPAN_FIELD_COLUMNS[field])
    return _scoped(df, field, nullable)


def span_tag(df: DataFrame, tag: str, nullable: bool = False) -> Column:
    tag = tag.lstrip(".")
    if tag in TAG_COLUMNS:
        return F.col(TAG_COLUMNS[tag])
    return _scoped(df, tag, nullable)


def _scoped(df: DataFrame, name: str, nullable: bool) -> Column:
    if name.startswith("resource."):
        found = attribute(df, "ResourceAttributes", name.removeprefix("resource."))
    else:
        found = attribute(df, "SpanAttributes", name.removeprefix("span."))
    return _first([found], nullable)


def carried_name(field: str) -> str:
    """The name a carried span field is reported under: without its scope."""
    for scope in ("span.", "resource."):
        if field.startswith(scope):
            return field.removeprefix(scope)
    return field


def metric_label(df: DataFrame, label: str, nullable: bool = False) -> Column:
    """Only the environment label falls back to the resource; every other one is a point attribute."""
    if label == "service_name":
        return F.col("ServiceName")
    key = dotted(label)
    if label == "deployment_environment_name":
        return _first([attribute(df, "Attributes", key), attribute(df, "ResourceAttributes", key)], nullable)
    return _first([attribute(df, "Attributes", key)], nullable)


def log_labels() -> Column:
    """The flat label map of a log row.

    Columns first, then resource and record attributes under both their dotted and snake_case key. Later entries win
    (LAST_WIN, see ``session``) and empty values are dropped at the end.
    """
    columns = F.create_map(
        F.lit("service_name"), F.col("ServiceName"),
        F.lit("trace_id"), F.col("TraceId"),
        F.lit("span_id"), F.col("SpanId"),
        F.lit("level"), F.col("SeverityText"),
    )
    resource, record = F.col("ResourceAttributes"), F.col("LogAttributes")
    merged = F.map_concat(columns, resource, _snake_keys(resource), record, _snake_keys(record))
    return F.map_filter(merged, lambda _, value: value != "")


def _snake_keys(attributes: Column) -> Column:
    return F.transform_keys(attributes, lambda key, _: F.replace(key, F.lit("."), F.lit("_")))
