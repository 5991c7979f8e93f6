"""Reading loosely typed JSON leaves (VARIANT columns) into strings, numbers, lists and attribute maps.

Nothing here raises: a value of the wrong kind becomes ``''``, ``0`` or an empty list.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that counts as a number: surrounding blanks are fine, type suffixes and words are not.
INTEGER_TEXT = r"^[ \t\n\r\x0B\f]*[+-]?[0-9]+[ \t\n\r\x0B\f]*\z"
NUMBER_TEXT = r"^[ \t\n\r\x0B\f]*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t\n\r\x0B\f]*\z"

BIGINT_MAX = 9223372036854775807


# An attribute list as it is read from a payload.
ATTRIBUTES = "array<struct<key variant, value variant>>"


def shape(**members: str) -> str:
    """The type of a JSON object with the given members."""
    return f"struct<{', '.join(f'{name} {kind}' for name, kind in members.items())}>"


def leaves(*names: str) -> dict[str, str]:
    """Members whose own type is looked at later."""
    return dict.fromkeys(names, "variant")


def read(node: Column, path: str, kind: str) -> Column:
    """The member at ``path`` in the given shape, in one pass. Parts of another shape are NULL."""
    return F.try_variant_get(node, path, kind)


def present(value: Column) -> Column:
    """The value, with a JSON null read as absent."""
    return F.when(~F.is_variant_null(value), value)


def kind(value: Column) -> Column:
    """``STRING``, ``BIGINT``, ``DECIMAL(2,1)``, ``OBJECT<...>`` and so on."""
    return F.schema_of_variant(value)


def _plain(value: Column, target: str) -> Column:
    return F.try_variant_get(value, "$", target)


def integer(value: Column) -> Column:
    """JSON integers and numeric text; a JSON number with a fraction point is 0."""
    text = _plain(value, "string")
    from_text = F.coalesce(
        text.try_cast("bigint"),
        F.when(text.rlike(INTEGER_TEXT), F.when(text.contains("-"), -BIGINT_MAX - 1).otherwise(BIGINT_MAX)),
        F.when(text.rlike(NUMBER_TEXT), text.try_cast("double").try_cast("bigint")),
        F.lit(0).cast("bigint"),
    )
    return (
        F.when(kind(value) == "BIGINT", _plain(value, "bigint"))
        .when(kind(value) == "STRING", from_text)
        .otherwise(F.lit(0).cast("bigint"))
    )


def number(value: Column) -> Column:
    """JSON numbers and numeric text as DOUBLE."""
    text = _plain(value, "string")
    of_text = F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))
    of_number = F.when(kind(value) != "BOOLEAN", _plain(value, "double"))
    return F.coalesce(F.when(kind(value) == "STRING", of_text).otherwise(of_number), F.lit(0.0))


def string(value: Column) -> Column:
    """Scalars as text; lists, objects and null are empty. A bare ``true`` is ``1``, a bare ``false`` empty."""
    return (
        F.when(kind(value) == "STRING", _plain(value, "string"))
        .when(kind(value) == "BOOLEAN", F.when(_plain(value, "boolean"), "1").otherwise(""))
        .when(kind(value).rlike("^(OBJECT|ARRAY)"), "")
        .otherwise(F.coalesce(_plain(value, "string"), F.lit("")))
    )


def truthy(value: Column) -> Column:
    """Loose truth: false, 0, ``""``, ``"0"``, null, absent and empty are false."""
    members = _plain(value, "map<string,variant>")
    return F.coalesce(
        F.when(kind(value) == "STRING", ~_plain(value, "string").isin("", "0"))
        .when(kind(value) == "BOOLEAN", _plain(value, "boolean"))
        .when(kind(value) == "VOID", F.lit(False))
        .otherwise(_plain(value, "double") != 0),
        *(F.when(c.isNotNull(), F.size(c) > 0) for c in (_plain(value, "array<variant>"), members)),
        F.lit(False),
    )


def any_value(value: Column) -> Column:
    """An attribute value as text: the first known typed member, JSON text for nested values, bare scalars as they are.

    Nearly all values are an object with one text member; these are told by their type alone and read at once.
    """
    plain = F.when(kind(value) == "OBJECT<stringValue: STRING>", F.try_variant_get(value, "$.stringValue", "string"))
    return F.coalesce(plain, _any_other(value))


def _any_other(value: Column) -> Column:
    wrapped = _plain(value, shape(**leaves(*ANY_VALUE_MEMBERS)))
    text = (
        F.when(wrapped["stringValue"].isNotNull(), string(wrapped["stringValue"]))
        .when(wrapped["boolValue"].isNotNull(), truthy(wrapped["boolValue"]).cast("string"))
        .when(wrapped["intValue"].isNotNull(), string(wrapped["intValue"]))
        .when(wrapped["doubleValue"].isNotNull(), string(wrapped["doubleValue"]))
        .when(wrapped["bytesValue"].isNotNull(), string(wrapped["bytesValue"]))
        .when(wrapped["arrayValue"].isNotNull() | wrapped["kvlistValue"].isNotNull(), F.to_json(value))
        .otherwise("")
    )
    return F.coalesce(F.when(wrapped.isNotNull(), text), string(value))


# The typed members of an attribute value, in the order they are looked for.
ANY_VALUE_MEMBERS = (
    "stringValue",
    "boolValue",
    "intValue",
    "doubleValue",
    "bytesValue",
    "arrayValue",
    "kvlistValue",
)


def attribute_map(attributes: Column) -> Column:
    """``[{key, value}]`` as a map; entries without a usable key are skipped, of equal keys the last one wins."""
    entries = F.transform(
        F.coalesce(attributes, F.array().cast(ATTRIBUTES)),
        lambda e: F.named_struct(
            F.lit("key"),
            F.when(kind(e["key"]) == "STRING", _plain(e["key"], "string")),
            F.lit("value"),
            any_value(e["value"]),
        ),
    )
    return F.map_from_entries(F.filter(entries, lambda e: e["key"] != ""))
