"""Access to semi-structured values.

A payload value is a VARIANT, so its JSON type survives parsing: the text "9" and the
number 9 stay different.  Four kinds of empty are told apart: absent key (SQL NULL),
JSON null (variant null), blank text, and the single blank that marks erased data.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VARIANT_MAP = "map<string,variant>"
VARIANT_MAP_ARRAY = "array<map<string,variant>>"
BLANK = r"^\s*$"
ERASED = " "


def text(value: Column) -> Column:
    """A variant as text; JSON null, absent and unconvertible values are NULL."""
    return F.try_variant_get(value, "$", "string")


def kind(value: Column) -> Column:
    """JSON type of a variant: STRING, BIGINT, BOOLEAN, VOID, OBJECT<..>, ARRAY<..>, ..."""
    return F.schema_of_variant(value)


def is_text(value: Column) -> Column:
    return F.coalesce(kind(value) == "STRING", F.lit(False))


def is_object(value: Column) -> Column:
    return F.coalesce(kind(value).startswith("OBJECT"), F.lit(False))


def variant(value: Column) -> Column:
    """A SQL scalar as a variant."""
    return value.cast("variant")


def variant_null() -> Column:
    return F.parse_json(F.lit("null"))


def is_blank(txt: Column) -> Column:
    """NULL, empty or whitespace-only text."""
    return F.coalesce(txt.rlike(BLANK), F.lit(True))


def is_null_or_blank(value: Column) -> Column:
    """Variant that is absent, JSON null, or blank text."""
    return F.when(kind(value) == "STRING", is_blank(text(value))).otherwise(
        value.isNull() | F.coalesce(F.is_variant_null(value), F.lit(True))
    )


def is_falsy(value: Column) -> Column:
    """Absent, null, empty text, false, zero, or an empty object or array."""
    shape = kind(value)
    body = F.to_json(value)
    return (
        F.when(value.isNull() | F.is_variant_null(value), True)
        .when(shape == "STRING", text(value) == "")
        .when(shape == "BOOLEAN", text(value) == "false")
        .when(shape.startswith("OBJECT") | shape.startswith("ARRAY"), body.isin("{}", "[]"))
        .otherwise(F.coalesce(F.try_variant_get(value, "$", "double") == 0, F.lit(False)))
    )


def usable(value: Column) -> Column:
    """The value itself when it is non-blank text, a non-zero whole number or true; else NULL."""
    shape = kind(value)
    keep = (
        F.when(shape == "STRING", ~is_blank(text(value)))
        .when(shape == "BIGINT", text(value) != "0")
        .when(shape == "BOOLEAN", text(value) == "true")
        .otherwise(False)
    )
    return F.when(keep, value)


def from_traits_or_properties(key: str) -> Column:
    """First usable value of ``key`` in traits, then properties."""
    return F.coalesce(usable(F.col("traits")[key]), usable(F.col("properties")[key]))


def has_key(mapping: Column, key: str) -> Column:
    return F.coalesce(F.map_contains_key(mapping, key), F.lit(False))


def put(mapping: Column, key: str, value: Column) -> Column:
    """Map with ``key`` set to ``value``; independent of the map-key dedup policy."""
    kept = F.map_filter(mapping, lambda k, _: k != F.lit(key))
    return F.map_concat(kept, F.create_map(F.lit(key), value))


def put_all(mapping: Column, other: Column) -> Column:
    """Map with every entry of ``other`` added; ``other`` wins."""
    kept = F.map_filter(mapping, lambda k, _: ~F.map_contains_key(other, k))
    return F.map_concat(kept, other)


def empty_map() -> Column:
    return F.from_json(F.lit("{}"), VARIANT_MAP)


def root(key: str) -> Column:
    """Top-level value as a variant."""
    return F.col("root")[key]


def root_text(key: str) -> Column:
    return text(root(key))


def has_root(key: str) -> Column:
    """Presence of a top-level key, whatever its value."""
    return F.coalesce(F.array_contains(F.col("top_keys"), key), F.lit(False))


# ---- external ids -----------------------------------------------------------


def ext_type(item: Column) -> Column:
    return text(item["type"])


def ext_first(kind_name: str, array: Column | None = None) -> Column:
    """First external id of a type, as a map; NULL when there is none."""
    ids = F.col("ext_ids") if array is None else array
    return F.get(F.filter(ids, lambda x: ext_type(x) == kind_name), F.lit(0))


def ext_id(kind_name: str, array: Column | None = None) -> Column:
    """Variant ``id`` of the first external id of a type."""
    return ext_first(kind_name, array)["id"]


def ext_text(kind_name: str, array: Column | None = None) -> Column:
    return text(ext_id(kind_name, array))


def ext_entry(kind_name: str, id_value: Column) -> Column:
    """A new external-id object; ``id_value`` is a variant."""
    return F.create_map(
        F.lit("collection"), variant(F.lit("users")),
        F.lit("encoding"), variant(F.lit("none")),
        F.lit("id"), id_value,
        F.lit("type"), variant(F.lit(kind_name)),
    )


def ext_append(array: Column, entry: Column, when: Column) -> Column:
    """``array`` with ``entry`` at its end where ``when`` holds; a missing array counts as empty."""
    no_ids = F.from_json(F.lit("[]"), VARIANT_MAP_ARRAY)
    return F.when(when, F.concat(F.coalesce(array, no_ids), F.array(entry))).otherwise(array)


def ext_drop_first(array: Column, kind_name: str, when: Column) -> Column:
    """``array`` without its first entry of a type where ``when`` holds."""
    position = F.array_position(F.transform(array, ext_type), kind_name)
    rest = F.filter(array, lambda _, i: i + 1 != position)
    return F.when(when, rest).otherwise(array)
