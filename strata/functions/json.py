"""Column helpers over JSON held as text or as VARIANT.

Documents are parsed once into VARIANT and walked there; paths use the ``$.a.b``
syntax of ``variant_get``.  All lookups are null-on-mismatch (``try_variant_get``),
like path extraction in SQL engines: a missing key, a JSON null or a value of
another kind gives null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_variant(text: Column | str, strict: bool = True) -> Column:
    """Text → VARIANT; ``strict=False`` gives null for text that is not JSON."""
    return F.parse_json(_c(text)) if strict else F.try_parse_json(_c(text))


def json_string(v: Column | str, path: str = "$") -> Column:
    """Value at ``path`` as text: strings unquoted, numbers and booleans as written."""
    return F.try_variant_get(_c(v), path, "string")


def json_value(v: Column | str, path: str, type_: str) -> Column:
    """Text of the value at ``path`` cast to ``type_`` (null when it does not convert:
    JSON ``true`` is no number)."""
    return F.try_variant_get(_c(v), path, "string").try_cast(type_)


def json_doc(v: Column | str, path: str) -> Column:
    """Sub-document at ``path`` as VARIANT (null when missing)."""
    return F.try_variant_get(_c(v), path, "variant")


def json_length(v: Column | str, path: str = "$") -> Column:
    """Number of elements of the array at ``path``; null when it is not an array."""
    return F.array_size(json_items(v, path))


def json_items(v: Column | str, path: str = "$") -> Column:
    """Array at ``path`` as ``array<variant>``; null when the value is not an array."""
    return F.try_variant_get(_c(v), path, "array<variant>")


def json_entries(v: Column | str, path: str = "$") -> Column:
    """Object at ``path`` as ``map<string, variant>``; null when it is not an object."""
    return F.try_variant_get(_c(v), path, "map<string,variant>")


def is_json_array(v: Column | str, path: str = "$") -> Column:
    """True when the value is a JSON array (never for a string such as ``"[x]"``)."""
    return json_items(v, path).isNotNull()


def json_kind(v: Column | str) -> Column:
    """Kind of a value: ARRAY, OBJECT, STRING, BIGINT, DECIMAL (plain fractions such as
    ``1.5``), DOUBLE (exponent forms), BOOLEAN, VOID (JSON null) …"""
    return F.regexp_extract(F.schema_of_variant(_c(v)), r"^([A-Z_]+)", 1)
