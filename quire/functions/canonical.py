"""Canonical JSON of nested values: keys sorted, nothing between tokens, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Short escapes; other control characters are written by code.
SHORT = {"\b": "\\b", "\f": "\\f", "\n": "\\n", "\r": "\\r", "\t": "\\t"}
ESCAPES = {"\\": "\\\\", '"': '\\"', **{chr(c): SHORT.get(chr(c), f"\\u{c:04x}") for c in range(32)}}


def _string(value: Column, ascii_only: bool) -> Column:
    escaped = reduce(lambda s, pair: F.replace(s, F.lit(pair[0]), F.lit(pair[1])), ESCAPES.items(), value)
    text = F.when(value.rlike(r'[\x00-\x1f"\\\\]'), escaped).otherwise(value)
    if ascii_only:
        units = lambda run: F.regexp_replace(F.lower(F.hex(F.encode(run, "UTF-16BE"))), "(.{4})", r"\\u$1")
        runs = F.regexp_extract_all(text, F.lit(r"[\x00-\x7e]+|[^\x00-\x7e]+"), 0)
        text = F.when(value.rlike(r"[^\x00-\x7e]"), F.array_join(F.transform(runs, lambda run: F.when(run.rlike(r"^[\x00-\x7e]"), run).otherwise(units(run))), "")).otherwise(text)
    return F.concat(F.lit('"'), text, F.lit('"'))


def _double(value: Column) -> Column:
    """The shortest digits that give the number back: by place from 1e-4 to below 1e16, else with an exponent of two digits or more.

    Found by trying each number of digits, as a cast gives more than needed on some Java versions.
    """
    tries = [F.format_string(f"%.{digits}e", value) for digits in range(17)]
    shortest = F.coalesce(*(F.when(text.cast("double") == value, text) for text in tries))
    size = F.abs(value)
    placed = F.regexp_replace(F.regexp_replace(shortest.cast("decimal(38,21)").cast("string"), "0+$", ""), r"\.$", ".0")
    return F.when((size >= 1e-4) & (size < 1e16), placed).when((size > 0) & (size < float("inf")), shortest).otherwise(value.cast("string"))


def canonical_json(value: Column, kind: T.DataType, ascii_only: bool = False) -> Column:
    """JSON of a value of this type; null fields are written as null, maps have string keys, numbers are integers or doubles."""

    def inner(v: Column, of: T.DataType) -> Column:
        return canonical_json(v, of, ascii_only)

    if isinstance(kind, T.StructType):
        parts = []
        for field in sorted(kind.fields, key=lambda f: f.name):
            parts += [F.lit("," if parts else "{"), _string(F.lit(field.name), ascii_only), F.lit(":"), inner(value.getField(field.name), field.dataType)]
        text = F.concat(*parts, F.lit("}")) if parts else F.lit("{}")
    elif isinstance(kind, T.ArrayType):
        text = F.concat(F.lit("["), F.array_join(F.transform(value, lambda x: inner(x, kind.elementType)), ","), F.lit("]"))
    elif isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
        pair = lambda k: F.concat(_string(k, ascii_only), F.lit(":"), inner(F.element_at(value, k), kind.valueType))
        text = F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.map_keys(value)), pair), ","), F.lit("}"))
    elif isinstance(kind, T.StringType):
        text = _string(value, ascii_only)
    elif isinstance(kind, T.DoubleType):
        text = _double(value)
    elif isinstance(kind, (T.BooleanType, T.IntegralType)):
        text = value.cast("string")
    else:
        raise TypeError(f"no canonical JSON for {kind.simpleString()}")
    return F.when(value.isNull(), "null").otherwise(text)


def canonical_hash(value: Column, kind: T.DataType, ascii_only: bool = False) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(canonical_json(value, kind, ascii_only).cast("binary"), 256))
