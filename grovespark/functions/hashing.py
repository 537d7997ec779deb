"""Canonical JSON, digests, tags and cursors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def by_name(value: Column, kind: T.DataType) -> Column:
    """A value of a type with the fields of its structs by name and the entries of its maps by key, at any depth; arrays keep their order, nulls stay."""
    if isinstance(kind, T.StructType):
        if not kind.fields:
            return value
        fields = [by_name(value[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: by_name(x, kind.elementType)) if _holds_names(kind.elementType) else value
    if isinstance(kind, T.MapType):
        sorted_ = F.array_sort(F.map_entries(value), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
        return F.map_from_entries(F.transform(sorted_, lambda e: F.struct(e["key"].alias("key"), by_name(e["value"], kind.valueType).alias("value"))))
    return value


def _holds_names(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StructType, T.MapType)) or isinstance(kind, T.ArrayType) and _holds_names(kind.elementType)


def canonical_json(fields: dict[str, Column], schema: T.StructType | None = None) -> Column:
    """A JSON object with its fields by name, nulls written.

    schema: the types of the fields, where structs and maps in them are to be put in order as well.
    """
    kinds = {f.name: f.dataType for f in schema} if schema is not None else {}
    ordered = {k: by_name(v, kinds[k]) if k in kinds else v for k, v in fields.items()}
    return F.to_json(F.struct(*(ordered[k].alias(k) for k in sorted(ordered))), {"ignoreNullFields": "false"})


def canonical_sha256(fields: dict[str, Column], schema: T.StructType | None = None) -> Column:
    return F.sha2(canonical_json(fields, schema), 256)


def idempotency_key(commit: Column, snapshot: Column, transformation: Column) -> Column:
    return canonical_sha256({"commit": commit, "snapshot": snapshot, "transformation": transformation})


def etag(manifest: Column, query: Column) -> Column:
    return F.concat(F.lit('"'), F.substring(F.sha2(F.concat(manifest, F.coalesce(query, F.lit(""))), 256), 1, 32), F.lit('"'))


def encode_cursor(value: Column) -> Column:
    return F.translate(F.rtrim(F.base64(value.cast("binary")), F.lit("=")), "+/", "-_")


def decode_cursor(value: Column) -> Column:
    plain = F.translate(value, "-_", "+/")
    filled = F.rpad(plain, (F.ceil(F.length(plain) / 4) * 4).cast("int"), F.lit("="))
    return F.unbase64(filled).cast("string")
