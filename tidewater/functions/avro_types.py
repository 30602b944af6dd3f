"""Avro schema JSON to Spark types (the mapping Spark's own Avro reader uses)."""

from __future__ import annotations

import json
import re
from typing import Any

from pyspark.sql import types as T

# Avro primitive -> Spark type.
PRIMITIVES = {"int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(),
              "boolean": T.BooleanType(), "string": T.StringType(), "bytes": T.BinaryType(),
              "null": T.NullType()}


def parse_avro(schema: str | dict | list) -> Any:
    """Schema JSON text to its parsed form; a bare type name stays a string."""
    if isinstance(schema, str) and schema.lstrip()[:1] in ("{", "[", '"'):
        return json.loads(schema)
    return schema


def _full_name(s: dict, namespace: str | None) -> str:
    name = s["name"]
    ns = s.get("namespace", namespace)
    return name if "." in name or not ns else f"{ns}.{name}"


def _collect_named(s, namespace, named: dict) -> None:
    if isinstance(s, list):
        for b in s:
            _collect_named(b, namespace, named)
    elif isinstance(s, dict):
        t = s.get("type")
        if t in ("record", "enum", "fixed"):
            full = _full_name(s, namespace)
            named[full] = s
            named.setdefault(s["name"], s)
            ns = s.get("namespace", namespace)
            for f in s.get("fields", []):
                _collect_named(f["type"], ns, named)
        elif t == "array":
            _collect_named(s["items"], namespace, named)
        elif t == "map":
            _collect_named(s["values"], namespace, named)


def named_types(schema) -> dict[str, dict]:
    named: dict[str, dict] = {}
    _collect_named(parse_avro(schema), None, named)
    return named


def resolve(s, named: dict):
    """Replace a named-type reference by its definition."""
    if isinstance(s, str) and s not in PRIMITIVES:
        return named[s]
    return s


def non_null_branches(union: list) -> list:
    return [b for b in union if b != "null"]


def collapsed_union_type(branches: list, named: dict) -> T.DataType | None:
    """[int, long] -> bigint and [float, double] -> double, as Spark maps them."""
    kinds = {resolve(b, named) if isinstance(b, str) else None for b in branches}
    if kinds <= {"int", "long"} and kinds:
        return T.LongType() if "long" in kinds else T.IntegerType()
    if kinds <= {"float", "double"} and kinds:
        return T.DoubleType() if "double" in kinds else T.FloatType()
    return None


def to_spark(s, named: dict | None = None) -> T.DataType:
    named = named if named is not None else named_types(s)
    s = resolve(parse_avro(s), named)
    if isinstance(s, str):
        return PRIMITIVES[s]
    if isinstance(s, list):
        branches = non_null_branches(s)
        if len(branches) == 1:
            return to_spark(branches[0], named)
        collapsed = collapsed_union_type(branches, named)
        if collapsed is not None:
            return collapsed
        return T.StructType([T.StructField(f"member{i}", to_spark(b, named), True)
                             for i, b in enumerate(branches)])
    t = s["type"]
    logical = s.get("logicalType")
    if t == "record":
        return T.StructType([T.StructField(f["name"], to_spark(f["type"], named), _nullable(f["type"]))
                             for f in s["fields"]])
    if t == "array":
        return T.ArrayType(to_spark(s["items"], named), _nullable(s["items"]))
    if t == "map":
        return T.MapType(T.StringType(), to_spark(s["values"], named), _nullable(s["values"]))
    if t == "enum":
        return T.StringType()
    if t == "fixed":
        return T.BinaryType()
    if logical == "timestamp-millis" or logical == "timestamp-micros":
        return T.TimestampType()
    if logical == "local-timestamp-millis" or logical == "local-timestamp-micros":
        return T.TimestampNTZType()
    if logical == "date":
        return T.DateType()
    if logical == "decimal":
        return T.DecimalType(s["precision"], s.get("scale", 0))
    return PRIMITIVES[t]


def _nullable(s) -> bool:
    return isinstance(s, list) and "null" in s


def record_schema(schema) -> T.StructType:
    """Top-level record as a StructType (columns = record fields)."""
    out = to_spark(schema)
    if not isinstance(out, T.StructType):
        raise ValueError("top-level Avro schema must be a record")
    return out


def legal_name(name: str) -> str:
    """A name that the Avro specification allows: letters, digits and underscores, not starting with a digit."""
    out = re.sub(r"[^A-Za-z0-9_]", "_", name)
    return out if re.match(r"[A-Za-z_]", out) else f"_{out}"


def legal_names(schema) -> Any:
    """The schema with legal field names at every level, as container files need them; types and order stay.

    Raises if two fields of a record would then share a name."""
    s = parse_avro(schema)
    if isinstance(s, list):
        return [legal_names(b) for b in s]
    if not isinstance(s, dict):
        return s
    out = dict(s)
    if s["type"] == "record":
        out["fields"] = [dict(f, name=legal_name(f["name"]), type=legal_names(f["type"])) for f in s["fields"]]
        names = [f["name"].lower() for f in out["fields"]]
        if len(set(names)) < len(names):
            raise ValueError(f"record {s['name']} has fields whose names differ only in characters that Avro doesn't allow")
    for part in ("items", "values"):
        if part in s:
            out[part] = legal_names(s[part])
    return out


def loose(dtype: T.DataType) -> T.DataType:
    """The type with nulls allowed at every level, as columns made by expressions have it."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, loose(f.dataType)) for f in dtype])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(loose(dtype.elementType))
    if isinstance(dtype, T.MapType):
        return T.MapType(T.StringType(), loose(dtype.valueType))
    return dtype


def field_defaults(schema) -> dict[str, Any]:
    """Declared defaults of the top-level fields (used for reader-schema fill)."""
    s = parse_avro(schema)
    return {f["name"]: f["default"] for f in s.get("fields", []) if "default" in f}
