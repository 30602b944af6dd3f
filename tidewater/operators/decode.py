"""Decode topic payloads: JSON with a schema (dead letters split off), reader-schema
default fill, and the wire-format header (magic byte + 4-byte schema id)."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.columns import wire_body, wire_magic_ok, wire_schema_id

META = ["partition", "offset", "timestamp"]


def json_path(keys: list[str]) -> str:
    """The path of nested keys, whatever characters they hold."""
    for k in keys:
        if "'" in k and '"' in k:
            raise ValueError(f"a key with both kinds of quotes has no path: {k!r}")
    return "$" + "".join(f'["{k}"]' if "'" in k else f"['{k}']" for k in keys)


def _schema(schema: T.StructType | str) -> T.StructType:
    return T._parse_datatype_string(schema) if isinstance(schema, str) else schema


def decode_json(df: DataFrame, schema: T.StructType | str, required: list[str] | None = None,
                meta: list[str] | None = None, key_as_string: bool = True, wire: bool = False,
                registry: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, dead_letter) from a topic frame whose ``value`` is JSON text.

    Parsing is PERMISSIVE: a malformed body or a missing required field sends the
    record to the dead-letter frame (raw value and a reason) and the stream goes
    on. Both outputs are lazy and work on streams.

    ``wire``: the value starts with the 5-byte header of a schema registry, which is checked and taken off; with
    ``registry`` (a table with the schemas' ``id``) its schema id must be known there. A key or source column that
    a payload field shares its name with is called ``_topic_<name>``.
    """
    schema = _schema(schema)
    meta = META if meta is None else meta
    required = list(required or [])
    names = {f.name.lower() for f in schema.fields}
    own = lambda c: f"_topic_{c}" if c.lower() in names else c
    with_corrupt = T.StructType(schema.fields + [T.StructField("_corrupt", T.StringType())])
    head = {own("key"): F.col("key").cast("string")} if key_as_string and "key" in df.columns else {}
    head |= {own(m): F.col(m) for m in meta if m in df.columns}
    problem = F.lit(None).cast("string")
    if wire:
        df = split_wire(df)
        problem = F.when(F.col("value").isNull(), F.lit("null value")).when(
            (F.length("value") < 5) | ~F.col("magic_ok"), F.lit("header"))
        if registry is not None:
            known = registry.select(F.col("id").alias("_known")).distinct()
            df = df.join(known, F.col("schema_id") == F.col("_known"), "left")
            problem = F.coalesce(problem, F.when(F.col("_known").isNull(), F.lit("unknown schema id")))
    text = F.col("body" if wire else "value").cast("string")
    parsed = df.select(
        *[c.alias(name) for name, c in head.items()], F.col("value").cast("string").alias("_raw"), problem.alias("_problem"),
        F.from_json(text, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("_r"))
    missing = [F.when(F.col(f"_r.`{c}`").isNull(), F.lit(f"missing:{c}")) for c in required]
    reason = F.coalesce(F.col("_problem"), F.when(F.col("_raw").isNull(), F.lit("null value")),
                        F.when(F.col("_r._corrupt").isNotNull() | F.col("_r").isNull(), F.lit("malformed")),
                        *missing)
    flagged = parsed.withColumn("_reason", reason)
    fields = [F.col(f"_r.`{f.name}`").alias(f.name) for f in schema.fields]
    good = flagged.where(F.col("_reason").isNull()).select(*head, *fields)
    bad = flagged.where(F.col("_reason").isNotNull()).select(*head, F.col("_raw").alias("value"),
                                                               F.col("_reason").alias("reason"))
    return good, bad


def json_topic_table(df: DataFrame, schema: T.StructType | str, proctime: str | None = None,
                     meta: list[str] | None = None, on_bad: str = "fail") -> DataFrame:
    """A JSON topic as a typed table, with an optional processing-time column (fixed once per micro-batch in
    Structured Streaming). A malformed record fails the query; ``on_bad="discard"`` drops it instead, and
    ``decode_json`` hands it over."""
    if on_bad not in ("fail", "discard"):
        raise ValueError("on_bad must be 'fail' or 'discard'")
    if on_bad == "fail":
        parsed = F.try_parse_json(F.col("value").cast("string"))
        stop = F.raise_error(F.concat(F.lit("malformed record: "), F.coalesce(F.col("value").cast("string"), F.lit("null"))))
        df = df.withColumn("value", F.when(parsed.isNotNull(), F.col("value")).otherwise(stop.cast("binary")))
    good, _ = decode_json(df, schema, meta=meta if meta is not None else [])
    return good.withColumn(proctime, F.current_timestamp()) if proctime else good


def conform_json(df: DataFrame, col: str, schema: T.StructType | str, defaults: dict[str, Any] | None = None,
                 keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, dead letters) of JSON text read with a reader schema.

    A field that is absent takes its declared default, an explicit JSON null stays null, extra fields are
    dropped. Text that is no JSON object takes no defaults: it goes, unchanged, to the dead letters.
    """
    schema = _schema(schema)
    defaults = defaults or {}
    parsed = df.withColumn("_v", F.try_parse_json(F.col(col)))
    is_object = F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False))
    v = F.col("_v")
    out = []
    for f in schema.fields:
        path = json_path([f.name])
        present = F.try_variant_get(v, path, "variant").isNotNull()
        val = F.try_variant_get(v, path, f.dataType.simpleString())
        if f.name in defaults:
            val = F.when(present, val).otherwise(F.lit(defaults[f.name]).cast(f.dataType))
        out.append(val.alias(f.name))
    return parsed.where(is_object).select(*(keep or []), *out), parsed.where(~is_object).select(*(keep or []), col)


def conform(df: DataFrame, schema: T.StructType | str, defaults: dict[str, Any] | None = None) -> DataFrame:
    """Project a typed frame onto a reader schema: present columns are cast,
    absent ones take their default (or null); columns not in the schema drop."""
    schema = _schema(schema)
    defaults = defaults or {}
    have = set(df.columns)
    cols = [(F.col(f"`{f.name}`").cast(f.dataType) if f.name in have
             else F.lit(defaults.get(f.name)).cast(f.dataType)).alias(f.name) for f in schema.fields]
    return df.select(*cols)


def split_wire(df: DataFrame) -> DataFrame:
    """Add ``schema_id``, ``magic_ok`` and the header-stripped ``body`` (binary)."""
    return df.withColumns({"magic_ok": wire_magic_ok("value"), "schema_id": wire_schema_id("value"),
                           "body": wire_body("value")})


def with_wire_header(body: Column, schema_id: int) -> Column:
    """Prefix a body with the 5-byte wire header for ``schema_id``."""
    header = F.unhex(F.lit("00" + format(schema_id, "08x")))
    return F.concat(header, body)
