"""Avro payloads on topics, through Spark's own ``from_avro`` / ``to_avro`` (the spark-avro package must be loaded)."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.avro_types import parse_avro, record_schema
from tidewater.functions.columns import wire_body, wire_magic_ok, wire_schema_id
from tidewater.operators.decode import with_wire_header


def encode_avro(df: DataFrame, schema, schema_id: int | None = None, out_col: str = "value",
                keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns plus ``out_col``: each row's record fields as an Avro body,
    with the 5-byte wire header when ``schema_id`` is given. Fields the rows lack take their declared defaults."""
    from pyspark.sql.avro.functions import to_avro

    s = parse_avro(schema)
    declared = record_schema(s)
    for f in s["fields"]:
        if f["name"] not in df.columns:
            if "default" not in f:
                raise ValueError(f"field {f['name']!r} is missing and has no default")
            df = df.withColumn(f["name"], F.lit(f["default"]).cast(declared[f["name"]].dataType))
    body = to_avro(F.struct(*[F.col(f"`{f['name']}`") for f in s["fields"]]), json.dumps(s))
    return df.select(*(keep or []), (with_wire_header(body, schema_id) if schema_id is not None else body).alias(out_col))


def decode_avro(df: DataFrame, reader_schema, schema_id: int | None = None, keep: list[str] | None = None,
                value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(good, dead letters) of records whose Avro body was written with ``reader_schema``.

    With ``schema_id`` the value has the wire header, which must name that id: a body of another writer schema is
    never read with this one. PERMISSIVE decoding makes a malformed body null, and it goes to the dead letters.
    """
    from pyspark.sql.avro.functions import from_avro

    wire = schema_id is not None
    body = wire_body(value) if wire else F.col(value)
    right_id = (wire_magic_ok(value) & (wire_schema_id(value) == schema_id)) if wire else F.lit(True)
    parsed = df.withColumn("_ok_id", F.coalesce(right_id, F.lit(False))).withColumn(
        "_r", F.when(F.col("_ok_id"), from_avro(body, json.dumps(parse_avro(reader_schema)), {"mode": "PERMISSIVE"})))
    reason = F.when(~F.col("_ok_id"), F.lit("header")).when(F.col("_r").isNull(), F.lit("malformed"))
    good = parsed.where(F.col("_r").isNotNull()).select(*(keep or []), "_r.*")
    return good, parsed.where(F.col("_r").isNull()).select(*(keep or []), value, reason.alias("reason"))


def payload_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    """The decoded payload as JSON text, nulls kept."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in (columns or df.columns)]), {"ignoreNullFields": "false"})
