"""Topic plans: the test tables as Parquet topics in the topic record schema, and their decoding."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tidewater.functions.columns import wire_body
from tidewater.operators import timebuckets as tb
from tidewater.operators.decode import conform_json, decode_json, json_topic_table, with_wire_header
from tidewater.operators.resolution import decode_by_writer
from tidewater.plans.registry import plan, table
from tidewater.session import scratch_path
from tidewater.sinks.topics import json_value, to_topic, write_topic
from tidewater.sources.registry import registry_table, with_schema
from tidewater.sources.topics import TopicSpec, read_topic

EVENTS_DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def event_records(ev, name, value=None):
    """Events as records of a topic with three partitions; the event's id is its offset."""
    return to_topic(ev, name, value if value is not None else json_value(ev), key=F.col("event_id").cast("string"),
                    timestamp=F.col("ts"), partition=F.col("event_id") % 3, offset=F.col("event_id"))


def events_topic(spark, sf, value=None, name="events-json"):
    """``events`` written as a keyed JSON topic."""
    spec = TopicSpec(name, path=scratch_path(spark, f"topic-{name}"))
    write_topic(event_records(table(spark, sf, "events"), name, value), spec)
    return spec


# Source columns of a decoded record, as the oracles compare them.
SOURCE = ["partition", "offset", "timestamp"]
SOURCE_SQL = 'CAST(event_id % 3 AS INTEGER) AS "partition", event_id AS "offset"'


@plan("decode_json_topic", "K9 S1 T9 T3 W4", f"""
SELECT CAST(event_id AS VARCHAR) AS key, {SOURCE_SQL}, ts AS "timestamp", event_id, ts, user_id, event_type, value, props FROM events
""")
def decode_json_topic(spark, sf):
    spec = events_topic(spark, sf)
    good, _ = decode_json(read_topic(spark, spec), EVENTS_DDL, required=["event_id", "user_id"])
    return good.select("key", "partition", "offset", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), *EVENT_COLS)


@plan("decode_json_dead_letter", "T10 T9", """
SELECT CAST(event_id AS VARCHAR) AS key,
       CASE WHEN event_type = 'error' THEN 'malformed' ELSE 'missing:user_id' END AS reason
FROM events WHERE event_type IN ('error', 'signup')
""")
def decode_json_dead_letter(spark, sf):
    ev = table(spark, sf, "events")
    full = json_value(ev)
    # Error events get a broken body (a dangling key in front of the whole message).
    value = (F.when(F.col("event_type") == "error", F.concat(F.lit('{"bad" '), full))
             .when(F.col("event_type") == "signup", json_value(ev, [c for c in EVENT_COLS if c != "user_id"]))
             .otherwise(full))
    spec = events_topic(spark, sf, value, "events-dirty")
    _, bad = decode_json(read_topic(spark, spec), EVENTS_DDL, required=["event_id", "user_id"])
    return bad.select("key", "reason")


PAGEVIEW_READER = ("event_id bigint, event_type string, user_id bigint, address string, "
                   "added_column string, added_column2 int")
# Reader-schema defaults of the evolved record.
PAGEVIEW_DEFAULTS = {"address": "null", "added_column": "null", "added_column2": 42}


@plan("default_fill", "T4 T10", """
SELECT event_id, event_type, user_id, CASE WHEN event_type = 'signup' THEN NULL ELSE 'null' END AS address,
       'null' AS added_column, 42 AS added_column2, 'good' AS outcome
FROM events WHERE event_type <> 'error'
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, 'dead letter' FROM events WHERE event_type = 'error'
""")
def default_fill(spark, sf):
    """Absent fields take their defaults, explicit nulls stay, cut bodies become dead letters and take none."""
    ev = table(spark, sf, "events")
    v1 = F.to_json(F.struct("event_id", "event_type", "user_id"))
    with_null = F.to_json(F.struct("event_id", "event_type", "user_id", F.lit(None).cast("string").alias("address")),
                          {"ignoreNullFields": "false"})
    cut = F.expr("substring(to_json(struct(event_id, event_type, user_id)), 1, 12)")
    value = F.when(F.col("event_type") == "signup", with_null).when(F.col("event_type") == "error", cut).otherwise(v1)
    spec = events_topic(spark, sf, value, "events-v1")
    recs = read_topic(spark, spec).withColumn("value", F.col("value").cast("string"))
    good, bad = conform_json(recs, "value", PAGEVIEW_READER, PAGEVIEW_DEFAULTS)
    return good.withColumn("outcome", F.lit("good")).unionByName(
        bad.select(F.lit("dead letter").alias("outcome")), allowMissingColumns=True)


REGISTRY_ROWS = [("events-json-value", 1, 7, '{"version": 1}'), ("events-json-value", 2, 9, '{"version": 2}'),
                 ("other-value", 1, 11, "{}")]


@plan("decode_wire_json", "T9 S11 F1 T10", """
SELECT CAST(event_id AS VARCHAR) AS key, CASE event_type WHEN 'error' THEN 'header' WHEN 'signup' THEN 'unknown schema id'
         WHEN 'purchase' THEN 'malformed' END AS reason,
       CASE WHEN event_type IN ('click', 'view') THEN user_id END AS user_id,
       CASE WHEN event_type IN ('click', 'view') THEN value END AS value
FROM events
""")
def decode_wire_json(spark, sf):
    """Framed JSON values: good headers of two registered versions, a wrong magic byte, an unknown id, a cut body."""
    body = json_value(table(spark, sf, "events")).cast("binary")
    kind = F.col("event_type")
    value = (F.when(kind == "error", F.concat(F.unhex(F.lit("0100000007")), body))
             .when(kind == "signup", with_wire_header(body, 8))
             .when(kind == "purchase", with_wire_header(F.substring(body, 1, 20), 7))
             .when(kind == "view", with_wire_header(body, 9)).otherwise(with_wire_header(body, 7)))
    spec = events_topic(spark, sf, value, "events-wire")
    registry = registry_table(spark, REGISTRY_ROWS).where("subject = 'events-json-value'")
    good, bad = decode_json(read_topic(spark, spec), EVENTS_DDL, meta=[], wire=True, registry=registry)
    return good.select("key", F.lit(None).cast("string").alias("reason"), "user_id", "value").unionByName(
        bad.select("key", "reason"), allowMissingColumns=True)


@plan("registry_lookup", "S11 F1", """
SELECT CAST(event_id AS VARCHAR) AS key, CASE event_type WHEN 'view' THEN 9 WHEN 'error' THEN 99 ELSE 7 END AS schema_id,
       CASE event_type WHEN 'view' THEN '{"version": 2}' WHEN 'error' THEN NULL ELSE '{"version": 1}' END AS "schema",
       octet_length(CAST(event_type AS BLOB)) AS body_bytes
FROM events
""")
def registry_lookup(spark, sf):
    """Each record with the schema that the id in its header names, and its body's length."""
    body, kind = F.col("event_type").cast("binary"), F.col("event_type")
    value = F.when(kind == "view", with_wire_header(body, 9)).when(kind == "error", with_wire_header(body, 99)).otherwise(
        with_wire_header(body, 7))
    records = read_topic(spark, events_topic(spark, sf, value, "events-ids"))
    out = with_schema(records, registry_table(spark, REGISTRY_ROWS), "events-json-value")
    return out.select(F.col("key").cast("string").alias("key"), "schema_id", "schema",
                      F.octet_length(wire_body("value")).cast("bigint").alias("body_bytes"))


def _event_schema(*fields, **extra):
    return json.dumps({"type": "record", "name": "event", "fields": [dict(zip(("name", "type"), f[:2]), **(f[2] if f[2:] else {})) for f in fields], **extra})


def _kind(*symbols, **extra):
    return {"type": "enum", "name": "kind", "symbols": [*symbols], **extra}


#: three versions of the event record, by schema id: other names, types, unions and fields
EVENT_VERSIONS = {
    21: _event_schema(("event_id", "int"), ("type", _kind("click", "error")), ("value", "int"), ("props", "string")),
    22: _event_schema(("event_id", "long"), ("event_type", _kind("view", "purchase")), ("value", ["null", "float"]), ("user_id", ["null", "int"])),
    23: _event_schema(("event_id", "long"), ("event_type", _kind("signup")), ("value", "double"), ("user_id", ["null", "int", "string"]),
                      ("steps", {"type": "array", "items": "int"})),
}
EVENT_READER = _event_schema(
    ("id", "long", {"aliases": ["event_id"]}),
    ("event_type", _kind("click", "error", "signup", "view", "unlisted", default="unlisted"), {"aliases": ["type"]}), ("value", ["null", "double"]),
    ("user_id", ["null", "long", "string"], {"default": None}), ("steps", {"type": "array", "items": "double"}, {"default": [0.5]}),
    ("source", "string", {"default": "web"}))


@plan("decode_versions", "S11 T1 T4 T10 G3", """
SELECT CAST(event_id AS VARCHAR) AS key, CAST(CASE WHEN event_id % 50 = 0 THEN 99 WHEN event_type IN ('click', 'error') THEN 21
         WHEN event_type = 'signup' THEN 23 ELSE 22 END AS INTEGER) AS schema_id,
       CASE WHEN event_id % 50 = 0 THEN 'unknown schema id' WHEN event_id % 50 = 1 THEN 'malformed' END AS reason,
       CASE WHEN ok THEN event_id END AS id, CASE WHEN ok AND event_type = 'purchase' THEN 'unlisted' WHEN ok THEN event_type END AS event_type,
       CASE WHEN NOT ok OR (event_type = 'view' AND event_id % 7 = 0) THEN NULL WHEN event_type IN ('click', 'error') THEN CAST(floor(value) AS DOUBLE)
            WHEN event_type = 'signup' THEN round(value, 2) ELSE CAST(floor(value) AS DOUBLE) + 0.5 END AS value,
       CASE WHEN ok AND (event_type = 'view' OR event_type = 'purchase' OR (event_type = 'signup' AND event_id % 2 = 0)) THEN user_id END AS user_long,
       CASE WHEN ok AND event_type = 'signup' AND event_id % 2 = 1 THEN 'u' || user_id END AS user_string,
       CASE WHEN ok AND event_type = 'signup' THEN CAST(event_id % 3 + 2 AS DOUBLE) WHEN ok THEN 0.5 END AS steps_sum,
       CASE WHEN ok THEN 'web' END AS source
FROM (SELECT *, event_id % 50 > 1 AS ok FROM events)
""")
def decode_versions(spark, sf):
    """A topic of three schema versions, each record read with its writer's schema as the reader's record.

    The reader's enum lacks purchases, so its default symbol stands for them."""
    ev = table(spark, sf, "events")
    kind, whole = F.col("event_type"), F.floor("value").cast("int")
    v1 = F.struct("event_id", kind.alias("type"), whole.alias("value"), "props")
    v2 = F.struct("event_id", kind.alias("event_type"), F.when(~((kind == "view") & (F.col("event_id") % 7 == 0)), whole + 0.5).alias("value"), "user_id")
    odd = F.col("event_id") % 2 == 1
    members = F.struct(F.when(~odd, F.col("user_id")).alias("member0"), F.when(odd, F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("member1"))
    v3 = F.struct("event_id", "event_type", F.round("value", 2).alias("value"), members.alias("user_id"),
                  F.array((F.col("event_id") % 3).cast("int"), F.lit(2)).alias("steps"))
    version = F.when(kind.isin("click", "error"), 21).when(kind == "signup", 23).otherwise(22)
    text = F.when(version == 21, F.to_json(v1)).when(version == 22, F.to_json(v2)).otherwise(F.to_json(v3))
    text = F.when(F.col("event_id") % 50 == 1, F.substring(text, 1, 12)).otherwise(text)
    schema_id = F.when(F.col("event_id") % 50 == 0, 99).otherwise(version)
    header = F.unhex(F.concat(F.lit("00"), F.lpad(F.hex(schema_id), 8, "0")))
    spec = events_topic(spark, sf, F.concat(header, text.cast("binary")), "events-versions")
    registry = registry_table(spark, [("events-versions-value", i, i, text) for i, text in EVENT_VERSIONS.items()] + [("other", 1, 99, "{}")])
    records = read_topic(spark, spec).withColumn("key", F.col("key").cast("string"))
    good, bad = decode_by_writer(records, registry, EVENT_READER, "events-versions-value", ["key"])
    steps = F.aggregate("steps", F.lit(0.0), lambda a, x: a + x)
    out = good.select("key", "schema_id", F.lit(None).cast("string").alias("reason"), "id", "event_type", "value",
                      F.col("user_id.member0").alias("user_long"), F.col("user_id.member1").alias("user_string"), steps.alias("steps_sum"), "source")
    return out.unionByName(bad.select("key", "schema_id", "reason"), allowMissingColumns=True)


SALES_DDL = "event_type string, window_end timestamp_ntz, window_sales double"


@plan("topic_roundtrip_agg", "S4 W2 K8 W1", """
SELECT event_type, time_bucket(INTERVAL '60 seconds', ts) + INTERVAL '60 seconds' AS window_end,
       CAST(sum(CAST(value AS DECIMAL(18,2))) * 0.85 AS DOUBLE) AS window_sales
FROM events GROUP BY 1, 2
""")
def topic_roundtrip_agg(spark, sf):
    source = events_topic(spark, sf, name="sales-in")
    rows = json_topic_table(read_topic(spark, source), EVENTS_DDL, proctime="proctime")
    sales = tb.tumble_sum(rows, "ts", "event_type", "value", "60 seconds", factor="0.85", decimal_scale=2)
    sink = TopicSpec("sales-out", path=scratch_path(spark, "topic-sales-out"))
    write_topic(to_topic(sales, sink.name, json_value(sales), key=F.col("event_type")), sink)
    good, _ = decode_json(read_topic(spark, sink), SALES_DDL, meta=[])
    return good.select("event_type", "window_end", "window_sales")


@plan("payload_as_json", "T2 F11 X1", """
SELECT CAST(event_id AS VARCHAR) AS key, event_id, ts, user_id, event_type, value, CAST(NULL AS VARCHAR) AS props, TRUE AS null_kept FROM events
""")
def payload_as_json(spark, sf):
    """The decoded payload as JSON text, nulls kept, and what its text says."""
    spec = events_topic(spark, sf, name="events-payload")
    good, _ = decode_json(read_topic(spark, spec), EVENTS_DDL)
    good = good.withColumn("props", F.lit(None).cast("string"))
    payload = json_value(good, EVENT_COLS, keep_nulls=True)
    text = good.select("key", payload.alias("payload"))
    back = F.from_json("payload", EVENTS_DDL)
    return text.select("key", back.alias("r"), F.array_contains(F.json_object_keys("payload"), "props").alias("null_kept")).select(
        "key", "r.*", "null_kept")
