import json

import pytest
from pyspark.sql import functions as F

from tidewater.functions.avro_types import record_schema
from tidewater.operators.resolution import MOST_IDS, ResolutionError, decode_by_writer, loose, resolved_row, subject_schemas
from tidewater.session import scratch_path
from tidewater.sources.registry import registry_table
from tidewater.streaming.runner import run_available


def rec(*fields, name="r", **extra):
    return {"type": "record", "name": name, "fields": [{"name": n, "type": t, **(x[0] if x else {})} for n, t, *x in fields], **extra}


def read(spark, writer, reader, *rows):
    """[(reader's field values, has one)] of rows written as JSON in the writer's Spark type."""
    df = spark.createDataFrame([(json.dumps(r),) for r in rows], "t string").select(F.from_json("t", loose(record_schema(writer))).alias("w"))
    value, ok = resolved_row(json.dumps(writer), reader, F.col("w"))
    out = df.select(value.cast(loose(record_schema(reader))).alias("r"), (F.lit(True) if ok is None else F.coalesce(ok, F.lit(False))).alias("ok"))
    return [(r.r.asDict(recursive=True) if r.r else None, r.ok) for r in out.collect()]


@pytest.mark.parametrize("w,r,value,want", [
    ("int", "long", 3, 3), ("int", "float", 3, 3.0), ("int", "double", 3, 3.0), ("long", "float", 3, 3.0), ("long", "double", 3, 3.0),
    ("float", "double", 0.5, 0.5), ("string", "bytes", "é", "é".encode()), ("boolean", "boolean", True, True),
    ("int", ["null", "long"], 3, 3), ("int", ["string", "double"], 3, {"member0": None, "member1": 3.0}),
    ("string", ["double", "string"], "x", {"member0": None, "member1": "x"}), ("int", ["double", "int"], 3, {"member0": None, "member1": 3}),
    ({"type": "array", "items": "int"}, {"type": "array", "items": ["null", "double"]}, [1, 2], [1.0, 2.0]),
    ({"type": "map", "values": "int"}, {"type": "map", "values": "long"}, {"k": 1}, {"k": 1}),
    (["int", "long"], "double", 5, 5.0), (["null", "int"], ["null", "string", "long"], 5, {"member0": None, "member1": 5}),
    (["null", "int", "string"], ["null", "string", "long"], {"member0": 5}, {"member0": None, "member1": 5}),
    (["null", "int", "string"], ["null", "string", "long"], {"member1": "s"}, {"member0": "s", "member1": None}),
    (["null", "int", "string"], ["null", "string", "long"], None, None),
    ({"type": "enum", "name": "e", "symbols": ["A", "B"]}, {"type": "enum", "name": "e", "symbols": ["A"], "default": "A"}, "B", "A"),
    (rec(("x", "int"), name="a.p"), rec(("x", "long"), ("y", "string", {"default": "z"}), name="b.q", aliases=["p"]), {"x": 1}, {"x": 1, "y": "z"}),
])
def test_values(spark, w, r, value, want):
    assert read(spark, rec(("f", w)), rec(("f", r)), {"f": value}) == [({"f": want}, True)]


@pytest.mark.parametrize("r,default,want", [
    ("int", 42, 42), ("string", "null", "null"), (["null", "int"], None, None), (["int", "null"], 7, 7), ("bytes", "ÿ", b"\xff"),
    ({"type": "array", "items": "string"}, ["a"], ["a"]), ({"type": "array", "items": "string"}, [], []), ({"type": "map", "values": "int"}, {}, {}),
    ({"type": "map", "values": "int"}, {"a": 1}, {"a": 1}), (["string", "int"], "d", {"member0": "d", "member1": None}),
    (rec(("x", "int"), ("y", "string", {"default": "k"}), name="n"), {"x": 1}, {"x": 1, "y": "k"})])
def test_defaults(spark, r, default, want):
    assert read(spark, rec(("a", "int")), rec(("f", r, {"default": default})), {"a": 1}) == [({"f": want}, True)]


def test_aliases_order_and_extra_fields(spark):
    writer, reader = rec(("c", "string"), ("a", "int"), ("b", "int")), rec(("b2", "long", {"aliases": ["gone", "b"]}), ("a", "int"))
    assert read(spark, writer, reader, {"a": 1, "b": 2, "c": "x"}) == [({"b2": 2, "a": 1}, True)]


@pytest.mark.parametrize("w,r", [
    ("string", "int"), ("double", "float"), ("long", "int"), ("int", ["null", "string"]), (["int", "string"], "boolean"),
    ({"type": "fixed", "name": "x", "size": 4}, {"type": "fixed", "name": "x", "size": 8}), (rec(("x", "int"), name="p"), rec(("x", "int"), name="q")),
    ({"type": "array", "items": "string"}, {"type": "array", "items": "int"}), ({"type": "long", "logicalType": "timestamp-micros"}, "double"), ("null", "int")])
def test_what_no_value_can_be_read_as(w, r):
    with pytest.raises(ResolutionError):
        resolved_row(rec(("f", w)), rec(("f", r)), F.lit(None))


def test_field_without_default_is_refused():
    with pytest.raises(ResolutionError, match="inner.y"):
        resolved_row(rec(("inner", rec(("x", "int"), name="n"))), rec(("inner", rec(("y", "int"), name="n"))), F.lit(None))


@pytest.mark.parametrize("w,r,value", [
    (["null", "int"], "int", None), (["null", "int", "string"], ["null", "int"], {"member1": "x"}), ({"type": "array", "items": ["null", "int"]},
     {"type": "array", "items": "int"}, [1, None]), ({"type": "map", "values": ["int", "string"]}, {"type": "map", "values": "long"}, {"k": {"member1": "x"}}),
    ({"type": "enum", "name": "e", "symbols": ["A", "B"]}, {"type": "enum", "name": "e", "symbols": ["A"]}, "B")])
def test_values_beyond_the_reader_are_marked(spark, w, r, value):
    (_, ok), = read(spark, rec(("f", w)), rec(("f", r)), {"f": value})
    assert not ok


@pytest.fixture(scope="module")
def topic(spark):
    v1, v2, dead = rec(("id", "int"), ("name", "string")), rec(("id", "long"), ("name", ["null", "string"]), ("tags", {"type": "array", "items": "string"})), \
        rec(("other", "int"))
    rows = [(1, '{"id": 1, "name": "a"}'), (2, '{"id": 5000000000, "name": "b", "tags": ["x"]}'), (1, '{"id": 3, "na'), (1, '{"name": "c"}'),
            (9, '{"id": 4}'), (2, '{"id": 6, "name": null, "tags": []}'), (3, '{"other": 1}'), (1, None), (0, "raw")]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, schema int, body string")
    framed = F.concat(F.unhex(F.format_string("00%08x", "schema")), F.col("body").cast("binary"))
    value = F.when(F.col("schema") == 0, F.unhex(F.lit("01000000017b7d"))).otherwise(framed)
    registry = registry_table(spark, [("t", i, i, json.dumps(s)) for i, s in ((1, v1), (2, v2), (3, dead))] + [("u", 1, 9, json.dumps(v1))])
    return df.select("k", value.alias("value")), registry


READER = rec(("id", "long"), ("name", "string"), ("tags", {"type": "array", "items": "string"}, {"default": ["none"]}))
GOOD = {0: (1, 1, "a", ["none"]), 1: (2, 5000000000, "b", ["x"])}
BAD = {2: "malformed", 3: "missing:id", 4: "unknown schema id", 5: "value", 7: "null value", 8: "header"}


def outcome(good, bad):
    reasons = {r.k: r.reason for r in bad.collect()}
    assert reasons.pop(6) == "id: the writer lacks it and it has no default"
    return {r.k: tuple(r)[1:] for r in good.collect()}, reasons


def test_records_are_routed_by_id(topic):
    records, registry = topic
    assert outcome(*decode_by_writer(records, registry, READER, "t", ["k"])) == (GOOD, BAD)


def test_routing_on_a_stream(spark, topic):
    records, registry = topic
    path = scratch_path(spark, "records")
    records.write.parquet(path)
    good, bad = decode_by_writer(spark.readStream.schema(records.schema).parquet(path), registry, json.dumps(READER), "t", ["k"])
    assert outcome(run_available(good), run_available(bad)) == (GOOD, BAD)


def test_each_body_is_parsed_once(topic):
    """One projection per schema id over one scan: no join and no second parse of a body."""
    records, registry = topic
    plan = decode_by_writer(records, registry, READER, "t", ["k"])[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("from_json") == 2


def test_no_schema_and_too_many(spark, topic):
    records, registry = topic
    good, bad = decode_by_writer(records, registry.where("false"), READER, "t", ["k"])
    assert good.count() == 0 and bad.where("reason = 'unknown schema id'").count() == 7
    with pytest.raises(ValueError, match="more than"):
        subject_schemas(spark.range(MOST_IDS + 1).selectExpr("'t' AS subject", "1 AS version", "cast(id as int) AS id", "cast(id as string) AS schema"))
    with pytest.raises(ValueError, match="two schemas"):
        subject_schemas(registry_table(spark, [("t", 1, 1, "{}"), ("t", 2, 1, "[]")]))


def test_empty_topic(spark, topic):
    records, registry = topic
    good, bad = decode_by_writer(records.limit(0), registry, READER, "t", ["k"])
    assert good.collect() == bad.collect() == []
