import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidewater.operators.avro import decode_avro, encode_avro
from tidewater.operators.decode import (conform, conform_json, decode_json, json_topic_table, split_wire,
                                        with_wire_header)
from tidewater.plans.avro_fixtures import PAGEVIEWS_SCHEMA
from tidewater.session import scratch_path
from tidewater.sinks.topics import json_value, to_topic, write_topic
from tidewater.sources.registry import latest_schema, latest_schemas, registry_table, with_schema
from tidewater.sources.topics import TOPIC_SCHEMA, TopicSpec, read_topic

from tests.conftest import SF_SMALL


def events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


def test_topic_records(spark):
    ev = events(spark)
    recs = to_topic(ev, "t", json_value(ev), key=F.col("event_id").cast("string"))
    assert recs.schema.simpleString() == TOPIC_SCHEMA.simpleString()
    rows = recs.select("partition", "offset").distinct().collect()
    assert {r["partition"] for r in rows} == {0, 1, 2} and {r["offset"] for r in rows} == {None}
    own = to_topic(ev, "t", json_value(ev), partition=F.col("event_id") % 4, offset=F.col("event_id"))
    assert own.select("partition", "offset").distinct().count() == ev.count()


def test_topic_files_append(spark):
    ev = events(spark)
    spec = TopicSpec("t", path=scratch_path(spark, "topic"))
    recs = to_topic(ev, "t", json_value(ev), key=F.col("event_id").cast("string"), offset=F.col("event_id"))
    write_topic(recs, spec)
    write_topic(recs.where("offset < 10"), spec)
    topic = read_topic(spark, spec)
    assert topic.count() == ev.count() + 10 and topic.schema == TOPIC_SCHEMA


def test_json_dead_letters(spark):
    df = spark.createDataFrame([(b'{"a": 1, "b": "x"}',), (b'{"a": 2}',), (b"{bad",), (None,)], "value binary")
    good, bad = decode_json(df, "a int, b string", required=["b"], meta=[], key_as_string=False)
    assert [r.asDict() for r in good.collect()] == [{"a": 1, "b": "x"}]
    assert sorted(r["reason"] for r in bad.collect()) == ["malformed", "missing:b", "null value"]


def test_payload_fields_named_like_source_columns(spark):
    row = (b"k", b'{"key": "own", "offset": 5, "a": 1}', 2, 77)
    df = spark.createDataFrame([row], "key binary, value binary, partition int, offset bigint")
    good, bad = decode_json(df, "key string, offset int, a int")
    assert good.columns == ["_topic_key", "partition", "_topic_offset", "key", "offset", "a"]
    assert tuple(good.first()) == ("k", 2, 77, "own", 5, 1) and bad.count() == 0


def test_wire_json_headers(spark):
    body = b'{"a": 1}'
    rows = [(b"\0\0\0\0\7" + body,), (b"\1\0\0\0\7" + body,), (b"\0\0\0\0\x08" + body,), (b"\0\0\0",), (None,),
            (b"\0\0\0\0\7{bad",), (b"\0\0\0\0\7",)]
    df = spark.createDataFrame(rows, "value binary")
    reg = registry_table(spark, [("s", 1, 7, "{}"), ("s", 2, 7, "{}")])
    good, bad = decode_json(df, "a int", meta=[], wire=True, registry=reg)
    assert [r.a for r in good.collect()] == [1]
    assert sorted(r.reason for r in bad.collect()) == ["header", "header", "malformed", "malformed", "null value",
                                                      "unknown schema id"]
    good, bad = decode_json(df, "a int", meta=[], wire=True)
    assert good.count() == 2 and bad.count() == 5


def test_json_topic_table_fails_or_discards(spark):
    df = spark.createDataFrame([(b'{"a": 1}',), (b"{bad",)], "value binary")
    assert json_topic_table(df, "a int", on_bad="discard").count() == 1
    with pytest.raises(Exception, match="malformed record"):
        json_topic_table(df, "a int").collect()
    assert json_topic_table(df.limit(1), "a int", proctime="p").columns == ["a", "p"]


def test_conform_json_defaults_vs_explicit_null(spark):
    df = spark.createDataFrame([('{"v": 1}',), ('{"v": 2, "address": null}',), ('{"v": 3, "address": "A"}',),
                                ('{"v": 4',), ("[4]",), (None,)], ["j"])
    good, bad = conform_json(df, "j", "v long, address string, added_column2 int", {"address": "null", "added_column2": 42})
    assert [tuple(r) for r in good.collect()] == [(1, "null", 42), (2, None, 42), (3, "A", 42)]
    assert sorted(str(r.j) for r in bad.collect()) == ["None", "[4]", '{"v": 4']


def test_conform_json_key_with_separators(spark):
    df = spark.createDataFrame([('{"a.b": 1, "it\'s": 2}',)], ["j"])
    good, _ = conform_json(df, "j", "`a.b` int, `it's` int, c int", {"c": 9})
    assert tuple(good.first()) == (1, 2, 9)


def test_conform_typed_frame(spark):
    df = spark.createDataFrame([(1, "x", "drop me")], ["viewtime", "userid", "column"])
    out = conform(df, "viewtime long, userid string, added_column2 int", {"added_column2": 42})
    assert out.columns == ["viewtime", "userid", "added_column2"] and out.first()["added_column2"] == 42


def test_wire_header(spark):
    df = spark.createDataFrame([(b"body",)], "b binary").select(with_wire_header(F.col("b"), 260).alias("value"))
    row = split_wire(df).first()
    assert (row["magic_ok"], row["schema_id"], bytes(row["body"])) == (True, 260, b"body")


def test_registry_latest_and_by_id(spark):
    reg = registry_table(spark, [("pageviews-avro-value", 1, 4, "{}"), ("pageviews-avro-value", 2, 5, '{"v":2}'),
                                 ("other-value", 1, 9, "{}")])
    assert latest_schema(reg, "pageviews-avro-value") == (5, '{"v":2}')
    assert {r["subject"]: r["version"] for r in latest_schemas(reg).collect()} == {"pageviews-avro-value": 2,
                                                                                  "other-value": 1}
    df = spark.createDataFrame([(b"\0\0\0\0\4x",), (b"\0\0\0\0\x09x",), (b"\1\0\0\0\4x",), (b"",)], "value binary")
    got = [(r["schema_id"], r["schema"]) for r in with_schema(df, reg, "pageviews-avro-value").collect()]
    assert sorted(got, key=str) == sorted([(4, "{}"), (9, None), (None, None), (None, None)], key=str)


def test_avro_needs_its_package(spark):
    """Without spark-avro the pass-through fails with Spark's own message; it never falls back to something else."""
    rows = spark.createDataFrame([(1, "u", "p")], "viewtime long, userid string, pageid string")
    with pytest.raises(AnalysisException, match="AVRO"):
        encode_avro(rows, PAGEVIEWS_SCHEMA, schema_id=4).collect()
    with pytest.raises(AnalysisException, match="AVRO"):
        decode_avro(spark.createDataFrame([(b"x",)], "value binary"), PAGEVIEWS_SCHEMA)[0].collect()


def test_kafka_options_mapping():
    from tidewater.sources.topics import _kafka_options
    spec = TopicSpec("pageviews-avro", bootstrap_servers="localhost:9092", max_per_trigger=20,
                     group_id_prefix="ingest", options={"failOnDataLoss": "false"})
    assert _kafka_options(spec) == {
        "kafka.bootstrap.servers": "localhost:9092", "subscribe": "pageviews-avro", "startingOffsets": "earliest",
        "includeHeaders": "true", "maxOffsetsPerTrigger": "20", "groupIdPrefix": "ingest",
        "kafka.isolation.level": "read_committed", "failOnDataLoss": "false"}


def test_missing_kafka_connector_is_explained(spark):
    with pytest.raises(RuntimeError, match="file-backed"):
        read_topic(spark, TopicSpec("t", bootstrap_servers="localhost:9092"))
