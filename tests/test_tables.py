import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.operators.decode import decode_json
from tidewater.session import scratch_path
from tidewater.sinks.tables import (TableSpec, append_stream, check_checkpoint, latest_stream, merge, newest_per_key,
                                    read_topic_table)
from tidewater.sinks.topics import json_value, to_topic, write_topic
from tidewater.sources.topics import TopicSpec, read_topic
from tidewater.streaming.runner import run_available
from tidewater.streaming.windows import tumble_sum_stream
from tidewater.operators import timebuckets as tb

from tests.conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1)


def people(spark, rows):
    return spark.createDataFrame(rows, "uuid string, first_name string, city string, state string, v int")


def cities(df):
    return {r["uuid"]: r["city"] for r in df.collect()}


def test_newest_per_key_and_replay(spark):
    first = newest_per_key(people(spark, [("a", "Ada", "Miami", "FL", 1), ("b", "Ben", "Reno", "NV", 1),
                                          ("a", "Ada", "Tampa", "FL", 2)]), None, ["uuid"], ["v"])
    assert cities(first) == {"a": "Tampa", "b": "Reno"}
    # older precombine loses, equal precombine: incoming wins, new key inserted
    batch = people(spark, [("a", "Ada", "Old", "FL", 1), ("b", "Ben", "Salem", "OR", 1), ("c", "Cleo", "Austin", "TX", 0)])
    second = newest_per_key(first, batch, ["uuid"], ["v"])
    assert cities(second) == {"a": "Tampa", "b": "Salem", "c": "Austin"}
    assert cities(newest_per_key(second, batch, ["uuid"], ["v"])) == cities(second)


def test_newest_per_key_keeps_columns_and_null_keys(spark):
    old = spark.createDataFrame([(1, 0, "x"), (2, 0, "y"), (None, 0, "z")], "k long, v int, note string")
    new = spark.createDataFrame([(3, 1, True), (None, 2, False)], "k long, v int, flag boolean")
    got = sorted(map(tuple, newest_per_key(old, new, ["k"], ["v"]).collect()), key=str)
    assert got == sorted([(1, 0, "x", None), (2, 0, "y", None), (3, 1, None, True), (None, 2, None, False)], key=str)


def test_ties_within_a_batch_go_by_source_position(spark):
    rows = spark.createDataFrame([("a", 1, 0, 7, "late"), ("a", 1, 0, 3, "early")], "k string, v int, partition int, offset long, x string")
    assert newest_per_key(rows, None, ["k"], ["v", "partition", "offset"]).first()["x"] == "late"


def test_merge_is_for_lake_formats(spark):
    df = people(spark, [("a", "Ada", "Miami", "FL", 1)])
    with pytest.raises(ValueError, match="keyed merge"):
        merge(df, TableSpec("t", "/t", key=("uuid",), precombine=("v",)))
    with pytest.raises(ValueError, match="precombine"):
        merge(df, TableSpec("t", "/t", "delta", key=("uuid",)))


def test_checkpoint_outside_table():
    with pytest.raises(ValueError):
        check_checkpoint("/t/events", "/t/events/_ckpt")
    check_checkpoint("/t/events", "/t/checkpoints/events")


def _topic_with_events(spark, batches):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    spec = TopicSpec("events", path=scratch_path(spark, "topic"))
    split = F.lit("2024-01-15").cast("timestamp_ntz")
    parts = {0: ev.where(F.col("ts") < split), 1: ev.where(F.col("ts") >= split)}
    for b in batches:
        write_topic(to_topic(parts[b], "events", json_value(parts[b]), key=F.col("event_id").cast("string")), spec)
    return ev, spec


DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def test_latest_stream_over_restarts_equals_batch(spark):
    """Update mode over two loads and an idle run: every key is there, not only those of the last micro-batch."""
    ev, topic = _topic_with_events(spark, [0])
    path, ckpt = scratch_path(spark, "latest"), scratch_path(spark, "ckpt")
    split = F.lit("2024-01-15").cast("timestamp_ntz")
    for late in (False, True, False):
        if late:
            part = ev.where(F.col("ts") >= split)
            write_topic(to_topic(part, "events", json_value(part), key=F.col("event_id").cast("string")), topic)
        good, _ = decode_json(read_topic(spark, topic, stream=True), DDL, meta=[], key_as_string=False)
        out = run_available(latest_stream(good.drop("key"), ["user_id"], ["ts", "event_id"]), path, ckpt,
                            output_mode="update", keys=["user_id"])
    want = newest_per_key(ev, None, ["user_id"], ["ts", "event_id"])
    out = out.select(want.columns)
    assert out.count() == want.count() and out.exceptAll(want).count() == 0
    with pytest.raises(ValueError, match="keys"):
        run_available(good, output_mode="update")


def test_stream_append_twice_on_one_checkpoint(spark):
    ev, topic = _topic_with_events(spark, [0, 1])
    spec = TableSpec("events", scratch_path(spark, "events"))
    ckpt = scratch_path(spark, "ckpt")
    for _ in range(2):
        good, _ = decode_json(read_topic(spark, topic, stream=True), DDL, meta=[], key_as_string=False)
        good = good.drop("key")
        append_stream(good, spec, ckpt).awaitTermination()
    out = spark.read.parquet(spec.path)
    assert out.count() == ev.count() and out.exceptAll(ev).count() == 0


def test_stream_tumble_equals_batch_on_closed_windows(spark):
    ev, topic = _topic_with_events(spark, [0, 1])
    good, _ = decode_json(read_topic(spark, topic, stream=True), DDL, meta=[], key_as_string=False)
    good = good.drop("key")
    streamed = run_available(tumble_sum_stream(good, "ts", "event_type", "value", "1 hour", "0.85",
                                               delay="10 minutes", decimal_scale=2))
    batch = tb.tumble_sum(ev, "ts", "event_type", "value", "1 hour", "0.85", decimal_scale=2)
    cutoff = ev.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=10)
    closed = batch.where(F.col("window_end") <= F.lit(cutoff))
    assert streamed.exceptAll(closed).count() == 0 and closed.exceptAll(streamed).count() == 0


def test_read_topic_table_registers_view(spark):
    base = scratch_path(spark, "lake")
    spark.range(3).write.parquet(f"{base}/pageviews_avro")
    read_topic_table(spark, base, "pageviews-avro")
    assert spark.sql("SELECT count(*) FROM pageviews_avro").first()[0] == 3


def test_stream_bursts_equal_batch_on_closed_buckets(spark):
    from tidewater.streaming.windows import bursts_stream
    ev, topic = _topic_with_events(spark, [0, 1])
    good, _ = decode_json(read_topic(spark, topic, stream=True), DDL, meta=[], key_as_string=False)
    streamed = run_available(bursts_stream(good.drop("key"), "user_id", "ts", "1 hour", 2))
    batch = tb.bursts(ev, "user_id", "ts", "1 hour", 2, sort=False)
    cutoff = ev.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=10)
    closed = batch.where(F.col("bucket_start") + F.expr("INTERVAL 1 HOUR") <= F.lit(cutoff))
    assert streamed.count() > 0
    assert streamed.exceptAll(closed).count() == 0 and closed.exceptAll(streamed).count() == 0


def test_processing_time_tumble_in_complete_mode(spark):
    """Processing time is fixed per micro-batch: one batch lands in one window per key."""
    ev, topic = _topic_with_events(spark, [0, 1])
    good, _ = decode_json(read_topic(spark, topic, stream=True), DDL, meta=[], key_as_string=False)
    agg = tumble_sum_stream(good.drop("key"), None, "event_type", "value", "60 seconds", "0.85",
                            decimal_scale=2)
    out = run_available(agg, output_mode="complete").groupBy("event_type").agg(F.sum("window_sales").alias("s"))
    want = tb.tumble_sum(ev.withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz")), "ts", "event_type",
                         "value", "1 day", "0.85", decimal_scale=2)
    got = {r["event_type"]: round(r["s"], 4) for r in out.collect()}
    assert got == {r["event_type"]: round(r["window_sales"], 4) for r in want.collect()}
