import os

import pytest
from pyspark.sql import functions as F

from tidewater import fs
from tidewater.contracts import Check, Column, Contract, ContractError
from tidewater.operators.decode import decode_json, json_topic_table
from tidewater.operators.relational import relationalize
from tidewater.session import scratch_path
from tidewater.sinks.files import write_tables
from tidewater.sinks.tables import TableSpec, hourly_files_stream
from tidewater.sinks.topics import json_value, to_topic, write_topic
from tidewater.sources.files import read_objects, read_positional_csv
from tidewater.sources.topics import TopicSpec, read_topic
from tidewater.streaming.ingest import DISCARD, IngestSpec, run_ingest
from tidewater.streaming.runner import run_available, write_batch
from tidewater.streaming.validate import split_stream, validate_stream
from tidewater.streaming.windows import stream_to_topic, tumble_sum_stream

from tests.conftest import SF_SMALL

DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _topic(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    spec = TopicSpec("events", path=scratch_path(spark, "topic"))
    write_topic(to_topic(ev, "events", json_value(ev), key=F.col("event_id").cast("string")), spec)
    return ev, spec


def _stream(spark, spec):
    good, _ = decode_json(read_topic(spark, spec, stream=True), DDL, meta=[], key_as_string=False)
    return good.drop("key")


def test_inline_stream_validation_equals_batch(spark):
    ev, spec = _topic(spark)
    contract = Contract(columns={"value": Column("float64", Check.le(100.0)),
                                 "event_type": Column("str", Check.isin(["click", "view", "purchase", "signup"]))})
    valid, bad = split_stream(_stream(spark, spec), contract)
    assert valid.isStreaming and bad.isStreaming
    v = run_available(valid)
    q = run_available(bad)
    expect_valid = ev.where("value <= 100 AND event_type <> 'error'")
    assert v.count() == expect_valid.count() and v.exceptAll(expect_valid).count() == 0
    assert q.count() == ev.count() - v.count()
    assert q.where("array_contains(_reasons, 'event_type:isin')").count() == ev.where("event_type = 'error'").count()


def test_stream_pipeline_replay_is_noop(spark):
    ev, source = _topic(spark)
    sink = TopicSpec("out", path=scratch_path(spark, "out"))
    ckpt = scratch_path(spark, "ckpt")
    for _ in range(2):
        agg = tumble_sum_stream(_stream(spark, source), "ts", "event_type", "value", "1 hour", "0.85",
                                delay="10 minutes", decimal_scale=2)
        stream_to_topic(agg, sink, ckpt, key="event_type").awaitTermination()
    out = read_topic(spark, sink)
    assert out.count() == out.select("key", "value").distinct().count() > 0


def test_json_topic_table_proctime(spark):
    _, spec = _topic(spark)
    t = json_topic_table(read_topic(spark, spec), DDL, proctime="proctime")
    assert t.columns[-1] == "proctime" and t.where("proctime IS NULL").count() == 0


def test_hourly_stream_sink(spark):
    ev, spec = _topic(spark)
    path, ckpt = scratch_path(spark, "hourly"), scratch_path(spark, "ckpt")
    hourly_files_stream(_stream(spark, spec), path, "ts", ckpt, available_now=True).awaitTermination()
    hours = [n for n in fs.list_names(spark, path) if n.startswith("hour=")]
    assert len(hours) == ev.select(F.date_format("ts", "yyyy-MM-dd--HH")).distinct().count()
    assert spark.read.schema(DDL).json(path).count() == ev.count()


def test_read_objects_by_file_stem(spark):
    base = scratch_path(spark, "objs").replace("file:", "")
    os.makedirs(base)
    for name, n in (("decision_results", 3), ("applications", 2)):
        with open(f"{base}/{name}.json", "w") as fh:
            fh.write("\n".join(f'{{"id": {i}}}' for i in range(n)))
    counts = {r["object"]: r["count"] for r in read_objects(spark, base, "json", "id long").groupBy("object").count().collect()}
    assert counts == {"decision_results": 3, "applications": 2}


def test_write_tables_csv_and_ddl(spark):
    nested = spark.createDataFrame([(1, [10, 20]), (2, [])], "id long, xs array<int>")
    base = scratch_path(spark, "tables")
    paths = write_tables(relationalize(nested, "id", "obj"), base)
    assert set(paths) == {"obj", "obj_xs"}
    ddl = fs.read_text(spark, f"{base}/DDL_obj_xs.sql")
    assert ddl.startswith('CREATE TABLE IF NOT EXISTS "public"."obj_xs"') and '"xs_index" INTEGER' in ddl
    back = spark.read.option("header", True).schema("id long, xs_index int, xs int").csv(paths["obj_xs"])
    assert sorted(tuple(r) for r in back.collect() if r["xs"] is not None) == [(1, 0, 10), (1, 1, 20)]


def test_positional_csv(spark):
    base = scratch_path(spark, "csv").replace("file:", "")
    os.makedirs(base)
    for i in range(2):
        with open(f"{base}/part{i}.csv", "w") as fh:
            fh.write("h1,h2\n" + f"{i},x{i}\n")
    df = read_positional_csv(spark, [f"{base}/part0.csv", f"{base}/part1.csv"], ["Time", "Line"])
    assert df.columns == ["Time", "Line"] and sorted(r["Line"] for r in df.collect()) == ["x0", "x1"]


def test_ddl_is_replaced_with_its_table(spark):
    base = scratch_path(spark, "tables")
    write_tables({"t": spark.createDataFrame([(1,)], "a int")}, base)
    write_tables({"t": spark.createDataFrame([(1, "x")], "a int, b string")}, base, mode="overwrite")
    assert '"b" VARCHAR' in fs.read_text(spark, f"{base}/DDL_t.sql")


def test_a_new_checkpoint_adds_to_old_output(spark):
    """Both runs' valid and quarantined rows stay; a unique key accepted before is refused in the second run."""
    contract = Contract(columns={"event_id": Column("int64", unique=True), "value": Column("float64", Check.le(100.0))})
    ev, spec = _topic(spark)
    valid, bad = scratch_path(spark, "valid"), scratch_path(spark, "bad")
    for run in (1, 2):
        validate_stream(_stream(spark, spec), contract, valid, bad, scratch_path(spark, "ckpt")).awaitTermination()
        good, n = spark.read.parquet(valid), ev.where("value <= 100").count()
        assert good.count() == good.select("event_id").distinct().count() == n
        assert spark.read.parquet(bad).count() == run * (ev.count() - n) + (run - 1) * n


def test_a_replayed_batch_replaces_itself(spark):
    path = scratch_path(spark, "out")
    for n in (5, 3):
        write_batch(spark.range(n), path, "q", 0)
    write_batch(spark.range(2), path, "other", 0)
    assert spark.read.parquet(path).count() == 5


def test_aggregate_checks_are_refused_on_streams(spark):
    _, spec = _topic(spark)
    whole = Contract(columns={"event_type": Column("str", Check.unique_values_eq(["click"]))})
    unique = Contract(columns={"event_id": Column("int64", unique=True)})
    paths = [scratch_path(spark, n) for n in "vqc"]
    with pytest.raises(ContractError, match="aggregate"):
        validate_stream(_stream(spark, spec), whole, *paths)
    for c in (whole, unique):
        with pytest.raises(ContractError, match="inline"):
            split_stream(_stream(spark, spec), c)


def _spec(spark, source, **kw):
    return IngestSpec(**{"source": source, "target": TableSpec("t", scratch_path(spark, "table")), "schema": DDL,
                         "checkpoint": scratch_path(spark, "ckpt"), "dead_letter_path": DISCARD, **kw})


def test_ingest_discards_nothing_unsaid(spark):
    contract = Contract(columns={"value": Column("float64", Check.le(100.0))})
    whole = Contract(columns={"value": Column("float64", Check.custom(lambda c: F.max(c) < 9, "top", aggregate=True))})
    source = TopicSpec("t", path="/nowhere")
    for kw, error in (({"dead_letter_path": ""}, ValueError), ({"contract": contract}, ValueError),
                      ({"contract": whole, "quarantine_path": DISCARD}, ContractError), ({"operation": "upsert"}, ValueError),
                      ({"operation": "odd"}, ValueError)):
        with pytest.raises(error):
            run_ingest(spark, _spec(spark, source, **kw))


def test_ingest_decodes_once_and_keeps_all(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    source = TopicSpec("events", path=scratch_path(spark, "topic"))
    value = F.when(F.col("event_id") % 10 == 0, F.lit("{cut")).otherwise(json_value(ev))
    write_topic(to_topic(ev, "events", value, key=F.col("event_id").cast("string")), source)
    bad, dead = scratch_path(spark, "bad"), scratch_path(spark, "dead")
    spec = _spec(spark, source, dead_letter_path=dead, quarantine_path=bad,
                 contract=Contract(columns={"value": Column("float64", Check.le(100.0))}))
    for _ in range(2):  # the second run finds nothing new
        run_ingest(spark, spec).awaitTermination()
    counts = [spark.read.parquet(p).count() for p in (spec.target.path, bad, dead)]
    want = [ev.where(c).count() for c in ("event_id % 10 <> 0 and value <= 100", "event_id % 10 <> 0 and value > 100", "event_id % 10 = 0")]
    assert counts == want


def test_run_available_has_no_time_limit_unless_given(spark):
    import inspect
    assert inspect.signature(run_available).parameters["timeout_s"].default is None
