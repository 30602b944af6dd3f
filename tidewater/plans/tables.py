"""Lake-table and streaming plans: upserts, appends, partitioned and hourly writes,
stream aggregates and stream validation, all read back from what was committed."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.contracts import Check, Column, Contract, guarded_write
from tidewater.plans.registry import plan, table
from tidewater.plans.topics import EVENT_COLS, EVENTS_DDL, SOURCE_SQL, event_records
from tidewater.session import scratch_path
from tidewater.sinks.rolling import folder_files, roll_hours
from tidewater.sinks.tables import TableSpec, append_stream, hourly_files, hourly_files_stream, latest_stream, newest_per_key
from tidewater.sinks.topics import JSON_OPTIONS, json_value, write_topic
from tidewater.sources.topics import TopicSpec, read_topic
from tidewater.operators.decode import decode_json
from tidewater.streaming.ingest import DISCARD, IngestSpec, run_ingest
from tidewater.streaming.clock import clock_windows, settled
from tidewater.streaming.runner import at_rest, input_read, query_id, run_available, run_until_rest, write_batch
from tidewater.streaming.validate import report_stream, reports, validate_stream as run_validate_stream
from tidewater.streaming.windows import tumble_sum_stream as tumble_stream

SPLIT_TS = "2024-01-15 00:00:00"


def _publish_events(spark, sf, spec, early: bool | None = None):
    """All events, or those before / from SPLIT_TS on, appended to the topic."""
    ev = table(spark, sf, "events")
    if early is not None:
        cond = F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz")
        ev = ev.where(cond if early else ~cond)
    write_topic(event_records(ev, spec.name), spec)


def _events_stream(spark, spec):
    good, _ = decode_json(read_topic(spark, spec, stream=True), EVENTS_DDL, required=["event_id"], meta=[])
    return good.select(*EVENT_COLS)


@plan("upsert_orders", "K3 S6", """
WITH u AS (
  SELECT *, 0 AS b FROM orders
  UNION ALL SELECT o_orderkey, o_custkey, 'F', o_totalprice + 1.0, o_orderdate + INTERVAL 1 DAY, o_orderpriority, 1
            FROM orders WHERE o_orderstatus = 'O'
  UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, 0.0, o_orderdate - INTERVAL 1 DAY, o_orderpriority, 1
            FROM orders WHERE o_orderstatus = 'P'
  UNION ALL SELECT o_orderkey + 1000000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, 1
            FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC, b DESC) AS rn FROM u)
WHERE rn = 1
""")
def upsert_orders(spark, sf):
    """Orders merged with a batch of newer rows, older rows and new keys."""
    orders = table(spark, sf, "orders")
    day = F.expr("INTERVAL 1 DAY")
    newer = (orders.where(F.col("o_orderstatus") == "O")
             .withColumns({"o_orderstatus": F.lit("F"), "o_totalprice": F.col("o_totalprice") + 1.0,
                           "o_orderdate": F.col("o_orderdate") + day}))
    older = (orders.where(F.col("o_orderstatus") == "P")
             .withColumns({"o_totalprice": F.lit(0.0), "o_orderdate": F.col("o_orderdate") - day}))
    inserts = orders.where(F.col("o_orderpriority") == "1-URGENT").withColumn(
        "o_orderkey", F.col("o_orderkey") + 1000000000)
    batch = newer.unionByName(older).unionByName(inserts)
    once = newest_per_key(orders, batch, ["o_orderkey"], ["o_orderdate"])
    return newest_per_key(once, newer, ["o_orderkey"], ["o_orderdate"])  # a replayed batch changes nothing


@plan("newest_per_key_orders", "K3 K2", """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, note FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, side DESC, o_orderkey DESC) AS rn FROM (
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, NULL AS note, 0 AS side FROM orders
    UNION ALL SELECT o_custkey, o_orderkey, o_orderdate, NULL, 'batch', 1 FROM orders WHERE o_orderpriority = '1-URGENT'))
WHERE rn = 1
""")
def newest_per_key_orders(spark, sf):
    """Newest order per customer; the batch has a column more and one less, and its rows win ties of the date."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    batch = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(
        "o_custkey", "o_orderkey", "o_orderdate", F.lit("batch").alias("note"))
    # rows of one side can tie on the date too, so each side is brought to one row per customer by date and key
    sides = [newest_per_key(d, None, ["o_custkey"], ["o_orderdate", "o_orderkey"]) for d in (orders, batch)]
    return newest_per_key(*sides, ["o_custkey"], ["o_orderdate"])


@plan("upsert_events_latest", "K2 K5 K6 S1", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1
""")
def upsert_events_latest(spark, sf):
    """Newest event per user, kept by a stream over two loads on one checkpoint (update mode: changed users only)."""
    topic = TopicSpec("events", path=scratch_path(spark, "topic-events"))
    path, ckpt = scratch_path(spark, "events-latest"), scratch_path(spark, "ckpt-latest")
    for early in (True, False):
        _publish_events(spark, sf, topic, early)
        latest = latest_stream(_events_stream(spark, topic), ["user_id"], ["ts", "event_id"])
        out = run_available(latest, path, ckpt, output_mode="update", keys=["user_id"])
    return out.select(*EVENT_COLS)


@plan("append_topic", "K1 K5 K6 W5", """
SELECT event_id, ts, user_id, event_type, value, props FROM events
""")
def append_topic(spark, sf):
    topic = TopicSpec("events", path=scratch_path(spark, "topic-events"), max_per_trigger=4)
    spec = TableSpec("events", scratch_path(spark, "events-append"))
    ckpt = scratch_path(spark, "ckpt-append")
    for early in (True, False, None):  # last run: nothing new
        if early is not None:
            _publish_events(spark, sf, topic, early)
        append_stream(_events_stream(spark, topic), spec, ckpt).awaitTermination()
    return spark.read.parquet(spec.path)


@plan("rate_limited_topic", "S2 K6", """
SELECT 4 AS batches, count(*) AS events FROM events
""")
def rate_limited_topic(spark, sf):
    """A topic of four files read one file per trigger: four micro-batches, whatever the rows."""
    topic = TopicSpec("events", path=scratch_path(spark, "topic-rate"), max_per_trigger=1)
    write_topic(event_records(table(spark, sf, "events"), topic.name).repartition(4), topic)
    path, ckpt = scratch_path(spark, "rate-out"), scratch_path(spark, "ckpt-rate")

    def each(batch, batch_id):
        write_batch(batch, path, query_id(spark, ckpt), batch_id)

    _events_stream(spark, topic).writeStream.option("checkpointLocation", ckpt).foreachBatch(each).trigger(
        availableNow=True).start().awaitTermination()
    back = spark.read.parquet(path)
    return back.agg(F.count_distinct("batch_id").cast("int").alias("batches"), F.count(F.lit(1)).alias("events"))


@plan("partitioned_customers", "K4 S6 C1", """
SELECT * FROM customer
""")
def partitioned_customers(spark, sf):
    path = scratch_path(spark, "customer-by-segment")
    table(spark, sf, "customer").write.partitionBy("c_mktsegment").parquet(path)
    return spark.read.parquet(path)


@plan("ingest_job", "K7 W4 S1 T9", f"""
SELECT CAST(event_id AS VARCHAR) AS key, {SOURCE_SQL}, ts AS topic_timestamp, event_id, ts, user_id, event_type, value, props
FROM events
""")
def ingest_job(spark, sf):
    """Two loads ingested by the configured job, the second one on a new checkpoint that adds to the table."""
    topics = [TopicSpec(f"pageviews-json-{i}", path=scratch_path(spark, "topic-ingest")) for i in (0, 1)]
    target = TableSpec("pageviews_json", scratch_path(spark, "ingest-table"))
    for topic, early in zip(topics, (True, False)):
        _publish_events(spark, sf, topic, early)
        run_ingest(spark, IngestSpec(source=topic, target=target, checkpoint=scratch_path(spark, "ckpt-ingest"), schema=EVENTS_DDL,
                                     dead_letter_path=DISCARD, required=("event_id",))).awaitTermination()
    return spark.read.parquet(target.path).select(
        "key", "partition", "offset", F.col("_topic_timestamp").cast("timestamp_ntz").alias("topic_timestamp"), *EVENT_COLS)


@plan("hourly_files", "K11 K13", """
SELECT strftime(ts, '%Y-%m-%d--%H') AS hour, event_id, ts, user_id, event_type, value, props FROM events
""")
def hourly_files_plan(spark, sf):
    path = scratch_path(spark, "hourly")
    hourly_files(table(spark, sf, "events"), path, "ts", max_records_per_file=10000)
    return spark.read.schema(EVENTS_DDL + ", hour string").options(**JSON_OPTIONS).json(path)


@plan("rolled_hours", "K11 K13 W5", """
WITH e AS (SELECT *, CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-05 07:00:00' + INTERVAL (event_id % 3600) SECOND ELSE ts END AS moved FROM events)
SELECT strftime(moved, '%Y-%m-%d--%H') AS hour, count(*) AS "rows", CAST(sum(event_id) AS BIGINT) AS ids, TRUE AS files_fit, TRUE AS as_few_as_fit
FROM e GROUP BY 1
""")
def rolled_hours(spark, sf):
    """Three triggers' small files per hour, rolled into files of 64 KiB; one hour holds a third of all events."""
    topic = TopicSpec("events", path=scratch_path(spark, "topic-events"))
    landing, out, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "rolled"), scratch_path(spark, "ckpt-landing")
    hot = F.timestamp_add("SECOND", F.col("event_id") % 3600, F.lit("2024-01-05 07:00:00").cast("timestamp_ntz"))
    ev = table(spark, sf, "events").withColumn("ts", F.when(F.col("event_id") % 3 == 0, hot).otherwise(F.col("ts")))
    tasks = 2 * spark.sparkContext.defaultParallelism  # by time: an hour is one or two tasks', the hot one many's
    for load in range(3):
        write_topic(event_records(ev.where(F.expr("event_id % 9 div 3") == load), topic.name), topic)
        hourly_files_stream(_events_stream(spark, topic).repartitionByRange(tasks, "ts"), landing, "ts", ckpt, available_now=True).awaitTermination()
    target = 64 << 10
    roll_hours(spark, landing, out, "ts", EVENTS_DDL, idle_s=0.0, target_bytes=target)
    rows = spark.read.schema(f"{EVENTS_DDL}, hour string, part int").options(**JSON_OPTIONS).json(out)
    rows = rows.groupBy("hour").agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids"))
    files = folder_files(spark, out).where("path LIKE '%/part=%'").groupBy("hour").agg(
        F.max("bytes").alias("most"), F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("files"))
    longest = 1024  # bytes, more than any event's line
    return rows.join(files, "hour").select("hour", "rows", "ids", (F.col("most") <= target + longest).alias("files_fit"),
                                           (F.col("files") <= F.ceil(F.col("bytes") / target)).alias("as_few_as_fit"))


ORDERS_WRITE_CONTRACT = Contract(name="orders_out", columns={
    "o_orderkey": Column("int64", Check.ge(0), unique=True),
    "o_totalprice": Column("float64", Check.gt(0.0)),
    "o_orderstatus": Column("str", Check.isin(["F", "O", "P"])),
    "o_orderdate": Column("datetime64[ns]", Check.ge("1990-01-01 00:00:00")),
})


@plan("guarded_write", "K14 V1", """
SELECT * FROM orders
""")
def guarded_write_plan(spark, sf):
    """Single-pass guarded write: checks observed while staging, then published."""
    path = scratch_path(spark, "orders-guarded")
    guarded_write(table(spark, sf, "orders"), ORDERS_WRITE_CONTRACT, path)
    return spark.read.parquet(path)


@plan("tumble_sum_stream", "W1 W3 A7 F9", """
SELECT event_type, time_bucket(INTERVAL '60 seconds', ts) + INTERVAL '60 seconds' AS window_end,
       CAST(sum(CAST(value AS DECIMAL(18,2))) * 0.85 AS DOUBLE) AS window_sales
FROM events GROUP BY 1, 2
HAVING time_bucket(INTERVAL '60 seconds', ts) + INTERVAL '60 seconds'
       <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTES
""")
def tumble_sum_stream(spark, sf):
    topic = TopicSpec("events", path=scratch_path(spark, "topic-events"))
    _publish_events(spark, sf, topic)
    sales = tumble_stream(_events_stream(spark, topic), "ts", "event_type", "value", "60 seconds",
                          factor="0.85", delay="10 minutes", decimal_scale=2)
    return run_available(sales)


@plan("tumble_clock_stream", "W1 A7 F9 K6", """
SELECT event_type, time_bucket(INTERVAL '60 seconds', ts) + INTERVAL '60 seconds' AS window_end,
       CAST(sum(CAST(value AS DECIMAL(18,2))) * 0.85 AS DOUBLE) AS window_sales
FROM events GROUP BY 1, 2
""")
def tumble_clock_stream(spark, sf):
    """All windows of the event stream, those still open when the input ends too: they close by the clock.

    The query is stopped in the middle of a window and goes on from its checkpoint with the rest of the events.
    """
    topic = TopicSpec("events", path=scratch_path(spark, "topic-events"))
    out, ckpt = scratch_path(spark, "clock"), scratch_path(spark, "ckpt-clock")
    ev, middle = table(spark, sf, "events"), F.col("ts") < F.lit("2024-01-15 00:00:30").cast("timestamp_ntz")
    for load, done in ((ev.where(middle), input_read), (ev.where(~middle), at_rest)):
        write_topic(event_records(load, topic.name), topic)
        windows = clock_windows(_events_stream(spark, topic), "ts", "event_type", "value", "60 seconds", grace_s=4)
        closed = run_until_rest(windows, out, ckpt, done=done)
    return settled(closed, ["event_type"], "0.85")


STREAM_REPORT_CONTRACT = Contract(name="events_report", columns={
    "event_type": Column("str", [Check.unique_values_eq(["click", "error", "purchase", "signup", "view"]),
                                 Check.custom(lambda c: F.avg((c == "error").cast("int")) < 0.1, "few_errors", aggregate=True)]),
    "value": Column("float64", [Check.le(400.0), Check.custom(lambda c: F.max(c) < 1000.0, "max_below_1000", aggregate=True)]),
    "user_id": Column("int64", Check.custom(lambda c: F.count_if(c % 2 == 0) > F.count_if(c % 2 == 1), "mostly_even", aggregate=True)),
})


@plan("stream_report", "V23 V12 V13", """
WITH loads AS (SELECT unnest([1, 2, 3]) AS load, [TIMESTAMP '2024-01-08', TIMESTAMP '2024-01-22', TIMESTAMP '9999-01-01'] AS ends),
seen AS (SELECT load, e.* FROM loads JOIN events e ON e.ts < ends[load])
SELECT CAST(load - 1 AS BIGINT) AS batch_id, r[1] AS "column", r[2] AS "check", CAST(r[3] AS BIGINT) AS failures FROM (
  SELECT load, unnest([
    ['event_type', 'not_nullable', count_if(event_type IS NULL)::VARCHAR], ['value', 'not_nullable', count_if(value IS NULL)::VARCHAR],
    ['user_id', 'not_nullable', count_if(user_id IS NULL)::VARCHAR], ['value', 'less_than_or_equal_to', count_if(value > 400)::VARCHAR],
    ['event_type', 'unique_values_eq', CASE WHEN list_sort(list(DISTINCT event_type)) = ['click', 'error', 'purchase', 'signup', 'view'] THEN '0' ELSE '1' END],
    ['event_type', 'few_errors', CASE WHEN avg((event_type = 'error')::INT) < 0.1 THEN '0' ELSE '1' END],
    ['value', 'max_below_1000', CASE WHEN max(value) < 1000 THEN '0' ELSE '1' END],
    ['user_id', 'mostly_even', CASE WHEN count_if(user_id % 2 = 0) > count_if(user_id % 2 = 1) THEN '0' ELSE '1' END]]) AS r
  FROM seen GROUP BY load)
""")
def stream_report(spark, sf):
    """The report of row and aggregate checks after each of three loads, each on all events up to it."""
    topic = TopicSpec("events", path=scratch_path(spark, "topic-events"))
    out, ckpt = scratch_path(spark, "report"), scratch_path(spark, "ckpt-report")
    ev, begin = table(spark, sf, "events"), "0001-01-01"
    for end in ("2024-01-08", "2024-01-22", "9999-01-01"):
        write_topic(event_records(ev.where(f"ts >= timestamp_ntz'{begin}' AND ts < timestamp_ntz'{end}'"), topic.name), topic)
        report_stream(_events_stream(spark, topic), STREAM_REPORT_CONTRACT, out, ckpt).awaitTermination()
        begin = end
    return reports(spark, out, ckpt).withColumn("batch_id", F.col("batch_id").cast("bigint"))


STREAM_CONTRACT = Contract(name="events_stream", columns={
    "event_id": Column("int64", unique=True),
    "user_id": Column("int64", Check.ge(0)),
    "event_type": Column("str", Check.isin(["click", "error", "purchase", "signup", "view"])),
    "value": Column("float64", Check.le(400.0)),
})


@plan("validate_stream", "V23 V16", """
SELECT event_id, ts, user_id, event_type, value, props, 'valid' AS outcome FROM events WHERE value <= 400.0
UNION ALL SELECT event_id, ts, user_id, event_type, value, props, 'value:less_than_or_equal_to' FROM events WHERE value > 400.0
UNION ALL SELECT event_id, ts, user_id, event_type, value, props, 'event_id:unique' FROM events
          WHERE value <= 400.0 AND ts >= TIMESTAMP '2024-01-15' AND event_type = 'click'
UNION ALL SELECT event_id, ts, user_id, event_type, value, props, 'value:less_than_or_equal_to' FROM events
          WHERE value > 400.0 AND ts >= TIMESTAMP '2024-01-15' AND event_type = 'click'
""")
def validate_stream(spark, sf):
    """Three loads, the last one a repeat of some late events: their ids were accepted before."""
    topic = TopicSpec("events", path=scratch_path(spark, "topic-events"))
    valid, bad = scratch_path(spark, "valid"), scratch_path(spark, "quarantine")
    ckpt = scratch_path(spark, "ckpt-validate")
    for load in (True, False, "again"):
        if load == "again":
            late = table(spark, sf, "events").where(f"ts >= '{SPLIT_TS}' AND event_type = 'click'")
            write_topic(event_records(late, topic.name), topic)
        else:
            _publish_events(spark, sf, topic, load)
        run_validate_stream(_events_stream(spark, topic), STREAM_CONTRACT, valid, bad, ckpt,
                            order_by="event_id").awaitTermination()
    good = spark.read.parquet(valid).select(*EVENT_COLS, F.lit("valid").alias("outcome"))
    return good.unionByName(spark.read.parquet(bad).select(*EVENT_COLS, F.array_join("_reasons", ",").alias("outcome")))


@plan("union_bag", "U1 S7 K12", """
SELECT event_id, ts, user_id, event_type, value, props FROM events
""")
def union_bag(spark, sf):
    ev = table(spark, sf, "events")
    first = ev.where(F.col("event_type").isin("click", "error"))
    a, b = scratch_path(spark, "csv-a"), scratch_path(spark, "csv-b")
    first.write.options(header=True, **JSON_OPTIONS).csv(a)
    ev.where(~F.col("event_type").isin("click", "error")).write.options(header=True, **JSON_OPTIONS).csv(b)
    return (spark.read.schema(EVENTS_DDL).options(header=True, enforceSchema=True, **JSON_OPTIONS)
            .csv([a, b]))


@plan("user_bursts_stream", "A4 A3 T7 W1", """
SELECT user_id, time_bucket(INTERVAL '1 hour', ts) AS bucket_start, count(*) AS events, 1 AS fail_event
FROM events GROUP BY 1, 2
HAVING count(*) >= 2
   AND time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTES
""")
def user_bursts_stream(spark, sf):
    """Bursts (>= 2 events per user and hour) detected on the event stream."""
    from tidewater.streaming.windows import bursts_stream
    topic = TopicSpec("events", path=scratch_path(spark, "topic-events"))
    _publish_events(spark, sf, topic, True)
    _publish_events(spark, sf, topic, False)
    return run_available(bursts_stream(_events_stream(spark, topic), "user_id", "ts", "1 hour", 2,
                                       delay="10 minutes"))


@plan("ingest_validated", "K7 V23 V16 T10", """
SELECT event_id, ts, user_id, event_type, value, props, 'valid' AS outcome FROM events
WHERE value <= 400.0 AND event_type <> 'error' AND event_type <> 'signup'
UNION ALL
SELECT event_id, ts, user_id, event_type, value, props, concat_ws(',',
         CASE WHEN value > 400.0 THEN 'value:less_than_or_equal_to' END, CASE WHEN event_type = 'error' THEN 'event_type:isin' END)
FROM events WHERE (value > 400.0 OR event_type = 'error') AND event_type <> 'signup'
UNION ALL
SELECT event_id, ts, user_id, event_type, value, props, 'event_id:unique' FROM events WHERE value <= 400.0 AND event_type = 'view'
UNION ALL
SELECT event_id, ts, user_id, event_type, value, props, 'value:less_than_or_equal_to' FROM events WHERE value > 400.0 AND event_type = 'view'
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, 'malformed' FROM events WHERE event_type = 'signup'
""")
def ingest_validated(spark, sf):
    """Ingest with a contract: valid rows reach the table, others the quarantine, cut bodies the dead letters.

    A second load repeats the views: their ids were accepted in an earlier batch."""
    topic = TopicSpec("events-json", path=scratch_path(spark, "topic-ingest-v"))
    target = TableSpec("events_json", scratch_path(spark, "ingest-valid"))
    quarantine, dead = scratch_path(spark, "ingest-quarantine"), scratch_path(spark, "ingest-dead")
    contract = Contract(columns={
        "event_id": Column("int64", unique=True), "value": Column("float64", Check.le(400.0)),
        "event_type": Column("str", Check.isin(["click", "purchase", "signup", "view"]))})
    spec = IngestSpec(source=topic, target=target, schema=EVENTS_DDL, checkpoint=scratch_path(spark, "ckpt-ingest-v"),
                      contract=contract, quarantine_path=quarantine, dead_letter_path=dead, offsets_on_rows=False)
    ev = table(spark, sf, "events")
    cut = F.when(F.col("event_type") == "signup", F.substring(json_value(ev), 1, 15)).otherwise(json_value(ev))
    for load in (event_records(ev, topic.name, cut), event_records(ev.where("event_type = 'view'"), topic.name)):
        write_topic(load, topic)
        run_ingest(spark, spec).awaitTermination()
    good = spark.read.parquet(target.path).select(*EVENT_COLS, F.lit("valid").alias("outcome"))
    bad = spark.read.parquet(quarantine).select(*EVENT_COLS, F.array_join("_reasons", ",").alias("outcome"))
    return good.unionByName(bad).unionByName(spark.read.parquet(dead).select(F.col("reason").alias("outcome")),
                                             allowMissingColumns=True)
