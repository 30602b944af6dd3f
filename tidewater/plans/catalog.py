"""Plans over files, SQL views and catalog tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidewater.operators.decode import decode_json
from tidewater.operators.relational import relationalize
from tidewater.plans.registry import plan, table
from tidewater.plans.topics import EVENT_COLS, EVENTS_DDL, event_records
from tidewater.session import scratch_path
from tidewater.sinks.catalog import back_fill, create_table, evolve_table, insert_rows
from tidewater.sinks.files import write_tables
from tidewater.sinks.tables import read_topic_table
from tidewater.sinks.topics import JSON_OPTIONS, write_topic
from tidewater.sources.files import read_avro_files, read_objects, stream_avro_files, write_avro_files
from tidewater.sources.topics import TopicSpec, read_topic
from tidewater.streaming.runner import run_available
from tidewater.streaming.windows import stream_to_topic, tumble_sum_stream


# The events record as an Avro schema (NTZ timestamps as local micros).
EVENTS_AVRO = {
    "type": "record", "name": "event", "namespace": "tidewater.events",
    "fields": [
        {"name": "event_id", "type": "long"},
        {"name": "ts", "type": {"type": "long", "logicalType": "local-timestamp-micros"}},
        {"name": "user_id", "type": "long"},
        {"name": "event_type", "type": "string"},
        {"name": "value", "type": "double"},
        {"name": "props", "type": ["null", "string"]},
    ],
}


@plan("object_dispatch", "S9 S8", """
SELECT event_type AS object, event_id, ts, user_id, value, props FROM events
""")
def object_dispatch(spark, sf):
    """A folder of many objects (one folder of JSON-lines files per event type),
    read in one pass and tagged with the object name."""
    path = scratch_path(spark, "objects")
    table(spark, sf, "events").write.partitionBy("event_type").options(**JSON_OPTIONS).json(path)
    return read_objects(spark, path, "json", schema=EVENTS_DDL.replace(", event_type string", ""), object_from="dir", **JSON_OPTIONS)


@plan("avro_files", "S12 T4 K13", """
SELECT event_id, ts, user_id, event_type, value, props, 'web' AS source, 42 AS version FROM events
""")
def avro_files(spark, sf):
    """Write Avro container files, read them back with an evolved reader schema."""
    path = scratch_path(spark, "avro-files")
    write_avro_files(table(spark, sf, "events"), path, EVENTS_AVRO)
    reader = dict(EVENTS_AVRO, fields=EVENTS_AVRO["fields"] + [
        {"name": "source", "type": "string", "default": "web"},
        {"name": "version", "type": "int", "default": 42}])
    return read_avro_files(spark, path, reader)


@plan("avro_stream", "S12 T4 K6", """
SELECT event_id, user_id, event_type, CASE WHEN event_id % 2 = 0 THEN value ELSE CAST(floor(value) AS DOUBLE) END AS value,
       CASE WHEN event_id % 2 = 0 THEN 'new' ELSE 'web' END AS source FROM events
""")
def avro_stream(spark, sf):
    """Avro container files as a stream: the query goes on from its checkpoint after the writers' schema has changed.

    The first writer had a whole-number value and no source; the second one's fields stand in another order."""
    path, out, ckpt = scratch_path(spark, "avro-landing"), scratch_path(spark, "avro-out"), scratch_path(spark, "ckpt-avro")
    def schema(*fields):
        return {"type": "record", "name": "event", "fields": [{"name": n, "type": t, **(x[0] if x else {})} for n, t, *x in fields]}
    first = schema(("event_id", "long"), ("user_id", "int"), ("event_type", "string"), ("value", "long"))
    second = schema(("source", "string"), ("value", "double"), ("event_type", "string"), ("event_id", "long"), ("user_id", "long"))
    reader = schema(("event_id", "long"), ("user_id", "long"), ("event_type", "string"), ("value", "double"), ("source", "string", {"default": "web"}))
    ev, odd = table(spark, sf, "events"), F.col("event_id") % 2 == 1
    loads = [(first, ev.where(odd).withColumns({"user_id": F.col("user_id").cast("int"), "value": F.floor("value").cast("bigint")})),
             (second, ev.where(~odd).withColumn("source", F.lit("new")))]
    for writer, rows in loads:
        write_avro_files(rows.select(*[f["name"] for f in writer["fields"]]), path, writer, mode="append")
        done = run_available(stream_avro_files(spark, path, reader), out, ckpt)
    return done


@plan("schema_listing", "C4 C1", """
SELECT name, type, CAST(nulls AS BIGINT) AS nulls, "distinct" FROM (VALUES
  ('event_id', 'bigint', (SELECT count_if(event_id IS NULL) FROM events), (SELECT count(DISTINCT event_id) FROM events)),
  ('ts', 'timestamp_ntz', (SELECT count_if(ts IS NULL) FROM events), (SELECT count(DISTINCT ts) FROM events)),
  ('user_id', 'bigint', (SELECT count_if(user_id IS NULL) FROM events), (SELECT count(DISTINCT user_id) FROM events)),
  ('event_type', 'string', (SELECT count_if(event_type IS NULL) FROM events), (SELECT count(DISTINCT event_type) FROM events)),
  ('value', 'double', (SELECT count_if(value IS NULL) FROM events), (SELECT count(DISTINCT value) FROM events)),
  ('props', 'string', (SELECT count_if(props IS NULL) FROM events), (SELECT count(DISTINCT props) FROM events))) t(name, type, nulls, "distinct")
""")
def schema_listing(spark, sf):
    """The schema of a registered view as SQL lists it, with each column's nulls and distinct values over all rows."""
    ev = table(spark, sf, "events")
    ev.createOrReplaceTempView("events_listed")
    listed = [(r["col_name"], r["data_type"]) for r in spark.sql("DESCRIBE TABLE events_listed").collect()]  # the schema, not rows
    # a row per column and value group: one shuffle for all columns, combined on the map side
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.lit(t).alias("type"), F.col(c).cast("string").alias("v")) for c, t in listed]))
    groups = ev.select(cells.alias("c")).groupBy("c.name", "c.type", "c.v").agg(F.count(F.lit(1)).alias("n"))
    return groups.groupBy("name", "type").agg(F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
                                              F.count("v").alias("distinct"))


@plan("lake_sql", "S6 T6 C1 F2", """
SELECT event_type, count(*) AS events, max(ts) AS last_ts FROM events WHERE value > 100 GROUP BY 1
""")
def lake_sql(spark, sf):
    base = scratch_path(spark, "lake")
    table(spark, sf, "events").write.parquet(f"{base}/events_json")
    read_topic_table(spark, base, "events-json")   # registers view events_json
    return spark.sql("SELECT event_type, count(*) AS events, max(ts) AS last_ts FROM events_json "
                     "WHERE value > 100 GROUP BY event_type")


@plan("sql_table_insert", "C2 C3 K4", """
SELECT CAST(c_custkey AS VARCHAR) AS uuid, c_name AS first_name, 'NATION_' || CAST(c_nationkey AS VARCHAR) AS city,
       c_mktsegment AS state
FROM customer
""")
def sql_table_insert(spark, sf):
    """DDL-declared partitioned table, filled with INSERT INTO ... SELECT."""
    path = scratch_path(spark, "people-table")
    name = "people_" + path.rsplit("-", 1)[-1]
    table(spark, sf, "customer").createOrReplaceTempView("customer_src")
    spark.sql(f"CREATE TABLE {name} (uuid VARCHAR(36), first_name VARCHAR(50), city VARCHAR(50), "
              f"state VARCHAR(50)) USING parquet PARTITIONED BY (state) LOCATION '{path}'")
    spark.sql(f"INSERT INTO {name} SELECT CAST(c_custkey AS STRING), c_name, "
              f"concat('NATION_', CAST(c_nationkey AS STRING)), c_mktsegment FROM customer_src")
    return spark.table(name)


VIEW_V1 = {"type": "record", "name": "pageviews", "fields": [
    {"name": "viewtime", "type": "long"}, {"name": "userid", "type": "string"}, {"name": "pageid", "type": "string"}]}
VIEW_V2 = dict(VIEW_V1, fields=VIEW_V1["fields"] + [
    {"name": "address", "type": "string", "default": "null"}, {"name": "added_column", "type": "string", "default": "null"},
    {"name": "added_column2", "type": "int", "default": 42}, {"name": "note", "type": ["null", "string"], "default": None}])


@plan("table_evolution", "T4 C2 C3 K4", """
SELECT event_id AS viewtime, CASE WHEN day(ts) = 3 THEN 'corrected' ELSE 'User_' || user_id END AS userid, 'Page_' || event_type AS pageid,
       CASE WHEN day(ts) > 15 THEN 'Address_' || user_id ELSE 'null' END AS address, 'null' AS added_column,
       CASE WHEN day(ts) = 3 THEN 7 ELSE 42 END AS added_column2, CAST(NULL AS VARCHAR) AS note, strftime(ts, '%Y-%m-%d') AS day FROM events
""")
def table_evolution(spark, sf):
    """A catalog table written before and after its schema grew, then one day of it computed anew.

    Old files answer the new columns with the defaults; later rows of the old producer take them too."""
    name = f"evolving_{uuid.uuid4().hex[:10]}"
    ev = table(spark, sf, "events")
    rows = ev.select(F.col("event_id").alias("viewtime"), F.concat(F.lit("User_"), "user_id").alias("userid"),
                     F.concat(F.lit("Page_"), "event_type").alias("pageid"), F.date_format("ts", "yyyy-MM-dd").alias("day"))
    late = F.dayofmonth("day") > 15
    create_table(spark, name, VIEW_V1, ("day",), "day string", location=scratch_path(spark, "evolving"))
    insert_rows(rows.where(~late & (F.col("viewtime") % 2 == 0)), name)
    evolve_table(spark, name, VIEW_V2)
    insert_rows(rows.where(~late & (F.col("viewtime") % 2 == 1)), name)
    insert_rows(rows.where(late).withColumn("address", F.regexp_replace("userid", "^User", "Address")), name)
    third = rows.where(F.dayofmonth("day") == 3)
    back_fill(third.withColumns({"userid": F.lit("corrected"), "added_column2": F.lit(7)}), name)
    path = scratch_path(spark, "evolved")
    spark.table(name).write.parquet(path)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path)


@plan("topic_roundtrip_stream", "W2 S4 K8 W1", """
SELECT event_type, time_bucket(INTERVAL '60 seconds', ts) + INTERVAL '60 seconds' AS window_end,
       CAST(sum(CAST(value AS DECIMAL(18,2))) * 0.85 AS DOUBLE) AS window_sales
FROM events GROUP BY 1, 2
HAVING time_bucket(INTERVAL '60 seconds', ts) + INTERVAL '60 seconds'
       <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTES
""")
def topic_roundtrip_stream(spark, sf):
    source = TopicSpec("sales-in", path=scratch_path(spark, "topic-sales-in"))
    write_topic(event_records(table(spark, sf, "events"), source.name), source)
    rows, _ = decode_json(read_topic(spark, source, stream=True), EVENTS_DDL, meta=[])
    sales = tumble_sum_stream(rows.select(*EVENT_COLS), "ts", "event_type", "value", "60 seconds", "0.85",
                              delay="10 minutes", decimal_scale=2)
    sink = TopicSpec("sales-out", path=scratch_path(spark, "topic-sales-out"))
    stream_to_topic(sales, sink, scratch_path(spark, "ckpt-sales"), key="event_type").awaitTermination()
    good, _ = decode_json(read_topic(spark, sink), "event_type string, window_end timestamp_ntz, window_sales double",
                          meta=[])
    return good.drop("key")


@plan("relationalize_csv", "R5 R6 R1", """
SELECT conv_id, turn, CAST(pos - 1 AS INTEGER) AS words_index, word AS words FROM (
  SELECT conv_id, turn, generate_subscripts(w, 1) AS pos, unnest(w) AS word FROM (
    SELECT conv_id, turn, regexp_split_to_array(text, '[ \n\r\t]+') AS w FROM conversations)) WHERE word <> ''
""")
def relationalize_csv(spark, sf):
    """Turns with their words, relationalized, written as CSV + DDL per object, read back by the written DDL's columns."""
    nested = table(spark, sf, "conversations").select("conv_id", "turn", F.split("text", "[ \\n\\r\\t]+").alias("words"))
    paths = write_tables(relationalize(nested, ["conv_id", "turn"], "conversations"), scratch_path(spark, "objects-csv"))
    back = spark.read.option("header", True).schema("conv_id bigint, turn bigint, words_index int, words string").option(
        "quote", '"').option("escape", '"').csv(paths["conversations_words"])
    return back.where("words <> ''")


@plan("value_only_stream", "S5 W3 W5", """
SELECT event_id, ts, user_id, event_type, value, props FROM events
""")
def value_only_stream(spark, sf):
    """Pass-through stream of message values as text (no watermark, no state), and what the texts say."""
    from tidewater.sources.topics import value_stream
    from tidewater.streaming.runner import run_available
    topic = TopicSpec("events", path=scratch_path(spark, "topic-values"))
    write_topic(event_records(table(spark, sf, "events"), topic.name), topic)
    texts = run_available(value_stream(read_topic(spark, topic, stream=True)))
    return texts.select(F.from_json("value", EVENTS_DDL).alias("r")).select("r.*")
