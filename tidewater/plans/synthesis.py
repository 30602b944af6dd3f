"""Synthesis plans: rows derived from the ids of the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidewater.contracts import Check, Column, Contract, ContractModel, Field, typed, validate
from tidewater.operators.decode import conform_json
from tidewater.operators.synth import PEOPLE_SCHEMA, conforms, fake_people, pageviews, synthesize, synthesize_contract
from tidewater.plans.avro_fixtures import AVRO_SCHEMAS, PAGEVIEWS_SCHEMA
from tidewater.plans.registry import plan, table
from tidewater.session import scratch_path
from tidewater.sources.files import read_avro_files, write_avro_files
from tidewater.sinks.topics import hashed_uuid, json_value, to_topic, write_topic
from tidewater.sources.topics import TopicSpec, read_topic
from tidewater.functions.avro_types import field_defaults, named_types
from tidewater.functions.canonical import differences


_SYNTH_SQL = "\nUNION ALL ".join(
    f"SELECT '{name}' AS \"schema\", '{f['name']}' AS field, count(*) AS \"rows\", CAST(0 AS BIGINT) AS nulls, "
    f"count(*) AS conforming FROM orders" for name, schema in AVRO_SCHEMAS.items() for f in schema["fields"])


@plan("synth_rows", "G1 G2 G3 G5 K13 F14", _SYNTH_SQL)
def synth_rows(spark, sf):
    """One generated record per order id for each of the eight schemas, rendered as JSON (bytes as base64), read
    again and held against its schema field by field: one aggregate per schema over ids that are spread once."""
    # CPU per row is far above the input's size, so ids go round all cores; the eight branches share the exchange
    ids = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id")).repartition(2 * spark.sparkContext.defaultParallelism)
    parts = []
    for name, schema in AVRO_SCHEMAS.items():
        named = named_types(schema)
        rows = synthesize(spark, schema, ids=ids, seed=42)
        back = F.from_json(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns])), rows.schema)
        cells = []
        for f in schema["fields"]:
            value = F.col("r").getField(f["name"])
            bounds = {k: f[k] for k in ("min_value", "max_value") if k in f}
            kind = {"type": f["type"], **bounds} if bounds and isinstance(f["type"], str) else f["type"]
            cells.append(F.struct(F.lit(name).alias("schema"), F.lit(f["name"]).alias("field"), F.count(F.lit(1)).alias("rows"),
                                  F.count_if(value.isNull()).alias("nulls"),
                                  F.count_if(conforms(value, kind, named)).alias("conforming")))
        parts.append(rows.select(back.alias("r")).agg(F.array(*cells).alias("c")).select(F.explode("c").alias("c")).select("c.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@plan("synth_json", "G1 G2 G3 G5", "\nUNION ALL ".join(
    f"SELECT '{name}' AS \"schema\", count(*) AS \"rows\", TRUE AS all_written FROM orders" for name in AVRO_SCHEMAS))
def synth_json(spark, sf):
    """One generated record per order id for each of the eight schemas, rendered as JSON: generation alone."""
    ids = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id")).repartition(2 * spark.sparkContext.defaultParallelism)
    parts = []
    for name, schema in AVRO_SCHEMAS.items():
        rows = synthesize(spark, schema, ids=ids, seed=42)
        size = F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns])))
        parts.append(rows.agg(F.lit(name).alias("schema"), F.count(F.lit(1)).alias("rows"), (F.min(size) > 2).alias("all_written")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@plan("synth_qualified", "G4 G1", """
SELECT name, n FROM (VALUES ('com.example.address'), ('age')) t(name) CROSS JOIN (SELECT count(*) AS n FROM orders)
""")
def synth_qualified(spark, sf):
    """Field names of a schema with a nested record, qualified by the enclosing namespace, as its JSON records carry them."""
    ids = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    schema = {"type": "record", "name": "Person", "namespace": "com.example", "fields": [
        {"name": "address", "type": {"type": "record", "name": "Address", "fields": [{"name": "street", "type": "string"}]}},
        {"name": "age", "type": "int"}]}
    rows = synthesize(spark, schema, ids=ids, seed=42, qualify_names=True)
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))
    return rows.select(F.explode(F.json_object_keys(text)).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@plan("avro_round_trip", "G9 G3 G5 S12 K13", "\nUNION ALL ".join(
    f"SELECT '{name}' AS \"schema\", count(*) AS \"rows\", CAST(0 AS BIGINT) AS lost, CAST(0 AS BIGINT) AS gained FROM customer" for name in AVRO_SCHEMAS))
def avro_round_trip(spark, sf):
    """Rows of each schema through Avro container files: how many come back otherwise than they went, by value."""
    # a small file's rows are one task's, and each costs far more than its id: they go round all cores
    ids = table(spark, sf, "customer").select(F.col("c_custkey").alias("id")).repartition(2 * spark.sparkContext.defaultParallelism)
    out = None
    for name, schema in AVRO_SCHEMAS.items():
        path = scratch_path(spark, "avro")
        rows = synthesize(spark, schema, ids=ids, seed=7, null_fraction=0.2)
        write_avro_files(rows, path, schema)
        back = read_avro_files(spark, path, schema)
        wrong = differences(rows, back).agg(F.coalesce(F.sum(F.greatest("n", F.lit(0))), F.lit(0)).alias("lost"),
                                            F.coalesce(F.sum(F.greatest(-F.col("n"), F.lit(0))), F.lit(0)).alias("gained"))
        one = wrong.select(F.lit(name).alias("schema"), F.lit(back.count()).cast("bigint").alias("rows"), "lost", "gained")
        out = one if out is None else out.unionByName(one)
    return out


class CityModel(ContractModel):
    """The same contract, declared class-style (validated on construction by ``typed``)."""
    state: str = Field(isin=["FL", "CA"])
    city: str = Field(str_startswith="City_", unique=True)
    price: int = Field(in_range={"min_value": 5, "max_value": 20})
    opened: dt.datetime = Field(in_range={"min_value": "2010-01-01 00:00:00", "max_value": "2012-01-01 00:00:00"})
    score: float = Field(gt=0.0, lt=1.0)


@plan("synth_contract", "G6 G8 V1 V20", """
SELECT kind, field, n AS "rows", n AS conforming, CASE WHEN field IN ('city', 'uuid') AND NOT (kind = 'person' AND field = 'city') THEN n END AS "distinct"
FROM (VALUES ('city', 'state'), ('city', 'city'), ('city', 'price'), ('city', 'opened'), ('city', 'score'),
             ('person', 'uuid'), ('person', 'first_name'), ('person', 'city'), ('person', 'state')) t(kind, field)
CROSS JOIN (SELECT count(*) AS n FROM customer)
""")
def synth_contract(spark, sf):
    """Contract-conforming rows and fake people, one per customer id, each field held against its rule."""
    ids = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    rows = typed(synthesize_contract(spark, CityModel.to_contract(), ids=ids, seed=3), CityModel)
    people = fake_people(spark, ids=ids, seed=3)
    rules = {"city": (rows, {
        "state": F.col("state").isin("FL", "CA"), "city": F.col("city").startswith("City_"), "price": F.col("price").between(5, 20),
        "opened": F.col("opened").between("2010-01-01 00:00:00", "2012-01-01 00:00:00"),
        "score": (F.col("score") > 0) & (F.col("score") < 1)}),
        "person": (people, {f["name"]: conforms(F.col(f["name"]), f["type"]) for f in PEOPLE_SCHEMA["fields"]})}
    unique = {("city", "city"), ("person", "uuid")}
    parts = []
    for kind, (frame, checks) in rules.items():
        cells = [F.struct(F.lit(kind).alias("kind"), F.lit(f).alias("field"), F.count(F.lit(1)).alias("rows"),
                          F.count_if(ok).alias("conforming"),
                          (F.count_distinct(f) if (kind, f) in unique else F.lit(None).cast("bigint")).alias("distinct"))
                 for f, ok in checks.items()]
        parts.append(frame.agg(F.array(*cells).alias("r")).select(F.explode("r").alias("r")).select("r.*"))
    return parts[0].unionByName(parts[1])


PATTERN_CONTRACT = Contract(name="accounts", columns={
    "account": Column("str", [Check.str_matches(r"[A-Z]{3}-\d{6}$"), Check.notin(["AAA-000000"])], unique=True),
    "mail": Column("str", [Check.str_matches(r"[a-z]+(\.[a-z]+)?@"), Check.str_contains(r"@(example|test)\.(org|net)$"), Check.str_length(12, 30)]),
    "level": Column("int64", [Check.in_range(0, 9), Check.notin([4, 7])]),
    "limit": Column("int64", Check.in_range(0, 9)),
}, checks=[Check.custom(lambda cols: cols.level <= cols.limit, "level_within_limit")])


@plan("synth_patterns", "G6 V12 V13", """
SELECT r[1] AS "column", r[2] AS "check", CAST(0 AS BIGINT) AS failures, n AS "rows" FROM (SELECT count(*) AS n FROM customer), (SELECT unnest([
  ['account', 'not_nullable'], ['account', 'str_matches'], ['account', 'notin'], ['account', 'unique'], ['mail', 'not_nullable'], ['mail', 'str_matches'],
  ['mail', 'str_contains'], ['mail', 'str_length'], ['level', 'not_nullable'], ['level', 'in_range'], ['level', 'notin'], ['limit', 'not_nullable'],
  ['limit', 'in_range'], ['<dataframe>', 'level_within_limit']]) AS r)
""")
def synth_patterns(spark, sf):
    """Rows for patterns, excluded values and a check of the whole row, one per customer, held against their own contract."""
    ids = table(spark, sf, "customer").select(F.col("c_custkey").alias("id")).repartition(2 * spark.sparkContext.defaultParallelism)  # texts cost far more than ids
    path = scratch_path(spark, "accounts")
    synthesize_contract(spark, PATTERN_CONTRACT, ids=ids, seed=11).write.parquet(path)
    rows = spark.read.parquet(path)
    return validate(PATTERN_CONTRACT, rows, "report").withColumn("rows", F.lit(rows.count()).cast("bigint"))


@plan("pageviews", "G7 K9 T4 F13", """
SELECT CAST('10' || CAST(event_id AS VARCHAR) AS BIGINT) AS viewtime, 'User_' || CAST(event_id AS VARCHAR) AS userid,
       'Page_' || CAST(event_id AS VARCHAR) AS pageid, 'Address_' || CAST(event_id AS VARCHAR) AS address,
       'null' AS added_column, 42 AS added_column2, TRUE AS key_is_uuid
FROM events
""")
def pageviews_plan(spark, sf):
    ids = table(spark, sf, "events").select(F.col("event_id").alias("id"))
    rows = pageviews(ids)
    topic = TopicSpec("pageviews", path=scratch_path(spark, "topic-pageviews"))
    write_topic(to_topic(rows, topic.name, json_value(rows), key=hashed_uuid("userid")), topic)
    reader = ", ".join(f"{f['name']} {'bigint' if f['type'] == 'long' else f['type']}"
                       for f in PAGEVIEWS_SCHEMA["fields"])
    records = read_topic(spark, topic).select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    good, _ = conform_json(records, "value", reader, field_defaults(PAGEVIEWS_SCHEMA), keep=["key"])
    return good.withColumn("key_is_uuid", F.col("key").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).drop("key")
