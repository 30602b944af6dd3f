import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidewater.contracts import Check, Column, Contract, validate
from tidewater.functions.avro_types import record_schema
from tidewater.operators.synth import (_Gen, DOUBLE_RANGE, fake_people, pageviews, synthesize,
                                       synthesize_contract)
from tidewater.plans.avro_fixtures import AVRO_SCHEMAS
from tidewater.session import scratch_path

AVRO = "org.apache.spark.sql.avro.AvroFileFormat"
# Spark's Avro writer requires Avro-legal field names; this fixture's names start with digits.
ILLEGAL_NAMES = {"fake-nested-unions"}


@pytest.mark.parametrize("name", sorted(AVRO_SCHEMAS))
def test_generator_round_trip(spark, name):
    schema = AVRO_SCHEMAS[name]
    df = synthesize(spark, schema, n=40, seed=11)
    assert df.schema.simpleString() == record_schema(schema).simpleString()
    path = scratch_path(spark, "roundtrip")
    if name in ILLEGAL_NAMES:
        df.write.json(path)
        back = spark.read.schema(df.schema).json(path)
    else:
        df.write.format(AVRO).option("avroSchema", json.dumps(schema)).save(path)
        back = spark.read.format(AVRO).option("avroSchema", json.dumps(schema)).load(path)
    assert back.schema.simpleString() == df.schema.simpleString()
    as_json = lambda d: d.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in d.columns])).alias("j"))
    assert as_json(df).exceptAll(as_json(back)).count() == 0
    assert as_json(back).exceptAll(as_json(df)).count() == 0


def test_same_rows_at_1_and_8_partitions(spark):
    schema = AVRO_SCHEMAS["fake-heavily-nested"]
    one = synthesize(spark, schema, ids=spark.range(0, 200, 1, 1), seed=5, keep_id=True)
    eight = synthesize(spark, schema, ids=spark.range(0, 200, 1, 8), seed=5, keep_id=True)
    j = lambda d: d.select(F.to_json(F.struct("*")).alias("j"))
    assert j(one).exceptAll(j(eight)).count() == 0


def test_ranges_and_shapes(spark):
    schema = {"type": "record", "name": "r", "fields": [
        {"name": "i", "type": "int"}, {"name": "l", "type": "long"}, {"name": "d", "type": "double"},
        {"name": "s", "type": "string"}, {"name": "b", "type": "int", "min_value": 100, "max_value": 500},
        {"name": "u", "type": {"type": "string", "logicalType": "uuid"}},
        {"name": "t", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "a", "type": {"type": "array", "items": "int"}},
        {"name": "m", "type": {"type": "map", "values": "boolean"}},
        {"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["x", "y"]}},
        {"name": "f", "type": {"type": "fixed", "name": "F", "size": 8}},
        {"name": "n", "type": ["null", "string"]}]}
    rows = synthesize(spark, schema, n=300, seed=1, base_ts=dt.datetime(2024, 5, 1)).collect()
    for r in rows:
        assert 0 <= r["i"] <= 2**31 - 1 and 0 <= r["l"] and 0 <= r["d"] <= DOUBLE_RANGE[1]
        assert len(r["s"]) == 10 and set(r["s"]) <= set("abcdef")
        assert 100 <= r["b"] <= 500 and len(r["u"]) == 36
        assert 1 <= len(r["a"]) <= 2 and sorted(r["m"]) == ["key0", "key1", "key2"]
        assert r["e"] in ("x", "y") and len(r["f"]) == 8 and bytes(r["f"]).isalnum()
        assert r["n"] is not None
        assert r["t"].replace(tzinfo=None) == dt.datetime(2024, 5, 1)
    with_nulls = synthesize(spark, schema, n=300, seed=1, null_fraction=0.5)
    assert 50 < with_nulls.where("n IS NULL").count() < 250


def test_union_of_records_has_exactly_one_member(spark):
    df = synthesize(spark, AVRO_SCHEMAS["complex-union-records-fixed"], n=100, seed=2)
    members = df.select(*[F.col(f"complex_union.member{i}").isNotNull().cast("int") for i in range(3)]).collect()
    assert all(sum(m) == 1 for m in members)


def test_namespace_qualified_names(spark):
    schema = {"type": "record", "name": "outer", "namespace": "com.example", "fields": [
        {"name": "inner", "type": {"type": "record", "name": "I", "fields": [{"name": "x", "type": "int"}]}}]}
    assert synthesize(spark, schema, n=1, qualify_names=True).columns == ["com.example.inner"]


CONTRACT = Contract(columns={
    "state": Column("str", Check.isin(["FL", "CA"])),
    "city": Column("str", Check.str_startswith("City_"), unique=True),
    "price": Column("int64", Check.in_range(5, 20)),
    "age": Column("int16", Check.gt(17)),
    "score": Column("float64", [Check.ge(0.0), Check.lt(1.0)]),
    "since": Column("datetime64[ns]", Check.in_range("2010-01-01 00:00:00", "2012-01-01 00:00:00")),
    "code": Column("str", Check.str_length(4, 6)),
})


def test_contract_synthesis_passes_its_contract(spark):
    df = synthesize_contract(spark, CONTRACT, n=500, seed=9)
    assert validate(CONTRACT, df).count() == 500


def test_pageviews_and_people(spark):
    pv = pageviews(spark.range(3)).collect()
    assert [(r["viewtime"], r["userid"], r["pageid"], r["address"]) for r in pv] == [
        (100, "User_0", "Page_0", "Address_0"), (101, "User_1", "Page_1", "Address_1"),
        (102, "User_2", "Page_2", "Address_2")]
    people = fake_people(spark, 10)
    assert people.count() == 10 and people.select("uuid").distinct().count() == 10


def test_unique_beyond_its_range_fails_instead_of_breaking_the_contract(spark):
    narrow = Contract(columns={"v": Column("int64", Check.in_range(5, 9), unique=True)})
    assert {r["v"] for r in synthesize_contract(spark, narrow, n=5).collect()} == {5, 6, 7, 8, 9}
    choice = Contract(columns={"v": Column("str", Check.isin(["a", "b"]), unique=True)})
    assert {r["v"] for r in synthesize_contract(spark, choice, n=2).collect()} == {"a", "b"}
    for contract, n in ((narrow, 6), (choice, 3)):
        with pytest.raises(Exception, match="possible values"):
            synthesize_contract(spark, contract, n=n).collect()


def test_fixed_bytes_use_the_whole_alphabet(spark):
    import string
    schema = {"type": "record", "name": "r", "fields": [{"name": "f", "type": {"type": "fixed", "name": "F", "size": 16}}]}
    rows = [bytes(r["f"]).decode() for r in synthesize(spark, schema, n=400, seed=1).collect()]
    assert all(len(x) == 16 for x in rows) and set("".join(rows)) == set(string.ascii_letters + string.digits)
    assert len(set(rows)) == 400


def test_avro_round_trip_spreads_the_rows_of_a_small_file(spark, monkeypatch):
    from tidewater.plans import synthesis
    tasks, write = [], synthesis.write_avro_files

    def counted(rows, *args, **kw):
        tasks.append(rows.rdd.getNumPartitions())
        write(rows, *args, **kw)

    monkeypatch.setattr(synthesis, "write_avro_files", counted)
    assert all(r.lost == 0 and r.gained == 0 for r in synthesis.avro_round_trip(spark, "/root/testdata/sf0.001").collect())
    assert len(tasks) == 8 and min(tasks) > 1


def _written(alphabet, h, n):
    """n letters of the number h: leading digit first."""
    r, out = h % len(alphabet) ** 10, ""
    for _ in range(10):
        r, d = divmod(r, len(alphabet))
        out = alphabet[d] + out
    return out[:n]


@pytest.mark.parametrize("alphabet", ["abcdef", "ab", "abcdefghijklmnopqrstuvwxyz0123456789"])
def test_texts_are_the_digits_of_their_hash(spark, alphabet):
    g = _Gen(5, F.col("id"), 0, 0.0, False, {})
    hashes = [g.h("p", [F.lit(j)]).alias(f"h{j}") for j in range(2)]
    rows = spark.range(-20, 80).select(*hashes, g.chars(alphabet, 10, "p", []).alias("a"), g.chars(alphabet, 13, "p", []).alias("b"),
                                       g.chars(alphabet, F.pmod("id", F.lit(21)), "p", [], max_len=20).alias("c"), F.pmod("id", F.lit(21)).alias("n")).collect()
    for r in rows:
        text = _written(alphabet, r.h0, 10) + _written(alphabet, r.h1, 10)
        assert (r.a, r.b, r.c) == (text[:10], text[:13], text[: r.n])


def test_generated_code_does_not_grow_with_nesting(spark):
    """Elements written out place by place made a method of some hundred thousand characters, which the JIT refuses."""
    rows = synthesize(spark, AVRO_SCHEMAS["deeply-nested-map-array"], ids=spark.range(5), seed=1)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64") < 12
