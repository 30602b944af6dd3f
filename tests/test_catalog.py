import uuid

import pytest
from pyspark.sql import functions as F

from tidewater.session import scratch_path
from tidewater.sinks.catalog import _literal, back_fill, create_table, evolve_table, insert_rows
from tidewater.functions.avro_types import record_schema


def rec(*fields):
    return {"type": "record", "name": "r", "fields": [{"name": n, "type": t, **(x[0] if x else {})} for n, t, *x in fields]}


V1 = rec(("id", "long"), ("name", "string"))
V2 = rec(("id", "long"), ("name", "string"), ("note", "string", {"default": "it's \\ new"}), ("n", "int", {"default": 42}), ("ok", "boolean", {"default": True}),
         ("x", "double", {"default": -1.5}), ("maybe", ["null", "long"], {"default": None}), ("odd name", "string", {"default": ""}))


@pytest.fixture
def name(spark):
    table = f"t_{uuid.uuid4().hex[:10]}"
    yield table
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_old_rows_answer_with_defaults(spark, name):
    create_table(spark, name, V1, ("day",), "day int", location=scratch_path(spark, "t"))
    insert_rows(spark.createDataFrame([(1, 1, "a"), (1, 2, None)], "day int, id long, name string"), name)
    before = {r.file for r in spark.table(name).select(F.input_file_name().alias("file")).collect()}
    assert evolve_table(spark, name, V2) == ["note", "n", "ok", "x", "maybe", "odd name"] and evolve_table(spark, name, V2) == []
    old = spark.table(name).where("id = 1").first().asDict()
    assert old == {"id": 1, "name": "a", "note": "it's \\ new", "n": 42, "ok": True, "x": -1.5, "maybe": None, "odd name": "", "day": 1}
    assert {r.file for r in spark.table(name).select(F.input_file_name().alias("file")).collect()} == before  # nothing was rewritten
    insert_rows(spark.createDataFrame([(2, 3, "late", None, 7)], "day int, id long, name string, note string, n int"), name)
    assert spark.table(name).where("note IS NULL").first().asDict()["n"] == 7
    insert_rows(spark.createDataFrame([(4, 2, "old producer")], "id long, day int, name string"), name)
    assert spark.table(name).where("id = 4").first()["note"] == "it's \\ new"


def test_back_fill_replaces_its_partitions_only(spark, name):
    create_table(spark, name, V2, ("day",), "day int", location=scratch_path(spark, "t"))
    insert_rows(spark.range(90).selectExpr("id", "'a' AS name", "cast(id % 3 AS int) AS day"), name)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
    for _ in range(2):
        back_fill(spark.range(5).selectExpr("id", "'new' AS name", "1 AS day", "9 AS n"), name)
        counts = {r.day: (r["c"], r.n) for r in spark.table(name).groupBy("day").agg(F.count(F.lit(1)).alias("c"), F.max("n").alias("n")).collect()}
        assert counts == {0: (30, 42), 1: (5, 9), 2: (30, 42)}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static") == mode
    back_fill(spark.table(name).limit(0), name)
    assert spark.table(name).count() == 65


def test_changes_that_old_files_cannot_answer(spark, name):
    create_table(spark, name, V1, location=scratch_path(spark, "t"))
    for schema, message in ((rec(("id", "string")), "bigint to string"), (rec(("new", "int")), "without a default")):
        with pytest.raises(ValueError, match=message):
            evolve_table(spark, name, schema)
    with pytest.raises(ValueError, match="no columns"):
        insert_rows(spark.createDataFrame([(1, 2)], "id long, other int"), name)
    assert [f.name for f in spark.table(name).schema] == ["id", "name"]
    with pytest.raises(ValueError, match="literal"):
        _literal([1], record_schema(rec(("a", {"type": "array", "items": "int"})))["a"].dataType)
