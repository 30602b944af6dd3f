"""Canonical forms, Avro files and streams by value, and nesting as the inverse of relationalize."""

import pytest
from pyspark.sql import functions as F

from tidewater.functions.avro_types import legal_name, legal_names, record_schema
from tidewater.functions.canonical import canonical_rows, differences
from tidewater.operators.relational import nest, relationalize
from tidewater.operators.synth import synthesize
from tidewater.plans.avro_fixtures import AVRO_SCHEMAS
from tidewater.session import scratch_path
from tidewater.sources.files import read_avro_files, stream_avro_files, write_avro_files
from tidewater.streaming.runner import run_available

DDL = "id long, m map<string,array<map<string,double>>>, s struct<a: map<string,int>, b: double>"


def test_maps_compare_whatever_their_order(spark):
    a = spark.createDataFrame([(1, {"x": [{"p": 1.0, "q": 2.0}], "y": []}, ({"k": 1, "l": 2}, -0.0)), (2, None, None), (2, None, None)], DDL)
    b = spark.createDataFrame([(2, None, None), (1, {"y": [], "x": [{"q": 2.0, "p": 1.0}]}, ({"l": 2, "k": 1}, 0.0)), (2, None, None)], DDL)
    assert differences(a, b).count() == 0
    assert canonical_rows(a).exceptAll(canonical_rows(b)).count() == canonical_rows(b).exceptAll(canonical_rows(a)).count() == 0


def test_differences_are_counted(spark):
    a = spark.createDataFrame([(1, {"x": []}, None)] * 5 + [(2, None, None)], DDL)
    b = spark.createDataFrame([(1, {"x": []}, None)] * 3 + [(2, {}, None)], DDL)
    got = {(r.id, None if r.m is None else len(r.m)): r.n for r in differences(a, b).collect()}
    assert got == {(1, 1): 2, (2, None): 1, (2, 0): -1}
    assert differences(a.limit(0), b.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(AVRO_SCHEMAS))
def test_avro_files_return_every_value(spark, name):
    schema, path = AVRO_SCHEMAS[name], scratch_path(spark, "avro")
    rows = synthesize(spark, schema, n=120, seed=3, null_fraction=0.3)
    write_avro_files(rows, path, schema)
    back = read_avro_files(spark, path, schema)
    assert back.columns == rows.columns and back.count() == 120
    a, b = canonical_rows(rows), canonical_rows(back)
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_legal_names():
    assert [legal_name(n) for n in ("a", "1a", "a-b", "é", "")] == ["a", "_1a", "a_b", "_", "_"]
    inner = {"type": "record", "name": "i", "fields": [{"name": "2x", "type": ["null", {"type": "map", "values": "int"}]}]}
    schema = {"type": "record", "name": "r", "fields": [{"name": "1", "type": {"type": "array", "items": inner}}]}
    assert record_schema(legal_names(schema)).simpleString() == "struct<_1:array<struct<_2x:map<string,int>>>>"
    with pytest.raises(ValueError, match="differ only"):
        legal_names({"type": "record", "name": "r", "fields": [{"name": "a-b", "type": "int"}, {"name": "a_b", "type": "int"}]})


def test_stream_goes_on_after_both_schemas_changed(spark):
    path, out, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "out"), scratch_path(spark, "ckpt")

    def rec(*fields):
        return {"type": "record", "name": "r", "fields": [{"name": n, "type": t, **(x[0] if x else {})} for n, t, *x in fields]}

    one = rec(("id", "int"), ("name", "string"))
    two = rec(("name", "string"), ("extra", "string"), ("id", "long"))
    old = rec(("id", "long"), ("name", "string"))
    new = rec(("id", "long"), ("name", "string"), ("extra", "string", {"default": "none"}))
    write_avro_files(spark.createDataFrame([(1, "a")], "id int, name string"), path, one)
    assert run_available(stream_avro_files(spark, path, old), out, ckpt).count() == 1
    write_avro_files(spark.createDataFrame([("b", "x", 2)], "name string, extra string, id long"), path, two, mode="append")
    write_avro_files(spark.createDataFrame([(3, "c")], "id int, name string"), path, one, mode="append")
    run_available(stream_avro_files(spark, path, new), out, ckpt)
    run_available(stream_avro_files(spark, path, new), out, ckpt)  # nothing is read twice
    rows = spark.read.schema("id long, name string, extra string").parquet(out).collect()
    assert sorted(map(tuple, rows)) == [(1, "a", None), (2, "b", "x"), (3, "c", "none")]


NESTED = ("id long, top int, customer struct<name: string, at: struct<x: int, y: int>>, tags array<string>, "
          "items array<struct<sku: string, parts: array<struct<n: int, w: map<string,double>>>, note: string>>, "
          "attrs map<string,struct<v: int, l: array<int>>>, grid array<array<int>>")


def nested_rows():
    deep = [("p", [(1, {"a": 1.0, "b": 2.0}), (2, None), None], "n"), ("q", None, None), None, (None, [(None, {"c": None})], None)]
    return [(1, 5, ("A", (1, None)), ["x", None, "x"], deep, {"k": (1, [1, 2]), "l": (None, [3])}, [[1, 2], None, [3]]),
            (2, None, None, None, None, None, None), (3, 7, ("B", None), ["z"], [("r", [(5, {"d": 1.0})] * 9, None)] * 3, {"only": (4, None)}, [[7]])]


@pytest.mark.parametrize("chunk", [2, 10_000])
def test_nesting_undoes_relationalize(spark, chunk):
    df = spark.createDataFrame(nested_rows(), NESTED)
    back = nest(relationalize(df, "id", "t"), df.schema, "id", "t", chunk=chunk)
    assert back.columns == df.columns
    # what the tables can't tell apart: an element of nulls only is a null element
    assert differences(back, df).count() == 0


def test_nesting_a_hot_parent(spark):
    df = spark.range(3000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50)).cast("long").alias("k"), "id")
    parents = df.select("k").distinct()
    items = df.selectExpr("k", "cast(row_number() OVER (PARTITION BY k ORDER BY id) - 1 AS int) AS xs_index", "id AS xs").repartition(7)
    schema = spark.createDataFrame([], "k long, xs array<bigint>").schema
    got = {r.k: r.xs for r in nest({"t": parents, "t_xs": items}, schema, "k", "t", chunk=64).collect()}
    want = {}
    for r in df.orderBy("id").collect():
        want.setdefault(r.k, []).append(r.id)
    assert got == want and len(got[0]) > 1000


def test_nesting_tables_without_children_and_empty(spark):
    df = spark.createDataFrame([(1, None, None)], "id long, xs array<int>, m map<string,int>")
    assert nest(relationalize(df, "id", "t", keep_empty=False), df.schema, "id", "t").collect() == df.collect()
    assert nest(relationalize(df.limit(0), "id", "t"), df.schema, "id", "t").collect() == []
    two = spark.createDataFrame([(1, "a", [1, 2]), (1, "b", [3])], "x int, y string, l array<int>")
    assert sorted(nest(relationalize(two, ["x", "y"], "t"), two.schema, ["x", "y"], "t").collect()) == sorted(two.collect())


@pytest.mark.parametrize("chunk", [2, 10_000])
def test_long_lists_in_pieces(spark, chunk):
    df = spark.createDataFrame(nested_rows(), NESTED)
    tables = relationalize(df, "id", "t")
    pieces = nest(tables, df.schema, "id", "t", chunk=chunk, piece="piece")
    assert pieces.columns == [*df.columns, "piece"]
    assert max(len(r[c] or []) for r in pieces.collect() for c in ("tags", "items", "grid")) <= chunk
    again = relationalize(pieces, "id", "t", piece="piece")
    assert again.keys() == tables.keys()
    for name, table in tables.items():
        assert again[name].schema.simpleString() == table.schema.simpleString()
        assert differences(again[name], table).count() == 0, name


def test_pieces_of_a_hot_parent(spark):
    """Two lists of other lengths, one behind a gap and of a repeated parent; a null key and rows of no parent."""
    parents = spark.createDataFrame([(0, "a"), (1, "b"), (1, "b"), (2, "c"), (None, "d")], "k long, note string")
    xs = spark.range(3000).selectExpr("cast(0 as long) AS k", "cast(id as int) AS xs_index", "id AS xs")
    xs = xs.unionByName(spark.createDataFrame([(1, 500, 7), (1, 500, 7), (1, 900, 8), (9, 0, 1)], "k long, xs_index int, xs long")).repartition(7)
    ys = spark.range(100).selectExpr("id % 2 AS k", "cast(id div 2 as int) AS s_ys_index", "cast(id as string) AS s_ys")
    schema = spark.createDataFrame([], "k long, xs array<bigint>, note string, s struct<ys: array<string>>").schema
    tables = {"t": parents, "t_xs": xs, "t_s_ys": ys}
    pieces = nest(tables, schema, "k", "t", chunk=64, piece="p")
    assert max(len(r.xs or []) for r in pieces.collect()) == 64
    got, want = (relationalize(f, "k", "t", **kw) for f, kw in ((pieces, {"piece": "p"}), (nest(tables, schema, "k", "t", chunk=64), {})))
    for name in want:
        assert differences(got[name], want[name]).count() == 0, name


def test_nested_again_has_no_long_list(spark, monkeypatch):
    from tidewater.plans import nesting
    held = []
    monkeypatch.setattr(nesting, "relationalize", lambda df, *a, **kw: held.append(df) or relationalize(df, *a, **kw))
    nesting.nested_again(spark, "/root/testdata/sf0.001")
    assert held[0].agg(F.max(F.size("items"))).first()[0] <= 1000
