from pyspark.sql import functions as F

import json

import pytest
from hypothesis import given, settings, strategies as st

from tidewater.operators import relational as rel
from tidewater.operators.relational import (ELEMENT, convert_json, convert_objects, ddl_for, infer_json_types, infer_object_types, json_tables,
                                            relationalize, resolve_choices)

NESTED = """
{"id": 1, "s3_reference": {"bucket": "b", "key": "x/LA-1/d/2024-08-24"}, "tags": ["a", "b"],
 "items": [{"sku": "p1", "qty": 1, "parts": [{"n": "bolt", "meta": {"w": 1.5}}]}, {"sku": "p2", "qty": 2, "parts": []}]}
{"id": 2, "s3_reference": {"bucket": "b", "key": "x/LA-2/d/2024-08-25"}, "tags": [], "items": null}
{"id": 3, "s3_reference": null, "tags": null, "items": [{"sku": "p3", "qty": 3, "parts": null}]}
"""


def nested(spark):
    lines = [ln for ln in NESTED.strip().splitlines()]
    joined = [lines[0] + lines[1]] + lines[2:]
    return spark.read.json(spark.sparkContext.parallelize(joined, 2))


def test_relationalize_tables_and_keys(spark):
    tables = relationalize(nested(spark), "id", "root")
    assert set(tables) == {"root", "root_tags", "root_items", "root_items_parts"}
    assert tables["root"].columns == ["id", "s3_reference_bucket", "s3_reference_key"]
    assert set(tables["root_items_parts"].columns) == {"id", "items_index", "parts_index", "parts_meta_w", "parts_n"}
    tags = [(r["id"], r["tags_index"], r["tags"]) for r in tables["root_tags"].collect()]
    # empty and null lists keep one null child row
    assert sorted(tags, key=str) == sorted([(1, 0, "a"), (1, 1, "b"), (2, None, None), (3, None, None)], key=str)
    parts = tables["root_items_parts"].where("parts_n IS NOT NULL").first()
    assert (parts["id"], parts["items_index"], parts["parts_index"], parts["parts_meta_w"]) == (1, 0, 0, 1.5)


def test_relationalize_drop_empty(spark):
    tables = relationalize(nested(spark), "id", "root", keep_empty=False)
    assert tables["root_tags"].count() == 2


def test_children_reassemble_to_input(spark):
    df = nested(spark)
    tags = relationalize(df, "id", "root")["root_tags"].where("tags_index IS NOT NULL")
    back = tags.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("tags_index", "tags"))).alias("t")) \
        .select("id", F.transform("t", lambda x: x["tags"]).alias("tags"))
    orig = df.select("id", "tags").where(F.size("tags") > 0)
    assert back.exceptAll(orig).count() == 0 and orig.exceptAll(back).count() == 0


def test_choice_types_resolution(spark):
    rows = [('{"a": 1, "b": "x", "c": {"d": 1}}',), ('{"a": 1.5, "b": 2, "c": {"d": 2.5}}',),
            ('{"a": null, "e": true}',), ("not json",)]
    df = spark.createDataFrame(rows, ["j"])
    types = infer_json_types(df, "j")
    assert types == {("a",): {"int", "float"}, ("b",): {"int", "str"}, ("c", "d"): {"int", "float"}, ("e",): {"bool"}}
    resolved = resolve_choices(types)
    assert [c for c, _, _ in resolved[("b",)]] == ["b_int", "b_str"] and resolved[("a",)] == [("a", "double", "float")]
    out = convert_json(df, "j", resolved).collect()
    assert [r["a"] for r in out] == [1.0, 1.5, None, None]
    assert [(r["b_int"], r["b_str"]) for r in out] == [(None, "x"), (2, None), (None, None), (None, None)]
    assert [r["c_d"] for r in out] == [1.0, 2.5, None, None]


def test_ddl_text(spark):
    df = spark.createDataFrame([(1, "a", 1.5)], "id bigint, name string, w double")
    assert ddl_for(df, "decision_results") == (
        'CREATE TABLE IF NOT EXISTS "public"."decision_results" (\n    "id" BIGINT,\n'
        '    "name" VARCHAR,\n    "w" DOUBLE PRECISION\n);')


def test_many_keys_are_all_inferred(spark):
    df = spark.createDataFrame([(f'{{"user_{i}": {i}}}',) for i in range(50)], ["j"])
    assert len(infer_json_types(df, "j")) == 50


DOCS = [(1, '{"a.b": 1, "c:d": {"e,f": "x", "g": [1, 2]}, "l": [{"n.o": 1, "t": [true]}, {"n.o": 2.5}], "m": {}}'),
        (2, '{"a.b": "s", "l": [], "it\'s": 3, "x": null}'), (3, "not"), (4, "[1]"), (5, '{"l": 7}'), (6, None)]


def test_paths_are_segments_whatever_keys_hold(spark):
    df = spark.createDataFrame(DOCS, "id int, j string")
    types = infer_json_types(df, "j")
    assert types[("a.b",)] == {"int", "str"} and types[("c:d", "e,f")] == {"str"} and types[("x",)] == set()
    assert types[("l",)] == {"array", "int"} and types[("l", ELEMENT, "n.o")] == {"int", "float"}
    assert types[("l", ELEMENT, "t", ELEMENT)] == {"bool"} and types[()] == {"array"}
    rows = {r["id"]: r for r in convert_json(df, "j", resolve_choices(types), ["id"]).collect()}
    assert (rows[1]["a.b_int"], rows[2]["a.b_str"], rows[2]["it's"], rows[1]["c:d_e,f"]) == (1, "s", 3, "x")


def test_arrays_become_child_tables(spark):
    df = spark.createDataFrame(DOCS, "id int, j string")
    tables = json_tables(df, "j", "id", "doc")
    assert set(tables) == {"doc", "doc_list", "doc_l", "doc_l_t", "doc_c:d_g"}
    assert tables["doc"].count() == 6 and {r["id"]: r["l"] for r in tables["doc"].collect() if r["l"]} == {5: 7}
    assert sorted(map(tuple, tables["doc_l"].collect())) == [(1, 0, 1.0), (1, 1, 2.5)]
    assert list(map(tuple, tables["doc_l_t"].collect())) == [(1, 0, 0, True)]
    assert sorted(map(tuple, tables["doc_c:d_g"].collect())) == [(1, 0, 1), (1, 1, 2)]
    assert list(map(tuple, tables["doc_list"].collect())) == [(4, 0, 1)]


def test_names_that_meet_are_told_apart(spark):
    df = spark.createDataFrame([('{"a_b": 1, "a": {"b": 2}, "A_B": 3}',)], ["j"])
    out = convert_json(df, "j", resolve_choices(infer_json_types(df, "j")))
    assert len({c.lower() for c in out.columns}) == 3 and sorted(out.first()) == [1, 2, 3]


VALUES = st.recursive(st.one_of(st.none(), st.booleans(), st.integers(-2**70, 2**70), st.floats(allow_nan=False, allow_infinity=False), st.text(max_size=3)),
                      lambda x: st.one_of(st.lists(x, max_size=3), st.dictionaries(st.sampled_from(["a", "b", "0", ""]), x, max_size=3)), max_leaves=12)


def kinds_of(v, path=()):
    """{path: kinds} by plain recursion."""
    kind = ("object" if isinstance(v, dict) else "array" if isinstance(v, list) else "bool" if isinstance(v, bool) else None if v is None
            else "float" if isinstance(v, float) or (isinstance(v, int) and not -2**63 <= v < 2**63) else "int" if isinstance(v, int) else "str")
    out = {path: {kind} - {None}}
    for key, x in v.items() if isinstance(v, dict) else [(ELEMENT, x) for x in v] if isinstance(v, list) else []:
        for p, k in kinds_of(x, (*path, key)).items():
            out.setdefault(p, set()).update(k)
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(VALUES, max_size=6), st.randoms())
def test_kinds_merge_in_any_order(docs, draw):
    want = {}
    for d in docs:
        for p, k in kinds_of(d).items():
            want.setdefault(p, set()).update(k)
    trees = []
    for part in (docs[: len(docs) // 2], docs[len(docs) // 2 :]):
        tree = rel._Kinds()
        draw.shuffle(part)
        for d in part:
            tree.add(json.loads(json.dumps(d)))
        trees.append(tree)
    got = {}
    for tree in trees:
        for p, bits in tree.rows():
            got[p] = got.get(p, 0) | bits
    got = {p: {k for k, bit in rel._BITS.items() if bits & bit} for p, bits in got.items()}
    assert {p: k for p, k in got.items() if p} == {p: k for p, k in want.items() if p}


def jobs(spark, f):
    sc = spark.sparkContext
    sc.setJobGroup("counted", "")
    try:
        return f(), len(sc.statusTracker().getJobIdsForGroup("counted"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_objects_are_inferred_together(spark):
    rows = [("x", '{"a": 1, "b": {"c": "t"}}'), ("x", '{"a": 2.5, "l": [{"n": 1}, {"n": "s"}]}'), ("y", '{"a": "s"}'), ("y", "{broken"), ("y", '{"a": 1, "a": 2}'),
            (None, '{"a": true} trailing'), ("z", "[1, [2.0]]"), ("z", "7"), ("e", ""), ("e", None), ("n", ' \n{"deep": ' + "[" * 900 + "]" * 900 + "}")]
    df = spark.createDataFrame(rows, "o string, j string").repartition(4)
    types, n = jobs(spark, lambda: infer_object_types(df, "j", "o"))
    assert types.pop("n").keys() >= {("deep",)}
    assert types == {"x": {("a",): {"int", "float"}, ("b", "c"): {"str"}, ("l",): {"array"}, ("l", ELEMENT, "n"): {"int", "str"}}, "y": {("a",): {"str"}},
                     None: {("a",): {"bool"}}, "z": {(): {"array"}, (ELEMENT,): {"int", "array"}, (ELEMENT, ELEMENT): {"float"}}}
    assert n <= 4  # the stages of one query, and not one per level, of which there are 900
    assert infer_object_types(df.limit(0), "j", "o") == {} and infer_json_types(df.limit(0), "j") == {}


def test_keys_that_are_data_are_named(spark):
    df = spark.range(500).selectExpr("concat('{\"id', id, '\": {\"v\": 1}}') AS j")
    with pytest.raises(ValueError, match="more than 300 paths.*id9"):
        infer_json_types(df, "j", most_paths=300)
    assert len(infer_json_types(df, "j")) == 500


def test_tasks_hold_few_paths(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(rel, "_HELD_PATHS", 10)
    batch = pa.RecordBatch.from_arrays([pa.array(["o"] * 50), pa.array([json.dumps({f"k{i}": i}) for i in range(50)])], names=["object", "text"])
    parts = list(rel._task_kinds([batch]))
    assert len(parts) >= 5 and {json.loads(p)[0] for t in parts for p in t.column(1).to_pylist() if p != "[]"} == {f"k{i}" for i in range(50)}


def test_columns_of_several_objects(spark):
    rows = [("x", 1, '{"a": 1, "only": "x", "m": 1}'), ("x", 2, '{"a": null, "m": "t"}'), ("y", 3, '{"a": "s", "m": 2}'), (None, 4, '{"a": 2.5}'), ("x", 5, "{broken")]
    df = spark.createDataFrame(rows, "o string, id int, j string")
    out = convert_objects(df, "j", "o", infer_object_types(df, "j", "o"), keep=["id"])
    assert out.columns == ["id", "a_int", "a_float", "a_str", "m_int", "m_str", "only"]
    got = {r.id: tuple(r)[1:] for r in out.collect()}
    assert got == {1: (1, None, None, 1, None, "x"), 2: (None, None, None, None, "t", None), 3: (None, None, "s", 2, None, None),
                   4: (None, 2.5, None, None, None, None), 5: (None,) * 6}
