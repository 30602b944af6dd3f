import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tests.llm.brute import ascii_lower
from tidewater.llm import bitmap_rank as br, merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        first = i // 8 * 8
        out.append(("".join(level[first:i]), "".join(level[i + 1 : first + 8])))
        i //= 8
    return out


def plain_manifest(rows):
    """Sorted (doc_id, leaf, subroot, root, proof, folded root, verified) of rows with the columns of documents."""
    def leaf(r, text):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))

    groups, out = {}, []
    for r in rows:
        hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0
        changed = leaf(r, None if r.text is None else ascii_lower(r.text)) if hit else None
        groups.setdefault(r.lang, []).append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), changed, r.doc_id))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: x[:3])
        trees[g] = tree([x[2] for x in groups[g]])
    top = tree([trees[g][-1][0] for g in names])
    for j, g in enumerate(names):
        for i, (_, _, own, changed, doc_id) in enumerate(groups[g]):
            steps, h = path(trees[g], i) + path(top, j), changed or own
            for left, right in steps:
                h = sha(left + h + right)
            out.append((str(doc_id), own, trees[g][-1][0], top[-1][0], sha("".join(a + b for a, b in steps)), h, h == top[-1][0]))
    return sorted(out)


def manifest(df, **kw):
    return sorted((str(r.doc_id), *r[1:7]) for r in merkle.merkle_manifest(df, **kw).collect())


DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def odd(spark, small):
    rows = [(None, "a", None, "s", 3), (None, None, None, None, None), (None, "B", None, "s", 3), (None, "B", None, "s", 3), (5, "Zz", "", None, None),
            (5, "Zy", "", None, None), (5, "Zy", "", None, None), (-7, "", "zz", "", 0), (1 << 40, "é" * 70000, "zz", None, 1),
            (-(1 << 62), "x", "zz", None, 1), (1 << 62, "x", "zz", None, 1), (65535, "x", "zz", None, 1), (65536, "x", "zz", None, 1)]
    rows += [(1, "Copy", "copies", "s", 4)] * 70 + [(i, "alone", f"lang{i}", "s", 1) for i in range(70)]
    return spark.createDataFrame(rows, DOCUMENT).unionByName(small.select("doc_id", "text", "lang", "source", "n_chars"))


@pytest.mark.parametrize("depth", [1, 2, 4])
def test_against_plain_trees(odd, depth):
    """Ties, nulls, lone leaves and ids of all sizes, with several rounds of blocks and with one."""
    want = plain_manifest(odd.collect())
    assert manifest(odd.withColumns({"sig": merkle.F.lit("x"), "grp": merkle.F.lit(1), "pos": merkle.F.lit(2)}), depth=depth) == want
    assert {r[6] for r in want} == {True, False}


def test_copies_are_written_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "COPIES", 9)
    rows = spark.createDataFrame([(1, "Same", "en", "s", 4)] * 100 + [(2, "b", "en", "s", 1)], DOCUMENT)
    assert manifest(rows) == plain_manifest(rows.collect())


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], DOCUMENT)
    assert manifest(empty) == []
    one = spark.createDataFrame([(9, "A", None, None, None)], DOCUMENT)
    got = manifest(one)
    assert got == plain_manifest(one.collect()) and got[0][1] == got[0][2] == got[0][3] and got[0][4] == sha("")


def test_extra_fields_and_groups(spark):
    rows = spark.createDataFrame([(i, f"T{i}", f"s{i % 3}") for i in range(30)], "id long, body string, site string")
    got = merkle.merkle_manifest(rows, "id = 7", ["id", "body"], "site", "id", "body").collect()
    assert [r.doc_id for r in got if not r.verified] == [7] and len({r.subroot for r in got}) == 3
    assert {r.leaf for r in got} == {sha(f"{len(str(i))}:{i}{len(f'T{i}')}:T{i}") for i in range(30)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 65535), min_size=1, max_size=300), st.booleans())
def test_containers_answer_ranks(keys, dense):
    keys = keys + list(range(500, 500 + 5 * br.FEW // 4)) if dense else keys
    low, rows = np.unique(keys, return_counts=True)
    bits, extra = br.compressed(low, rows)
    assert (len(bits) == 1 << 13) == (len(low) > br.FEW)
    back = br.expanded(bits, extra)
    assert back[0].tolist() == low.tolist() and back[1].tolist() == rows.tolist()
    rank, same = br.Directory(bits, extra).rank(low)
    assert same.tolist() == rows.tolist() and rank.tolist() == (np.cumsum(rows) - rows).tolist()


@pytest.mark.parametrize("hot", [1 << 18, 40])
def test_ranks_of_a_table(spark, monkeypatch, hot):
    """Dense, sparse, negative, null and repeated keys; with a small bound most containers are shared among tasks."""
    monkeypatch.setattr(br, "HOT", hot)
    draw = random.Random(3)
    rows = [("a", k) for k in range(-3000, 9000, 1)] + [("a", 5)] * 300 + [("b", draw.randrange(-2**63, 2**63)) for _ in range(500)]
    rows += [("b", None)] * 200 + [("", 7), ("c", None)]
    df = spark.createDataFrame(rows, "g string, key bigint").repartition(5)
    got = {(r.g, r.key): (r["rank"], r.same, r.n) for r in br.ranked(df, "g", "key").collect()}
    for g in "abc":
        keys = sorted((k is not None, k or 0) for x, k in rows if x == g)
        at = {}
        for i, k in enumerate(keys):
            at.setdefault(k, i)
        for k, i in at.items():
            assert got[(g, k[1] if k[0] else None)] == (i, keys.count(k), len(keys)) or len(keys) > 10000
        if len(keys) > 10000:
            assert all(got[(g, k[1])][0] == i for k, i in at.items()) and got[(g, 5)][1] == 301
    assert df.count() == br.ranked(df, "g", "key").count()


def test_merging_goes_container_by_container():
    parts = [("g", 0, np.arange(10)), ("g", 0, np.arange(5, 20)), ("g", 1, np.arange(3)), ("h", None, np.zeros(1, int))]
    batch = br._table([br._part(g, hi, low, np.ones(len(low), np.int64)) for g, hi, low in parts])
    got = pa.Table.from_batches(br._merge_sorted([batch.slice(0, 1), batch.slice(1)])).to_pylist()
    assert [(r["grp"], r["hi"], r["total"]) for r in got] == [("g", 0, 25), ("g", 1, 3), ("h", None, 1)]
