import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm import brute
from tests.llm.test_tokens import sequences
from tidewater.llm import substring_dedup as sd
from tidewater.llm.exchange import materialized

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in cp.STAGES:
        docs = materialized(spark, stage(spark, docs, SMALL), name)
        out.append((name, docs))
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_keep_the_columns_and_narrow_the_rows(stages):
    names = stages[0][1].columns
    for (_, before), (_, after) in zip(stages[:-2], stages[1:-1]):
        assert after.columns == names and ids(after) <= ids(before) and after.count() == len(ids(after))


def test_filters_reject_labelled_documents(spark, stages):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    for step, column, bad in ((1, "quality", 0), (2, "toxic", 1)):
        before, after = ids(stages[step - 1][1]), ids(stages[step][1])
        known = [i for i in before if i in labels]
        wrong = sum((i in after) == (labels[i][column] == bad) for i in known)
        assert wrong <= 0.1 * len(known)


def test_one_document_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[2][1].collect()]
    assert ids(stages[3][1]) == {c for _, c in brute.components(rows).values()}


def test_repeated_passages_go(stages):
    before = {r.doc_id: r for r in stages[3][1].collect()}
    want = brute.without_repeats([(i, r.text) for i, r in before.items()])
    for r in stages[4][1].collect():
        _, removed, kept = want[r.doc_id]
        assert (r.text, r.n_chars) == ((kept, len(kept)) if removed else (before[r.doc_id].text, before[r.doc_id].n_chars))


def test_all_that_is_left_is_packed(stages):
    packed = stages[5][1].collect()
    assert {r.doc_id for r in packed} == ids(stages[4][1])
    used = sequences(packed)
    assert len(used) <= -(-sum(r.length for r in packed) // 2048) + 1


def test_run_gives_the_last_stage(spark, stages):
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, cp.run(spark, SMALL).select(key).collect())) == sorted(map(tuple, stages[5][1].select(key).collect()))


def test_no_documents(spark, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{SMALL}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_odd_documents(spark, tmp_path):
    """Null, empty and repeated texts, repeated rows, null metadata and extra columns pass every stage."""
    rows = [(i, t, None, None, None, "extra") for i, t in enumerate([None, "", "a b c", "a b c", "word " * 4000])] + [(2, "a b c", "en", "s", 5, "x")] * 2
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in cp.STAGES[2:4]:
        docs = materialized(spark, stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == frame.columns
    assert ids(docs) == {0, 1, 2, 4}
    assert cp.pack(spark, docs, str(tmp_path)).agg(F.countDistinct("doc_id")).first()[0] == 4


def test_texts_of_null_and_repeated_ids(spark, frame):
    """Texts that don't link all stay, whatever their doc_id; passages repeated between them go; rows don't multiply."""
    passage = " ".join(f"p{i}" for i in range(25))
    own = {i: " ".join(f"w{i}_{j}" for j in range(60)) for i in range(6)}
    rows = [(None, f"{own[0]} {passage}"), (None, f"{own[1]} {passage}"), (None, f"{own[1]} {passage}"), (None, None),
            (7, own[2]), (7, f"{own[3]} {passage}"), (7, f"{own[3]} {passage}"), (8, own[2]), (None, own[2]), (9, own[4])]
    kept = cp.near_duplicates(spark, frame(rows), "")
    assert kept.columns == frame([]).columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    want = [(None, rows[0][1]), (None, rows[1][1]), (None, None), (7, own[2]), (7, rows[5][1]), (9, own[4])]
    assert got == sorted(want, key=str)
    cut = [(r.doc_id, r.text) for r in cp.substring_dedup_stage(spark, frame(want), "").collect()]
    want = [(None, own[0]), (None, own[1]), (None, None), (7, own[2]), (7, rows[5][1]), (9, own[4])]
    assert sorted(cut, key=str) == sorted(want, key=str)
    twice = cp.substring_dedup_stage(spark, frame([(7, rows[5][1]), (9, rows[0][1]), (9, rows[0][1])]), "")
    assert sorted((r.doc_id, r.text) for r in twice.collect()) == [(7, rows[5][1]), (9, own[0]), (9, own[0])]


def test_texts_of_one_id_have_several_homes():
    tags = np.arange(100, dtype=np.uint64) * np.uint64(12345678901)
    assert len(set(sd._homes_of(np.full(100, sd.LAST), tags, 8).tolist())) == 8


def test_texts_reach_python_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([[batch.nbytes]], names=["n"])

    docs = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))
    stage = cp._in_small_batches(lambda spark, docs, sf_dir: docs.mapInArrow(sizes, "n bigint"))
    n = [r.n for r in stage(spark, docs, "").collect()]
    assert sum(n) > 40_000_000 and max(n) < 20 << 20
