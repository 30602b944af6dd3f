import random
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import ODD_TEXTS
from tidewater.llm import exchange, heavy, jaccard_join as jj, substring_dedup as sd
from tidewater.llm.exchange import SHUFFLES_GO, materialized


def near_copies(seed, groups=4, copies=25, length=60, passage=()):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(4000)]
    out = []
    for _ in range(groups):
        base = rng.choices(vocab, k=rng.choice([8, length, 2 * length]))
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            out.append(" ".join([*w, *(passage if rng.random() < 0.3 else ())]))
    out += [" ".join([*rng.choices(vocab, k=rng.randrange(1, 40)), *passage]) for _ in range(30)]
    rng.shuffle(out)
    return list(enumerate(out))


def joined(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jj.jaccard_components(df).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_brute_force(frame, seed):
    rows = near_copies(seed, passage=[f"p{i}" for i in range(40)])
    rows += [(len(rows) + i, t) for i, t in enumerate(ODD_TEXTS)] + [(900 + i, "the same line of words again") for i in range(9)]
    assert joined(frame(rows)) == brute.components(rows)


@pytest.mark.parametrize("light", [0, 20, 10**6])
def test_light_and_heavy_sets_and_blocks_agree(frame, monkeypatch, light):
    """Whatever the boundary; with short lists, hubs and blocks of a cluster all in use."""
    monkeypatch.setattr(jj, "boundary", lambda sets: light)
    monkeypatch.setattr(jj, "SHORT", 3)
    monkeypatch.setattr(jj, "BLOCK_SETS", 7)
    rows = near_copies(3, groups=3, copies=20)
    assert joined(frame(rows)) == brute.components(rows)


def test_join_of_repeated_rows_nulls_and_nothing(frame):
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (1, "A b c d e f"), (None, "a b c d e f"), (7, None), (7, ""), (None, "q")]
    got = sorted(map(tuple, jj.jaccard_components(frame(rows)).collect()), key=str)
    assert got == sorted([(3, 2, 1), (3, 2, 1), (1, 2, 1), (None, 2, 1), (7, 0, 7), (7, 0, 7), (None, 1, None)], key=str)
    assert jj.jaccard_components(frame([])).collect() == []


def test_heavy_keys_leave_the_result_alone(frame, monkeypatch):
    rows = [(i, "common words of a passage that all of them share in full " + " ".join(f"r{i}_{j}" for j in range(i % 7)))
            for i in range(60)]
    want = brute.components(rows)
    assert joined(frame(rows)) == want
    monkeypatch.setattr(heavy, "SHARE", 2.0)  # none is heavy
    assert joined(frame(rows)) == want


def test_boundary_is_where_costs_are_least(spark):
    sets = spark.createDataFrame([(1, 10, [], 3, 4, 100), (2, 1000, [], 200, 201, 300)], jj.SETS)
    assert jj.boundary(sets) == 10


def removed(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in sd.substring_dedup(df).collect()}


def passages(seed):
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(300)]
    shared = [rng.choices(vocab, k=rng.choice([19, 20, 21, 60])) for _ in range(5)]
    rows = []
    for i in range(60):
        parts = [rng.choices(vocab, k=rng.randrange(0, 30)) for _ in range(3)]
        text = [w for p in parts for w in [*p, *rng.choice(shared)]]
        rows.append((i, "  ".join(text) + "\n"))
    return rows + [(100, "echo " * 100), (101, "a b " * 40), *((200 + i, t) for i, t in enumerate(ODD_TEXTS))]


@pytest.mark.parametrize("records", ["3", "10000"])
def test_removed_words_match_brute_force(spark, frame, records):
    rows = passages(int(records))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
    try:
        assert removed(frame(rows).repartition(5)) == brute.without_repeats(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_removal_over_the_small_table(small, small_rows):
    assert removed(small) == brute.without_repeats(small_rows)


def test_factors_are_copies_of_earlier_words(frame):
    rows = passages(5)
    texts = {i: brute.words(t) for i, t in rows}
    n = 0
    for r in sd.substring_dedup(frame(rows)).collect():
        for f in r.factors:
            n += 1
            assert f.length >= 20 and (f.ref_doc, f.ref_start) < (r.doc_id, f.start)
            assert texts[r.doc_id][f.start : f.start + f.length] == texts[f.ref_doc][f.ref_start : f.ref_start + f.length]
    assert n > 20


def test_removal_of_repeated_rows_nulls_and_nothing(frame):
    text = " ".join(f"u{i}" for i in range(25))
    got = sorted((r.doc_id, r.n_removed) for r in sd.substring_dedup(frame([(2, text), (2, text), (5, text)])).collect())
    assert got == [(2, 0), (2, 0), (5, 25)]
    got = {r.doc_id: r.n_removed for r in sd.substring_dedup(frame([(None, text), (9, text)])).collect()}
    assert got == {None: 25, 9: 0}
    assert sd.substring_dedup(frame([])).collect() == []


def test_blobs_round_trip():
    h = np.array([2**63 + 5, 77, 2**40], np.uint64)
    raw = exchange.low_bytes(h, 7).ravel()
    assert (exchange.from_low_bytes(raw, 7, 3) & np.uint64(2**56 - 1) == h & np.uint64(2**56 - 1)).all()
    assert (exchange.bucket_of(h, 10) == [5, 0, 0]).all()


def test_a_bucket_of_shingles_is_small():
    """Counting a bucket's shingles takes a task less than 64 MB of Python memory, however many postings there are in all."""
    rng, n = np.random.default_rng(1), 3_000_000
    sh, sig = np.repeat(rng.integers(0, 2**64, n // 2, np.uint64), 2), rng.integers(1, 2**64, n, np.uint64)
    mine = exchange.bucket_of(sh, exchange.buckets_for(n, jj.HELD)) == 0
    held = exchange.dealt(np.zeros(mine.sum(), np.int32), jj.POSTING, exchange.low_bytes(sh[mine], jj.KEPT), sig[mine])
    table = pa.Table.from_batches([held])
    tracemalloc.start()
    out = jj._count((pa.scalar(jj.POSTING), pa.scalar(0)), table, 2)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 64 << 20
    assert len(exchange.column(out, "a", np.uint64)) == mine.sum()


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    before, setting = _shuffle_files(spark), spark.conf.get(SHUFFLES_GO, None)
    df = spark.range(20_000).groupBy((F.col("id") % 5000).alias("k")).agg(F.count("*").alias("n"))
    out = materialized(spark, df, "counts")
    end = time.monotonic() + 10  # files are removed beside the session
    while _shuffle_files(spark) - before and time.monotonic() < end:
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert out.agg(F.sum("n")).first()[0] == 20_000 and spark.conf.get(SHUFFLES_GO, None) == setting
