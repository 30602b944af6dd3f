import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tests.llm.conftest import ODD_TEXTS, SMALL
from tests.llm.test_tokens import MIXED, library  # noqa: F401 - fixture
from tidewater.llm import byte_ids, first_fit as ff
from tidewater.llm.queries import op13_first_fit_packing, tokenizer_path

BYTES, WORDS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")


@settings(max_examples=200, deadline=None)
@given(MIXED)
def test_ids_are_those_of_the_library(text):
    t = byte_ids.load(BYTES)
    assert t.quick and t.encode(text).tolist() == t.library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["x" * 300_000, " " * 200_000, "\n" * 1000 + "a", "a<|endoftext|>b", "é" * 5000, "ab " * 50_000 + " " * 60_000])
def test_long_words_and_spaces(text):
    t = byte_ids.load(BYTES)
    assert t.encode(text).tolist() == t.library.encode(text, add_special_tokens=False).ids


def test_other_files_go_through_the_library():
    t = byte_ids.load(WORDS)
    assert t.quick is None and t.encode("Some words").tolist() == t.library.encode("Some words", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=70))
def test_tournament_tree_is_first_fit_decreasing(lengths):
    room, want = [], [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        b = next((b for b, r in enumerate(room) if r >= lengths[i]), len(room))
        if b == len(room):
            room.append(50)
        room[b] -= lengths[i]
        want[i] = b
    assert ff.first_fit_decreasing(np.array(lengths, np.int64), 50).tolist() == want


def check_places(bins, lengths, capacity):
    """Each id in one place; all bins full but those whose lengths are distinct powers of two."""
    used = [sum(n for _, _, n in b) for b in bins]
    rest = [u for u in used if u != capacity]
    assert all(u & (u - 1) == 0 for u in rest) and len(set(rest)) == len(rest)
    spans = {}
    for b in bins:
        for doc, start, n in b:
            assert n > 0
            spans.setdefault(doc, []).append((start, n))
    for doc, n in enumerate(lengths):
        at = 0
        for start, m in sorted(spans[doc]):
            assert start == at
            at += m
        assert at == n


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=60), st.sampled_from([1, 7, 32, 50]))
def test_all_sequences_are_full(lengths, capacity):
    check_places(ff.packed(lengths, capacity), lengths, capacity)


def test_few_documents_are_cut():
    lengths = np.random.default_rng(1).integers(1, 3000, 4000).tolist()
    bins = ff.packed(lengths, 1024)
    check_places(bins, lengths, 1024)
    pieces = sum(map(len, bins))
    assert pieces < sum(-(-n // 1024) for n in lengths) * 1.1


def packed_ids(rows, ids_of, capacity=1024):
    """Pieces of a result held against the ids of the library; returns the sequences' lengths."""
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.sequence_length))
    for doc, pieces in docs.items():
        ids, at = np.array(ids_of[doc] + [0], "<u4"), 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for places in sequences.values():
        at = 0
        for offset, n, _ in sorted(places):
            assert offset == at
            at += n
        assert {p[2] for p in places} == {at} and at <= capacity
        assert at == capacity or at & (at - 1) == 0
    return docs.keys()


def test_query(spark, library):  # noqa: F811
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    ids = {i: e.ids for i, e in zip(texts, library[BYTES].encode_batch([t or "" for t in texts.values()], add_special_tokens=False))}
    assert packed_ids(op13_first_fit_packing(spark, SMALL).collect(), ids) == texts.keys()


def test_odd_rows_in_several_groups(frame, library, small_rows, monkeypatch):  # noqa: F811
    monkeypatch.setattr(ff, "GROUP_BYTES", 20_000)
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(100, "very long " * 30_000)] + [(1000 + i, t) for i, t in small_rows]
    got = ff.first_fit_packing(frame(rows), BYTES, 64, with_ids=True).collect()
    ids = {i: library[BYTES].encode(t or "", add_special_tokens=False).ids for i, t in rows}
    assert packed_ids(got, ids, 64) == ids.keys()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got) and len({r.sequence_id >> 36 for r in got}) > 3


def test_repeated_and_null_ids(frame):
    rows = [(5, "same text")] * 40 + [(None, "none")] * 30 + [(5, "another")]
    got = ff.first_fit_packing(frame(rows), BYTES, 16).collect()
    alone = {t: len(byte_ids.load(BYTES).encode(t)) + 1 for _, t in rows}
    assert sum(r.length for r in got) == sum(alone[t] for _, t in rows)
    assert sum(r.length for r in got if r.doc_id is None) == 30 * alone["none"]
    assert ff.first_fit_packing(frame([]), BYTES).collect() == []


def test_groups_beyond_the_bound_are_packed_in_parts(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(ff, "GROUP_TOKENS", 30)
    monkeypatch.setattr(ff, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": staticmethod(lambda: 2)}))}))
    batch = pa.RecordBatch.from_arrays([pa.array([1] * 20 + [2] * 20), pa.array(range(40)), pa.array(["a b c d e f g"] * 40)], names=["g", "d", "t"])
    out = pa.Table.from_batches(ff._pack_sorted([batch.slice(0, 7), batch.slice(7)], BYTES, 16, 0, False)).to_pylist()
    assert sum(r["length"] for r in out) == 40 * 8 and {r["doc_id"] for r in out} == set(range(40))
    assert min(r["sequence_id"] for r in out) == 2 << 36
