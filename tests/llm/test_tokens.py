import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tests.llm.conftest import ODD_TEXTS
from tidewater.llm import best_fit as bf, bpe, token_output as to, word_tokens as wt
from tidewater.llm.queries import tokenizer_path

BYTES, WORDS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")
MIXED = st.text(alphabet=st.one_of(st.characters(max_codepoint=0x24F), st.sampled_from(list("aeinrst   \n'Ω中𝔸́")),
                                   st.characters(codec="utf-8")), max_size=60)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return {p: Tokenizer.from_file(p) for p in (BYTES, WORDS)}


@settings(max_examples=150, deadline=None)
@given(st.lists(MIXED, min_size=1, max_size=4))
def test_ids_are_those_of_the_library(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTES) if not hasattr(test_ids_are_those_of_the_library, "t") else test_ids_are_those_of_the_library.t
    test_ids_are_those_of_the_library.t = t
    model = bpe.load(BYTES)
    for x, ids in zip(texts, model.encode_batch(texts)):
        assert ids.tolist() == t.encode(x, add_special_tokens=False).ids
        assert model.decode(ids).decode("utf-8", "replace") == t.decode(ids.tolist(), skip_special_tokens=False) == x


@pytest.mark.parametrize("text", ["<|endoftext|>", "a<|endoftext|><|endoftext|> b", "x" * 3000, "é" * 1500, " ", "\n\n a", "'s't'LL",
                                  "<|startoftext|> A", "\x1c\x85  x"])
def test_special_tokens_and_long_words(library, text):
    assert bpe.load(BYTES).encode_batch([text])[0].tolist() == library[BYTES].encode(text, add_special_tokens=False).ids
    got = np.frombuffer(wt.load(WORDS).encode([text])[0], "<u4").tolist()
    assert got == library[WORDS].encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(MIXED)
def test_word_ids_are_those_of_the_library(text):
    t = wt.load(WORDS)
    assert np.frombuffer(t.encode([text])[0], "<u4").tolist() == t.library.encode(text, add_special_tokens=False).ids


def test_memory_of_words_may_be_cleared(monkeypatch, library):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 5)
    monkeypatch.setattr(wt, "KNOWN_WORDS", 5)
    a, b = bpe.ByteBpe(BYTES), wt.WordTokenizer(WORDS)
    for i in range(6):
        text = f"word{i} other{i} and more of those {i}"
        assert a.encode_batch([text])[0].tolist() == library[BYTES].encode(text, add_special_tokens=False).ids
        assert np.frombuffer(b.encode([text])[0], "<u4").tolist() == library[WORDS].encode(text, add_special_tokens=False).ids


def test_encode_and_decode_frames(frame, library, small_rows):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(50, "x y"), (50, "x y"), (None, "null id")] + [(1000 + i, t) for i, t in small_rows]
    coded = bpe.encode(frame(rows), BYTES, ["doc_id", "sig"])
    got = bpe.decode(coded, BYTES, ["doc_id", "ids"]).collect()
    assert coded.columns == ["doc_id", "sig", "ids"] and len(got) == len(rows)
    assert sorted((str(r.doc_id), r.decoded, tuple(r.ids)) for r in got) == sorted(
        (str(i), t or "", tuple(library[BYTES].encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert bpe.encode(frame([]), BYTES, ["doc_id"]).collect() == []
    broken = frame([(1, None)]).selectExpr("doc_id", "cast(array(194) as array<int>) as ids")
    assert bpe.decode(broken.union(frame([(2, "")]).selectExpr("doc_id", "cast(null as array<int>)")), BYTES, ["doc_id"]).count() == 2


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit_and_tree_agree(lengths):
    """Both packings are valid and use as many bins as plain best fit decreasing."""
    capacity, free = 50, []
    for n in sorted(lengths, reverse=True):
        fit = [f for f in free if f >= n]
        if fit:
            free.remove(min(fit))
        free.append((min(fit) if fit else capacity) - n)
    bins, offsets = bf.best_fit(np.array(lengths, np.int64), capacity)
    assert len(set(bins.tolist())) == len(free)
    place = sorted(zip(bins.tolist(), offsets.tolist(), lengths))
    for (a, x, n), (b, y, _) in zip(place, place[1:]):
        assert y == (x + n if a == b else 0) and x + n <= capacity
    packed = to.best_fit_decreasing(np.array(lengths, np.int64), capacity)
    assert len(packed) == len(free) and sorted(i for p in packed for i in p) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in p) <= capacity for p in packed)


def sequences(rows):
    out = {}
    for r in rows:
        out.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in out.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
    return out


@pytest.mark.parametrize("items", [7, 20000])
def test_packing_is_gapless_and_tight(spark, frame, library, small_rows, monkeypatch, items):
    """With groups of seven the rounds go up the tree; the result stays tight."""
    monkeypatch.setattr(bf, "GROUP_ITEMS", items)
    rows = [(i, t) for i, t in small_rows] + [(5000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(7, "again"), (7, "again"), (None, "n")]
    got = bf.best_fit_packing(frame(rows), WORDS, capacity=256).collect()
    used = sequences(got)
    total = sum(r.length for r in got)
    assert all(sum(n for _, n in p) <= 256 for p in used.values())
    assert len(used) <= total / 256 * (1.01 if items > 100 else 1.05) + 3
    want = sorted((str(i), len(library[WORDS].encode(t or "", add_special_tokens=False).ids) + 1) for i, t in rows)
    pieces = {}
    for r in sorted(got, key=lambda r: (str(r.doc_id), r.piece)):
        assert r.start == 256 * r.piece
        pieces[str(r.doc_id)] = pieces.get(str(r.doc_id), 0) + r.length
    total_by = {}
    for i, n in want:
        total_by[i] = total_by.get(i, 0) + n
    assert pieces == total_by


def test_pieces_checksum_and_ids(frame, library):
    import zlib

    text = "some words of a document " * 30
    ids = library[WORDS].encode(text, add_special_tokens=False).ids + [0]
    got = sorted(bf.pieces(frame([(4, text)]), WORDS, capacity=64, with_ids=True).collect(), key=lambda r: r.piece)
    assert [i for r in got for i in np.frombuffer(r.ids, "<u4")] == ids and [r.length for r in got[:-1]] == [64] * (len(got) - 1)
    assert all(r.ids_crc32 == zlib.crc32(r.ids) for r in got)


def test_packing_nothing_and_unmergeable(spark, frame):
    assert bf.best_fit_packing(frame([]), WORDS).collect() == []
    rows = spark.createDataFrame([(i, 30) for i in range(50)], "doc_id bigint, length bigint")
    assert rows.count() == bf.pack(rows, 50).select("sequence_id").distinct().count()


def test_matrices_round_trip(spark, frame, library, small_rows, tmp_path):
    rows = [(i, t) for i, t in small_rows] + [(5000 + i, t) for i, t in enumerate(ODD_TEXTS)]
    packed = to.packed_tokens(frame(rows), WORDS, 49407, capacity=128)
    out = f"file://{tmp_path}/packed"
    to.write_packed(packed, out, 128)
    packed = spark.read.parquet(f"{out}/sequences")
    total = 0
    for r in packed.collect():
        assert len(r.ids) == 256 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= 128
        assert r.position_resets == r.cu_seqlens[:-1] and [s.length for s in r.segments] == np.diff(r.cu_seqlens).tolist()
        assert set(np.frombuffer(r.ids, "<u2")[r.n_tokens:]) <= {0}
        total += r.n_tokens
    assert packed.count() <= total / 128 * 1.05 + 12
    texts = {}
    for r in to.documents_of(packed).collect():
        texts.setdefault(r.doc_id, {})[r.piece] = np.frombuffer(r.ids, "<u2")
    for i, t in rows:
        ids = np.concatenate([texts[i][p] for p in sorted(texts[i])]).tolist()
        assert ids == library[WORDS].encode(t or "", add_special_tokens=False).ids + [49407]
    assert to.packed_tokens(frame([]), WORDS, 0).collect() == []


def test_shards_are_bounded(frame, monkeypatch):
    monkeypatch.setattr(to, "SHARD_TOKENS", 40)
    rows = [(i, "a b c d e f g h") for i in range(60)]
    got = to.packed_tokens(frame(rows).coalesce(1), WORDS, 0, capacity=16).collect()
    assert sum(len(r.segments) for r in got) == 60 and len({(r.shard, r.sequence) for r in got}) == len(got)


def test_digest_query_columns(spark, library):
    from tests.llm.conftest import SMALL
    from tidewater.llm.queries import op5_bpe

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = op5_bpe(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in random.Random(0).sample(rows, 60):
        ids = library[BYTES].encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("kept", [1.0, 0.999, 0.7])
def test_groups_stay_bounded_when_little_merges(kept):
    """Items that hardly merge never meet in groups above the bound, and rounds end."""
    left, groups, dealt, rounds = 10**9, 50_000, 0, 0
    while groups > 1:
        left = int(left * kept)
        groups, dealt = bf._next_round(left, groups, dealt)
        rounds += 1
        assert rounds < 200
        if not groups:
            break
        assert left / groups <= bf.GROUP_ITEMS * bf.FAN_IN / (bf.FAN_IN - 1)


def test_barely_merging_documents(spark, monkeypatch):
    """Nearly all pieces longer than half a sequence, in many small groups: all are placed, and short ones fill gaps."""
    monkeypatch.setattr(bf, "GROUP_ITEMS", 10)
    lengths = [60 + i % 30 for i in range(200)] + [20] * 30
    got = bf.pack(spark.createDataFrame(list(enumerate(lengths)), "doc_id bigint, length bigint"), 100).collect()
    used = sequences(got)
    assert len(got) == 230 and all(sum(n for _, n in p) <= 100 for p in used.values()) and len(used) < 215


def test_words_are_remembered_over_generations(monkeypatch, library):
    monkeypatch.setattr(wt, "KNOWN_WORDS", 3)
    t, texts = wt.WordTokenizer(WORDS), [f"common word{i} again{i % 3}" for i in range(12)]
    for x in texts + texts:
        assert np.frombuffer(t.encode([x])[0], "<u4").tolist() == library[WORDS].encode(x, add_special_tokens=False).ids
        assert len(t.known) <= 3 and len(t.older) <= 6
