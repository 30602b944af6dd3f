import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from tests.llm import brute
from tidewater.llm import words as W
from tidewater.llm.features import char_grams


def hashes(texts, **kw):
    return [c.words(i) for c in W.chunks(pa.array(texts, pa.string()), **kw) for i in range(c.last - c.first)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t\x0b\x1cAé　", max_size=30)), min_size=1, max_size=8))
def test_words_are_those_of_the_pattern(texts):
    name = {}
    for got, text in zip(hashes(texts), texts):
        want = brute.words(text)
        assert len(got) == len(want)
        for h, w in zip(got.tolist(), want):
            assert name.setdefault(w, h) == h
    assert len(set(name.values())) == len(name)


def test_lower_is_ascii_only():
    a, b, c, d = hashes(["AbZ", "abz", "É", "é"], lower=True)
    assert a == b and c != d


def test_long_text_and_many_chunks(monkeypatch):
    texts = ["w%d " % i * 50 for i in range(40)] + ["", "z " * 5000]
    whole = hashes(texts)
    monkeypatch.setattr(W, "CHUNK_BYTES", 64)
    split = hashes(texts)
    assert all((a == b).all() for a, b in zip(whole, split)) and len(whole) == len(split) == len(texts)


def test_blocks_of_a_long_text(monkeypatch):
    texts = [" ".join(f"word{i % 977}" for i in range(3000)), "é" * 500 + " x", ""]
    whole = hashes(texts)
    many = [W.grams(whole[0], k) for k in (5, 20)]
    monkeypatch.setattr(W, "BLOCK", 64)
    assert all((a == b).all() for a, b in zip(whole, hashes(texts)))
    assert all((a == W.grams(whole[0], k)).all() for a, k in zip(many, (5, 20)))


def test_grams_agree_for_equal_runs():
    h = hashes(["a b c d e f g h i j k l m n o p q r s t u v a b c d e f g h i j k l m n o p q r s t"])[0]
    for k in (1, 2, 5, 8, 9, 20):
        g = W.grams(h, k)
        assert len(g) == len(h) - k + 1 and g[0] == g[22] and len(np.unique(g)) > 1
    assert len(W.grams(h, 99)) == 0
    assert len(W.shingle_set(h[:3], 5)) == 1 and len(W.shingle_set(h[:0], 5)) == 0


def test_hashes_do_not_depend_on_the_block_they_are_made_in():
    """Texts longer than a block, and words and trigrams across its edge, hash as they do on their own."""
    words = [f"w{i:03d}" * (1 + i % 3) for i in range(500)]
    text = " ".join(words[i * 7 % 500] for i in range(W.NEAR // 3))
    assert len(text) > 2 * W.NEAR
    (whole,) = W.chunks(pa.array([text]))
    (alone,) = W.chunks(pa.array(words))
    known = dict(zip(words, alone.hashes))
    assert [known[w] for w in text.split(" ")] == whole.hashes.tolist()
    tri, data = char_grams(whole, 3), text.encode()
    code = [(int.from_bytes(data[i : i + 3], "little") + (3 << 60)) * 0x9E3779B97F4A7C15 % 2**64 >> 46 for i in range(len(data) - 2)]
    assert tri.tolist() == code
