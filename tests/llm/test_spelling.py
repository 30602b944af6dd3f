import collections
import re
import zlib

import pytest
from hypothesis import given, settings, strategies as st

from tests.llm.brute import ascii_lower
from tests.llm.conftest import ODD_TEXTS
from tidewater.llm import spelling as sp


def plain_words(rows, slip=199):
    count = collections.Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = ascii_lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % slip == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1 :]
            count[w] += 1
    return {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}


def plain_variants(words):
    """{word: (form, root, n, n_near, form_n)}"""
    letters, near = sorted({c for w in words for c in w}), {}
    for w in words:
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))}
        edits |= {w[:i] + c + w[j:] for i in range(len(w) + 1) for c in letters for j in (i, i + 1)}
        near[w] = (edits & words.keys()) - {w}
    best = {w: min(e, key=lambda x: (-words[x], x), default=None) for w, e in near.items()}
    form = {w: b if b and words[b] >= 5 * n else None for (w, n), b in zip(words.items(), best.values())}
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words.get(form[w]))
    return out


def variants(df, **kw):
    rows = sp.spelling_variants(df, **kw).collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: tuple(r)[1:] for r in rows}


def test_against_brute_force(spark, frame, small_rows):
    """All texts of the small table, odd rows, and made-up variants with chains of forms and ties."""
    made = [("letter", 3000), ("lettre", 5), ("leter", 9), ("lettter", 100), ("letttter", 20), ("letters", 600), ("better", 3000), ("xetter", 7),
            ("straße", 50), ("strasse", 9), ("strahe", 6), ("aaaaaa", 5), ("aaaaaaa", 30), ("aaaaaaaa", 200), ("éclair", 5), ("eclair", 25)]
    rows = [(9000 + i, " ".join([w] * n)) for i, (w, n) in enumerate(made)] + [(8000 + i, t) for i, t in enumerate(ODD_TEXTS)]
    rows += small_rows + [(None, "Nameless " * 6), (7, "letterx " * 5), (7, "letterx " * 5)]
    want = plain_variants(plain_words(rows))
    assert variants(frame(rows)) == want
    assert want["letttter"][:2] == ("lettter", "letter") and any(f and r != f for f, r, *_ in want.values())


def test_slips(frame):
    """Deleted characters: every fourth run loses one; runs of the least length then are no words."""
    rows = [(i, "Sixlet sevenly ELEVENTHLY größeren") for i in range(400)]
    want = plain_words(rows, 4)
    got = {w: n for w, n in sp.vocabulary(frame(rows), slip=4).collect()}
    assert got == want and len(got) > 8


def test_empty(spark, frame):
    assert sp.spelling_variants(frame([])).collect() == []
    assert sp.spelling_variants(frame([(1, None), (2, "short words only"), (3, "lonely words")])).collect() == []


WORD = st.text(alphabet="abà", min_size=1, max_size=7)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(WORD, st.integers(1, 9), min_size=2, max_size=40))
def test_ranges_hold_each_near_pair_once(words):
    """Rotations in Python, scanned as tasks do."""
    dealt = []
    for w, n in words.items():
        dealt += [(w[i:] + sp.END + w[:i], "", w, n) for i in range(len(w) + 1)]
        dealt += [(w[i + 1 :] + sp.END + w[:i], w[i], w, n) for i in range(len(w))]
    near, best, group = collections.Counter(), {}, []
    dealt.sort()
    for i, (p, last, w, n) in enumerate(dealt):
        group.append((last, n, w))
        if i + 1 == len(dealt) or dealt[i + 1][0] != p:
            out = []
            sp._range(p, group, out)
            group = []
            for word, k, m, b in out:
                near[word] += k
                best[word] = sp._better((m, b), best.get(word))
    for w in words:
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))}
        edits |= {w[:i] + c + w[j:] for i in range(len(w) + 1) for c in "abà" for j in (i, i + 1)}
        edits = (edits & words.keys()) - {w}
        assert near[w] == len(edits)
        assert best.get(w) == max(((words[x], x) for x in edits), key=lambda x: (x[0], [-ord(c) for c in x[1]] + [0]), default=None)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aB é×中1", max_size=60), st.integers(1, 12))
def test_blocks_cut_between_runs(text, block):
    whole = [w for part in sp.runs(text) for w in part]
    old, sp.BLOCK = sp.BLOCK, block
    try:
        assert [w for part in sp.runs(text) for w in part] == whole
    finally:
        sp.BLOCK = old
    assert [w.decode("latin-1") for w in whole] == [ascii_lower(w) for w in re.findall("[A-Za-zÀ-ÿ]+", text)]


def test_chains_of_many_steps(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(13)] + [("x", "w4"), ("y", "z")], "word string, form string")
    got = {r.word: r.root for r in sp.roots(forms).collect()}
    assert got == {f"w{i}": "w13" for i in range(13)} | {"x": "w13", "y": "z"}


def test_long_texts(frame):
    rows = [(1, "longish " * 300_000), (2, "x" * 2_500_000 + " longish")]
    got = sp.vocabulary(frame(rows), slip=10**9).collect()
    assert [tuple(r) for r in got] == [("longish", 300_001)]


@pytest.mark.parametrize("run,code,want", [(b"abcdef", 6, b"bcdef"), (b"abcdef", 11, b"abcde")])
def test_slipped(run, code, want):
    assert sp.slipped(run, code) == want
