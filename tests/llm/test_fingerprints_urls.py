import datetime
import hashlib

import numpy as np
import pytest

from tests.llm import brute
from tests.llm.conftest import ODD_TEXTS, SMALL
from tidewater.llm import fingerprints as fp, url_filter as uf
from tidewater.llm.queries import op1_url_filter, op10_fingerprints


def edited(rows):
    """{(doc_id, text): (edited text, next text)}."""
    order = sorted(set(rows), key=lambda r: -r[0])
    out = {}
    for n, (i, t) in enumerate(order):
        following, m = order[(n + 1) % len(order)][1], len(t) // 3
        out[i] = t[: len(t) - m] + following[:m], following
    return out


def test_edited_texts_and_likeness(spark, small_rows):
    got = {r.doc_id: r for r in op10_fingerprints(spark, SMALL).collect()}
    want, texts = edited(small_rows), dict(small_rows)
    off = []
    for i, r in got.items():
        text, following = want[i]
        assert (r.n_chars, r.edited_sha256) == (len(texts[i]), hashlib.sha256(text.encode()).hexdigest())
        off.append((r.near_edited - brute.generalised_jaccard(texts[i], text), r.near_next - brute.generalised_jaccard(texts[i], following)))
    assert len(got) == len(texts) and abs(np.mean(off, axis=0)).max() < 0.02 and np.std(off) < 0.1
    by_text = {}
    for i, r in got.items():
        by_text.setdefault(texts[i], set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())


def test_collision_rate_is_the_generalised_jaccard_similarity(spark):
    a, b = "x x x x y y z " * 2 + "q", "x y y y y z z w " * 2
    rows = spark.createDataFrame([(1, a, b)], "k bigint, a string, b string")
    got = fp.fingerprints(fp.minima(rows, "k", ["a", "b"], 2048), "k", 2, 2048).first()
    want = brute.generalised_jaccard(a, b)
    assert abs(got.agree / 2048 - want) < 4 * (want * (1 - want) / 2048) ** 0.5
    assert len(got.fingerprint0) == 8 * 2048


def test_odd_rows(spark, frame):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(20, "w " * 40000), (21, "b a"), (21, "b a"), (None, "a b")]
    got = fp.edited_fingerprints(frame(rows)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[0][0].fingerprint == by[1][0].fingerprint == by[2][0].fingerprint == fp.NO_TERM * fp.SAMPLES
    assert by[1][0].near_next == 1.0 and by[1][0].edited_sha256 == hashlib.sha256(b"").hexdigest()
    assert by[21][0] == by[21][1] and by[21][0].fingerprint == by[None][0].fingerprint
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert by[None][0].n_chars == 3  # comes last, so the first document follows: (21, "b a")
    assert by[None][0].edited_sha256 == hashlib.sha256(b"a b"[:2] + b"b").hexdigest()
    one = fp.edited_fingerprints(frame([(1, "abc def")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abc dab").hexdigest() and one.near_next == 1.0
    assert fp.edited_fingerprints(frame([])).collect() == []


def test_plan_is_native(spark, small):
    plan = fp.minima(small, "doc_id", ["text"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


DAY = datetime.date(2024, 5, 1)


def days(n):
    return DAY + datetime.timedelta(n)


@pytest.fixture(scope="module")
def lists(spark):
    rows = [("block", "Bad.example.com", days(0), "add"), ("block", "bad.example.com", days(10), "remove"),
            ("block", "bad.example.com", days(20), "add"), ("block", "example.org", days(0), "add"),
            ("allow", "good.example.org", days(5), "add"), ("block", "site.net/spam", days(0), "add"),
            ("block", "tie.net", days(0), "add"), ("allow", "tie.net", days(0), "add"), ("block", "both.net", days(3), "add"),
            ("block", "both.net", days(3), "remove"), ("block", None, days(0), "add"), ("block", "x.net", None, "add"), ("block", "y.net", days(0), "odd")]
    return spark.createDataFrame(rows, "list string, value string, day date, action string")


def verdicts(spark, lists, rows):
    captures = spark.createDataFrame(rows, "page_id bigint, url string, fetched_on date, host string")
    return {r.page_id: r for r in uf.temporal_filter(captures, lists).collect()}


def test_entries_count_as_of_the_fetch_day(spark, lists):
    url = "http://www.bad.example.com/x"
    got = verdicts(spark, lists, [(n, url, days(n), "?") for n in (-1, 0, 9, 10, 19, 20, 99)])
    assert {n: r.blocked for n, r in got.items()} == {-1: False, 0: True, 9: True, 10: False, 19: False, 20: True, 99: True}
    assert (got[9].entry, got[9].valid_from, got[9].valid_to) == ("bad.example.com", days(0), days(10))
    assert got[99].valid_to is None and got[10].n_active == 0 and got[10].host == "www.bad.example.com"


def test_the_most_specific_entry_decides(spark, lists):
    got = verdicts(spark, lists, [
        (1, "https://a.good.example.org/p?q", days(6), None), (2, "https://a.good.example.org", days(4), None),
        (3, "HTTP://User@SITE.net:80/Spam/x", days(1), None), (4, "http://site.net/spamless", days(1), None),
        (5, "http://tie.net", days(1), None), (6, "http://both.net", days(4), None), (7, "http://notexample.org", days(4), None)])
    assert [got[i].blocked for i in range(1, 8)] == [False, True, True, False, False, False, False]
    assert got[1].n_active == 2 and got[1].list == "allow" and got[5].n_active == 2


def test_odd_captures_and_empty_lists(spark, lists):
    rows = [(1, None, days(1), None), (2, "", days(1), None), (3, "no scheme", days(1), None), (4, "http://bad.example.com", None, None),
            (None, "http://example.org", days(1), None), (5, "http://example.org/" + "y" * 100000, days(1), None),
            (6, "http://example.org", days(1), None), (6, "http://example.org", days(1), None)]
    captures = spark.createDataFrame(rows, "page_id bigint, url string, fetched_on date, host string")
    got = uf.temporal_filter(captures, lists).collect()
    assert len(got) == len(rows) and sorted(r.page_id for r in got if r.blocked and r.page_id) == [5, 6, 6]
    assert [r.blocked for r in got if r.page_id is None] == [True]
    assert not any(r.blocked for r in uf.temporal_filter(captures, lists.limit(0)).collect())
    assert uf.temporal_filter(captures.limit(0), lists).collect() == []


def test_query_has_a_verdict_for_every_page(spark):
    assert op1_url_filter(spark, SMALL).count() == spark.read.parquet(f"{SMALL}/pages.parquet").count()
