import collections
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import ODD_TEXTS, SMALL
from tidewater.llm import co_training as ct, linear, quality_rules as qr, toxicity as tx
from tidewater.llm.queries import LEARN

TABLE = "/root/testdata/sf0.01"
EMPTY = [linear.Sparse.from_rows([]), linear.Sparse.from_rows([])]


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{TABLE}/documents.parquet"), spark.read.parquet(f"{TABLE}/labels.parquet")


def held_out(result, labels, column, score):
    """(correct, all) on labelled rows that no model has seen, and the same for the commonest label."""
    rows = result.join(labels.where(f"not ({LEARN})"), "doc_id").select(score, column).collect()
    right = sum((s >= 0.5) == bool(y) for s, y in rows)
    ones = sum(y for _, y in rows)
    return right / len(rows), max(ones, len(rows) - ones) / len(rows)


def brute_nearest(index, hashes, k):
    """All cosines, by whole vectors."""
    t, w = index.vector(hashes)
    dense = np.zeros((len(index.doc), len(index.terms)))
    dense[index.example, np.repeat(np.arange(len(index.terms)), np.diff(index.at))] = index.weight
    s = np.round(dense[:, t] @ w, 6)
    kth = np.sort(s)[::-1][min(k, len(s)) - 1]
    hit = np.flatnonzero((s >= kth) & (s > 0))
    return hit[np.lexsort((hit, -s[hit]))], s


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(4)
    n, v = 700, 40
    terms = np.sort(rng.integers(1, 2**63, v).astype(np.uint64))
    rows = [np.sort(rng.choice(v, rng.integers(1, 6), replace=False)) for _ in range(n)]
    t = np.concatenate(rows)
    e = np.repeat(np.arange(n), [len(r) for r in rows])
    w = rng.random(len(t)) + 0.1
    w /= np.sqrt(np.bincount(e, w * w))[e]
    o = np.lexsort((e, t))
    index = tx.BlockMaxIndex(terms, rng.random(v) + 1, np.searchsorted(t[o], np.arange(v + 1)), e[o], w[o], np.arange(n),
                             rng.integers(0, 2, n))
    for _ in range(60):
        q = terms[rng.choice(v, rng.integers(1, 5))]
        want, s = brute_nearest(index, q, 15)
        got, cos = index.nearest(*index.vector(q), 15)
        assert sorted(got.tolist()) == sorted(want.tolist()) and np.allclose(np.sort(cos), np.sort(s[want]), atol=2e-6)


def test_toxicity_on_held_out_labels(table):
    docs, labels = table
    index = tx.fit(docs, labels.where(LEARN).select("doc_id", "toxic"))
    right, base = held_out(tx.toxicity(docs, index), labels, "toxic", "score")
    assert right > max(0.95, base)


def toy(frame):
    rows = [(i, f"filler{i % 17} words here and idiot clown" if i % 3 == 0 else f"filler{i % 17} words here and there") for i in range(120)]
    return frame(rows), [(i, int(i % 3 == 0)) for i in range(120)]


def test_toxicity_scores_evidence_and_odd_texts(spark, frame):
    docs, labels = toy(frame)
    index = tx.fit(docs, spark.createDataFrame(labels + [(5, None), (None, 1)], "d bigint, y int"))
    odd = frame([(1000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(1, "Idiot! CLOWN."), (2, "there"), (2, "there"), (None, "idiot " * 40000)])
    got = tx.toxicity(odd, index).collect()
    assert len(got) == len(ODD_TEXTS) + 4 and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert by[1].score > 0.5 > by[2].score and by[None].score > 0.5
    assert by[1].evidence[0].label == 1 and by[1].evidence[0].cosine > 0.9 and by[1000].evidence == []
    assert by[1000].score == by[1001].score
    none = tx.fit(frame([]), spark.createDataFrame([], "d bigint, y int"))
    assert [r.score for r in tx.toxicity(odd, none).collect()] == [0.0] * len(got)
    assert tx.toxicity(frame([]), index).collect() == []


def test_every_word_of_the_examples_counts(spark, frame):
    """A text equal to a toxic example finds it, however few labels there are and however rare its words; idf is all documents'."""
    toxic = [f"bane{i} scorn{i} venom{i}" for i in range(3)]
    rows = [*enumerate(toxic), *((10 + i, f"calm{i} plain{i} mild{i} venom2") for i in range(9)), (90, toxic[0]), (91, "venom0 venom0"), (92, "calm5")]
    index = tx.fit(frame(rows), spark.createDataFrame([(i, int(i < 10)) for i, _ in rows if i < 90], "d bigint, y int"))
    held = [f"{a}{i}" for i in range(3) for a in ("bane", "scorn", "venom")] + [f"{a}{i}" for i in range(9) for a in ("calm", "plain", "mild")]
    assert len(index.terms) == len(set(held))
    got = {r.doc_id: r for r in tx.toxicity(frame(rows), index).collect()}
    assert got[90].evidence[0].doc_id == 0 and got[90].evidence[0].cosine == pytest.approx(1, abs=1e-5)
    assert got[91].evidence[0].doc_id == 0 and got[92].evidence[0].doc_id == 15
    word = [int(np.flatnonzero(index.terms == h)[0]) for h in next(tx.chunks(pa.array(["venom0 bane1 calm1"]))).hashes]
    df = [sum(w in brute.words(t) for _, t in rows) for w in ("venom0", "bane1", "calm1")]
    assert df == [3, 1, 1] and index.idf[word[0]] / index.idf[word[1]] == pytest.approx((np.log(16 / 4) + 1) / (np.log(16 / 2) + 1))


def test_clean_documents_keep_every_column(spark, frame):
    docs, labels = toy(frame)
    index = tx.fit(docs, spark.createDataFrame(labels, "d bigint, y int"))
    kept = tx.clean_documents(docs.withColumnRenamed("sig", "score").withColumnRenamed("k", "_text2"), index)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "_text2"]
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(120) if i % 3]


def test_co_training_on_held_out_labels(table):
    docs, labels = table
    model = ct.fit(docs, labels.where(LEARN).select("doc_id", "quality"))
    out = ct.quality_classifier(docs, model)
    right, base = held_out(out, labels, "quality", "score")
    assert right > max(0.95, base)
    kept = {r.doc_id for r in out.where("kept").collect()}
    assert {r.doc_id for r in ct.good_documents(docs, model).collect()} == kept


def test_views_exchange_pseudo_labels(monkeypatch):
    """A view that can't tell the pool by its few labels learns from the other one's sure pseudo-labels."""
    rng = random.Random(1)
    label = np.array([float(i % 2) if i < 100 else np.nan for i in range(500)])
    truth = [i % 2 for i in range(500)]
    meta = [(np.array([y]), np.ones(1)) for y in truth]
    text = [(np.array([2 + 2 * (rng.randrange(8) if i >= 100 else 0) + y]), np.ones(1)) for i, y in enumerate(truth)]
    x = [linear.Sparse.from_rows(text), linear.Sparse.from_rows(meta)]
    few, many = (ct.co_train(x, label, n) for n in (0, 3))
    unseen = [2 + 2 * g + y for g in range(1, 8) for y in (0, 1)]
    apart = [sum(abs(m.text[0][f]) > 1e-3 for f in unseen) for m in (few, many)]
    assert apart[0] == 0 and apart[1] == len(unseen)


def test_pool_is_every_unlabelled_document(spark, frame, monkeypatch):
    """Passes over the table count and add up what a plain version does, for all documents outside of the labelled sample."""
    rows = [(i, f"good{i % 5} fine words here {i}" if i % 2 else f"BAD{i % 5} $$$ 12{i} stuff") for i in range(3000)] + [(None, "good1"), (None, "")]
    docs, seen = frame(rows).repartition(5), []
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 200)], "d bigint, y int")
    plain = ct._Documents.__init__
    monkeypatch.setattr(ct._Documents, "__init__", lambda self, rows: (plain(self, rows), seen.append(self))[0])
    monkeypatch.setattr(ct._Documents, "discard", lambda self: None)
    model = ct.fit(docs, labels)
    assert seen[0].size == 2802
    text, meta, u = [], [], []
    for r in seen[0].table.collect():
        chunk = next(ct.chunks(pa.array([r.text])))
        tf, tv, _, _ = ct._views(chunk, [[None], ["s"]])[0]
        text.append((tf, tv))
        meta.append((np.array(r.mf), np.ones(len(r.mf))))
        u.append(r.u)
    same = ct._Rows([linear.Sparse.from_rows(text), linear.Sparse.from_rows(meta)], (ct.DIMS, ct.META_DIMS))
    same.u = np.array(u)
    turns = [ct._Turn([model.text, model.meta])]
    counts = seen[0].counted(turns)
    assert abs(counts - same.counted(turns)).sum() <= 4 and counts.sum() > 2802
    turns[0].picks = [[(-1, 0.0)] * 2] * 2
    got, want = seen[0].sums(turns), same.sums(turns)
    assert np.allclose(got.ends, want.ends, rtol=1e-3, atol=1e-2) and got.ends[..., 2].sum() > 2802
    for v in (0, 1):
        assert np.allclose(got.grad[v], want.grad[v], rtol=1e-3, atol=1e-2) and np.allclose(got.curve[v], want.curve[v], rtol=1e-3, atol=0.1)


def test_quality_models_without_labels_or_with_one_class(spark, frame):
    odd = frame([(i, t) for i, t in enumerate(ODD_TEXTS)] + [(3, "x"), (None, "many words " * 30000)])
    for labels in ([], [(1, 1), (2, 1)], [(1, None)]):
        labels = spark.createDataFrame(labels, "d bigint, y int")
        got = ct.quality_classifier(odd, ct.fit(odd, labels)).collect()
        assert len(got) == len(ODD_TEXTS) + 2 and len({r.score for r in got}) == 1
        got = qr.quality_rules(odd, qr.fit(odd, labels)).collect()
        assert len(got) == len(ODD_TEXTS) + 2 and len({r.score for r in got}) == 1
    assert ct.quality_classifier(frame([]), ct.co_train(EMPTY, np.zeros(0), 1)).collect() == []
    assert ct.quality_classifier(odd.drop("lang", "source"), ct.co_train(EMPTY, np.zeros(0), 1)).count() == len(ODD_TEXTS) + 2


def test_quality_rules_on_held_out_labels(table):
    docs, labels = table
    out = qr.quality_rules(docs, qr.fit(docs, labels.where(LEARN).select("doc_id", "quality")))
    right, base = held_out(out.withColumn("v", F.col("kept").cast("double")), labels, "quality", "v")
    assert right > max(0.95, base)


def test_base_counts_match_brute_force(spark, frame, small_rows):
    rows = [(5000 + i, t) for i, t in enumerate(ODD_TEXTS)] + small_rows
    rows += [(9000, "l one\nl two\nl one\r\n\n \nl one\nl two"), (9001, "a b c d e " * 5), (9002, "é#*%  𝔸|<>&$ x " * 3), (9003, "same " * 30000)]
    model = qr.fit_rows(linear.Sparse.from_rows([]), np.zeros(0))
    got = {r.doc_id: r for r in qr.quality_rules(frame(rows), model).collect()}
    for i, t in rows:
        want, r = brute.base_counts(t), got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, (i, t)
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (r.base_failed and r.kept)
    assert qr.quality_rules(frame([]), model).collect() == []


def test_scores_do_not_depend_on_neighbours_in_the_batch(frame):
    """A text's score is its own: features are cut at the ends of texts."""
    texts = ["good plain words " * 5, "", "a", "BAD!! $$$ words###"]
    rows = [(i, t) for i, t in enumerate(texts * 4)]
    model = qr.NgramModel(np.random.default_rng(0).normal(size=qr.DIMS).astype(np.float32), 0.1, (1.0, 0.0))
    got = {}
    for r in qr.quality_rules(frame(rows).coalesce(1), model).collect():
        got.setdefault(rows[r.doc_id][1], set()).add(round(r.score, 9))
    assert all(len(v) == 1 for v in got.values()) and len(got) == 4


def test_products_in_blocks(monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(np.sort(rng.choice(30, n, replace=False)), rng.normal(size=n)) for n in (0, 3, 9, 0, 0, 30, 1, 0)]
    dense = np.zeros((len(rows), 30))
    for i, (f, v) in enumerate(rows):
        dense[i, f] = v
    x, w, g = linear.Sparse.from_rows(rows), rng.normal(size=30), rng.normal(size=len(rows))
    for block in (4, 1 << 19):
        monkeypatch.setattr(linear, "BLOCK", block)
        assert np.allclose(x.dot(w), dense @ w, atol=1e-4) and np.allclose(x.back(g, 30), dense.T @ g, atol=1e-4)


def test_logistic_fit_and_platt():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 400).astype(float)
    rows = [(np.array([int(v), 2]), np.array([1.0, rng.normal()])) for v in y]
    w, b = linear.fit_logistic(linear.Sparse.from_rows(rows), y, np.ones(400), 3)
    assert w[1] > 1 > -1 > w[0]
    score = rng.normal(size=2000)
    label = (rng.random(2000) < linear.sigmoid(2 * score - 1)).astype(int)
    a, c = linear.platt(score, label)
    assert abs(a - 2) < 0.3 and abs(c + 1) < 0.3


def plain_words(text):
    return re.findall(r"[^\x00-/:-@\[-`{-\x7f]+", brute.ascii_lower(text or ""))


def test_toxicity_from_texts_to_scores(spark, frame, small_rows):
    """Counts over all documents, weights, lengths, neighbours and votes against plain dictionaries."""
    texts = dict(small_rows) | {9001: "", 9002: None, 9003: "only unheard words zzq zzr", 9004: "<|...|>"}
    ids = sorted(texts)
    labelled = {i: int(n % 4 == 0) for n, i in enumerate(ids[:90])}
    for i, y in labelled.items():
        texts[i] = (texts[i] or "") + (" venom bane" if y else " balm") + f" w{i % 7}"
    docs = frame(sorted(texts.items()))
    index = tx.fit(docs, spark.createDataFrame(sorted(labelled.items()), "d bigint, y int"))
    tf = {i: collections.Counter(plain_words(t)) for i, t in texts.items()}
    holders = collections.Counter(w for c in tf.values() for w in c)
    vocabulary = {w for i in labelled for w in tf[i]}

    # copies of a text, by its least shingle, count once for the labels' factor
    packed = {r.doc_id: r.origin for r in spark.createDataFrame([(i, texts[i], 0) for i in labelled], "doc_id bigint, text string, label int").mapInArrow(
        tx._terms_of, tx.EXAMPLES).collect()}
    groups = {}
    for i in labelled:
        groups.setdefault(packed[i], []).append(i)
    m, pos = len(groups), sum(any(labelled[i] for i in g) for g in groups.values())
    held = collections.Counter(w for g in groups.values() for w in {w for i in g for w in tf[i]})
    ones = collections.Counter(w for g in groups.values() for w in {w for i in g if labelled[i] for w in tf[i]})
    weight = {}
    for w in vocabulary:
        off = max(abs(ones[w] - held[w] * pos / m) - 0.5, 0)
        chi = off**2 * m**3 / (held[w] * max(m - held[w], 1) * pos * (m - pos))
        weight[w] = (np.log((1 + len(texts)) / (1 + holders[w])) + 1) * (1 + max(chi - 2 * np.log(len(vocabulary)), 0))
    rare = np.log((1 + len(texts)) / 2) + 1

    def vector(i):
        v = {w: (1 + np.log(n)) * weight.get(w, rare) for w, n in tf[i].items()}
        length = np.sqrt(sum(x * x for x in v.values()))
        return {w: x / length for w, x in v.items()}

    vectors = {i: vector(i) for i in texts}
    assert len(index.terms) == len(vocabulary) and len(index.doc) == len(labelled)
    for r in tx.toxicity(docs, index).collect():
        cosines = {e: sum(x * vectors[e].get(w, 0) for w, x in vectors[r.doc_id].items() if w in vocabulary) for e in labelled}
        best = sorted((-round(c, 5), e) for e, c in cosines.items() if c > 1e-6)
        if not set(tf[r.doc_id]) & vocabulary:
            assert r.score == index.unknown and r.evidence == []
            continue
        assert [round(x.cosine, 4) for x in r.evidence] == pytest.approx([-c for c, _ in best[: tx.EVIDENCE]], abs=2e-4)
        kth = -best[min(tx.NEIGHBOURS, len(best)) - 1][0]
        if any(abs(-c - kth) < 3e-5 for c, _ in best[tx.NEIGHBOURS : tx.NEIGHBOURS + 1]):
            continue  # a tie of the k-th to within rounding
        near = [(1 / (1.05 - min(-c, 1)), labelled[e]) for c, e in best[: tx.NEIGHBOURS]]
        base = sum(labelled.values()) / len(labelled)
        share = (sum(a * y for a, y in near) + base) / (sum(a for a, _ in near) + 1)
        assert r.score == pytest.approx(float(linear.sigmoid(index.curve[0] * tx._logit(share) + index.curve[1])), abs=1e-3)


def test_toxicity_examples_are_bounded_by_words(spark, frame):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(10))) for i in range(40)]
    index = tx.fit(frame(rows), spark.createDataFrame([(i, i % 2) for i in range(40)], "d bigint, y int"), max_words=205)
    assert len(index.doc) == 20 and len(index.terms) == 200
    assert sorted(index.doc.tolist()) == sorted(tx.fit(frame(rows), spark.createDataFrame([(i, i % 2) for i in range(40)], "d bigint, y int"), max_examples=20).doc.tolist())


def test_toxicity_query_holds_out_rows_without_id(spark, frame, tmp_path):
    from tidewater.llm.queries import op3_toxicity

    docs = frame([(i, f"some words {i} {'venom' if i % 2 else 'balm'}") for i in range(40)] + [(None, "venom"), (None, None)])
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 0, i % 2) for i in range(40)] + [(None, 0, 1)], "doc_id bigint, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    got = op3_toxicity(spark, f"file://{tmp_path}").collect()
    assert len(got) == 42 and [r.held_out for r in got if r.doc_id is None] == [True, True]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) for r in got if r.doc_id is not None)


def test_range_sums():
    rng = np.random.default_rng(5)
    for n in (0, 1, 7):
        values = rng.normal(size=n).astype(np.float32)
        a = rng.integers(0, n + 1, 40)
        b = np.minimum(a + rng.integers(0, 4, 40), n)
        a, b = np.r_[a, 0, n], np.r_[b, n, n]
        assert np.allclose(ct._range_sums(values, a, b), [values[i:j].sum() for i, j in zip(a, b)], atol=1e-6)


def test_sums_meet_until_few_are_left(spark, frame, monkeypatch):
    """Many tasks: the tree goes on level by level, and the sums are those of one task."""
    docs = frame([(i, f"fine words {i}" if i % 2 else f"BAD $$ {i}") for i in range(300)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 60)], "d bigint, y int")
    monkeypatch.setattr(ct, "FAN_IN", 2)
    model = ct.fit(docs.coalesce(1), labels)
    turns = [ct._Turn([model.text, model.meta], [[(-1, 0.0)] * 2] * 2)]
    rows = ct._prepared(docs, "doc_id", "text")
    one, many = ct._Documents(rows.coalesce(1)), ct._Documents(rows.repartition(9))
    assert (one.tasks, many.tasks) == (1, 4) or many.tasks > 1
    a, b = one.sums(turns), many.sums(turns)
    assert np.allclose(a.ends, b.ends, rtol=1e-4) and np.allclose(a.grad[0], b.grad[0], rtol=1e-3, atol=1e-3)


def test_sampled_rows_are_in_order_and_distinct(spark):
    from tidewater.llm.features import sampled_rows

    def row(i, y, f, v):
        return i, y, np.array(f, np.int32).tobytes(), np.array(v, np.float32).tobytes()

    df = spark.createDataFrame([row(3, 1, [1, 2], [0.5, 1.5]), row(1, 0, [], []), row(2, 1, [7], [2.0]), row(2, 1, [7], [2.0])], "doc_id long, label int, f binary, v binary")
    label, (x,) = sampled_rows(df)
    assert label.tolist() == [0, 1, 1] and x.at.tolist() == [0, 0, 1, 3] and x.feature.tolist() == [7, 1, 2] and x.value.tolist() == [2, 0.5, 1.5]


def test_toxicity_examples_come_a_partition_at_a_time(spark, frame, monkeypatch):
    """The words of the examples are nothing that the driver's JVM holds whole, and each example's products stand side by side."""
    whole, frames = [], type(spark.range(1))
    to_arrow = frames.toArrow
    monkeypatch.setattr(frames, "toArrow", lambda df: whole.extend(df.columns) or to_arrow(df))
    docs = [(i, f"w{i % 7} some words {i} " * 4) for i in range(60)] + [(7, "w0 a second text of one id " * 9), (61, ""), (62, None)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(63)], "doc_id bigint, label int")
    index = tx.fit(frame(docs), labels)
    assert "terms" not in whole
    assert sorted(index.doc.tolist()) == [*range(60), 61, 62]
    assert index.dense.T.flags.c_contiguous
    none = tx.fit(frame([(1, ""), (2, None)]), labels)
    assert len(none.terms) == 0 and none.doc.tolist() == [1, 2]
