"""Toxicity by nearest labelled examples: exact cosine of weighted TF-IDF vectors over a block-max inverted index.

The examples are a sample of labelled rows of bounded size (``max_examples`` and ``max_words``, by hash of doc_id); every word
of theirs is a term.  Example and query vectors are (1 + ln tf) * idf * (1 + excess), at length one.  idf is taken from
all documents; the factor of the labels is no part of plain TF-IDF, whose neighbours share a subject rather than a label; excess is the chi-squared, with Yates' correction, by which a word differs between the labels, above 2 ln(terms),
which is about the most that chance brings about among so many words; where examples with the
same least shingle count once, so that the words of one much copied text don't pass for a pattern.  A query's
other words lengthen its vector as words that no other document has.  The index keeps each term's postings by example;
terms that many examples hold (HEAVY) are dense rows, with the largest weight of each block of examples.  A query adds up
its light terms in full; with the block maxima of the heavy ones they bound each example's cosine, and only
examples that can reach the k-th best are completed: the k nearest are exact, with all
ties of the k-th.  Their votes weigh by closeness; the vote share becomes a probability by a
logistic curve fitted on the examples' own votes, each without itself.
"""

from __future__ import annotations

import ctypes
import glob
import os
from dataclasses import dataclass
from functools import partial
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.exchange import materialized
from tidewater.llm.features import fresh, kept_rows
from tidewater.llm.linear import platt, sigmoid
from tidewater.llm.words import chunks, grams

BLOCK = 64
NEIGHBOURS = 15
HEAVY = 16  # a term is heavy when one example in so many holds it
TOGETHER = 64  # texts whose heavy terms are added up at once
KNOWN = 20_000  # texts whose result a task remembers
EVIDENCE = 3  # nearest examples reported; votes use all


@dataclass
class BlockMaxIndex:
    """terms: sorted term hashes; idf per term; postings of term t are at[t]:at[t + 1] of example and weight."""

    terms: np.ndarray
    idf: np.ndarray
    at: np.ndarray
    example: np.ndarray
    weight: np.ndarray
    doc: np.ndarray
    label: np.ndarray
    rare: float = 0.0  # idf of a word that no example has
    curve: tuple[float, float] = (1.0, 0.0)
    unknown: float = 0.0  # share of label 1 among examples without a term

    def __post_init__(self):
        n = len(self.doc)
        held = np.diff(self.at)
        heavy = np.flatnonzero(held * HEAVY > n)
        self.heavy_row = np.full(len(self.terms), -1, np.int32)
        self.heavy_row[heavy] = np.arange(len(heavy))
        blocks = -(-max(1, n) // BLOCK)
        self.dense = np.zeros((blocks * BLOCK, len(heavy)), np.float32).T  # an example's weights lie together: products take half the time
        for row, t in enumerate(heavy):
            self.dense[row, self.example[self.at[t] : self.at[t + 1]]] = self.weight[self.at[t] : self.at[t + 1]]
        self.block_max = np.ascontiguousarray(self.dense.T.reshape(blocks, BLOCK, len(heavy)).max(axis=1).T)
        self.base = float(self.label.mean()) if len(self.label) else 0.0
        self.known = {}

    def __getstate__(self):
        """What can't be made again from the postings: the index travels to every executor, and lies on its disk."""
        own = ("terms", "idf", "at", "example", "weight", "doc", "label", "rare", "curve", "unknown")
        return {name: getattr(self, name) for name in own}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def vector(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(term numbers, weights) of a text's words."""
        if not len(self.terms) or not len(hashes):
            return np.zeros(0, np.int64), np.zeros(0)
        words, tf = np.unique(hashes, return_counts=True)
        t = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        has = self.terms[t] == words
        w = (1 + np.log(tf)) * np.where(has, self.idf[t], self.rare)
        return t[has], w[has] / np.sqrt((w * w).sum()) if has.any() else w[has]

    def _light(self, t: np.ndarray, w: np.ndarray) -> np.ndarray:
        """What the light terms of a vector add to each example's cosine."""
        first, last = self.at[t], self.at[t + 1]
        parts = [(self.example[i:j], self.weight[i:j]) for i, j in zip(first.tolist(), last.tolist())]
        if not parts:
            return np.zeros(len(self.doc))
        weight = np.concatenate([x for _, x in parts]) * np.repeat(w.astype(np.float32), last - first)
        return np.bincount(np.concatenate([x for x, _ in parts]), weight, minlength=len(self.doc))

    def nearest_of(self, vectors: list, k: int, skip: list | None = None) -> list:
        """Of each vector (term numbers, weights): (examples, cosines) of the k nearest and all that tie with the k-th, best
        first; skip: an example to leave out, per vector.

        A block of examples is completed by the heavy terms if its bound, from the block maxima, reaches the k-th best of any
        of the vectors, which are taken together so that a block's rows are read once for all of them.
        """
        n, blocks = len(self.doc), self.block_max.shape[1]
        score, weight = np.full((len(vectors), blocks * BLOCK), -np.inf), np.zeros((len(vectors), len(self.dense)), np.float32)
        for i, (t, w) in enumerate(vectors):
            row = self.heavy_row[t]
            score[i, :n] = self._light(t[row < 0], w[row < 0])
            weight[i, row[row >= 0]] = w[row >= 0]
            if skip:
                score[i, skip[i]] = -np.inf
        best = score.reshape(len(vectors), blocks, BLOCK).max(axis=2)
        bound = best + weight @ self.block_max
        reach = np.flatnonzero(((bound > 0) & (bound >= _kth(best, k)[:, None] - 1e-5)).any(axis=0))
        example = np.arange(blocks * BLOCK)
        if 2 * len(reach) >= blocks:
            score += weight @ self.dense
        else:
            example = example.reshape(blocks, BLOCK)[reach].ravel()
            dense = self.dense.T.reshape(blocks, BLOCK, len(self.dense))[reach].reshape(len(example), len(self.dense)).T
            score = score.reshape(len(vectors), blocks, BLOCK)[:, reach].reshape(len(vectors), len(example)) + weight @ dense
        out, least = [], _kth(score.reshape(len(vectors), len(example) // BLOCK, BLOCK).max(axis=2), k)
        for s, low in zip(score, least):
            near = np.flatnonzero((s > 0) & (s >= low - 1e-6))
            e, c = example[near], np.round(s[near], 6)
            keep = (c > 0) & (c >= (np.partition(c, len(c) - k)[len(c) - k] if len(c) > k else 0.0))
            e, c = e[keep], c[keep]
            order = np.lexsort((e, -c))
            out.append((e[order], c[order]))
        return out

    def nearest(self, t: np.ndarray, w: np.ndarray, k: int, skip: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """nearest_of one vector."""
        return self.nearest_of([(t, w)], k, None if skip is None else [skip])[0]

    def vote(self, e: np.ndarray, s: np.ndarray) -> float:
        """Share of label 1, by closeness; the base rate counts as a distant neighbour."""
        near = 1 / (1.05 - np.minimum(s, 1))
        return float(((near * self.label[e]).sum() + self.base) / (near.sum() + 1))

    def scores(self, texts: list[np.ndarray], k: int) -> list[tuple[float, list]]:
        """(probability, evidence) of texts given by their words; equal texts are looked up once."""
        keys = [blake2b(x, digest_size=16).digest() for x in texts]
        if len(self.known) > KNOWN:
            self.known = {}
        known = {key: self.known[key] for key in keys if key in self.known}
        new = {key: self.vector(x) for key, x in zip(keys, texts) if key not in known}
        known |= {key: (self.unknown, []) for key, (t, _) in new.items() if not len(t)}
        todo = [key for key in new if key not in known]
        for i in range(0, len(todo), TOGETHER):
            some = todo[i : i + TOGETHER]
            for key, (e, s) in zip(some, self.nearest_of([new[x] for x in some], k)):
                p = float(sigmoid(self.curve[0] * _logit(self.vote(e, s)) + self.curve[1])) if len(e) else self.unknown
                known[key] = p, [(int(self.doc[x]), int(self.label[x]), float(c)) for x, c in zip(e[:EVIDENCE], s[:EVIDENCE])]
        self.known |= known
        return [known[key] for key in keys]


def _kth(best: np.ndarray, k: int) -> np.ndarray:
    """A limit that k examples reach, per row: the k-th largest of their blocks' best, or none where blocks are too few."""
    m = best.shape[1]
    return np.maximum(np.partition(best, m - k, axis=1)[:, m - k], 0) if m >= k else np.zeros(len(best))


def _one_thread() -> None:
    """A task has one core: numpy's products, which would start a thread per core of the machine, get by with the task's own."""
    for path in glob.glob(os.path.join(os.path.dirname(np.__file__), os.pardir, "numpy.libs", "*openblas*")):
        library = ctypes.CDLL(path)
        for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)
                return


def _logit(p):
    return np.log(p / (1 - p)) if 0 < p < 1 else np.sign(p - 0.5) * 20.0


EXAMPLES = "doc_id bigint, label int, origin bigint, n bigint, terms binary, tf binary"
_EXAMPLES = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("origin", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()), ("tf", pa.binary())])


def _terms_of(batches):
    """A row per labelled text, its distinct words and their counts packed; origin: the least shingle, mostly the same for near copies."""
    for batch in batches:
        ids, labels = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for chunk in chunks(batch.column(1), lower=True, alnum=True):
            rows = []
            for i in range(chunk.last - chunk.first):
                t, tf = np.unique(chunk.words(i), return_counts=True)
                g = grams(chunk.words(i), min(5, max(1, int(tf.sum()))))
                origin = int(g.min().astype(np.uint64).view(np.int64)) if len(g) else 0
                rows.append((ids[chunk.first + i], labels[chunk.first + i], origin, len(t), t.astype("<u8").tobytes(), tf.astype("<u4").tobytes()))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _EXAMPLES)], schema=_EXAMPLES)


COUNTED = 1 << 16  # terms whose counts travel as one row


def _blobs(count):
    return [(i // COUNTED, count[i : i + COUNTED].astype("<i8").tobytes()) for i in range(0, len(count), COUNTED)]


def _documents_with(batches, terms):
    """(bucket, how many texts of the task hold each of its terms); the last count of all is the number of texts."""
    count = np.zeros(len(terms) + 1, np.int64)
    for batch in batches:
        count[-1] += batch.num_rows
        for chunk in chunks(batch.column(0), lower=True, alnum=True):
            t = np.minimum(np.searchsorted(terms, chunk.hashes), len(terms) - 1)
            has = terms[t] == chunk.hashes
            text = np.repeat(np.arange(chunk.last - chunk.first), np.diff(chunk.bounds))
            held = np.unique(text[has] * len(terms) + t[has]) % len(terms)
            count[:-1] += np.bincount(held, minlength=len(terms))
    rows = [(b, TaskContext.get().partitionId() % TREE, c) for b, c in _blobs(count)]
    yield _counts(rows)


TREE = 64  # sums of a bucket that are added up before the last ones are
COUNTS = "bucket int, branch int, counts binary"


def _counts(rows):
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary()))], names=["bucket", "branch", "counts"])


def _added(batches):
    """Rows sorted by bucket, each bucket's counts added up as they are read."""
    bucket, total = None, None
    for batch in batches:
        for b, c in zip(batch.column(0).to_pylist(), batch.column(2)):
            c = np.frombuffer(c.as_buffer(), "<i8")
            if b == bucket:
                total = total + c
            else:
                if bucket is not None:
                    yield _counts([(bucket, 0, total.tobytes())])
                bucket, total = b, c
    if bucket is not None:
        yield _counts([(bucket, 0, total.tobytes())])


def _document_counts(every: DataFrame, terms: np.ndarray) -> tuple[np.ndarray, int]:
    """(texts that hold each term, all texts): counted in tasks, added up over two levels."""
    counts = every.select("text").mapInArrow(partial(_documents_with, terms=terms), COUNTS)
    for keys in (["bucket", "branch"], ["bucket"]):
        counts = counts.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_added, COUNTS)
    rows = counts.toArrow().sort_by("bucket")  # eight bytes per term of the examples
    total = np.frombuffer(b"".join(rows.column("counts").to_pylist()), "<i8")
    return (total[:-1], int(total[-1])) if len(total) else (np.zeros(len(terms), np.int64), 0)


def _differs(a: np.ndarray, held: np.ndarray, pos: float, m: float) -> np.ndarray:
    """Chi-squared, with Yates' correction, of terms that `held` of m texts hold, a of the pos texts of label 1 among them."""
    if not 0 < pos < m:
        return np.zeros(len(held))
    off = np.maximum(np.abs(a - held * pos / m) - 0.5, 0)
    return off**2 * m**3 / (held * np.maximum(m - held, 1) * pos * (m - pos))


def fit(docs: DataFrame, labels: DataFrame, max_examples: int = 20_000, max_words: int = 8_000_000, k: int = NEIGHBOURS, id_col: str = "doc_id",
        text_col: str = "text") -> BlockMaxIndex:
    """Index over at most max_examples labelled documents, of at most max_words distinct words each added up; labels: (doc_id,
    label), null labels count as none.  The documents are those of least hash of doc_id.

    A doc_id labelled more than once counts once, with its largest label; of rows of one doc_id the one of the most
    words is its example.  Every word of the examples is a term.
    """
    spark = docs.sparkSession
    sample = labels.toDF("doc_id", "label").dropna().groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples)
    every = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = every.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "label")  # at most max_examples rows
    packed = materialized(spark, rows.mapInArrow(_terms_of, EXAMPLES), "examples")
    by_hash = packed.groupBy("doc_id").agg(F.max("n").alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()  # numbers of the sample
    fits = np.cumsum(by_hash.column("n").to_numpy()) <= max_words
    by_hash = by_hash.filter(pa.array(fits))
    chosen = packed.join(F.broadcast(spark.createDataFrame(by_hash.select(["doc_id"]).to_pandas(), "doc_id bigint")), "doc_id")
    best = F.max_by(F.struct("label", "origin", "terms", "tf"), F.struct("n", "origin")).alias("x")
    found = chosen.groupBy("doc_id").agg(best).select("doc_id", "x.*")
    by_hash = by_hash.sort_by("doc_id")
    doc, sizes = (by_hash.column(c).to_numpy().copy() for c in ("doc_id", "n"))
    n, begin = len(doc), np.cumsum(sizes) - sizes
    label, origin, words, tf = np.zeros(n, np.int64), np.zeros(n, np.int64), np.empty(sizes.sum(), np.uint64), np.empty(sizes.sum(), np.uint32)
    for r in found.toLocalIterator():  # bounded by max_words; a partition at a time, each row to its place, so that no process holds them twice
        i = int(np.searchsorted(doc, r.doc_id))
        label[i], origin[i], own = r.label, r.origin, slice(begin[i], begin[i] + sizes[i])
        words[own], tf[own] = np.frombuffer(r.terms, "<u8"), np.frombuffer(r.tf, "<u4")
    origin = np.unique(origin, return_inverse=True)[1]
    term = np.unique(words)
    t = np.empty(len(words), np.int32)
    for i in range(0, len(words), COUNTED):
        t[i : i + COUNTED] = np.searchsorted(term, words[i : i + COUNTED])
    del words
    rare, idf = 0.0, np.zeros(0)
    if len(term):
        number, every_n = _document_counts(every, term)
        held = _origins_with(t, origin, sizes, np.ones(n, bool), len(term))
        ones = _origins_with(t, origin, sizes, label == 1, len(term))
        worded = sizes > 0
        differs = _differs(ones, held, float(len(np.unique(origin[worded & (label == 1)]))), float(len(np.unique(origin[worded]))))
        idf = (np.log((1 + every_n) / (1 + number)) + 1) * (1 + np.maximum(differs - 2 * np.log(len(term)), 0))
        rare = float(np.log((1 + every_n) / 2) + 1)
    # in single precision and in place: the driver holds each number of the sample's words few times over
    idf = idf.astype(np.float32)
    w = (1 + np.log(np.arange(1, 2 + int(tf.max(initial=1))))).astype(np.float32)[tf - 1]
    del tf
    for i in range(0, len(t), COUNTED):
        w[i : i + COUNTED] *= idf[t[i : i + COUNTED]]
    for i, m in zip(begin.tolist(), sizes.tolist()):
        w[i : i + m] /= np.sqrt(np.dot(w[i : i + m], w[i : i + m])) if m else 1
    # examples that share their strongest term stand together, so that block maxima are tight
    strongest = np.array([t[i + w[i : i + m].argmax()] if m else -1 for i, m in zip(begin.tolist(), sizes.tolist())], np.int64)
    order = np.lexsort((doc, strongest))
    spans = list(zip(begin[order].tolist(), sizes[order].tolist()))
    doc, label, sizes = doc[order], label[order], sizes[order]
    t = np.concatenate([t[i : i + m] for i, m in spans] or [t])
    w = np.concatenate([w[i : i + m] for i, m in spans] or [w])
    ends = np.cumsum(sizes)
    by_example = t, w, ends - sizes, ends
    at = np.r_[0, np.cumsum(np.bincount(t, minlength=len(term)))].astype(np.int32)
    o = np.argsort(t, kind="stable").astype(np.int32)
    index = BlockMaxIndex(term, idf, at, np.repeat(np.arange(n, dtype=np.uint16 if n < 1 << 16 else np.int32), sizes)[o], w[o], doc, label, rare)
    del o
    has = sizes > 0
    index.unknown = float((label[~has].sum() + index.base) / ((~has).sum() + 1))
    _calibrate(index, *by_example, np.flatnonzero(has), k)
    return index


def _origins_with(t: np.ndarray, origin: np.ndarray, sizes: np.ndarray, which: np.ndarray, terms: int) -> np.ndarray:
    """How many origins of the marked examples hold each term: copies of one text count once."""
    out, begin = np.zeros(terms), np.cumsum(sizes) - sizes
    order = np.flatnonzero(which)
    order = order[np.argsort(origin[order], kind="stable")]
    edges = np.flatnonzero(np.diff(origin[order], prepend=-1))
    for i, j in zip(edges.tolist(), np.r_[edges[1:], len(order)].tolist()):
        parts = [t[begin[x] : begin[x] + sizes[x]] for x in order[i:j].tolist()]
        out[parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))] += 1
    return out


def _calibrate(index, t, w, begin, end, rows, k, most=4000):
    """The curve from vote shares to probabilities, on `most` examples at most, each voted on without itself; t and w stand by example."""
    _one_thread()  # the driver's memory is bounded, and each thread of a product would take some
    rows = rows[:: max(1, -(-len(rows) // most))]
    share, y = [], []
    for start in range(0, len(rows), TOGETHER):
        some = rows[start : start + TOGETHER]
        found = index.nearest_of([(t[begin[r] : end[r]], w[begin[r] : end[r]]) for r in some], k, some.tolist())
        for r, (near, s) in zip(some, found):
            if len(near):
                share.append(_logit(index.vote(near, s)))
                y.append(index.label[r])
    if len(set(y)) == 2:
        index.curve = platt(np.array(share), np.array(y))


SCORED = ("doc_id bigint, score double, evidence array<struct<doc_id:bigint,label:int,cosine:double>>")
_EVIDENCE = pa.list_(pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())]))


def _score(batches, index, k):
    _one_thread()
    for batch in batches:
        for chunk in chunks(batch.column(1), lower=True, alnum=True):
            got = index.scores([chunk.words(i) for i in range(chunk.last - chunk.first)], k)
            yield pa.record_batch([
                batch.column(0).slice(chunk.first, len(got)).cast(pa.int64()), pa.array([p for p, _ in got], pa.float64()),
                pa.array([[{"doc_id": a, "label": b, "cosine": c} for a, b, c in x] for _, x in got], _EVIDENCE)],
                names=["doc_id", "score", "evidence"])


def toxicity(docs: DataFrame, index: BlockMaxIndex, k: int = NEIGHBOURS, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, score (probability of label 1), evidence (nearest examples).

    Null, empty and other texts without an indexed term score the share of label 1 among such examples (0 with
    no examples at all).
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(partial(_score, index=index, k=k), SCORED)


def clean_documents(docs: DataFrame, index: BlockMaxIndex, threshold: float = 0.5, k: int = NEIGHBOURS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, that score below threshold; nothing is shuffled."""
    a, b = fresh(docs.columns, 2)
    rows = docs.select("*", F.col(id_col).alias(a), F.col(text_col).cast("string").alias(b))
    keep = partial(_below, threshold=threshold)
    return rows.mapInArrow(partial(kept_rows, columns=len(docs.columns), score=partial(_score, index=index, k=k), keep=keep),
                           docs.schema)


def _below(scored, threshold):
    return pc.less(scored.column(1), threshold)
