"""Quality classifier by co-training of two views of a document.

The text view holds the words and byte trigrams of the content, hashed.  The metadata view holds what is known of
the page without reading its words: source, language, length, and the layout of its lines and words (line
counts and lengths, shares of capitals, digits, separators and punctuation), as one-hot steps: no feature depends on which words
stand there.
Each view has a logistic classifier.  Every round both are fitted on the labelled rows and the pseudo-labels they
were given so far; then each labels the pool documents it is surest about, and these go to the other.  The pool is all
documents outside of the labelled sample: each round a pass over it counts them by both views' logits, which
gives the least logit of the surest share per view and label, and another adds up the gradients of those chosen so far
(``_Sums``), per task and then up a tree.  The driver holds weights, sums and the labelled sample; with the sums goes a
bound of the curvature of each weight, so that a fit may take many steps on them and still lower the loss over all rows.  At the end each
view's scores are calibrated on labelled rows that none has learnt from, the calibrated logits of both
are combined by a logistic model on the same rows, and all documents are scored in Arrow batches.

Labelled rows are a sample of bounded size (``max_labelled``), chosen by hash of doc_id.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.exchange import discard, materialized
from tidewater.llm.features import DIMS, char_grams, fresh, joined, kept_rows, packed, sample_ids, sampled_rows, share, word_grams
from tidewater.llm.linear import Sparse, fit_logistic, platt, sigmoid
from tidewater.llm.words import U64, Chunk, chunks, grams, mix

ROUNDS = 4
SURE = 0.95  # probability from which a view hands a pseudo-label over
SHARE_PER_ROUND = 0.1  # of the pool, at most, of each label and view
STEPS = 120  # of each fit
SCALE = 30.0
BINS, LEAST_LOGIT, MOST_LOGIT = 4096, float(np.log(SURE / (1 - SURE))), 35.0  # in which sure documents are counted
FAN_IN = 16  # tasks whose sums meet in one of the next level
META_DIMS = 1 << 12
FIELDS = ("lang", "source")


@dataclass
class CoModel:
    """Per view: weights, intercept, calibration; and the weights of both calibrated logits with their intercept."""

    text: tuple
    meta: tuple
    mixture: tuple[float, float, float]


_UPPER, _DIGIT, _PUNCT = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91] = _DIGIT[48:58] = True
_PUNCT[[i for i in range(33, 127) if not chr(i).isalnum()]] = True


def _one_hot(name: str, value) -> int:
    h = 2166136261
    for c in f"{name}={value}".encode():
        h = (h ^ c) * 16777619 % 2**32
    return (h ^ h >> 15) % META_DIMS


def _steps(x: np.ndarray, steps: int = 12) -> np.ndarray:
    return np.clip(np.round(x * steps), 0, steps).astype(np.int64)


def _log_steps(x: np.ndarray) -> np.ndarray:
    return np.round(2 * np.log2(1 + np.maximum(0.0, x))).astype(np.int64)


#: features of each layout step; logarithms of counts stay below 128
_LAYOUT = ("bytes", "words", "lines", "line", "word", "upper", "digit", "punct", "bars")
_PLACES = np.array([[_one_hot(name, k) for k in range(128)] for name in _LAYOUT])


def _layout(chunk: Chunk) -> np.ndarray:
    """Steps of each text's layout, a column per name."""
    a, b = chunk.text_starts[:-1], chunk.text_starts[1:]
    size, words = b - a, np.diff(chunk.bounds)
    upper, digit, punct = (_range_sums(m[chunk.data], a, b) for m in (_UPPER, _DIGIT, _PUNCT))
    lines, bars = (_range_sums(chunk.data == c, a, b) for c in (10, 124))
    n, w, lines = np.maximum(1, size), np.maximum(1, words), lines + 1
    return np.stack([_log_steps(size), _log_steps(words), _log_steps(lines), _log_steps(words / lines), _log_steps(size / w), _steps(upper / n),
                     _steps(digit / n), _steps(3 * punct / n, 24), _steps(5 * bars / n)], axis=1)


def _metas(chunk: Chunk, fields: list[list]) -> tuple[np.ndarray, np.ndarray]:
    """(features, edges) of the metadata view: those of text i of the chunk are at edges[i]:edges[i + 1], each once."""
    n, known = chunk.last - chunk.first, {}
    found = [_PLACES[np.arange(len(_LAYOUT)), np.minimum(_layout(chunk), 127)]]
    for name, column in zip(FIELDS, fields):
        values = column[chunk.first : chunk.last]
        for v in set(values):
            known[name, v] = _one_hot(name, v)
        found.append(np.array([known[name, v] for v in values], np.int64).reshape(n, 1))
    f = np.sort(np.concatenate(found, axis=1), axis=1)
    once = np.c_[np.ones(n, bool), f[:, 1:] != f[:, :-1]]
    return f[once].astype(np.int32), np.r_[0, np.cumsum(once.sum(axis=1))]


def _range_sums(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of values[a[i]:b[i]] for each i."""
    if not len(values):
        return np.zeros(len(a))
    at = np.empty(2 * len(a), np.int64)
    at[0::2], at[1::2] = np.minimum(a, len(values) - 1), np.minimum(b, len(values) - 1)
    out = np.add.reduceat(values, at, dtype=np.float64)[0::2]
    last = (b == len(values)) & (a < b - 1)  # a range's end must be a place, so the last value is added apart
    out[last] += values[-1]
    out[a >= b] = 0.0
    return out


def _views(chunk: Chunk, fields: list[list]) -> list[tuple]:
    """Of each text of a chunk: text features and values, metadata features and values."""
    tri, out, (mf, edges) = char_grams(chunk, 3), [], _metas(chunk, fields)
    for i in range(chunk.last - chunk.first):
        a, b = chunk.text_starts[i], chunk.text_starts[i + 1]
        text = joined([share(tri[a : max(a, b - 2)], SCALE), share(word_grams(chunk, i, 1), SCALE)])
        own = mf[edges[i] : edges[i + 1]]
        out.append((*text, own, np.ones(len(own))))
    return out


def _sampled(batches):
    for batch in batches:
        fields = [batch.column(3 + j).to_pylist() for j in range(len(FIELDS))]
        for chunk in chunks(batch.column(1)):
            rows = _views(chunk, fields)
            yield pa.record_batch([batch.column(0).slice(chunk.first, len(rows)), batch.column(2).slice(chunk.first, len(rows)), *packed(rows, 2)],
                                  names=["doc_id", "label", "tf", "tv", "mf", "mv"])


def _inputs(docs: DataFrame, id_col: str, text_col: str) -> list:
    """doc_id, text and the metadata columns as text; a column that docs lack is null."""
    fields = [(F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string")).alias(c) for c in FIELDS]
    return [F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *fields]


def _prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(*_inputs(docs, id_col, text_col))


@dataclass
class _Turn:
    """Weights, intercept and calibration of both views at a round, and per view and label the least bin chosen with its share."""

    models: list
    picks: list = None


def _bin(z: np.ndarray) -> np.ndarray:
    """Bin of a logit; -1 for those that aren't sure."""
    step = (np.minimum(z, MOST_LOGIT) - LEAST_LOGIT) * (BINS - 1) / (MOST_LOGIT - LEAST_LOGIT)
    return np.where(z >= LEAST_LOGIT, step, -1).astype(np.int64)


def _logits(turn: _Turn, raw: list) -> list:
    return [curve[0] * r + curve[1] for (_, _, curve), r in zip(turn.models, raw)]


def _given(turns: list, raws: list, u: np.ndarray) -> np.ndarray:
    """Pseudo-labels that each view was given, nan for none; u: places in 0..1 that tell equal logits apart."""
    target = np.full((2, len(u)), np.nan)
    for number, (turn, raw) in enumerate(zip(turns, raws)):
        if turn.picks is None:
            break
        place = (u + 0.618 * number) % 1
        for v, z in enumerate(_logits(turn, raw)):
            open_ = np.isnan(target[1 - v])
            for value, (least, part) in zip((0.0, 1.0), turn.picks[v]):
                b = _bin(z if value else -z)
                target[1 - v][open_ & ((b > least) | ((b == least) & (place < part)))] = value
    return target


def _counted(turns: list, raws: list, u: np.ndarray) -> np.ndarray:
    """(view, label, bin): sure documents by the last turn's logits, of those whose other view has no label yet."""
    target, out = _given(turns, raws, u), np.zeros((2, 2, BINS), np.int64)
    for v, z in enumerate(_logits(turns[-1], raws[-1])):
        open_ = np.isnan(target[1 - v])
        for value in (0, 1):
            b = _bin(z if value else -z)[open_]
            out[v, value] = np.bincount(b[b >= 0], minlength=BINS)
    return out


def _pick(count: np.ndarray, most: int) -> tuple[int, float]:
    """(bin, share of it) from which on about `most` documents are; all higher bins are whole."""
    above = np.cumsum(count[::-1])[::-1]
    if above[0] <= most:
        return -1, 0.0
    least = int(np.flatnonzero(above > most)[-1])
    return least, float((most - (above[least] - count[least])) / count[least])


class _Sums:
    """Of pseudo-labelled documents, per view and label: gradient and curvature bound of each weight, and their number.

    As (sum of x_j d_j)**2 <= (sum of |x_j|) * (sum of |x_j| d_j**2), each weight's share of the curvature is |x_j| times the
    length of x, over 4; the intercept is a feature of value 1.
    """

    def __init__(self, dims: tuple[int, int]):
        self.grad, self.curve = ([np.zeros((2, d)) for d in dims] for _ in range(2))
        self.ends = np.zeros((2, 2, 3))  # of the intercept: gradient, curvature; number of documents

    def add(self, v: int, y: np.ndarray, r: np.ndarray, length: np.ndarray):
        for value in (0, 1):
            at = y == value
            self.ends[v, value] += r[at].sum(), (length[at] + 1).sum() / 4, at.sum()

    def spread(self, v: int, feature: np.ndarray, value: np.ndarray, y: np.ndarray, r: np.ndarray, length: np.ndarray):
        """One entry per feature of a document: its value, and the document's label, residual and length."""
        d = self.grad[v].shape[1]
        at = feature + d * y.astype(np.int64)
        self.grad[v] += np.bincount(at, value * r, minlength=2 * d).reshape(2, d)
        self.curve[v] += np.bincount(at, value * (length + 1) / 4, minlength=2 * d).reshape(2, d)

    def packed(self) -> tuple[bytes, bytes]:
        flat = np.concatenate([x.ravel() for x in (*self.grad, *self.curve)]).astype(np.float32)
        return flat.tobytes(), self.ends.tobytes()


def _sums_of(packed, dims) -> _Sums:
    """Of packed sums, added up."""
    out = _Sums(dims)
    for flat, ends in packed:
        flat, at = np.frombuffer(flat, np.float32), 0
        for x in (*out.grad, *out.curve):
            x += flat[at : at + x.size].reshape(x.shape)
            at += x.size
        out.ends += np.frombuffer(ends, float).reshape(2, 2, 3)
    return out


class _Rows:
    """A pool in memory: rows of the text view and of the metadata view."""

    def __init__(self, x: list, dims: tuple[int, int]):
        self.x, self.dims, self.size = x, dims, len(x[0])
        self.u = np.arange(self.size) * 0.7548776662 % 1

    def _raws(self, turns):
        return [[x.dot(w) + b for x, (w, b, _) in zip(self.x, t.models)] for t in turns]

    def counted(self, turns: list) -> np.ndarray:
        return _counted(turns, self._raws(turns), self.u)

    def sums(self, turns: list) -> _Sums:
        raws, out = self._raws(turns), _Sums(self.dims)
        for v, y in enumerate(_given(turns, raws, self.u)):
            x, r = self.x[v], sigmoid(raws[-1][v]) - y
            size = np.diff(x.at)
            length = np.bincount(np.repeat(np.arange(len(x)), size), np.abs(x.value), minlength=len(x))
            has = ~np.isnan(y)
            out.add(v, y[has], r[has], length[has])
            each = np.repeat(has, size)
            out.spread(v, x.feature[each], x.value[each], *(np.repeat(c, size)[each] for c in (y, r, length)))
        return out


def _with_meta(batches):
    """(text, place, metadata features) of pool documents."""
    for batch in batches:
        fields = [batch.column(2 + j).to_pylist() for j in range(len(FIELDS))]
        for chunk in chunks(batch.column(0)):
            n = chunk.last - chunk.first
            mf, edges = _metas(chunk, fields)
            yield pa.record_batch([batch.column(0).slice(chunk.first, n), batch.column(1).slice(chunk.first, n),
                                   pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(mf))], names=["text", "u", "mf"])


class _View:
    """Features of a chunk of pool documents, each occurrence on its own; those of a document stand together."""

    def __init__(self, chunk: Chunk, features: np.ndarray, edges: np.ndarray):
        n, starts = chunk.last - chunk.first, chunk.text_starts
        self.n, tri = n, char_grams(chunk, 3).astype(np.intp)  # as places, which every turn's weights are taken by
        words = (mix(grams(chunk.hashes, 1) + U64(1)) & U64(DIMS - 1)).astype(np.intp)
        ends = np.minimum(np.maximum(starts[1:] - 2, starts[:-1]), len(tri))  # no trigram goes across the end of a text
        self.parts = [(tri, np.minimum(starts[:-1], len(tri)), ends), (words, chunk.bounds[:-1], chunk.bounds[1:])]
        self.meta = features, edges[:-1], edges[1:]

    @staticmethod
    def share(part) -> np.ndarray:
        """Value of one occurrence, per document."""
        return SCALE / np.maximum(part[2] - part[1], 1)

    def raws(self, turns: list) -> list:
        out = []
        for turn in turns:
            (w, b, _), (wm, bm, _) = turn.models
            text = b + sum(_range_sums(w.take(part[0]), *part[1:]) * self.share(part) for part in self.parts)
            out.append([text, bm + _range_sums(wm.take(self.meta[0]), *self.meta[1:])])
        return out

    def add(self, sums: _Sums, turns: list, u: np.ndarray):
        raws = self.raws(turns)
        for v, y in enumerate(_given(turns, raws, u)):
            has, r = np.flatnonzero(~np.isnan(y)), sigmoid(raws[-1][v]) - y
            parts = [self.meta] if v else self.parts
            values = [np.ones(self.n) if v else self.share(part) for part in parts]
            length = sum(x * (part[2] - part[1]) for x, part in zip(values, parts))
            sums.add(v, y[has], r[has], length[has])
            for x, (f, a, b) in zip(values, parts):
                size = (b - a)[has]
                own = np.repeat(has, size)
                at = np.arange(size.sum()) + np.repeat(a[has] - np.cumsum(size) + size, size)
                sums.spread(v, f[at], x[own], y[own], r[own], length[own])


def _pool_pass(batches, turns, summed):
    """One row per task: counts of sure documents, or sums over those chosen."""
    counts, sums = np.zeros((2, 2, BINS), np.int64), _Sums((DIMS, META_DIMS)) if summed else None
    for batch in batches:
        u, meta = batch.column(1).to_numpy(), batch.column(2)
        for chunk in chunks(batch.column(0)):
            own = meta.slice(chunk.first, chunk.last - chunk.first)
            edges = np.asarray(own.offsets).astype(np.int64)
            view, places = _View(chunk, np.asarray(own.flatten()), edges - edges[0]), u[chunk.first : chunk.last]
            if summed:
                view.add(sums, turns, places)
            else:
                counts += _counted(turns, view.raws(turns), places)
    task = TaskContext.get().partitionId()
    if summed:
        flat, ends = sums.packed()
        yield pa.record_batch([pa.array([task], pa.int64()), pa.array([flat], pa.binary()), pa.array([ends], pa.binary())],
                              names=["task", "flat", "ends"])
    else:
        at = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(at, pa.int64()), pa.array(counts.ravel()[at], pa.int64())], names=["bin", "n"])


_SUMS = "task bigint, flat binary, ends binary"


def _meet(key, table):
    rows = zip(table.column("flat").to_pylist(), table.column("ends").to_pylist())
    flat, ends = _sums_of(rows, (DIMS, META_DIMS)).packed()
    return pa.table({"task": pa.array([key[0].as_py()], pa.int64()), "flat": pa.array([flat], pa.binary()),
                     "ends": pa.array([ends], pa.binary())})


class _Documents:
    """The pool as a table, read once for each count and each sum."""

    def __init__(self, rows: DataFrame):
        place = (F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)).alias("u")
        table = rows.select("text", place, *FIELDS).mapInArrow(_with_meta, "text string, u double, mf array<int>")
        self.table = materialized(rows.sparkSession, table, "pool")
        size = self.table.select(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.max("p").alias("p")).first()
        self.size, self.tasks, self.dims = size["n"], (size["p"] or 0) + 1, (DIMS, META_DIMS)

    def counted(self, turns: list) -> np.ndarray:
        got = self.table.mapInArrow(partial(_pool_pass, turns=turns, summed=False), "bin bigint, n bigint")
        out = np.zeros(2 * 2 * BINS, np.int64)
        for b, n in got.groupBy("bin").agg(F.sum("n")).collect():  # at most 4 * BINS rows
            out[b] = n
        return out.reshape(2, 2, BINS)

    def sums(self, turns: list) -> _Sums:
        got = self.table.mapInArrow(partial(_pool_pass, turns=turns, summed=True), _SUMS)
        tasks, levels = self.tasks, 0
        while tasks > FAN_IN or not levels:  # a level of the tree at a time, until the driver has few sums to add
            got = got.withColumn("task", F.floor(F.col("task") / FAN_IN)).groupBy("task").applyInArrow(_meet, _SUMS)
            tasks, levels = -(-tasks // FAN_IN), levels + 1
        return _sums_of(((r.flat, r.ends) for r in got.toLocalIterator()), self.dims)

    def discard(self):
        discard(self.table)


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 6000, rounds: int = ROUNDS, id_col: str = "doc_id",
        text_col: str = "text") -> CoModel:
    """Model of labels (doc_id, label 0/1; null is none); the pool are all documents outside of the labelled sample.

    With one class only, or no labels, the model gives the smoothed share of label 1 for all.
    """
    rows = _prepared(docs, id_col, text_col)
    known = labels.toDF("doc_id", "label").dropna().groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
    chosen = materialized(docs.sparkSession, sample_ids(known, max_labelled), "labelled")  # at most max_labelled rows
    got = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label", *FIELDS)
    label, x = sampled_rows(got.mapInArrow(_sampled, "doc_id bigint, label int, tf binary, tv binary, mf binary, mv binary"))
    if not 0 < label.sum() < len(label):
        return co_train(x, label, 0)
    pool = _Documents(rows.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_anti"))
    model = co_train(x, label, rounds, pool)
    pool.discard()
    return model


def co_train(x: list, label: np.ndarray, rounds: int, pool=None) -> CoModel:
    """x: the text view's rows and the metadata view's rows; label: 0 or 1.

    Without a pool, it is the rows whose label is nan.
    """
    has = ~np.isnan(label)
    pos, n = float(np.nansum(label)), int(has.sum())
    if not 0 < pos < n:
        flat = float(np.log((pos + 1) / (n - pos + 1)))
        return CoModel((np.zeros(DIMS, np.float32), 0.0, (0.0, flat)), (np.zeros(META_DIMS, np.float32), 0.0, (0.0, flat)),
                       (0.5, 0.5, 0.0))
    dims = (DIMS, META_DIMS)
    if pool is None:
        pool = _Rows([v.rows(~has) for v in x], dims)
        x, label = [v.rows(has) for v in x], label[has]
    held = np.zeros(len(label), bool)
    held[4::5] = True  # rows are in doc_id order
    if len(set(label[held])) < 2 or len(set(label[~held])) < 2:
        held = np.ones(len(label), bool)
        learn = held
    else:
        learn = ~held
    fitted = [fit_logistic(x[v], label, _weights(learn, label), dims[v], rounds=STEPS) for v in (0, 1)]
    turns = []
    for _ in range(rounds):
        models = []
        for v, (w, b) in enumerate(fitted):
            models.append((w, b, platt((x[v].dot(w) + b)[learn], label[learn])))
        turns.append(_Turn(models))
        count, most = pool.counted(turns), max(1, int(SHARE_PER_ROUND * pool.size))
        turns[-1].picks = [[_pick(count[v, value], most) for value in (0, 1)] for v in (0, 1)]
        sums = pool.sums(turns)
        for v in (0, 1):
            each, scale = _weights(learn, label, sums.ends[v, :, 2])
            far = [scale @ sums.grad[v], scale @ sums.curve[v], *(scale @ sums.ends[v, :, :2]), float(scale @ sums.ends[v, :, 2])]
            fitted[v] = fit_logistic(x[v], label, each, dims[v], start=fitted[v], rounds=STEPS, rate=0.2, far=far)
    logits = []
    for v in (0, 1):
        score = x[v].dot(fitted[v][0]) + fitted[v][1]
        curve = platt(score[held], label[held])
        fitted[v] = (fitted[v][0], fitted[v][1], curve)
        logits.append(np.clip(curve[0] * score + curve[1], -12, 12))
    both = Sparse.from_rows([(np.array([0, 1]), np.array(z)) for z in np.c_[logits[0][held], logits[1][held]]])
    w, b = fit_logistic(both, label[held], np.ones(int(held.sum())), 2, l2=1e-3, rounds=200, rate=0.1)
    w0, b0, curve = fitted[0]
    return CoModel((w0, b0, curve), fitted[1], (float(w[0]), float(w[1]), b))


def _weights(learn: np.ndarray, label: np.ndarray, given: np.ndarray | None = None):
    """Weights of the labelled rows, so that both labels weigh the same; with those given to the pool, also theirs per label."""
    n = np.array([(learn & (label == value)).sum() for value in (0, 1)]) + (0 if given is None else given)
    scale = 0.5 / np.maximum(n, 1)
    each = learn * np.where(label == 1, scale[1], scale[0])
    return each if given is None else (each, scale)


SCORED = "doc_id bigint, text_score double, meta_score double, score double, kept boolean"


def _score(batches, model, threshold):
    for batch in batches:
        fields = [batch.column(2 + j).to_pylist() for j in range(len(FIELDS))]
        for chunk in chunks(batch.column(1)):
            n, turn = chunk.last - chunk.first, _Turn([model.text, model.meta])
            logits = np.array(_logits(turn, _View(chunk, *_metas(chunk, fields)).raws([turn])[0]))
            logits = np.clip(logits, -12, 12)
            score = sigmoid(model.mixture[0] * logits[0] + model.mixture[1] * logits[1] + model.mixture[2])
            yield pa.record_batch([batch.column(0).slice(chunk.first, n).cast(pa.int64()), pa.array(sigmoid(logits[0])),
                                   pa.array(sigmoid(logits[1])), pa.array(score), pa.array(score >= threshold)],
                                  names=["doc_id", "text_score", "meta_score", "score", "kept"])


def quality_classifier(docs: DataFrame, model: CoModel, threshold: float = 0.5, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, both views' probabilities of good quality, the combined score, kept.

    Null texts count as empty and are scored by what the views say of an empty page; null or absent metadata is a
    value of its own.  Repeated rows stay; other columns aren't read.
    """
    return _prepared(docs, id_col, text_col).mapInArrow(partial(_score, model=model, threshold=threshold), SCORED)


def good_documents(docs: DataFrame, model: CoModel, threshold: float = 0.5, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, that quality_classifier keeps; nothing is shuffled."""
    inputs = _inputs(docs, id_col, text_col)
    rows = docs.select("*", *[c.alias(name) for c, name in zip(inputs, fresh(docs.columns, len(inputs)))])
    score = partial(_score, model=model, threshold=threshold)
    return rows.mapInArrow(partial(kept_rows, columns=len(docs.columns), score=score, keep=_kept), docs.schema)


def _kept(scored):
    return scored.column(4)
