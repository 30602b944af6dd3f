"""Quality rules: base counts with fixed limits, and a hashed n-gram logistic model against a fixed threshold.

The model reads each text as the shares of its hashed character n-grams (bytes, n = 2 to 4) and word n-grams
(n = 1, 2).  It learns from labelled quality rows, at most ``max_examples`` by hash of doc_id; four fifths fit the
weights, the rest fit the curve that turns scores into probabilities.  Scoring runs over Arrow
batches: a text's score is a mean of weights looked up by feature.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.features import DIMS, char_grams, joined, packed, sample_ids, sampled_rows, share, word_grams
from tidewater.llm.linear import Sparse, fit_logistic, platt, sigmoid
from tidewater.llm.words import Chunk, chunks, grams

CHARS, WORDS = (2, 3, 4), (1, 2)
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 10, 20, 5
THRESHOLD = 0.5
SCALE = 30.0  # of shares, so that weights of ordinary size matter

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


@dataclass
class NgramModel:
    weights: np.ndarray
    intercept: float
    curve: tuple[float, float]


def _features(chunk: Chunk) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text of a chunk: (features, values)."""
    chars = [char_grams(chunk, n) for n in CHARS]
    out = []
    for i in range(chunk.last - chunk.first):
        a, b = chunk.text_starts[i], chunk.text_starts[i + 1]
        parts = [share(c[a : max(a, b - n + 1)], SCALE) for n, c in zip(CHARS, chars)]
        out.append(joined(parts + [share(word_grams(chunk, i, n), SCALE) for n in WORDS]))
    return out


def _sampled_features(batches):
    """(doc_id, label, features, values) of the sampled documents."""
    for batch in batches:
        for chunk in chunks(batch.column(1)):
            rows = _features(chunk)
            yield pa.record_batch([
                batch.column(0).slice(chunk.first, len(rows)), batch.column(2).slice(chunk.first, len(rows)), *packed(rows, 1)],
                names=["doc_id", "label", "features", "values"])


def fit(docs: DataFrame, labels: DataFrame, max_examples: int = 4000, id_col: str = "doc_id",
        text_col: str = "text") -> NgramModel:
    """Model of labels (doc_id, label 0/1; null is none) over at most max_examples documents.

    With one class only, or none, every text gets the smoothed share of label 1.
    """
    sample = sample_ids(labels.toDF("doc_id", "label").dropna().groupBy("doc_id").agg(
        F.min("label").cast("int").alias("label")), max_examples)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "label")  # at most max_examples rows
    y, (x,) = sampled_rows(rows.mapInArrow(_sampled_features, "doc_id bigint, label int, features binary, values binary"))
    return fit_rows(x, y)


def fit_rows(x: Sparse, y: np.ndarray) -> NgramModel:
    pos = float(y.sum())
    if not 0 < pos < len(y):
        return NgramModel(np.zeros(DIMS, np.float32), 0.0, (0.0, float(np.log((pos + 1) / (len(y) - pos + 1)))))
    late = np.arange(len(y)) % 5 == 4  # rows are in doc_id order
    use = ~late
    if len(set(y[use])) < 2 or len(set(y[late])) < 2:
        use = late = np.ones(len(y), bool)
    each = use * np.where(y == 1, 0.5 / max(1, y[use].sum()), 0.5 / max(1, (1 - y[use]).sum()))
    w, b = fit_logistic(x, y, each, DIMS)
    return NgramModel(w, b, platt((x.dot(w) + b)[late], y[late]))


def _score_chunk(chunk: Chunk, model: NgramModel) -> np.ndarray:
    """Probability of label 1 for each text."""
    starts = chunk.text_starts
    total = np.full(chunk.last - chunk.first, model.intercept)
    for n in CHARS:
        c = char_grams(chunk, n)
        sums = np.r_[0.0, np.cumsum(model.weights[c], dtype=np.float64)]
        a, b = np.minimum(starts[:-1], len(c)), np.maximum(starts[1:] - n + 1, starts[:-1])
        b = np.minimum(np.maximum(b, a), len(c))
        total += SCALE * (sums[b] - sums[a]) / np.maximum(b - a, 1)
    for n in WORDS:
        for i in range(len(total)):
            f = word_grams(chunk, i, n)
            if len(f):
                total[i] += SCALE * model.weights[f].mean(dtype=np.float64)
    return sigmoid(model.curve[0] * total + model.curve[1])


def _line_repeats(chunk: Chunk) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text, by text."""
    data, starts = chunk.data, chunk.text_starts
    n = len(starts) - 1
    if not len(data):
        return np.zeros(n, np.int64)
    begin = np.unique(np.r_[starts[:-1], np.flatnonzero(data == 10) + 1])
    begin = begin[begin < len(data)]
    text = np.searchsorted(starts, begin, side="right") - 1
    end = np.r_[begin[1:], len(data)]
    end = end - (data[end - 1] == 10)
    worded = np.searchsorted(chunk.starts, end) > np.searchsorted(chunk.starts, begin)
    begin, end, text = begin[worded], end[worded], text[worded]
    raw = data.tobytes()
    out, seen, last = np.zeros(n, np.int64), set(), -1
    for a, b, t in zip(begin.tolist(), end.tolist(), text.tolist()):
        if t != last:
            seen, last = set(), t
        line = raw[a:b]
        if line in seen:
            out[t] += 1
        else:
            seen.add(line)
    return out


def _repeat_words(hashes: np.ndarray) -> int:
    """Words in windows of REPEAT_WINDOW words that the text has twice or more, the first one included."""
    g = grams(hashes, REPEAT_WINDOW)
    if len(g) < 2:
        return 0
    o = np.argsort(g, kind="stable")
    s = g[o]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    at = o[np.r_[same, False] | np.r_[False, same]]
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + REPEAT_WINDOW, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


JUDGED = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "base_failed boolean, score double, kept boolean")


def _judge(batches, model, threshold):
    names = [x.split()[0] for x in JUDGED.split(", ")]
    for batch in batches:
        for chunk in chunks(batch.column(1)):
            n = chunk.last - chunk.first
            starts, bounds = chunk.text_starts, chunk.bounds
            words = np.diff(bounds)
            # a byte that doesn't continue a character begins one
            chars = np.r_[0, np.cumsum((chunk.data & 0xC0) != 0x80, dtype=np.int32)]
            in_word = np.r_[0, np.cumsum(chars[chunk.ends] - chars[chunk.starts], dtype=np.int64)]
            symbols = np.r_[0, np.cumsum(_SYMBOL[chunk.data], dtype=np.int32)]
            repeat = np.array([_repeat_words(chunk.words(i)) for i in range(n)], np.int64)
            failed = (words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * words)
            score = _score_chunk(chunk, model)
            cols = [batch.column(0).slice(chunk.first, n).cast(pa.int64()), words, in_word[bounds[1:]] - in_word[bounds[:-1]],
                    (symbols[starts[1:]] - symbols[starts[:-1]]).astype(np.int64), _line_repeats(chunk), repeat, failed, score,
                    ~failed & (score >= threshold)]
            yield pa.record_batch([pa.array(c) if isinstance(c, np.ndarray) else c for c in cols], names=names)


def quality_rules(docs: DataFrame, model: NgramModel, threshold: float = THRESHOLD, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: base counts, base_failed, the model's probability of good quality, kept.

    Null and empty texts have no words and fail.  Words are runs outside ASCII white space; lines end at \\n.
    Repeated rows stay; other columns aren't read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(partial(_judge, model=model, threshold=threshold), JUDGED)
