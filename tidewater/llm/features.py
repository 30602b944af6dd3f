"""Hashed features of texts, a whole chunk at a time, and bounded samples of labelled documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.linear import Sparse
from tidewater.llm.words import NEAR, U64, Chunk, grams, mix

DIMS = 1 << 18
_N = U64(DIMS - 1)


def char_grams(chunk: Chunk, n: int) -> np.ndarray:
    """Feature of the n bytes from each byte of the chunk on; those across text ends are the caller's to leave out."""
    m = len(chunk.data) - n + 1
    out = np.empty(max(m, 0), np.int32)
    for start in range(0, m, NEAR):
        d = chunk.data[start : start + NEAR + n - 1].astype(np.uint64)
        k = len(d) - n + 1
        code, shifted = d[:k].copy(), np.empty(k, np.uint64)
        for j in range(1, n):
            code |= np.left_shift(d[j : j + k], U64(8 * j), out=shifted)
        code += U64(n << 60)
        code *= U64(0x9E3779B97F4A7C15)
        code >>= U64(64 - 18)
        out[start : start + k] = code
    return out


def word_grams(chunk: Chunk, i: int, n: int) -> np.ndarray:
    """Features of the runs of n words of text i."""
    return (mix(grams(chunk.words(i), n) + U64(n)) & _N).astype(np.int32)


def share(features: np.ndarray, weight: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """(features, values): each feature's share of all occurrences."""
    if not len(features):
        return np.zeros(0, np.int64), np.zeros(0)
    f, n = np.unique(features, return_counts=True)
    return f.astype(np.int64), n * (weight / len(features))


def joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([f for f, _ in parts]), np.concatenate([v for _, v in parts])


def sample_ids(ids: DataFrame, most: int) -> DataFrame:
    """At most `most` rows of (doc_id, ...), those of least hash: the same rows whatever the partitions."""
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def sampled_rows(rows: DataFrame) -> tuple[np.ndarray, list[Sparse]]:
    """(labels, rows of each view) in doc_id order, of a bounded sample (doc_id, label, then features and values of each view, packed).

    A partition at a time comes to the driver, so that its JVM never holds the sample."""
    got = sorted(rows.dropDuplicates(["doc_id"]).toLocalIterator(), key=lambda r: r.doc_id)
    label = np.array([r.label for r in got], float)
    columns = [[r[j] for r in got] for j in range(2, len(rows.columns))]
    del got
    return label, [Sparse.from_bytes(f, v) for f, v in zip(columns[0::2], columns[1::2])]


def packed(rows: list[tuple], views: int) -> list[pa.Array]:
    """Columns of features and values of each view; rows: features and values, view by view."""
    return [pa.array([r[j].astype(np.float32 if j % 2 else np.int32).tobytes() for r in rows], pa.binary()) for j in range(2 * views)]


def fresh(columns: list[str], n: int) -> list[str]:
    """n column names that none of columns has."""
    taken, stem = {c.lower() for c in columns}, "_in"
    while any(c.startswith(stem) for c in taken):
        stem += "_"
    return [f"{stem}{i}" for i in range(n)]


def kept_rows(batches, columns: int, score, keep) -> Iterator[pa.RecordBatch]:
    """The first `columns` columns of the rows that keep(scored batch) marks; score reads the columns after them."""
    for batch in batches:
        rest = pa.RecordBatch.from_arrays(batch.columns[columns:], names=[f"c{i}" for i in range(batch.num_columns - columns)])
        masks = [keep(x) for x in score([rest])]
        if masks:
            own = pa.RecordBatch.from_arrays(batch.columns[:columns], names=batch.schema.names[:columns])
            yield own.filter(pa.concat_arrays(masks))
