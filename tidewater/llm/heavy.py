"""Keys that a large share of all documents holds.

Each task counts the documents that hold a key within a run of its rows and reports keys above half
the wanted share there.  A key above ``SHARE`` of all documents is reported where it holds at least half
of that share on average, so the reported counts of every such key sum to half of SHARE or more;
as all counts together are the postings, at most 2 / SHARE times the mean set size of keys remain.  That
bound on the broadcast table doesn't grow with the number of documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARE = 0.01
LEAST = 3  # a run of few rows reports only what it has seen so often


def local_heavy(keys: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, counts) above half of SHARE in a run of docs documents; keys: one per document and key."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    s = np.sort(keys)
    at = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
    n = np.diff(np.r_[at, len(s)])
    keep = n >= max(LEAST, SHARE / 2 * docs)
    return s[at][keep], n[keep]


def heavy_table(reported: DataFrame, docs: int, postings: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and their counts, from rows (key, count); checked against the bound above."""
    least = max(LEAST, SHARE / 2 * docs)
    rows = reported.groupBy("key").agg(F.sum("count").alias("count")).where(F.col("count") >= least).toArrow()
    if len(rows) > postings / least + 1:
        raise AssertionError(f"{len(rows)} heavy keys; the bound is {postings / least:.0f}")
    keys = rows.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], rows.column("count").to_numpy()[order]


def member(sorted_keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which of x are among sorted_keys."""
    if not len(sorted_keys):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_keys, x), len(sorted_keys) - 1)
    return sorted_keys[at] == x


def int64(a) -> pa.Array:
    return pa.array(np.ascontiguousarray(a).view(np.int64))
