"""Column blobs dealt to buckets: many small postings travel as a few binary rows.

A blob row is (bucket, kind, a, b, c): parallel arrays as bytes.  The number of buckets grows with
the input (``buckets_for``), so a bucket's postings fit in one task; keys that hold a large share of
all rows are found beforehand (``heavy.py``) and never dealt out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidewater import fs
from tidewater.llm.words import U64, chunks
from tidewater.session import scratch_path

BLOB = "bucket int, kind int, a binary, b binary, c binary"
BLOB_ARROW = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary()),
                        ("c", pa.binary())])
GROUP_WORDS = 500_000  # words that a task holds before it deals them out
BUCKET_POSTINGS = 1_500_000  # postings that a bucket's task holds, about


def buckets_for(postings: int, most: int = BUCKET_POSTINGS) -> int:
    return max(1, -(-postings // most))


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def set_conf(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for what runs inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def materialized(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: survives lost executors, computed once.

    The write's shuffle files go when it ends: nothing reads them again, and else they stay until the driver collects its garbage.
    """
    path = scratch_path(spark, name)
    with set_conf(spark, SHUFFLES_GO, "true"):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a materialized table that nothing reads any more."""
    fs.delete(df.sparkSession, df.scratch_path)


def text_groups(batches: Iterable[pa.RecordBatch], lower: bool) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """(ids, word hashes of each text) for runs of consecutive rows of up to GROUP_WORDS words."""
    for batch in batches:
        ids, texts, first, held = batch.column(0), [], 0, 0
        for chunk in chunks(batch.column(1), lower):
            if texts and held + len(chunk.hashes) > GROUP_WORDS:
                yield ids.slice(first, len(texts)), texts
                first, texts, held = chunk.first, [], 0
            texts += [chunk.words(i) for i in range(chunk.last - chunk.first)]
            held += len(chunk.hashes)
        if texts:
            yield ids.slice(first, len(texts)), texts


def bucket_of(h: np.ndarray, n: int) -> np.ndarray:
    """By the 24 top bits, so that all else of the hash stays free within a bucket."""
    return ((h >> U64(40)) * U64(n) >> U64(24)).astype(np.int32)


def dealt(bucket: np.ndarray, kind: int, *columns: np.ndarray) -> pa.RecordBatch:
    """One blob per bucket; rows keep their order within it."""
    small = bucket.astype(np.uint16) if len(bucket) and bucket.max() < 65536 else bucket
    order = np.argsort(small, kind="stable")
    cut = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    ends = np.r_[cut[1:], len(order)]
    cols = [c[order] for c in columns]
    blobs = [pa.array([c[i:j].tobytes() for i, j in zip(cut, ends)], pa.binary()) for c in cols]
    blobs += [pa.array([None] * len(cut), pa.binary())] * (3 - len(blobs))
    return pa.record_batch([pa.array(bucket[order][cut], pa.int32()), pa.array(np.full(len(cut), kind, np.int32)),
                            *blobs], schema=BLOB_ARROW)


def column(table: pa.Table, name: str, dtype) -> np.ndarray:
    """All of one binary column, joined."""
    return np.frombuffer(b"".join(x for x in table.column(name).to_pylist() if x), dtype)


def low_bytes(h: np.ndarray, n: int) -> np.ndarray:
    """The n low bytes of each hash, as rows of bytes."""
    return np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8)[:, :n]


def from_low_bytes(raw: np.ndarray, n: int, bucket: int) -> np.ndarray:
    """Hashes again, the bucket's number in place of the bytes left out."""
    out = np.empty((len(raw) // n, 8), np.uint8)
    out[:, :n] = raw.reshape(-1, n)
    fill = np.frombuffer(np.uint64(bucket % (1 << (8 * (8 - n)))).tobytes(), np.uint8)
    out[:, n:] = fill[: 8 - n]
    return out.view(np.uint64).ravel()
