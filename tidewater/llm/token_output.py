"""Token ids as packed binary matrices.

Each task packs the documents it reads, a bounded shard at a time, so no token crosses the network.  Pieces are
placed best-fit-decreasing: a segment tree over free capacities, each leaf the sequences with exactly that much
free, finds the fullest sequence that still holds a piece in one descent.  Documents longer than a sequence are cut
without loss.  A row is one sequence: fixed-width little-endian ids (padded), cumulative segment lengths, the
places where position ids start again, and which piece of which document each segment is.
"""

from __future__ import annotations

import json
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.bpe import runs
from tidewater.llm.word_tokens import load

CAPACITY = 2048
SHARD_TOKENS = 4_000_000  # tokens that a task holds before it packs them


class CapacityTree:
    """Sequences by free space; the nearest free space of at least n is found from the leaf of n upwards."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(self.size)]

    def _add(self, free: int, n: int) -> None:
        i = free + self.size
        while i:
            self.count[i] += n
            i >>= 1

    def put(self, free: int, b: int) -> None:
        self.bins[free].append(b)
        self._add(free, 1)

    def take(self, n: int) -> tuple[int, int] | None:
        """(free space, sequence) of the fullest sequence with n or more free, removed; None if there is none."""
        i, count = n + self.size, self.count
        while not count[i]:
            while i & 1:
                i >>= 1
            if i <= 1:
                return None
            i += 1
        while i < self.size:
            i *= 2
            if not count[i]:
                i += 1
        free = i - self.size
        self._add(free, -1)
        return free, self.bins[free].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Items of each sequence, in order of place."""
    tree, out = CapacityTree(capacity), []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        found = tree.take(n)
        if found is None:
            found = capacity, len(out)
            out.append([])
        free, b = found
        out[b].append(i)
        if free > n:
            tree.put(free - n, b)
    return out


PACKED = ("shard bigint, sequence int, n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, "
          "segments array<struct<doc_id:bigint,piece:int,start:bigint,length:int>>")
_SEGMENTS = pa.list_(pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32())]))


def _shard(number, held, capacity, dtype, pad_id):
    """Rows of one shard; held: (doc_id, piece, start, ids)."""
    bins = best_fit_decreasing(np.array([len(x[3]) for x in held]), capacity)
    matrix = np.full((len(bins), capacity), pad_id, dtype)
    edges, resets, segments, size = [], [], [], []
    for row, items in zip(matrix, bins):
        at, cu, seg = 0, [0], []
        for i in items:
            doc, piece, start, ids = held[i]
            row[at : at + len(ids)] = ids
            at += len(ids)
            cu.append(at)
            seg.append({"doc_id": doc, "piece": piece, "start": start, "length": len(ids)})
        edges.append(cu)
        resets.append(cu[:-1])
        segments.append(seg)
        size.append(at)
    n, ints = len(bins), pa.list_(pa.int32())
    return pa.record_batch([
        pa.array(np.full(n, number, np.int64)), pa.array(np.arange(n, dtype=np.int32)), pa.array(size, pa.int32()),
        pa.array([r.tobytes() for r in matrix], pa.binary()), pa.array(edges, ints), pa.array(resets, ints),
        pa.array(segments, _SEGMENTS)], names=[x.split()[0] for x in PACKED.split(", ")])


def _write_shards(batches, path, capacity, end_id, pad_id, dtype):
    tokenizer, held, tokens = load(path), [], 0
    number = TaskContext.get().partitionId() << 32
    end = np.array([end_id], "<u4")
    for batch in batches:
        texts, docs = [t or "" for t in batch.column(1).to_pylist()], batch.column(0).to_pylist()
        for i, j in runs(texts):
            for doc, ids in zip(docs[i:j], tokenizer.encode(texts[i:j])):
                ids = np.concatenate([np.frombuffer(ids, "<u4"), end]).astype(dtype)
                held += [(doc, k, s, ids[s : s + capacity]) for k, s in enumerate(range(0, len(ids), capacity))]
                tokens += len(ids)
            if tokens >= SHARD_TOKENS:
                yield _shard(number, held, capacity, dtype, pad_id)
                number, held, tokens = number + 1, [], 0
    if held:
        yield _shard(number, held, capacity, dtype, pad_id)


def packed_tokens(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, pad_id: int = 0, dtype: str = "<u2",
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per sequence of at most capacity tokens, of the ids of every whole text, each followed by end_id.

    Null texts count as empty: end_id alone.  (shard, sequence) names a sequence; which documents share one depends on how
    the input is split among tasks, the documents' own segments don't.  Repeated rows are packed as often as they stand.
    dtype: "<u2" holds ids up to 65535, "<u4" all.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(partial(_write_shards, path=path, capacity=capacity, end_id=end_id, pad_id=pad_id, dtype=dtype), PACKED)


def write_packed(packed: DataFrame, out: str, capacity: int = CAPACITY, dtype: str = "<u2") -> None:
    """Parquet of the rows with the matrix's shape and type in meta/, so that a reader needs nothing else."""
    packed.write.parquet(f"{out}/sequences")
    spark: SparkSession = packed.sparkSession
    spark.createDataFrame([(json.dumps({"capacity": capacity, "dtype": dtype}),)], "value string").coalesce(1).write.text(f"{out}/meta")


def documents_of(packed: DataFrame, dtype: str = "<u2") -> DataFrame:
    """(doc_id, piece, start, ids) again, one row per segment: the inverse of the packing."""
    width = np.dtype(dtype).itemsize
    seg = packed.select("ids", "cu_seqlens", F.posexplode("segments").alias("i", "s"))
    begin = F.element_at("cu_seqlens", F.col("i") + 1)
    return seg.select("s.doc_id", "s.piece", "s.start", F.expr(f"substring(ids, {width} * cu_seqlens[i] + 1, {width} * s.length)").alias(
        "ids"), begin.alias("offset"))
