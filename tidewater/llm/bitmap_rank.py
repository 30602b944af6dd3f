"""Ranks of integer keys within groups, from bitmaps instead of a sort.

Keys are cut into containers of 2**16 neighbours.  Each task adds its keys to compressed bitmaps (sorted 16-bit numbers while
there are few, 8 KiB of bits beyond); bitmaps of one container are merged; a directory of their populations, a tree over
the upper 48 bits with at most 2**16 children a node, gives how many rows stand before each container.  A rank
query is that number plus the population of the container's bits below the key, by a popcount directory over its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.exchange import materialized
from tidewater.llm.features import fresh

FEW = 4095  # keys that a container holds as numbers; more are bits, 8 KiB of them
TASK_ROWS = 1_000_000  # keys that a task turns into bitmaps at a time
HOT = 1 << 18  # rows of a container that one task ranks; a container of more is ranked by several

_EXTRA = np.dtype([("low", "<u2"), ("more", "<i8")])  # keys of more than one row, and how many more
PART = "grp string, hi bigint, bits binary, extra binary, total bigint"


def compressed(low: np.ndarray, rows: np.ndarray) -> tuple[bytes, bytes]:
    """(bits, extra) of ascending distinct 16-bit keys and their numbers of rows."""
    more = rows > 1
    extra = np.empty(int(more.sum()), _EXTRA)
    extra["low"], extra["more"] = low[more], rows[more] - 1
    if len(low) <= FEW:
        return low.astype("<u2").tobytes(), extra.tobytes()
    bits = np.zeros(1 << 16, bool)
    bits[low] = True
    return np.packbits(bits, bitorder="little").tobytes(), extra.tobytes()


def expanded(bits: bytes, extra: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of compressed."""
    if len(bits) == 1 << 13:
        low = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))
    else:
        low = np.frombuffer(bits, "<u2").astype(np.int64)
    rows = np.ones(len(low), np.int64)
    more = np.frombuffer(extra, _EXTRA)
    rows[np.searchsorted(low, more["low"])] += more["more"]
    return low, rows


class Directory:
    """Rank queries on one container."""

    def __init__(self, bits: bytes, extra: bytes):
        more = np.frombuffer(extra, _EXTRA)
        self.extra, self.more = more["low"].astype(np.int64), np.r_[0, np.cumsum(more["more"])]
        self.low = self.words = None
        if len(bits) == 1 << 13:
            self.words = np.frombuffer(bits, "<u8")
            count = np.bitwise_count(self.words).astype(np.int64)
            self.before = np.cumsum(count) - count
        else:
            self.low = np.frombuffer(bits, "<u2")

    def rank(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows of smaller keys, rows of the key) of 16-bit keys that the container holds."""
        if self.words is None:
            below = np.searchsorted(self.low, low)
        else:
            word, mask = low >> 6, (np.uint64(1) << (low & 63).astype(np.uint64)) - np.uint64(1)
            below = self.before[word] + np.bitwise_count(self.words[word] & mask)
        i = np.searchsorted(self.extra, low)
        same = np.ones(len(low), np.int64)
        if len(self.extra):
            at = np.minimum(i, len(self.extra) - 1)
            hit = self.extra[at] == low
            same[hit] += np.diff(self.more)[at[hit]]
        return below + self.more[i], same


def _merged(low: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(low, return_inverse=True)
    return keys, np.bincount(at, rows, len(keys)).astype(np.int64)


def _part(grp, hi, low, rows):
    return (grp, hi, *compressed(low, rows), int(rows.sum()))


def _table(parts):
    types = (pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*parts), types)], names=[x.split()[0] for x in PART.split(", ")])


def _task_bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmaps of the rows (grp, key, rows) of a task; a null key is a container of its own."""
    held, n = [], 0

    def flush():
        t = pa.Table.from_batches(held)
        names = t["grp"].combine_chunks().dictionary_encode()
        names = names.combine_chunks() if isinstance(names, pa.ChunkedArray) else names
        code = np.asarray(names.indices).astype(np.int64)
        none = np.asarray(t["key"].is_null())
        key = np.asarray(t["key"].fill_null(0))
        hi, low, rows = key >> 16, key & 0xFFFF, np.asarray(t["rows"])
        order = np.lexsort((low, hi, none, code))
        edge = np.flatnonzero((np.diff(code[order], prepend=-1) != 0) | (np.diff(none[order], prepend=False) != 0)
                              | (np.diff(hi[order], prepend=0) != 0))
        parts = []
        for i, j in zip(edge, np.r_[edge[1:], len(order)]):
            at = order[i:j]
            first = at[0]
            parts.append(_part(names.dictionary[int(code[first])].as_py(), None if none[first] else int(hi[first]),
                               *_merged(low[at], rows[at])))
        return _table(parts)

    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= TASK_ROWS:
            yield flush()
            held, n = [], 0
    if n:
        yield flush()


def _merge_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bitmap per container from parts sorted by (grp, hi), a container at a time."""
    current, low, rows, out = None, [], [], []
    for batch in batches:
        for r in batch.to_pylist():
            if (r["grp"], r["hi"]) != current:
                if current:
                    out.append(_part(*current, *_merged(np.concatenate(low), np.concatenate(rows))))
                current, low, rows = (r["grp"], r["hi"]), [], []
            a, b = expanded(r["bits"], r["extra"])
            low.append(a)
            rows.append(b)
            if len(low) > 64:
                a, b = _merged(np.concatenate(low), np.concatenate(rows))
                low, rows = [a], [b]
            if len(out) >= 512:
                yield _table(out)
                out = []
    if current:
        out.append(_part(*current, *_merged(np.concatenate(low), np.concatenate(rows))))
    if out:
        yield _table(out)


def bitmaps(keys: DataFrame) -> DataFrame:
    """(grp, hi, bits, extra, total): a compressed bitmap per container of the rows (grp string, key bigint, rows bigint)."""
    parts = keys.select("grp", "key", "rows").mapInArrow(_task_bitmaps, PART)
    return parts.repartition("grp", "hi").sortWithinPartitions("grp", "hi").mapInArrow(_merge_sorted, PART)


def directory(containers: DataFrame) -> DataFrame:
    """containers, with base (rows of the group before each) and n (rows of the group).

    Containers are leaves of a tree over hi: its nodes have at most 2**16 children, so no window is larger.
    """
    c = containers.withColumns({"hi1": F.shiftright("hi", 16), "hi2": F.shiftright("hi", 32)})
    level1 = c.groupBy("grp", "hi1", "hi2").agg(F.sum("total").alias("t1"))
    level2 = level1.groupBy("grp", "hi2").agg(F.sum("t1").alias("t2"))

    def before(column, *by):
        *part, order = by
        return F.coalesce(F.sum(column).over(Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)),
                          F.lit(0))

    level2 = level2.withColumns({"b2": before("t2", "grp", "hi2"), "n": F.sum("t2").over(Window.partitionBy("grp"))})
    level1 = level1.withColumn("b1", before("t1", "grp", "hi2", "hi1"))
    c = c.withColumn("b0", before("total", "grp", "hi1", "hi"))
    top = level1.alias("a").join(level2.alias("b"), F.expr("a.grp = b.grp and a.hi2 <=> b.hi2")).select(
        F.col("a.grp"), F.col("a.hi1"), (F.col("b1") + F.col("b2")).alias("b12"), "n")
    out = c.alias("c").join(top.alias("t"), F.expr("c.grp = t.grp and c.hi1 <=> t.hi1"))
    return out.select("c.grp", "c.hi", "bits", "extra", "total", (F.col("b0") + F.col("b12")).alias("base"), "n")


def _rank_sorted(batches: Iterator[pa.RecordBatch], width: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows sorted so that each container stands before its keys; first `width` columns are handed on, with their ranks."""
    base = n = 0
    ranks = None
    for batch in batches:
        kind, low, none = (batch.column(i) for i in range(width, width + 3))
        bits, extra, bases, totals = (batch.column(i) for i in range(width + 3, width + 7))
        is_row = np.asarray(kind) == 1
        low, none = np.asarray(low.fill_null(0)), np.asarray(none)
        rank, same, total = (np.zeros(len(low), np.int64) for _ in range(3))
        starts = np.flatnonzero(~is_row)
        for i, j in zip(np.r_[0, starts + 1], np.r_[starts, len(low)]):
            if i:
                base, n = bases[int(i) - 1].as_py(), totals[int(i) - 1].as_py()
                ranks = Directory(bits[int(i) - 1].as_py(), extra[int(i) - 1].as_py())
            if i < j:
                below, same[i:j] = ranks.rank(low[i:j])
                rank[i:j], total[i:j] = below + base, n
        keep = pa.array(is_row)
        kept = [c.filter(keep) for c in batch.columns[:width]]
        yield pa.RecordBatch.from_arrays([*kept, *[pa.array(x[is_row]) for x in (rank, same, total)]], names=names)


def ranked(rows: DataFrame, grp: str, key: str, weight: str | None = None) -> DataFrame:
    """rows and rank (rows of the group with a smaller key), same (rows with this key), n (rows of the group).

    grp: a string column without nulls; key: bigint, null being the smallest; weight: a column of how many rows
    each stands for.  rows is read twice, so it should be a table.  Hot containers are ranked by several tasks.
    """
    spark = rows.sparkSession
    lit = F.lit(1) if weight is None else F.col(weight)
    keys = rows.select(F.col(grp).alias("grp"), F.col(key).alias("key"), lit.cast("bigint").alias("rows"))
    table = materialized(spark, directory(materialized(spark, bitmaps(keys), "bitmaps")), "containers")
    hot = table.where(F.col("total") > HOT).select("grp", "hi", F.ceil(F.col("total") / HOT).alias("shares"))
    own = rows.columns
    a, b, c, d, k, none, x, y, z, t, ix = fresh(own, 11)
    r = rows.select(*[F.col(f"`{q}`") for q in own], F.lit(1).alias(k), F.col(key).bitwiseAND(F.lit(0xFFFF)).alias(x),
                    F.col(key).isNull().alias(none), F.lit(None).cast("binary").alias(a), F.lit(None).cast("binary").alias(b),
                    F.lit(None).cast("bigint").alias(c), F.lit(None).cast("bigint").alias(d), F.col(grp).alias(y),
                    F.shiftright(key, 16).alias(z), F.lit(0).cast("bigint").alias(t))
    shares = table.select("*", F.lit(0).cast("bigint").alias("share"))
    if not hot.isEmpty():
        r = r.withColumn(ix, F.monotonically_increasing_id()).alias("r").join(
            hot.alias("h"), F.expr(f"r.{y} = h.grp and r.{z} <=> h.hi"), "left")
        r = r.withColumn(t, F.coalesce(F.pmod(F.xxhash64(ix), F.col("shares")), F.lit(0))).select(
            *[F.col(f"r.`{q}`") for q in own], k, x, none, a, b, c, d, y, z, t)
        shares = table.withColumn("share", F.explode(F.expr(f"sequence(0L, cast((total - 1) div {HOT} as bigint))")))
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema]
    heads = shares.select(*blank, F.lit(0).alias(k), F.lit(0).cast("bigint").alias(x), F.col("hi").isNull().alias(none),
                          F.col("bits").alias(a), F.col("extra").alias(b), F.col("base").alias(c), F.col("n").alias(d),
                          F.col("grp").alias(y), F.col("hi").alias(z), F.col("share").alias(t))
    both = r.unionAll(heads).repartition(y, z, t).sortWithinPartitions(y, z, t, k)
    both = both.select(*[F.col(f"`{q}`") for q in own], k, x, none, a, b, c, d)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", rank bigint, same bigint, n bigint"
    return both.mapInArrow(partial(_rank_sorted, width=len(own), names=[*own, "rank", "same", "n"]), schema)
