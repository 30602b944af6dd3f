"""Best-fit packing of documents into sequences by hierarchical residual rounds.

Documents become pieces of at most `capacity` tokens.  In round 0 each group of pieces is packed best-fit,
longest first; sequences that are nearly full are done.  The underfull ones go up a tree as items
of their own, several groups meeting in one, and are packed best-fit again, until one group is left or a round
merges nothing.  Groups are of bounded size and only lengths and places travel, never token ids.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.bpe import runs
from tidewater.llm.exchange import materialized
from tidewater.llm.word_tokens import load

CAPACITY = 2048
END_ID = 0
GROUP_ITEMS = 20_000  # items that one task packs at a time
FAN_IN = 8  # groups that meet in one of the next round
DEALS = 2  # times that underfull items are dealt anew when there can't be fewer groups
NEARLY = 64  # a sequence is done when less than capacity / NEARLY is free

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def _pieces(batches, path, capacity, end_id, with_ids):
    tokenizer, end = load(path), np.array([end_id], "<u4").tobytes()
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        for i, j in runs(texts):
            rows = []
            for row, ids in zip(range(i, j), tokenizer.encode(texts[i:j])):
                ids += end
                n = len(ids) // 4
                for piece, start in enumerate(range(0, n, capacity)):
                    part = ids[4 * start : 4 * (start + capacity)]
                    rows.append((row, piece, start, len(part) // 4, zlib.crc32(part), part if with_ids else None))
            at, piece, start, length, crc, part = zip(*rows)
            cols = [batch.column(0).take(pa.array(at)).cast(pa.int64()), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols, names = [*cols, pa.array(part, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names=names)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of each document's ids and end_id: documents longer than capacity are cut every capacity tokens.

    Null texts count as empty and are one piece of one token.  with_ids adds the ids, little-endian uint32.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = PIECES + (", ids binary" if with_ids else "")
    return rows.mapInArrow(partial(_pieces, path=path, capacity=capacity, end_id=end_id, with_ids=with_ids), schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item: longest first, each into the fullest bin that still holds it.

    Bins stand in stacks by free space; the set of free spaces in use is one number's bits.
    """
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, made = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = used >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            b = stacks[free].pop()
            if not stacks[free]:
                used &= ~(1 << free)
        else:
            free, b = capacity, made
            made += 1
        bins[i], offsets[i] = b, capacity - free
        free -= n
        if free:
            stacks[free].append(b)
            used |= 1 << free
    return bins, offsets


ITEMS = "grp bigint, load bigint, uids array<bigint>, offsets array<bigint>"


def _pack(table, capacity):
    """One group: items into bins; a bin lists all pieces of its items with their offsets in it."""
    load_ = table["load"].to_numpy()
    uids, offs = (table[c].combine_chunks() for c in ("uids", "offsets"))
    size = np.diff(np.asarray(uids.offsets))
    flat_uid, flat_off = np.asarray(uids.flatten()), np.asarray(offs.flatten())
    bins, at = best_fit(load_, capacity)
    item = np.repeat(np.arange(len(load_)), size)
    order = np.lexsort((flat_off + at[item], bins[item]))
    n = int(bins.max()) + 1
    count = np.bincount(bins[item], minlength=n)
    edges = pa.array(np.r_[0, np.cumsum(count)].astype(np.int32))
    total = np.bincount(bins, load_, minlength=n).astype(np.int64)
    return pa.table({
        "grp": pa.array(np.full(n, table["grp"][0].as_py(), np.int64)), "load": total,
        "uids": pa.ListArray.from_arrays(edges, pa.array(flat_uid[order])),
        "offsets": pa.ListArray.from_arrays(edges, pa.array((flat_off + at[item])[order])),
        "done": pa.array(capacity - total < capacity / NEARLY)})


def _next_round(left: int, groups: int, dealt: int) -> tuple[int, int]:
    """(groups of the next round, times dealt anew at that number); no groups: underfull sequences stay as they are.

    Groups are never fewer than hold GROUP_ITEMS each.  Where full groups hardly merge, their items are dealt to
    others a few times, as new neighbours may fit."""
    fewer = max(1, -(-left // GROUP_ITEMS), -(-groups // FAN_IN))
    if 10 * fewer <= 9 * groups or (fewer < groups and groups <= FAN_IN):
        return fewer, 0
    return (groups, dealt + 1) if dealt < DEALS else (0, dealt)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces and, for each, sequence_id and offset: its sequence and its place there, without gaps from 0.

    pieces must have a column length of 1 to capacity; all columns are kept.  An empty table gives an empty one.
    """
    spark = pieces.sparkSession
    pieces = materialized(spark, pieces.withColumn("_uid", F.monotonically_increasing_id()), "pieces")
    left = pieces.count()
    groups = max(1, -(-left // GROUP_ITEMS))
    items = pieces.select(F.pmod(F.xxhash64("_uid"), F.lit(groups)).alias("grp"), F.col("length").cast("bigint").alias("load"),
                          F.array("_uid").alias("uids"), F.array(F.lit(0).cast("bigint")).alias("offsets"))
    done, dealt = None, 0
    while left:
        packed = materialized(spark, items.groupBy("grp").applyInArrow(partial(_pack, capacity=capacity), f"{ITEMS}, done boolean"),
                              "packed")
        full = packed.where("done")
        done = full if done is None else done.union(full)
        items = packed.where("not done").drop("done")
        before, left = left, items.count()
        if groups == 1 or left == before:
            done = done.union(packed.where("not done"))
            break
        fewer, dealt = _next_round(left, groups, dealt)
        if not fewer:
            done = done.union(packed.where("not done"))
            break
        if fewer < groups:
            group = F.floor(F.col("grp") * fewer / groups)
        else:
            group = F.pmod(F.xxhash64(F.element_at("uids", 1), F.lit(dealt)), F.lit(groups))
        items, groups = items.withColumn("grp", group), fewer
    if done is None:
        return pieces.drop("_uid").withColumns({"sequence_id": F.lit(0).cast("bigint"), "offset": F.lit(0).cast("bigint")})
    placed = done.select(F.array_min("uids").alias("sequence_id"), F.explode(F.arrays_zip("uids", "offsets")).alias("p"))
    placed = placed.select("sequence_id", F.col("p.uids").alias("_uid"), F.col("p.offsets").alias("offset"))
    return pieces.join(placed, "_uid").drop("_uid")


def best_fit_packing(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of a document, with its sequence and place; see pieces and pack."""
    return pack(pieces(docs, path, capacity, end_id, False, id_col, text_col), capacity)
