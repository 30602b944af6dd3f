"""First-fit-decreasing packing of documents into padded sequences, in randomised groups.

Documents are dealt to groups at random, whatever their source or copies, so groups are alike and of bounded size and
each packs alone.  Within a group, a document's ids are cut every `capacity`; what is shorter goes, longest first, to
the first sequence that still has room, which a tournament tree over the free room of all sequences finds in one
descent.  As documents may be cut, the emptiest sequences are then dealt out again, cut where a gap ends, until all
sequences but one are full; that one becomes sequences whose lengths are powers of two, which aren't padded.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.byte_ids import load

CAPACITY = 1024
END_ID = 0
GROUP_BYTES = 8 << 20  # text bytes of a group, on average
GROUP_TOKENS = 8_000_000  # ids that a task holds; a group beyond it is packed in parts
TASK_GROUPS = 16  # groups that a task packs, one after the other, at least

Piece = tuple[int, int, int]  # document (row of the group), start, length


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each item (length 1 to capacity): longest first, each into the first bin with room for it.

    A node of the tree holds the most room below it.  Bins not opened yet have all their room and stand last, so the
    leftmost leaf with room is the first fit, or the next new bin.
    """
    size = 1 << max(0, len(lengths) - 1).bit_length()
    room = [capacity] * (2 * size)
    bins = np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        n, node = int(lengths[i]), 1
        while node < size:
            node *= 2
            if room[node] < n:
                node += 1
        bins[i] = node - size
        room[node] -= n
        node >>= 1
        while node:
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
            node >>= 1
    return bins


def topped_up(bins: list[list[Piece]], capacity: int) -> list[list[Piece]]:
    """The same ids in bins that are all full, but for one: the emptiest bins fill the gaps of the fullest."""
    load_ = [sum(p[2] for p in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda b: -load_[b])
    i, j = 0, len(order) - 1
    while i < j:
        gap, donor = capacity - load_[order[i]], bins[order[j]]
        if not gap:
            i += 1
            continue
        if not donor:
            j -= 1
            continue
        doc, start, n = donor.pop()
        m = min(n, gap)
        bins[order[i]].append((doc, start, m))
        load_[order[i]] += m
        load_[order[j]] -= m
        if m < n:
            donor.append((doc, start + m, n - m))
    return [b for b in bins if b]


def in_powers(pieces: list[Piece]) -> list[list[Piece]]:
    """The same ids, in order, in bins whose lengths are distinct powers of two."""
    left, todo, out = sum(p[2] for p in pieces), pieces[::-1], []
    while left:
        room = 1 << left.bit_length() - 1
        left -= room
        out.append([])
        while room:
            doc, start, n = todo.pop()
            m = min(n, room)
            out[-1].append((doc, start, m))
            room -= m
            if m < n:
                todo.append((doc, start + m, n - m))
    return out


def packed(lengths: list[int], capacity: int) -> list[list[Piece]]:
    """Sequences of pieces, in order of place, of documents of these lengths (1 at least)."""
    whole, rest = [], []
    for doc, n in enumerate(lengths):
        cut = n - n % capacity
        whole += [[(doc, s, capacity)] for s in range(0, cut, capacity)]
        if n > cut:
            rest.append((doc, cut, n - cut))
    if not rest:
        return whole
    bins: list[list[Piece]] = [[] for _ in rest]
    for piece, b in zip(rest, first_fit_decreasing(np.array([p[2] for p in rest]), capacity).tolist()):
        bins[b].append(piece)
    out = whole
    for b in topped_up([b for b in bins if b], capacity):
        out += [b] if sum(p[2] for p in b) == capacity else in_powers(b)
    return out


PACKED = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, "
          "sequence_length bigint")
ROWS = 100_000  # rows of a batch, about


def _group(docs, ids, sequence, capacity, with_ids):
    """Batches of one group's pieces; sequence: number of its first."""
    rows = []
    for b in packed([len(x) for x in ids], capacity):
        at, length = 0, sum(p[2] for p in b)
        for doc, start, n in b:
            raw = ids[doc][start : start + n].astype("<u4").tobytes()
            rows.append((docs[doc], start, n, zlib.crc32(raw), len(ids[doc]), sequence, at, length, *([raw] if with_ids else [])))
            at += n
        sequence += 1
        if len(rows) >= ROWS:
            yield _batch(rows)
            rows = []
    if rows:
        yield _batch(rows)


def _batch(rows):
    *numbers, last = [pa.array(c, pa.int64()) for c in list(zip(*rows))[:8]]
    cols = [*numbers, last, *[pa.array(c, pa.binary()) for c in list(zip(*rows))[8:]]]
    return pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in PACKED.split(", ")] + ["ids"] * (len(cols) - 8))


def _pack_sorted(batches, path, capacity, end_id, with_ids):
    """Rows (group, doc_id, text) sorted by group: each group is packed once it is read."""
    tokenizer = load(path)
    held = np.uint16 if max(tokenizer.size, end_id) < 1 << 16 else np.uint32
    group, docs, ids, tokens, sequence = None, [], [], 0, TaskContext.get().partitionId() << 36
    for batch in batches:
        for g, doc, text in zip(*(batch.column(i).to_pylist() for i in range(2)), batch.column(2)):
            if docs and (g != group or tokens >= GROUP_TOKENS):
                for out in _group(docs, ids, sequence, capacity, with_ids):
                    sequence = out.column(5)[-1].as_py() + 1
                    yield out
                docs, ids, tokens = [], [], 0
            group = g
            docs.append(doc)
            ids.append(np.append(tokenizer.encode(text.as_py() or ""), np.uint32(end_id)).astype(held))
            tokens += len(ids[-1])
    if docs:
        yield from _group(docs, ids, sequence, capacity, with_ids)


def first_fit_packing(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of a document: where it starts among the document's ids, and its sequence and place there.

    A document's ids are those of its whole text by the file at path, without added special tokens, and end_id; each id
    lies in one piece.  Sequences hold at most capacity ids, without gaps; all are full, but at most
    log2(capacity) a group, whose lengths are powers of two.  sequence_length is that of the piece's sequence; with_ids adds the
    piece's ids (little-endian uint32).

    Null texts count as empty: end_id alone.  Rows of null or equal doc_id are documents of their own; other columns
    aren't read; an empty table gives no row.  Groups are dealt by row number, so copies don't meet in one.  Which
    documents share a sequence depends on how the input is split among tasks, their ids don't.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-size // GROUP_BYTES))
    tasks = min(groups, max(-(-groups // TASK_GROUPS), 3 * spark.sparkContext.defaultParallelism))
    group = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))
    dealt = rows.select(group.alias("grp"), "doc_id", "text")
    dealt = dealt.repartitionById(tasks, F.pmod("grp", F.lit(tasks)).cast("int")).sortWithinPartitions("grp")
    return dealt.mapInArrow(partial(_pack_sorted, path=path, capacity=capacity, end_id=end_id, with_ids=with_ids),
                            PACKED + (", ids binary" if with_ids else ""))
