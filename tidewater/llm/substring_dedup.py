"""Removal of repeated passages by relative factors against the corpus.

The reference is the whole input.  Its index maps every window of `window` words to the place where that
word sequence starts first (least doc_id, text hash and position), split by hash into blocks of bounded
size; each run of documents looks up its windows in every block that may hold them.  Factors are read off the
windows found: neighbours whose sources go on in step are one factor, and where the source changes another
begins.  Nothing is looked up anew or extended beyond that, so a factor may end where a longer match in one reference goes
on.  Factors are at least one window long, so they are the duplicate spans, and every window with an earlier source
lies in one.

Windows travel as blobs (``exchange.py``).  A task first resolves repeats among its own rows and deals out
one posting per distinct window, so a passage held by a third of all documents sends one row per task run.
"""

from __future__ import annotations

from functools import partial
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.exchange import BLOB, BLOB_ARROW, GROUP_WORDS, bucket_of, buckets_for, column, from_low_bytes, low_bytes
from tidewater.llm.words import U64, binary, chunks, grams, mix

POSTING, SPAN, TEXT = 0, 1, 2
KEPT = 7
HOME_BYTES = 12 << 20  # text that a home's task holds, about
LAST = np.iinfo(np.int64).max  # stands for a null doc_id: after all others
TAG_BITS = 48  # of a text's hash, which tells texts of one doc_id apart
#: windows start .. start + n - 1 of a document have an earlier source, in step from (ref, ref_start)
SPANS = np.dtype([("doc", "<i8"), ("tag", "<u8"), ("start", "<u4"), ("n", "<u4"), ("ref", "<i8"), ("ref_start", "<u4")])
OWNERS = np.dtype([("doc", "<i8"), ("tag", "<u8"), ("count", "<u4")])
ROWS = np.dtype([("doc", "<i8"), ("tag", "<u8"), ("length", "<u4"), ("null", "u1")])


def _planes(a: np.ndarray) -> bytes:
    """Bytes of equal place next to each other: they compress well."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T).tobytes()


def _from_planes(raw: bytes, dtype) -> np.ndarray:
    dtype = np.dtype(dtype)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(dtype.itemsize, -1).T).view(dtype).ravel()


def _joined(table: pa.Table, name: str, dtype) -> np.ndarray:
    parts = [_from_planes(x, dtype) for x in table.column(name).to_pylist() if x]
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def _blobs(rows: list[tuple]) -> pa.RecordBatch:
    """Of (bucket, kind, a, b, c)."""
    return pa.record_batch([pa.array(list(x), f.type) for x, f in zip(zip(*rows), BLOB_ARROW)], schema=BLOB_ARROW)


def _homes_of(docs: np.ndarray, tags: np.ndarray, homes: int) -> np.ndarray:
    return bucket_of(mix(mix(docs.astype(np.int64).view(U64) + U64(1)) + tags), homes)


def _tags(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(U64)


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(LAST).to_numpy(zero_copy_only=False)


def _by_home(spans: np.ndarray, homes: int) -> list[tuple]:
    home = _homes_of(spans["doc"], spans["tag"], homes)
    order = np.lexsort((spans["start"], spans["doc"], home))
    home, spans = home[order], spans[order]
    cut = np.flatnonzero(np.diff(home, prepend=-1))
    return [(int(home[i]), SPAN, _planes(spans[i:j]), None, None) for i, j in zip(cut, np.r_[cut[1:], len(home)])]


def _runs(own, pos, doc, tag, ref, ref_pos) -> np.ndarray:
    """Spans of single windows, joined where they and their sources go on in step."""
    if not len(own):
        return np.zeros(0, SPANS)
    new = np.r_[True, (own[1:] != own[:-1]) | (pos[1:] != pos[:-1] + 1) | (ref[1:] != ref[:-1])
                | (ref_pos[1:] != ref_pos[:-1] + 1)]
    at = np.flatnonzero(new)
    out = np.zeros(len(at), SPANS)
    out["doc"], out["tag"], out["start"], out["ref"], out["ref_start"] = doc[at], tag[at], pos[at], ref[at], ref_pos[at]
    out["n"] = np.diff(np.r_[at, len(own)])
    return out


def _group(ids, tags, texts, window, buckets, homes) -> list[tuple]:
    order = np.lexsort((tags, ids))
    ids, tags = ids[order], tags[order]
    wins = [grams(texts[i], window) for i in order]
    size = np.array([len(x) for x in wins])
    h, own = np.concatenate(wins), np.repeat(np.arange(len(wins)), size)
    if not len(h):
        return []
    pos = (np.arange(len(h)) - np.repeat(np.cumsum(size) - size, size)).astype(np.uint32)
    doc, tag = ids[own], tags[own]
    if ((ids[1:] == ids[:-1]) & (tags[1:] == tags[:-1])).any():  # equal rows: earlier means by position
        o = np.lexsort((pos, tag, doc))
        h, own, pos, doc, tag = h[o], own[o], pos[o], doc[o], tag[o]
    o = np.argsort(h, kind="stable")
    lead = np.r_[True, h[o][1:] != h[o][:-1]]
    first = np.flatnonzero(lead)
    source = np.empty(len(h), np.int64)
    source[o] = np.repeat(o[first], np.diff(np.r_[first, len(h)]))
    later = (source != np.arange(len(h))) & ((doc[source] != doc) | (tag[source] != tag) | (pos[source] != pos))
    at = np.flatnonzero(later)
    at = at[np.lexsort((pos[at], own[at]))]
    rows = _by_home(_runs(own[at], pos[at], doc[at], tag[at], doc[source[at]], pos[source[at]]), homes)
    at = np.flatnonzero(~later)  # firsts; equal rows stay, their results are equal too
    at = at[np.lexsort((pos[at], own[at]))]
    bucket = bucket_of(h[at], buckets)
    o = np.argsort(bucket.astype(np.uint16) if buckets < 65536 else bucket, kind="stable")
    bucket, at = bucket[o], at[o]
    cut = np.flatnonzero(np.diff(bucket, prepend=-1))
    for i, j in zip(cut, np.r_[cut[1:], len(bucket)]):
        part = at[i:j]
        begin = np.flatnonzero(np.diff(own[part], prepend=-1))
        owners = np.zeros(len(begin), OWNERS)
        owners["doc"], owners["tag"] = doc[part[begin]], tag[part[begin]]
        owners["count"] = np.diff(np.r_[begin, len(part)])
        step = np.diff(pos[part].astype(np.int64), prepend=0)
        step[begin] = pos[part[begin]]
        rows.append((int(bucket[i]), POSTING, low_bytes(h[part], KEPT).tobytes(), _planes(owners),
                     _planes(step.astype("<u4"))))
    return rows


def _deal(batches, window, buckets, homes):
    """Windows of runs of rows: repeats among them as spans to the documents' homes, firsts to their buckets."""
    for batch in batches:
        ids, raw, tags = _ids(batch.column(0)), binary(batch.column(1)), _tags(batch.column(2))
        texts, first, held = [], 0, 0
        for chunk in chunks(raw):
            if texts and held + len(chunk.hashes) > GROUP_WORDS:
                if rows := _group(ids[first : chunk.first], tags[first : chunk.first], texts, window, buckets, homes):
                    yield _blobs(rows)
                first, texts, held = chunk.first, [], 0
            texts += [chunk.words(i) for i in range(chunk.last - chunk.first)]
            held += len(chunk.hashes)
        if texts and (rows := _group(ids[first:], tags[first:], texts, window, buckets, homes)):
            yield _blobs(rows)


def _lookup(key, table, homes):
    """Of one index block: the postings whose window starts earlier elsewhere, as spans to their homes."""
    kind, bucket = (x.as_py() for x in key)
    if kind != POSTING:
        return table
    h = from_low_bytes(column(table, "a", np.uint8), KEPT, bucket)
    owners = _joined(table, "b", OWNERS)
    step = _joined(table, "c", "<u4").astype(np.int64)
    count = owners["count"].astype(np.int64)
    own = np.repeat(np.arange(len(owners)), count)
    total = np.cumsum(step)
    begin = np.cumsum(count) - count
    pos = total - np.repeat(total[begin] - step[begin], count)
    o = np.argsort(h)
    h = h[o]
    same = h[1:] == h[:-1]
    several = np.r_[same, False] | np.r_[False, same]
    o, h = o[several], h[several]
    if not len(h):
        return pa.table({c: [] for c in BLOB_ARROW.names}, schema=BLOB_ARROW)
    own, pos = own[o], pos[o]
    doc, tag = owners["doc"][own], owners["tag"][own]
    o = np.lexsort((pos, tag, doc, h))
    h, own, pos, doc, tag = h[o], own[o], pos[o], doc[o], tag[o]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    source = np.repeat(first, np.diff(np.r_[first, len(h)]))
    at = np.flatnonzero((doc != doc[source]) | (tag != tag[source]) | (pos != pos[source]))
    at = at[np.lexsort((pos[at], own[at]))]
    rows = _by_home(_runs(own[at], pos[at], doc[at], tag[at], doc[source[at]], pos[source[at]]), homes)
    return pa.Table.from_batches([_blobs(rows)] if rows else [], schema=BLOB_ARROW)


def _send_texts(batches, homes):
    """Texts to their homes, compressed per run of rows."""
    for batch in batches:
        ids, raw, tags = _ids(batch.column(0)), binary(batch.column(1)), _tags(batch.column(2))
        null = batch.column(1).is_null().to_numpy(zero_copy_only=False)
        home = _homes_of(ids, tags, homes)
        rows = []
        for x in np.unique(home):
            at = np.flatnonzero(home == x)
            texts = raw.take(pa.array(at)).to_pylist()
            head = np.zeros(len(at), ROWS)
            head["doc"], head["null"] = ids[at], null[at]
            head["tag"], head["length"] = tags[at], [len(t) for t in texts]
            data = b"".join(texts)
            rows.append((int(x), TEXT, _planes(head), pa.compress(data, "zstd", asbytes=True) if data else b"",
                         len(data).to_bytes(8, "little")))
        if rows:
            yield _blobs(rows)


PARSED = ("doc_id bigint, n_words bigint, n_removed bigint, kept string, "
          "factors array<struct<start:int,length:int,ref_doc:bigint,ref_start:int>>, text_hash bigint")
_FACTOR = pa.struct([("start", pa.int32()), ("length", pa.int32()), ("ref_doc", pa.int64()), ("ref_start", pa.int32())])
_PARSED_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()),
                           ("factors", pa.list_(_FACTOR)), ("text_hash", pa.int64())])


def _parse(spans: np.ndarray, window: int) -> np.ndarray:
    """Factors of one document, in order: spans of its windows joined where source and place go on in step."""
    spans = spans[np.lexsort((-spans["n"].astype(np.int64), spans["start"]))]
    end = np.maximum.accumulate(spans["start"].astype(np.int64) + spans["n"])
    fresh = np.r_[True, spans["start"][1:].astype(np.int64) + spans["n"][1:] > end[:-1]]  # else inside what is parsed
    spans = spans[fresh]
    start, n = spans["start"].astype(np.int64), spans["n"].astype(np.int64)
    shift = spans["ref_start"].astype(np.int64) - start
    new = np.r_[True, (spans["ref"][1:] != spans["ref"][:-1]) | (shift[1:] != shift[:-1]) | (start[1:] > (start + n)[:-1])]
    at = np.flatnonzero(new)
    out = spans[at].copy()
    out["n"] = (start + n)[np.r_[at[1:], len(spans)] - 1] - start[at] + window - 1
    return out


def _rebuild(key, table, window):
    """Of one home: each document parsed into factors, and its text without the words they cover."""
    kind = np.array(table.column("kind"))
    spans = _joined(table.filter(pa.array(kind == SPAN)), "a", SPANS)
    spans = spans[np.lexsort((spans["tag"], spans["doc"]))]
    name = np.zeros(len(spans), [("doc", "<i8"), ("tag", "<u8")])
    name["doc"], name["tag"] = spans["doc"], spans["tag"]
    begin = np.flatnonzero(np.r_[True, name[1:] != name[:-1]]) if len(spans) else np.zeros(0, np.int64)
    place = {(int(name["doc"][i]), int(name["tag"][i])): (i, j) for i, j in zip(begin, np.r_[begin[1:], len(spans)])}
    out = []
    for blob in table.filter(pa.array(kind == TEXT)).select(["a", "b", "c"]).to_pylist():
        head = _from_planes(blob["a"], ROWS)
        size = int.from_bytes(blob["c"], "little")
        data = pa.decompress(blob["b"], size, "zstd", asbytes=True) if size else b""
        at = 0
        for doc, tag, length, null in head.tolist():
            words = data[at : at + length].split()
            at += length
            found, n, factors = place.get((doc, tag)), len(words), []
            if found:
                parsed = _parse(spans[found[0] : found[1]], window)
                edge = np.zeros(n + 1, np.int64)
                np.add.at(edge, parsed["start"].astype(np.int64), 1)
                np.add.at(edge, parsed["start"].astype(np.int64) + parsed["n"], -1)
                words = list(compress(words, np.cumsum(edge[:n]) == 0))
                factors = [(int(f["start"]), int(f["n"]), int(f["ref"]), int(f["ref_start"])) for f in parsed]
            out.append((None if doc == LAST else doc, n, n - len(words), b" ".join(words).decode(), [
                {"start": a, "length": b, "ref_doc": None if c == LAST else c, "ref_start": d} for a, b, c, d in factors], tag))
    cols = list(zip(*out)) if out else [[]] * 6
    return pa.table([pa.array(list(c), f.type) for c, f in zip(cols, _PARSED_ARROW)], schema=_PARSED_ARROW)


def text_hash(text: Column) -> Column:
    """TAG_BITS of a text's hash: with its doc_id it names a text."""
    return F.xxhash64(text).bitwiseAND(F.lit((1 << TAG_BITS) - 1))


def substring_dedup(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (words left, joined by one space), factors, text_hash.

    Words are runs outside ASCII white space, unchanged.  A word goes when a window of `window` words over
    it has the same words as one that starts earlier: in a document of smaller doc_id, in one of the same doc_id whose
    text has the smaller text_hash, or before it in the same one, all judged on the input.  Null and empty texts have no words; texts shorter than a window
    keep all theirs.  Rows of equal doc_id and text have equal results; a null doc_id stands after all others.
    (doc_id, text_hash) names a text, see text_hash().  Other columns aren't read.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"), text_hash(text).alias("tag"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()["b"]
    buckets, homes = buckets_for(size // 6), max(1, -(-size // HOME_BYTES))
    blobs = rows.mapInArrow(partial(_deal, window=window, buckets=buckets, homes=homes), BLOB)
    found = blobs.groupBy("kind", "bucket").applyInArrow(partial(_lookup, homes=homes), BLOB)
    texts = rows.mapInArrow(partial(_send_texts, homes=homes), BLOB)
    return found.union(texts).groupBy("bucket").applyInArrow(partial(_rebuild, window=window), PARSED)
