"""Uniqueness over a whole stream, from keyed state.

Keys are dealt to BUCKETS by their hash; a bucket's state is the list of its accepted keys.  A micro-batch reads the lists of the
buckets that its own rows fall into, one call each, and appends what it accepted: a row's share of the history is 1 / BUCKETS at most,
all rows' the accepted keys once.  The accepted table is never read.  State and source offsets are committed together, so a replayed
micro-batch meets the state of its first attempt.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

FLAGS = T.StructType([T.StructField("_duplicate", T.BooleanType()), T.StructField("_seen", T.BooleanType())])
BUCKETS = 1 << 14  # a call and a look at state cost as much as reading some thousand keys
BUCKET = "_key_bucket"


def _plain(v):
    """A key's value such that equal keys, as Spark groups them, have the same text."""
    if isinstance(v, float):
        return v + 0.0  # no negative zero
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    if isinstance(v, dict):  # a struct within a row
        return tuple(map(_plain, v.values()))
    return tuple(map(_plain, v)) if isinstance(v, (list, tuple)) else v


def _text(values: Iterable) -> str:
    return repr(tuple(map(_plain, values)))


class _Group:
    """The rows of one key in a micro-batch: at most the present best ones are held."""

    __slots__ = ("how", "order_by", "n", "best", "held", "unordered")

    def __init__(self, how: str, order_by: str | None):
        self.how, self.order_by, self.n, self.best, self.held, self.unordered = how, order_by, 0, None, [], None

    def add(self, row: Row) -> list[Row]:
        """Rows that are duplicates now, whatever follows."""
        self.n += 1
        if self.how == "all":
            if self.n > 1:
                return [row]
            self.held = [row]
            return []
        value = row[self.order_by]
        if value is None:  # neither the first nor the last of its group
            if self.n > 1:
                return [row]
            self.unordered = row
        elif self.best is None or (value < self.best) == (self.how == "exclude_first") and value != self.best:
            worse, self.best, self.held = self.held, value, [row]
            return worse
        elif value == self.best:
            self.held.append(row)
        else:
            return [row]
        return []

    def rest(self) -> Iterator[tuple[Row, bool]]:
        """(row, is a duplicate) of those held, after the last row."""
        if self.unordered is not None:
            yield self.unordered, self.n > 1
        for row in self.held:
            yield row, self.how == "all" and self.n > 1


class _Accepted(StatefulProcessor):
    """The accepted keys of a bucket, as text, a value for each micro-batch that accepted some.  Rows are handed on, marked, without the bucket, which is their last column."""

    def __init__(self, how: str, order_by: str | None, ttl_ms: int | None, names: list[str], keys: list[str] = ()):
        self.how, self.order_by, self.ttl_ms, self.row = how, order_by, ttl_ms, Row(*names)
        self.keys, self.ok = [names.index(k) for k in keys], names.index("_ok") if "_ok" in names else None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.accepted = handle.getListState("accepted", T.StructType([T.StructField("keys", T.StringType())]), self.ttl_ms)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._accept(_text(k.values()) for k in initialState["keys"])

    def _accept(self, keys: Iterable[str]) -> None:
        self.accepted.appendValue(("\n".join(keys),))  # one value per micro-batch: a text has no line feed

    def _kept(self, rows) -> Iterator[tuple[Row, bool]]:
        """(row, is a duplicate within the micro-batch) of one key's rows"""
        group = _Group(self.how, self.order_by)
        for row in rows:
            yield from ((r, True) for r in group.add(row))
        yield from group.rest()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        seen, groups, taken = {k for (keys,) in self.accepted.get() for k in keys.split("\n")}, {}, []
        for row in rows:
            k = _text([row[i] for i in self.keys])
            group = groups.get(k)
            if group is None:
                group = groups[k] = _Group(self.how, self.order_by)
            for r in group.add(row):
                yield self.row(*r[:-1], True, k in seen)
        for k, group in groups.items():
            take = False
            for row, duplicate in group.rest():
                take = take or (row[self.ok] and not duplicate and k not in seen)
                yield self.row(*row[:-1], duplicate, k in seen)
            if take:
                taken.append(k)
        if taken:
            self._accept(taken)

    def close(self) -> None:
        pass


def marked(rows: DataFrame, columns: list[str], how: str = "all", order_by: str | None = None, before: DataFrame | None = None,
           ttl_s: int | None = None) -> DataFrame:
    """rows (a stream with a boolean `_ok`) and `_duplicate` (a duplicate by `columns` within its micro-batch) and `_seen` (an
    earlier micro-batch accepted the key).  A key is accepted with a row that is `_ok`, no duplicate and not seen.

    how, order_by: which rows of a group are duplicates, as in a contract's report_duplicates; null keys equal each other.
    before: keys accepted by other queries, read once when the query starts.  ttl_s: a key is forgotten that long after it was
    accepted (by the clock), and may come again; without it state grows by the text of each accepted key.
    """
    if how != "all" and order_by is None:
        raise ValueError(f"report_duplicates={how} needs order_by= to define first/last")
    keys = [f"`{c}`" for c in columns]
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias(BUCKET)
    start = None
    if before is not None:
        start = before.select(*keys).distinct().select(bucket, F.struct(*keys).alias("key"))
        start = start.groupBy(BUCKET).agg(F.collect_list("key").alias("keys")).groupBy(BUCKET)
    out = T.StructType([*rows.schema, *FLAGS])
    processor = _Accepted(how, order_by, None if ttl_s is None else 1000 * ttl_s, out.names, columns)
    return rows.select("*", bucket).groupBy(BUCKET).transformWithState(processor, out, "append",
                                                                       "none" if ttl_s is None else "processingTime", start)
