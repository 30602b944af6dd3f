"""Tumbling windows that close by the clock.

An event-time aggregate closes a window when later rows push its watermark, so the windows still open when the input ends are
never emitted.  Here each (key, window) has a timer on the processing-time clock: the window is emitted once the clock
passes its end, or, for rows that come late, once nothing has come for a while, whether or not any more input arrives.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from decimal import Decimal
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_EPOCH = dt.datetime(1970, 1, 1)
SUM = T.DecimalType(38, 9)


def _partial_sums(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """One row per key and window of a task's batch, so a hot window moves a few rows instead of all of its rows."""
    for batch in batches:
        if batch.num_rows:
            out = pa.Table.from_batches([batch]).group_by(keys).aggregate([("_total", "sum"), ("_rows", "sum")])
            out = out.rename_columns({"_total_sum": "_total", "_rows_sum": "_rows"}).select([*keys, "_total", "_rows"])
            out = out.cast(pa.schema([*[batch.schema.field(k) for k in keys], ("_total", pa.decimal128(38, 9)), ("_rows", pa.int64())]))
            yield from out.combine_chunks().to_batches()


class _ClosesByClock(StatefulProcessor):
    """State of a (key, window): its sum, its rows, and when it closes."""

    def __init__(self, grace_ms: int, names: list[str]):
        self.grace_ms, self.row = grace_ms, Row(*names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", T.StructType([
            T.StructField("total", SUM), T.StructField("rows", T.LongType()), T.StructField("closes", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        total, count = None, 0
        for r in rows:
            if r["_total"] is not None:
                total = r["_total"] + (total or 0)
            count += r["_rows"]
        before = self.open.get()
        if before:
            old, n, closes = before
            count += n
            total = old if total is None else total + (old or 0)
            self.handle.deleteTimer(closes)
        end_ms = (key[-1] - _EPOCH) // dt.timedelta(milliseconds=1)
        closes = max(end_ms, timerValues.getCurrentProcessingTimeInMs()) + self.grace_ms
        self.open.update((total, count, closes))
        self.handle.registerTimer(closes)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = self.open.get()
        if state:
            self.open.clear()
            yield self.row(*key, state[0], state[1])

    def close(self) -> None:
        pass


def clock_windows(stream: DataFrame, ts: str | None, key: str | list[str], value: str, width: str = "60 seconds",
                  grace_s: float = 2.0, scale: int = 2) -> DataFrame:
    """(keys, window_end, total, rows) of every tumbling window, emitted when the clock says that it is over.

    A window closes ``grace_s`` after the later of its end and its last row.  ``ts=None`` places rows by the clock itself
    (fixed per micro-batch); a timestamp column places them by what it says, so a replay of old rows closes too.  total
    is the exact decimal sum of value at ``scale`` digits (null if all values are null).  A row that comes after its window was
    emitted makes one more row of that window: ``settled`` adds the parts up.

    State is one row per open (key, window) in RocksDB.  Start it with ``run_until_rest`` or inside ``keyed_state``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    at = F.current_timestamp() if ts is None else F.col(ts)
    end = F.window(at.cast("timestamp"), width).end.cast("timestamp_ntz")
    rows = stream.select(*[F.col(k) for k in keys], end.alias("window_end"),
                         F.col(value).cast(f"decimal(18,{scale})").cast(SUM).alias("_total"), F.lit(1).cast("bigint").alias("_rows"))
    names = [*keys, "window_end"]
    sums = rows.mapInArrow(partial(_partial_sums, keys=names), rows.schema)
    out = T.StructType([*[rows.schema[k] for k in names], T.StructField("total", SUM), T.StructField("rows", T.LongType())])
    return sums.groupBy(*names).transformWithState(_ClosesByClock(int(grace_s * 1000), out.names), out, "append", "processingTime")


def settled(windows: DataFrame, keys: list[str], factor: str | None = "0.85", out_col: str = "window_sales") -> DataFrame:
    """One row per key and window of what ``clock_windows`` wrote: (keys, window_end, SUM(value) * factor)."""
    total = F.sum("total")
    if factor is not None:
        total = total.cast("decimal(30,9)") * F.lit(Decimal(factor))
    return windows.groupBy(*keys, "window_end").agg(total.cast("double").alias(out_col))
