"""Tumbling aggregates on streams (event time or processing time)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def tumble_sum_stream(stream: DataFrame, ts: str | None, key: str, value: str, width: str = "60 seconds",
                      factor: str | float | None = "0.85", delay: str = "10 minutes",
                      decimal_scale: int | None = None, out_col: str = "window_sales") -> DataFrame:
    """Per key and window: (key, window_end, SUM(value) * factor), emitted once the
    window closes (append mode: the watermark max(ts) - delay passes its end).
    Windows still open when the input ends are never emitted; use update or complete mode for those.

    ``ts=None`` uses processing time (``current_timestamp()``, fixed per
    micro-batch). Watermarks need TIMESTAMP, so an NTZ column is cast in and the
    window end is cast back to NTZ.
    """
    ntz = ts is not None and isinstance(stream.schema[ts].dataType, T.TimestampNTZType)
    t = F.current_timestamp() if ts is None else F.col(ts).cast("timestamp")
    v = F.col(value)
    if decimal_scale is not None:
        v = v.cast(f"decimal(18,{decimal_scale})")
    agg = F.sum(v)
    if factor is not None:
        agg = agg * (F.lit(Decimal(str(factor))) if decimal_scale is not None else F.lit(float(factor)))
    timed = stream.withColumn("_t", t).withWatermark("_t", delay)
    end = F.col("_w.end").cast("timestamp_ntz") if ntz else F.col("_w.end")
    return (timed.groupBy(F.window("_t", width).alias("_w"), key)
            .agg(agg.cast("double").alias(out_col))
            .select(key, end.alias("window_end"), out_col))


def stream_to_topic(stream: DataFrame, spec, checkpoint: str, key: str | None = None,
                    available_now: bool = True, processing_time: str | None = None):
    """Continuous topic -> aggregate -> topic: rows as JSON records, to the broker or to files in the topic schema
    (Spark's file sink, exactly-once per checkpoint)."""
    from tidewater.sinks.tables import check_checkpoint
    from tidewater.sinks.topics import json_value, to_topic

    records = to_topic(stream, spec.name, json_value(stream), key=F.col(key).cast("string") if key else None)
    w = records.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if spec.path is None:
        w = w.format("kafka").option("kafka.bootstrap.servers", spec.bootstrap_servers).option("topic", spec.name)
    else:
        check_checkpoint(spec.path, checkpoint)
        w = w.format("parquet").option("path", spec.path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "30 seconds")
    return w.start()


def bursts_stream(stream: DataFrame, key: str, ts: str, width: str, min_events: int,
                  delay: str = "10 minutes", count_col: str = "events") -> DataFrame:
    """Streaming burst detection: buckets where a key has at least ``min_events``
    rows, emitted once the bucket closes (append mode). Same result as the batch
    ``bursts`` on every bucket ending at or before max(ts) - delay."""
    ntz = isinstance(stream.schema[ts].dataType, T.TimestampNTZType)
    timed = stream.withColumn("_t", F.col(ts).cast("timestamp")).withWatermark("_t", delay)
    start = F.col("_w.start").cast("timestamp_ntz") if ntz else F.col("_w.start")
    return (timed.groupBy(key, F.window("_t", width).alias("_w"))
            .agg(F.count(F.lit(1)).alias(count_col))
            .where(F.col(count_col) >= min_events)
            .select(key, start.alias("bucket_start"), count_col, F.lit(1).alias("fail_event")))
