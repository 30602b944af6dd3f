"""Hour folders rolled by size and by idle time.

A stream leaves a small file per hour and trigger in its landing folder (``hourly_files_stream``).  Once nothing has come for an hour for
a while, ``roll_hours`` writes that hour's rows as files of a target size.  Where a file ends follows from prefix sums of row
bytes in time order, taken across tasks, so a hot hour is cut by many tasks and no task holds an hour.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater import fs
from tidewater.session import scratch_path
from tidewater.sinks.topics import JSON_OPTIONS

TARGET_BYTES = 128 << 20


def _running_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (hour, value, bytes, task) in order, with the bytes of the hour's rows before each in this task."""
    hour, held = False, 0  # no hour yet; None is one
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = batch.column(0).dictionary_encode(null_encoding="encode")
        ids, size = np.asarray(codes.indices), np.asarray(batch.column(2))
        total = np.cumsum(size) - size
        starts = np.flatnonzero(np.diff(ids, prepend=-1))
        first = np.repeat(total[starts], np.diff(np.r_[starts, len(ids)]))
        before = total - first
        if codes.dictionary[int(ids[0])].as_py() == hour:
            before[: starts[1] if len(starts) > 1 else len(ids)] += held
        hour, held = codes.dictionary[int(ids[-1])].as_py(), int(before[-1] + size[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before)], names=["hour", "value", "bytes", "task", "before"])


def sized_hours(df: DataFrame, path: str, ts: str, target_bytes: int = TARGET_BYTES) -> None:
    """Write rows as JSON lines into ``hour=yyyy-MM-dd--HH/part=n`` folders of one file each, replacing the parts that exist.

    A part holds the rows that begin within ``target_bytes`` of the hour's bytes, in time order (ties by the
    row's text): every file has at most the target and one row, and an hour has as few as fit.  Rows without a time are in the hour
    of no name (``hour=__HIVE_DEFAULT_PARTITION__``).
    """
    spark = df.sparkSession
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), JSON_OPTIONS)
    rows = df.select(F.date_format(F.col(ts), "yyyy-MM-dd--HH").alias("hour"), F.col(ts).alias("_at"), text.alias("value"))
    rows = rows.repartitionByRange("hour", "_at", "value").sortWithinPartitions("hour", "_at", "value")
    rows = rows.select("hour", "value", (F.octet_length("value") + 1).cast("bigint").alias("bytes"), F.spark_partition_id().alias("task"))
    staged = scratch_path(spark, "sized")
    # written once: the range bounds of the sort must be the same for the sums and the rows
    rows.mapInArrow(_running_bytes, "hour string, value string, bytes bigint, task int, before bigint").write.parquet(staged)
    rows = spark.read.parquet(staged)
    sums = rows.groupBy("hour", "task").agg(F.sum("bytes").alias("n"))  # a row per hour and task that has it
    w = Window.partitionBy("hour").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("hour", "task", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("base"))
    on = F.expr("r.task = s.task AND r.hour <=> s.hour")
    parts = rows.alias("r").join(sums.alias("s"), on).select(
        "r.hour", F.floor((F.col("base") + F.col("before")) / target_bytes).cast("int").alias("part"), "value", (F.col("base") + F.col("before")).alias("_begin"))
    # a part is one task's, in order; parts of a hot hour are many tasks'
    out = parts.repartition("hour", "part").sortWithinPartitions("hour", "part", "_begin").drop("_begin")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("hour", "part").text(path)
    fs.delete(spark, staged)


def folder_files(spark: SparkSession, path: str) -> DataFrame:
    """(hour, path, bytes, changed) of the files below an hour-partitioned folder; listed by Spark, contents unread."""
    hour = F.regexp_extract("path", r"/hour=([^/]*)/", 1)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(hour.alias("hour"), "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("changed"))


def idle_hours(spark: SparkSession, landing: str, out: str, idle_s: float, now: dt.datetime | None = None) -> DataFrame:
    """Hours of the landing folder that got no file for idle_s seconds and whose newest file isn't older than what was rolled."""
    limit = F.current_timestamp() if now is None else F.lit(now)
    last = folder_files(spark, landing).groupBy("hour").agg(F.max("changed").alias("came"))
    quiet = last.where(F.col("came") <= limit - F.make_dt_interval(secs=F.lit(float(idle_s))))
    if not fs.exists(spark, out):
        return quiet.select("hour")
    rolled = folder_files(spark, out).groupBy("hour").agg(F.min("changed").alias("rolled"))
    return quiet.join(rolled, "hour", "left").where("rolled IS NULL OR came > rolled").select("hour")


def roll_hours(spark: SparkSession, landing: str, out: str, ts: str, schema: str, idle_s: float, target_bytes: int = TARGET_BYTES,
               now: dt.datetime | None = None) -> None:
    """Write the idle hours of a landing folder (``hour=.../*.json``) to ``out`` as files of the target size.

    An hour that gets rows after it was rolled is rolled again, whole, when it is idle again: landing files stay until their owner
    deletes them.  A run that was lost half-way is repeated: it replaces the parts it wrote.
    """
    hours = idle_hours(spark, landing, out, idle_s, now)
    names = scratch_path(spark, "idle-hours")
    hours.write.parquet(names)  # one listing decides, also if a task is repeated later
    hours = spark.read.parquet(names)
    if not hours.isEmpty():
        rows = spark.read.schema(f"{schema}, hour string").options(**JSON_OPTIONS).json(landing)
        unnamed = F.coalesce("l.hour", F.lit("__HIVE_DEFAULT_PARTITION__"))
        rows = rows.alias("l").join(hours.alias("h"), unnamed == F.col("h.hour"), "left_semi")
        sized_hours(rows.drop("hour"), out, ts, target_bytes)
    fs.delete(spark, names)
