"""Run a streaming plan to the end of its available input and read the result back."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import scratch_path


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark wrote into the checkpoint of a started query: the same after a restart, new with a new one."""
    return json.loads("".join(r[0] for r in spark.read.text(f"{checkpoint.rstrip('/')}/metadata").collect()))["id"]


def write_batch(batch: DataFrame, path: str, query: str, batch_id: int, fmt: str = "parquet") -> None:
    """One micro-batch of one query as its own folder ``query_id=.../batch_id=...``.

    A replay of the batch replaces exactly what it wrote before; another query, or the same one on a new
    checkpoint, has another id and never touches it. Readers see query_id and batch_id as columns.
    """
    batch.write.mode("overwrite").format(fmt).save(f"{path}/query_id={query}/batch_id={batch_id}")


@contextmanager
def keyed_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which keyed processors need; a checkpoint remembers that."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def input_read(progress: dict) -> bool:
    return not progress["numInputRows"]


def at_rest(progress: dict) -> bool:
    """A micro-batch without input that left no state: everything that came was read, and every timer has fired."""
    return input_read(progress) and not any(o["numRowsTotal"] for o in progress["stateOperators"])


def run_until_rest(stream: DataFrame, path: str | None = None, checkpoint: str | None = None, every: str = "1 second",
                   timeout_s: int | None = None, done: Callable[[dict], bool] = at_rest) -> DataFrame:
    """Run a stream with timers until its input is read and its state has emptied by the clock; a batch read of the result.

    Spark goes on with micro-batches for ever where timers follow the clock, under ``availableNow`` too, so the query
    is stopped from here, once ``done`` holds for the progress of two micro-batches in a row.  ``done=input_read`` leaves what is still
    open to the next start on the checkpoint.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, "stream-out")
    checkpoint = checkpoint or scratch_path(spark, "stream-ckpt")
    with keyed_state(spark):
        q = (stream.writeStream.format("parquet").outputMode("append").option("path", path)
             .option("checkpointLocation", checkpoint).trigger(processingTime=every).start())
    end, first = None if timeout_s is None else time.monotonic() + timeout_s, None
    while q.isActive:
        progress = q.lastProgress
        if progress and not done(progress):
            first = None
        elif progress and first is None:
            first = progress["batchId"]
        elif progress and progress["batchId"] > first:
            break
        if end is not None and time.monotonic() > end:
            q.stop()
            raise TimeoutError("the stream did not come to rest")
        q.awaitTermination(0.2)
    if q.exception():
        raise q.exception()
    q.stop()
    return spark.read.schema(stream.schema).parquet(path)


def run_available(stream: DataFrame, path: str | None = None, checkpoint: str | None = None,
                  fmt: str = "parquet", output_mode: str = "append", partition_by: list[str] | None = None,
                  keys: list[str] | None = None, timeout_s: int | None = None) -> DataFrame:
    """``availableNow`` to the end of the input, then a batch read of the result.

    append: Spark's file sink, exactly-once per checkpoint. complete: the last micro-batch, which holds the whole
    result. update: micro-batches hold changed rows only, so ``keys`` must name the result's key and the row of the
    latest micro-batch counts. ``timeout_s`` stops a stream that takes longer (default: no limit) and raises.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, "stream-out")
    checkpoint = checkpoint or scratch_path(spark, "stream-ckpt")
    if output_mode == "append":
        w = (stream.writeStream.format(fmt).outputMode("append").option("path", path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True))
        if partition_by:
            w = w.partitionBy(*partition_by)
    else:
        if output_mode == "update" and not keys:
            raise ValueError("update mode needs keys=, the columns that name a row of the result")

        def each(batch: DataFrame, batch_id: int) -> None:
            write_batch(batch, path, query_id(spark, checkpoint), batch_id, fmt)

        w = (stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
             .foreachBatch(each).trigger(availableNow=True))
    q = w.start()
    if timeout_s is None:
        q.awaitTermination()
    else:
        q.awaitTermination(timeout_s)
        if q.isActive:
            q.stop()
            raise TimeoutError("stream did not finish")
    if q.exception():
        raise q.exception()
    if output_mode == "append":
        return spark.read.format(fmt).load(path)
    mine = spark.read.format(fmt).option("basePath", path).load(f"{path}/query_id={query_id(spark, checkpoint)}")
    columns = [c for c in mine.columns if c not in ("query_id", "batch_id")]
    if output_mode == "complete":
        return mine.where(F.col("batch_id") == mine.agg(F.max("batch_id")).first()[0]).select(columns)
    row = F.max_by(F.struct(*[F.col(f"`{c}`") for c in columns]), "batch_id").alias("_row")
    return mine.groupBy(*keys).agg(row).select("_row.*")
