"""Lake-table writes: append, partitioned, keyed merge, hour-bucketed files.

A keyed table lives in a lake format (Delta, Iceberg, Hudi): ``merge`` hands the newest row per key to
the format's own MERGE or upsert write. ``newest_per_key`` is the same rule on plain frames.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.sinks.topics import JSON_OPTIONS


@dataclass(frozen=True)
class TableSpec:
    name: str
    path: str
    format: str = "parquet"
    key: tuple[str, ...] = ()
    precombine: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    options: dict = field(default_factory=dict)


def check_checkpoint(table_path: str, checkpoint: str) -> None:
    """Reject a checkpoint inside the table folder (readers would list it as data)."""
    t, c = table_path.rstrip("/") + "/", checkpoint.rstrip("/") + "/"
    if c.startswith(t) or t.startswith(c):
        raise ValueError("checkpointLocation must be outside the table path")


def append(df: DataFrame, spec: TableSpec) -> None:
    """Batch append (duplicate keys are kept, as an insert does)."""
    w = df.write.mode("append").format(spec.format).options(**spec.options)
    if spec.partition_by:
        w = w.partitionBy(*spec.partition_by)
    w.save(spec.path)


def append_stream(stream: DataFrame, spec: TableSpec, checkpoint: str, available_now: bool = True,
                  processing_time: str | None = None, query_name: str | None = None):
    """Streaming append with an explicit checkpoint; the file sink is exactly-once."""
    check_checkpoint(spec.path, checkpoint)
    w = (stream.writeStream.format(spec.format).outputMode("append").options(**spec.options)
         .option("checkpointLocation", checkpoint).option("path", spec.path))
    if spec.partition_by:
        w = w.partitionBy(*spec.partition_by)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "30 seconds")
    return w.start()


# ---------------------------------------------------------------- keyed merge

LAKE_FORMATS = ("delta", "iceberg", "hudi")


def newest_per_key(old: DataFrame, new: DataFrame | None, key: list[str], precombine: list[str]) -> DataFrame:
    """One row per key: the one of largest ``precombine``, a row of ``new`` winning a tie with ``old``.

    Columns that one side lacks are null in its rows. Give the source position (partition, offset) as the last
    precombine columns where rows of one side can tie. A partial aggregate: a hot key is combined map-side, and
    null keys are one key.
    """
    both = old.withColumn("_side", F.lit(0))
    if new is not None:
        both = both.unionByName(new.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    columns = [c for c in both.columns if c != "_side"]
    order = F.struct(*[F.col(f"`{c}`") for c in precombine], F.col("_side"))
    newest = both.groupBy(*[F.col(f"`{c}`") for c in key]).agg(
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in columns]), order).alias("_row"))
    return newest.select("_row.*")


def merge(df: DataFrame, spec: TableSpec) -> None:
    """Merge the newest row per key into a lake table through the format itself (its jar must be loaded).

    Delta and Iceberg: ``MERGE INTO``, the larger precombine winning and the incoming row on ties; Hudi: an
    ``upsert`` write with record key and precombine field.
    """
    if not spec.key or not spec.precombine:
        raise ValueError("a merge needs key and precombine columns")
    if spec.format not in LAKE_FORMATS:
        raise ValueError(f"format {spec.format!r} has no keyed merge; use one of {LAKE_FORMATS}, or newest_per_key on frames")
    newest = newest_per_key(df, None, list(spec.key), list(spec.precombine))
    if spec.format == "hudi":
        newest.write.format("hudi").options(**{
            "hoodie.table.name": spec.name, "hoodie.datasource.write.operation": "upsert",
            "hoodie.datasource.write.recordkey.field": ",".join(spec.key),
            "hoodie.datasource.write.precombine.field": spec.precombine[0], **spec.options}).mode("append").save(spec.path)
        return
    source = f"_tw_src_{uuid.uuid4().hex[:8]}"
    newest.createOrReplaceTempView(source)
    target = f"delta.`{spec.path}`" if spec.format == "delta" else spec.path
    on = " AND ".join(f"t.`{k}` <=> s.`{k}`" for k in spec.key)
    order = [", ".join(f"{side}.`{c}`" for c in spec.precombine) for side in "st"]
    df.sparkSession.sql(f"MERGE INTO {target} t USING {source} s ON {on} WHEN MATCHED AND struct({order[0]}) >= struct({order[1]}) "
                        "THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *")


def merge_stream(stream: DataFrame, spec: TableSpec, checkpoint: str, available_now: bool = True,
                 processing_time: str | None = None):
    """Streaming keyed merge: each micro-batch goes through ``merge``, which a replay doesn't change."""
    check_checkpoint(spec.path, checkpoint)
    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda batch, _id: merge(batch, spec))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "30 seconds")
    return w.start()


def latest_stream(stream: DataFrame, key: list[str], precombine: list[str]) -> DataFrame:
    """The newest row per key of a stream, for update or complete mode; the state holds one row per key."""
    order = F.struct(*[F.col(f"`{c}`") for c in precombine])
    newest = stream.groupBy(*[F.col(f"`{c}`") for c in key]).agg(
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in stream.columns]), order).alias("_row"))
    return newest.select("_row.*")


def read_topic_table(spark: SparkSession, base: str, topic: str, fmt: str = "parquet", view: bool = True) -> DataFrame:
    """Read the lake table named after a topic (``-`` to ``_``) and register a temp view."""
    name = topic.replace("-", "_")
    df = spark.read.format(fmt).load(f"{base.rstrip('/')}/{name}")
    if view:
        df.createOrReplaceTempView(name)
    return df


# ---------------------------------------------------------------- rolling files

def _text_options(fmt: str) -> dict:
    """Timestamps to the microsecond in text formats, whose default keeps milliseconds."""
    return JSON_OPTIONS if fmt in ("json", "csv") else {}


def hourly_files(df: DataFrame, path: str, ts: str, fmt: str = "json", max_records_per_file: int | None = None,
                 prefix_col: str = "hour", cluster: bool = True) -> None:
    """Write rows into ``hour=yyyy-MM-dd--HH`` folders (bucket per event hour).

    ``cluster`` range-partitions on hour and time first, so a task writes one or a few hours and a hot hour is
    split among several, instead of every input task leaving a small file in every hour it touches.
    """
    out = df.withColumn(prefix_col, F.date_format(F.col(ts), "yyyy-MM-dd--HH"))
    if cluster:
        # An explicit count is not coalesced away by AQE, so hours are written in parallel.
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        out = out.repartitionByRange(n, prefix_col, ts)
    w = out.write.mode("append").format(fmt).options(**_text_options(fmt)).partitionBy(prefix_col)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.save(path)


def hourly_files_stream(stream: DataFrame, path: str, ts: str, checkpoint: str, fmt: str = "json",
                        processing_time: str = "30 seconds", available_now: bool = False):
    """Streaming variant: hour folders, rolled every trigger (default 30 s)."""
    check_checkpoint(path, checkpoint)
    out = stream.withColumn("hour", F.date_format(F.col(ts), "yyyy-MM-dd--HH"))
    w = (out.writeStream.format(fmt).options(**_text_options(fmt)).option("path", path)
         .option("checkpointLocation", checkpoint).partitionBy("hour"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()
