"""One-config ingest job: topic -> decode -> (offsets on rows) -> contract -> append or merge."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.contracts.schema import Contract
from tidewater.operators.decode import decode_json
from tidewater.sinks.tables import LAKE_FORMATS, TableSpec, append, check_checkpoint, merge
from tidewater.sources.topics import TopicSpec, read_topic
from tidewater.streaming.runner import keyed_state, query_id, write_batch
from tidewater.streaming.validate import batch_outcome, refuse_aggregates, stream_verdicts

DISCARD = "discard"  # said instead of a path: these records may go


@dataclass(frozen=True)
class IngestSpec:
    source: TopicSpec
    target: TableSpec
    checkpoint: str
    schema: str                      # DDL of the JSON value
    dead_letter_path: str            # undecodable records, or DISCARD
    operation: str = "insert"        # insert (append) | upsert (lake formats; needs target.key / precombine)
    wire: bool = False               # values have a registry header
    registry: DataFrame | None = None  # with wire: the known schema ids
    offsets_on_rows: bool = True     # keep partition, offset, timestamp on every row
    required: tuple[str, ...] = ()
    contract: Contract | None = None  # row and unique checks; aggregate checks are refused (see report_stream)
    unique_ttl_s: int | None = None  # accepted unique keys are forgotten after so long (default: never)
    quarantine_path: str | None = None  # rows that fail the contract, or DISCARD; needed with a contract
    order_by: str | None = None      # for a contract that keeps the first or last of duplicates
    available_now: bool = True


def _check(spec: IngestSpec) -> None:
    if not spec.dead_letter_path:
        raise ValueError("dead_letter_path must be a path or DISCARD")
    if spec.contract is not None:
        if not spec.quarantine_path:
            raise ValueError("a contract needs quarantine_path, a path or DISCARD")
        refuse_aggregates(spec.contract)
    if spec.unique_ttl_s is not None and spec.available_now:
        raise ValueError("a time to live keeps the query running: use available_now=False and stop it")
    if spec.operation not in ("insert", "upsert"):
        raise ValueError(f"unknown operation {spec.operation!r}")
    if spec.operation == "upsert" and spec.target.format not in LAKE_FORMATS:
        raise ValueError(f"upsert needs a lake format, one of {LAKE_FORMATS}")
    if spec.operation == "insert" and spec.target.format in LAKE_FORMATS and spec.target.format != "delta":
        raise ValueError(f"a replayed micro-batch would be inserted into {spec.target.format} twice: use upsert, delta or files")
    for path in (spec.target.path, spec.dead_letter_path, spec.quarantine_path):
        if path and path != DISCARD:
            check_checkpoint(path, spec.checkpoint)


def _append(df: DataFrame, target: TableSpec, query: str, batch_id: int) -> None:
    """A micro-batch into the table, once however often it is replayed."""
    if target.format == "delta":
        # the log keeps the last version of each application, so a replay is skipped
        append(df, replace(target, options={**target.options, "txnAppId": query, "txnVersion": str(batch_id)}))
    else:
        write_batch(df, target.path, query, batch_id, target.format)


def _decoded(spec: IngestSpec, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    meta = ["partition", "offset", "timestamp"] if spec.offsets_on_rows else []
    good, bad = decode_json(records, spec.schema, required=list(spec.required), meta=meta, wire=spec.wire, registry=spec.registry)
    if "timestamp" in good.columns and spec.offsets_on_rows:
        good = good.withColumnRenamed("timestamp", "_topic_timestamp")
    return good, bad


def _packed(good: DataFrame, bad: DataFrame) -> DataFrame:
    """One stream of both: each row is a good or a bad record."""
    a, b = F.struct(*[F.col(f"`{c}`") for c in good.columns]), F.struct(*[F.col(f"`{c}`") for c in bad.columns])
    left, right = good.select(a.alias("good")), bad.select(b.alias("bad"))
    none = [F.lit(None).cast(df.schema[0].dataType).alias(df.columns[0]) for df in (left, right)]
    return left.select("good", none[1]).unionByName(right.select(none[0], "bad"))


def run_ingest(spark: SparkSession, spec: IngestSpec):
    """Start the ingest query. Good, quarantined and undecodable rows of each micro-batch are written from one stream.

    Parquet outputs are folders ``query_id=.../batch_id=...`` of Spark's own ids, so a replayed batch replaces
    itself and a query on a new checkpoint adds to what is there. An insert into a Delta table carries the query and
    batch as its transaction; formats without one are refused, as a replay would insert twice. A contract's
    unique set is kept as keyed state (``stream_verdicts``).
    """
    _check(spec)
    good, bad = _decoded(spec, read_topic(spark, spec.source, stream=True))
    comp = None
    if spec.contract is not None:
        good, comp = stream_verdicts(good, spec.contract, spec.target.path, spec.checkpoint, spec.order_by, spec.unique_ttl_s)

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # replayable: a lost block is read again from the source
        try:
            query = query_id(batch.sparkSession, spec.checkpoint)
            rows = batch.where("good IS NOT NULL").select("good.*")
            if spec.dead_letter_path != DISCARD:
                dead = batch.where("bad IS NOT NULL").select("bad.*")
                write_batch(dead.withColumn("_at", F.current_timestamp()), spec.dead_letter_path, query, batch_id)
            if comp is not None:
                rows, quarantined = batch_outcome(spec.contract, comp, rows, spec.target.path, query, batch_id, spec.order_by)
                if spec.quarantine_path != DISCARD:
                    write_batch(quarantined, spec.quarantine_path, query, batch_id)
            if spec.operation == "upsert":
                merge(rows, spec.target)
            else:
                _append(rows, spec.target, query, batch_id)
        finally:
            batch.unpersist()

    w = _packed(good, bad).writeStream.option("checkpointLocation", spec.checkpoint).foreachBatch(each)
    w = w.trigger(availableNow=True) if spec.available_now else w.trigger(processingTime="30 seconds")
    with keyed_state(spark):
        return w.start()
