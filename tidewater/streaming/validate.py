"""Contract validation on streams.

Row checks are stateless, so they run inline on the stream (valid and quarantine outputs).  A ``unique`` set concerns the
whole stream: keyed state remembers the accepted keys.  Checks over all rows (aggregates) have a verdict per micro-batch, on
all rows up to it: ``report_stream`` keeps their mergeable partial states between micro-batches.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater import fs
from tidewater.contracts.schema import Contract
from tidewater.contracts.validate import (REPORT_SCHEMA, Compiled, ContractError, compile_contract, report_rules, row_verdicts, set_checks,
                                          split_verdicts, validate)
from tidewater.sinks.tables import check_checkpoint
from tidewater.streaming.runner import keyed_state, query_id, write_batch
from tidewater.streaming.unique import marked


def split_stream(stream: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine) streaming frames from the contract's row checks; other checks are refused."""
    unique, aggregates = set_checks(contract)
    if unique or aggregates:
        raise ContractError(f"checks over all rows can't run inline on a stream: {unique + aggregates}; use validate_stream")
    return validate(contract, stream, "quarantine", row_checks_only=True)


def refuse_aggregates(contract: Contract) -> None:
    _, aggregates = set_checks(contract)
    if aggregates:
        raise ContractError(f"aggregate checks reject no rows of a stream; report_stream gives their verdicts: {aggregates}")


def _accepted(spark: SparkSession, valid_path: str) -> DataFrame | None:
    try:
        return spark.read.option("basePath", valid_path).parquet(valid_path)
    except AnalysisException:  # nothing was written yet
        return None


def _accepted_by_others(spark: SparkSession, valid_path: str, checkpoint: str) -> DataFrame | None:
    """Rows that other queries accepted, for a query that has committed nothing yet; what it wrote itself is replaced."""
    if fs.list_names(spark, f"{checkpoint}/commits"):
        return None
    rows = _accepted(spark, valid_path)
    if rows is None or "query_id" not in rows.columns or not fs.exists(spark, f"{checkpoint}/metadata"):
        return rows
    return rows.where(F.col("query_id") != query_id(spark, checkpoint))


def stream_verdicts(stream: DataFrame, contract: Contract, valid_path: str, checkpoint: str, order_by: str | None = None,
                    unique_ttl_s: int | None = None) -> tuple[DataFrame, Compiled]:
    """The stream's rows with the contract's verdicts, for ``batch_outcome``.

    One unique set is held against keyed state.  Several sets depend on each other (a row takes its keys only if all sets
    accept it), which no single key's state can tell: they are checked in ``batch_outcome``.
    """
    refuse_aggregates(contract)
    rows, comp = row_verdicts(contract, stream)
    if len(comp.unique_sets) != 1:
        return rows, comp
    before = _accepted_by_others(stream.sparkSession, valid_path, checkpoint)
    return marked(rows, comp.unique_sets[0], contract.report_duplicates, order_by, before, unique_ttl_s), comp


def batch_outcome(contract: Contract, comp: Compiled, rows: DataFrame, valid_path: str, query: str, batch_id: int,
                  order_by: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine) of a micro-batch of ``stream_verdicts``.

    With several unique sets, the accepted rows' key columns are read and joined with this batch's keys.
    """
    if not comp.unique_sets:
        return split_verdicts(rows, comp)
    if len(comp.unique_sets) == 1:
        label = F.array(F.lit(f"{','.join(comp.unique_sets[0])}:unique"))
        again = F.col("_duplicate") | (F.col("_ok") & F.col("_seen"))
        none = F.array().cast("array<string>")
        rows = rows.withColumns({"_ok": F.col("_ok") & ~again,
                                 "_reasons": F.concat(F.coalesce("_reasons", none), F.when(again, label).otherwise(none))})
        return split_verdicts(rows, comp)
    own = [c for c in rows.columns if c not in ("_ok", "_reasons") and not c.startswith("_orig_")]
    found = rows.select(*[F.col(f"`_orig_{c}`").alias(c) if f"_orig_{c}" in rows.columns else F.col(f"`{c}`") for c in own])
    good, bad = validate(contract, found, "quarantine", order_by=order_by)
    before = _accepted(rows.sparkSession, valid_path)
    if before is not None and "query_id" in before.columns:
        before = before.where(~((F.col("query_id") == query) & (F.col("batch_id") == batch_id)))
    for cols in comp.unique_sets if before is not None else []:
        on = [F.col(f"g.`{c}`").eqNullSafe(F.col(f"s.`{c}`")) for c in cols]
        seen = before.select(*[F.col(f"`{c}`") for c in cols]).distinct().alias("s")
        again = good.alias("g").join(seen, on, "left_semi")
        bad = bad.unionByName(again.withColumn("_reasons", F.array(F.lit(f"{','.join(cols)}:unique"))))
        good = good.alias("g").join(seen, on, "left_anti")
    return good, bad


def validate_stream(stream: DataFrame, contract: Contract, valid_path: str, quarantine_path: str,
                    checkpoint: str, order_by: str | None = None, available_now: bool = True,
                    processing_time: str | None = None, unique_ttl_s: int | None = None):
    """Validate every micro-batch; valid rows and quarantined rows (with ``_reasons``) go to two tables.

    A row whose unique key was accepted in an earlier micro-batch, or by an earlier query into the same table, is
    quarantined.  ``unique_ttl_s``: accepted keys are forgotten after that many seconds (default: never); such state
    follows the clock, so the query never ends by itself and needs ``available_now=False``.
    """
    check_checkpoint(valid_path, checkpoint)
    if unique_ttl_s is not None and available_now:
        raise ValueError("a time to live keeps the query running: use available_now=False and stop it")
    rows, comp = stream_verdicts(stream, contract, valid_path, checkpoint, order_by, unique_ttl_s)

    def each(batch: DataFrame, batch_id: int) -> None:
        # Two writes read the same micro-batch: cache it once (a lost block is
        # recomputed from the replayable source batch).
        batch.persist()
        try:
            query = query_id(batch.sparkSession, checkpoint)
            good, bad = batch_outcome(contract, comp, batch, valid_path, query, batch_id, order_by)
            write_batch(bad, quarantine_path, query, batch_id)
            write_batch(good, valid_path, query, batch_id)
        finally:
            batch.unpersist()

    w = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "30 seconds")
    with keyed_state(stream.sparkSession):
        return w.start()


def report_stream(stream: DataFrame, contract: Contract, path: str, checkpoint: str, available_now: bool = True,
                  processing_time: str | None = None):
    """The contract's report after every micro-batch, on all rows up to it: rows (column, check, failures) at
    ``path/query_id=.../batch_id=...``; ``last_report`` reads the newest.

    Every row and aggregate check is one aggregate of a single streaming aggregation: a maximum, a share or the set of a few
    values is a partial state that tasks merge and the state store keeps, and no micro-batch reads an earlier one's rows.
    ``unique`` sets aren't in it (``validate_stream`` rejects their rows).  A check's own function must use aggregates that
    Spark can keep on a stream, which excludes distinct counts.
    """
    check_checkpoint(path, checkpoint)
    comp = compile_contract(contract, stream)
    if comp.structural:
        raise ContractError(f"contract failed on structure: {comp.structural}")
    rules = report_rules(comp)
    if not rules:
        raise ContractError("the contract has no check of rows or aggregates")
    counts = comp.df.agg(*[e.alias(f"_r{i}") for i, (_, _, e) in enumerate(rules)])
    each_row = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(k).alias("check"), F.col(f"_r{i}").alias("failures"))
                                   for i, (c, k, _) in enumerate(rules)]))

    def each(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch.select(each_row.alias("r")).select("r.*"), path, query_id(batch.sparkSession, checkpoint), batch_id)

    w = counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(each)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "30 seconds")
    return w.start()


def reports(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """All reports of the query of that checkpoint, with their batch_id."""
    rows = spark.read.option("basePath", path).parquet(f"{path}/query_id={query_id(spark, checkpoint)}")
    return rows.select(*REPORT_SCHEMA.names, "batch_id")


def last_report(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    rows = reports(spark, path, checkpoint)
    newest = rows.agg(F.max("batch_id")).first()[0]
    return rows.where(F.col("batch_id") == newest).drop("batch_id")
