"""Consecutive row numbers without a single-task window.

``row_number() OVER (ORDER BY ...)`` with no partition clause, or one over a
hot partition key, pulls every row of the group into one task. Here the frame
is range-sorted (sampled bounds split even one huge group across many tasks),
each task's rows get their in-partition position from
``monotonically_increasing_id``, and a table of per-(task, group) counts —
one row per task and group present in it — turns positions into global
numbers with a prefix sum.

The sorted, tagged frame is written once with a reliable ``checkpoint()`` to
the shared checkpoint folder: the count branch and the numbering branch must
see the same range bounds, and a lost executor must not re-sample them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import ensure_checkpoint_dir

_LOCAL_MASK = (1 << 33) - 1


def with_row_index(df: DataFrame, name: str, order_by: list[str], partition_by: list[str] | None = None,
                   start: int = 0) -> DataFrame:
    """Add ``name`` = 0-based (plus ``start``) position of each row in the order
    ``order_by`` within its ``partition_by`` group. ``order_by`` should be unique
    within a group for a deterministic result."""
    groups = list(partition_by or [])
    ordered = (df.repartitionByRange(*groups, *order_by)
               .sortWithinPartitions(*groups, *order_by)
               .withColumn("_ix_task", F.spark_partition_id())
               .withColumn("_ix_local", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_MASK))))
    ensure_checkpoint_dir(df.sparkSession)
    ordered = ordered.checkpoint(eager=True)
    runs = ordered.groupBy("_ix_task", *groups).agg(F.count(F.lit(1)).alias("_ix_n"),
                                                    F.min("_ix_local").alias("_ix_first"))
    w = Window.partitionBy(*groups).orderBy("_ix_task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_ix_base", F.coalesce(F.sum("_ix_n").over(w), F.lit(0)))
    runs = runs.select("_ix_task", *[F.col(g).alias(f"_ix_g_{g}") for g in groups], "_ix_base", "_ix_first")
    cond = ordered["_ix_task"] == runs["_ix_task"]
    for g in groups:
        cond = cond & ordered[g].eqNullSafe(runs[f"_ix_g_{g}"])
    # One row per (task, group): tiny for few groups, and AQE then broadcasts it from
    # measured run-time size; a high-cardinality grouping stays a shuffled join.
    out = ordered.join(runs, cond, "inner")
    idx = F.col("_ix_base") + F.col("_ix_local") - F.col("_ix_first") + F.lit(start)
    return out.select(*[ordered[c] for c in df.columns], idx.cast("bigint").alias(name))
