"""Connected components by repeated minimum labels and pointer jumps, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.exchange import discard, materialized


def components(links: DataFrame) -> DataFrame:
    """(node, label): label is the least node reachable over links (a, b).

    Each round a node takes the least label among its own and its neighbours', then its label's
    label; rounds end when no label changes.  Hot nodes only meet partial minima and joins that AQE
    splits; each round is written to the shared folder, so lineage stays short.
    """
    spark = links.sparkSession
    both = links.select("a", "b").union(links.select("b", "a")).toDF("node", "other").distinct()
    both = materialized(spark, both, "links")
    labels = both.groupBy("node").agg(F.min("other").alias("other")).select(
        "node", F.least("node", "other").alias("label"))
    held = materialized(spark, labels, "labels")
    labels = held.select("node", "label")
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "label"), "other")
        near = near.groupBy("node").agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"),
                                                F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        step = step.join(jump, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("next", "label")).alias("label"))
        step = materialized(spark, step, "labels")
        changed = step.where("label <> old").limit(1).count()
        discard(held)
        held, labels = step, step.select("node", "label")
        if not changed:
            discard(both)
            return labels
