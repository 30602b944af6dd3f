"""Schema registry as a table: (subject, version, id, schema).

Lookups are DataFrame operations: records find their schema by a join on the id in their header, and only the
one schema text that a reader needs reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.columns import wire_magic_ok, wire_schema_id

REGISTRY_DDL = "subject string, version int, id int, schema string"


def registry_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, REGISTRY_DDL)


def subject_for_topic(topic: str, part: str = "value") -> str:
    return f"{topic}-{part}"


def latest_schemas(registry: DataFrame) -> DataFrame:
    """Newest version per subject."""
    best = F.max_by(F.struct("version", "id", "schema"), "version")
    return registry.groupBy("subject").agg(best.alias("_r")).select("subject", "_r.*")


def latest_schema(registry: DataFrame, subject: str) -> tuple[int, str]:
    """(id, schema) of the newest version of ``subject``, fetched once on the driver."""
    row = latest_schemas(registry.where(F.col("subject") == subject)).first()
    if row is None:
        raise KeyError(f"no schema registered for subject {subject!r}")
    return row["id"], row["schema"]


def with_schema(records: DataFrame, registry: DataFrame, subject: str | None = None, value: str = "value") -> DataFrame:
    """Records with ``schema_id`` and ``schema``, by the id in their wire header; null for an id that isn't registered."""
    reg = registry if subject is None else registry.where(F.col("subject") == subject)
    reg = reg.select("id", "schema").dropDuplicates(["id"])
    tagged = records.withColumn("schema_id", F.when(wire_magic_ok(value), wire_schema_id(value)))
    return tagged.join(reg, F.col("schema_id") == F.col("id"), "left").drop("id")
