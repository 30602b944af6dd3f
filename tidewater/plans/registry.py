"""Named, registered plans over the test tables: one Spark builder and, where the
result is expressible in SQL, the equivalent DuckDB-dialect oracle query."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Plan:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: tuple[str, ...]


PLANS: dict[str, Plan] = {}


def plan(name: str, ops: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def wrap(fn):
        if name in PLANS:
            raise ValueError(f"duplicate plan {name}")
        PLANS[name] = Plan(name, fn, sql.strip() if sql else None, tuple(ops.split()))
        return fn
    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
