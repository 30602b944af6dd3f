"""Time-bucket analytics: histograms, bursts, calendars, top keys, tumbling sums.

All operators are plain groupBy/window plans, so they work unchanged on
streaming DataFrames where Structured Streaming supports the aggregate, and
Catalyst prunes the scan to the columns they touch. Bucket starts keep the
input timestamp type (``window()`` keeps TIMESTAMP_NTZ).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def bucket_counts(df: DataFrame, ts: str, width: str, keys: list[str] | None = None,
                  count_col: str = "events") -> DataFrame:
    """Count rows per (keys, bucket); only observed buckets appear.

    One shuffle on (keys, bucket) with map-side partial counts, so a hot key is
    already combined before the exchange and spread over its buckets after it.
    """
    keys = keys or []
    grouped = df.groupBy(*keys, F.window(_c(ts), width).alias("_w"))
    return grouped.agg(F.count(F.lit(1)).alias(count_col)).select(
        *keys, F.col("_w.start").alias("bucket_start"), count_col)


GRID_BLOCK = 100_000  # buckets generated per grid row


def time_histogram(df: DataFrame, ts: str, width: str, count_col: str = "events") -> DataFrame:
    """Zero-filled histogram: every bucket between the first and last observed one.

    The grid is unioned in with zero counts and summed: no join, and the only
    shuffle of source rows is the partial-aggregated count. The grid is built in
    two levels — block starts ``sequence(min, max, width * GRID_BLOCK)``, spread
    over the cluster, then the buckets of each block — so a fine width over a
    long span is generated in parallel rather than as one huge array in one task.
    """
    counts = bucket_counts(df, ts, width, count_col=count_col)
    step = F.expr(f"INTERVAL {width}")
    block = step * F.lit(GRID_BLOCK)
    spark = df.sparkSession
    blocks = (counts.agg(F.min("bucket_start").alias("lo"), F.max("bucket_start").alias("hi"))
              .select("hi", F.explode(F.sequence("lo", "hi", block)).alias("b"))
              .repartition(spark.sparkContext.defaultParallelism))
    grid = (blocks.select(F.explode(F.sequence("b", F.least("hi", F.col("b") + block - step), step))
                          .alias("bucket_start"))
            .withColumn(count_col, F.lit(0).cast("bigint")))
    return (counts.unionByName(grid)
            .groupBy("bucket_start").agg(F.sum(count_col).cast("bigint").alias(count_col)))


def bursts(df: DataFrame, key: str, ts: str, width: str, min_events: int,
           sort: bool = True, count_col: str = "events") -> DataFrame:
    """Buckets where a key has at least ``min_events`` rows, flagged ``fail_event = 1``."""
    out = (bucket_counts(df, ts, width, [key], count_col)
           .where(F.col(count_col) >= min_events)
           .withColumn("fail_event", F.lit(1)))
    return out.orderBy(key, "bucket_start") if sort else out


def daily_sum(df: DataFrame, key: str, ts: str, value: str, width: str = "1 day") -> DataFrame:
    """Sum of ``value`` per key per day (observed days only)."""
    return (df.groupBy(key, F.window(_c(ts), width).alias("_w"))
            .agg(F.sum(value).alias(value))
            .select(key, F.col("_w.start").alias("day"), value))


MOST_KEYS = 2_000  # columns that a pivot may have


def observed_keys(df: DataFrame, key: str, most: int = MOST_KEYS) -> list:
    """The distinct non-null values of a key, in order: one job, and as many values as a pivot has columns.

    More than ``most`` raise, instead of filling the driver and making a column of each: such keys want rows."""
    found = [r[0] for r in df.select(key).where(F.col(key).isNotNull()).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{key!r} has more than {most} values; name the keys that should be columns, or use daily_sum")
    return sorted(found)


def calendar(df: DataFrame, key: str, ts: str, value: str, keys: list[str] | None = None,
             width: str = "1 day") -> DataFrame:
    """Pivot day x key of ``sum(value)``; absent (day, key) cells are null.

    Without ``keys`` every observed key is a column, found by one distinct job. The pivot is written as one
    conditional aggregate per key: a single (partially aggregated) shuffle on the day, where
    ``groupBy().pivot()`` would aggregate by (day, key) first and shuffle twice.
    """
    keys = observed_keys(df, key) if keys is None else keys
    return (df.groupBy(F.window(_c(ts), width).start.alias("day"))
            .agg(*[F.sum(F.when(F.col(key) == F.lit(k), F.col(value))).alias(str(k)) for k in keys]))


def burst_calendar(df: DataFrame, key: str, ts: str, keys: list[str] | None = None, width: str = "1 hour",
                   min_events: int = 3, day: str = "1 day") -> DataFrame:
    """Bursts per key, summed per day and pivoted to one column per key (default: every key observed in df)."""
    keys = observed_keys(df, key) if keys is None else keys
    b = bursts(df, key, ts, width, min_events, sort=False)
    out = calendar(b, key, "bucket_start", "fail_event", keys, day)
    return out.select("day", *[F.col(f"`{k}`").cast("bigint").alias(str(k)) for k in keys])


def top_keys(df: DataFrame, key: str, k: int, count_col: str = "events") -> DataFrame:
    """The ``k`` keys with most rows (ties by key), returned sorted by key.

    ``limit`` after ``orderBy`` plans as TakeOrderedAndProject: every partition
    keeps its own top k and only those reach the final merge.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(count_col))
    return counts.orderBy(F.desc(count_col), F.asc(key)).limit(k).orderBy(key)


def tumble_sum(df: DataFrame, ts: str, key: str, value: str, width: str = "60 seconds",
               factor: float | Decimal | None = Decimal("0.85"), decimal_scale: int | None = None,
               out_col: str = "window_sales") -> DataFrame:
    """Per key and tumbling window: window end and ``SUM(value) * factor``.

    With ``decimal_scale`` the sum runs in DECIMAL(18, scale) and is cast back to
    double, which makes the result independent of summation order.
    """
    v = F.col(value)
    if decimal_scale is not None:
        v = v.cast(f"decimal(18,{decimal_scale})")
    agg = F.sum(v)
    if factor is not None:
        agg = agg * (F.lit(Decimal(str(factor))) if decimal_scale is not None else F.lit(float(factor)))
    return (df.groupBy(F.window(_c(ts), width).alias("_w"), key)
            .agg(agg.cast("double").alias(out_col))
            .select(key, F.col("_w.end").alias("window_end"), out_col))
