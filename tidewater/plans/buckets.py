"""Time-bucket plans over ``events`` and the scalar-function plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.columns import (epoch_ms_to_timestamp, path_segment, render_row,
                                          strip_suffix, timestamp_to_epoch_ms)
from tidewater.operators import timebuckets as tb
from tidewater.plans.registry import plan, table
from tidewater.session import scratch_path

@plan("user_bursts_day", "A3 A4 T7 O2", """
SELECT user_id, time_bucket(INTERVAL '1 day', ts) AS bucket_start, count(*) AS events, 1 AS fail_event
FROM events GROUP BY 1, 2 HAVING count(*) >= 3 ORDER BY 1, 2
""")
def user_bursts_day(spark, sf):
    return tb.bursts(table(spark, sf, "events"), "user_id", "ts", "1 day", 3)


@plan("user_bursts_15m", "A3 A4 T7 O2", """
SELECT user_id, time_bucket(INTERVAL '15 minutes', ts) AS bucket_start, count(*) AS events, 1 AS fail_event
FROM events GROUP BY 1, 2 HAVING count(*) >= 2 ORDER BY 1, 2
""")
def user_bursts_15m(spark, sf):
    return tb.bursts(table(spark, sf, "events"), "user_id", "ts", "15 minutes", 2)


@plan("error_histogram_hourly", "A2 F8", """
WITH b AS (SELECT date_trunc('hour', ts) AS h, count(*) AS n FROM events
           WHERE event_type = 'error' GROUP BY 1),
     g AS (SELECT unnest(generate_series(min(h), max(h), INTERVAL 1 HOUR)) AS h FROM b)
SELECT g.h AS bucket_start, CAST(coalesce(b.n, 0) AS BIGINT) AS events
FROM g LEFT JOIN b ON g.h = b.h
""")
def error_histogram_hourly(spark, sf):
    ev = table(spark, sf, "events").where(F.col("event_type") == "error")
    return tb.time_histogram(ev, "ts", "1 hour")


@plan("burst_calendar", "A4 A5 A6", """
WITH b AS (SELECT event_type, time_bucket(INTERVAL '1 hour', ts) AS h FROM events
           GROUP BY 1, 2 HAVING count(*) >= 3)
SELECT date_trunc('day', h) AS day,
       CAST(sum(CASE WHEN event_type = 'click' THEN 1 END) AS BIGINT) AS click,
       CAST(sum(CASE WHEN event_type = 'error' THEN 1 END) AS BIGINT) AS error,
       CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 END) AS BIGINT) AS purchase,
       CAST(sum(CASE WHEN event_type = 'signup' THEN 1 END) AS BIGINT) AS signup,
       CAST(sum(CASE WHEN event_type = 'view' THEN 1 END) AS BIGINT) AS "view"
FROM b GROUP BY 1
""")
def burst_calendar(spark, sf):
    return tb.burst_calendar(table(spark, sf, "events"), "event_type", "ts", width="1 hour", min_events=3)


@plan("top_users", "A1 O1 O3 O4", """
SELECT * FROM (SELECT user_id, count(*) AS events FROM events GROUP BY 1
               ORDER BY events DESC, user_id LIMIT 25) ORDER BY user_id
""")
def top_users(spark, sf):
    return tb.top_keys(table(spark, sf, "events"), "user_id", 25)


@plan("top_users_ranked", "O1 O2 O3", """
SELECT user_id, events, CAST(row_number() OVER (ORDER BY events DESC, user_id) AS INTEGER) AS position
FROM (SELECT user_id, count(*) AS events FROM events GROUP BY 1 ORDER BY events DESC, user_id LIMIT 25)
""")
def top_users_ranked(spark, sf):
    """The sorted report written as one ordered CSV and read back with each line's position in the file."""
    path = scratch_path(spark, "top-users-csv")
    top = tb.top_keys(table(spark, sf, "events"), "user_id", 25).orderBy(F.desc("events"), "user_id")
    top.coalesce(1).write.option("header", True).csv(path)  # 25 rows
    back = spark.read.option("header", True).schema("user_id bigint, events bigint").csv(path)
    return back.withColumn("position", (F.monotonically_increasing_id() + 1).cast("int"))


@plan("value_sums", "A7 A8", """
SELECT event_type, count(*) AS events, sum(value) * 0.85 AS scaled FROM events GROUP BY 1
""")
def value_sums(spark, sf):
    """The plain double path of the scaled sum, with the row count."""
    return table(spark, sf, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), (F.sum("value") * F.lit(0.85)).alias("scaled"))


@plan("tumble_sum_batch", "W1 A7 F9 F10", """
SELECT event_type, time_bucket(INTERVAL '60 seconds', ts) + INTERVAL '60 seconds' AS window_end,
       CAST(sum(CAST(value AS DECIMAL(18,2))) * 0.85 AS DOUBLE) AS window_sales
FROM events GROUP BY 1, 2
""")
def tumble_sum_batch(spark, sf):
    return tb.tumble_sum(table(spark, sf, "events"), "ts", "event_type", "value",
                         "60 seconds", factor="0.85", decimal_scale=2)


@plan("epoch_ms_to_ts", "F7 F8", """
SELECT event_id, epoch_us(ts) // 1000 AS epoch_ms, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts_back,
       time_bucket(INTERVAL '15 minutes', make_timestamp((epoch_us(ts) // 1000) * 1000)) AS bucket_15m
FROM events
""")
def epoch_ms_to_ts(spark, sf):
    ev = table(spark, sf, "events").select("event_id", timestamp_to_epoch_ms("ts").alias("epoch_ms"))
    back = epoch_ms_to_timestamp("epoch_ms")
    return ev.select("event_id", "epoch_ms", back.alias("ts_back"),
                     F.window(back, "15 minutes").start.alias("bucket_15m"))


@plan("name_suffix_strip", "F4 A1 O1", """
SELECT p_name[:-10] AS name_prefix, count(*) AS parts FROM part GROUP BY 1
""")
def name_suffix_strip(spark, sf):
    p = table(spark, sf, "part").select(strip_suffix("p_name", 9).alias("name_prefix"))
    return p.groupBy("name_prefix").agg(F.count(F.lit(1)).alias("parts")).orderBy(F.desc("parts"))


@plan("path_segments", "T8 F3", """
SELECT page_id, string_split(url, '/')[1] AS scheme, string_split(url, '/')[3] AS host,
       string_split(url, '/')[4] AS lang, string_split(url, '/')[5] AS leaf
FROM pages
""")
def path_segments(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    return pages.select("page_id", path_segment("url", 0).alias("scheme"), path_segment("url", 2).alias("host"),
                        path_segment("url", 3).alias("lang"), path_segment("url", 4).alias("leaf"))


@plan("render_rows", "F15 T6", """
SELECT n_nationkey, concat_ws(' | ', n_nationkey, n_name, n_regionkey) AS line FROM nation
""")
def render_rows(spark, sf):
    nation = table(spark, sf, "nation")
    return nation.select("n_nationkey", render_row("n_nationkey", "n_name", "n_regionkey").alias("line"))


@plan("daily_value_sum", "A5 F8", """
SELECT event_type, date_trunc('day', ts) AS day, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM events GROUP BY 1, 2
""")
def daily_value_sum(spark, sf):
    ev = table(spark, sf, "events").withColumn("value", F.col("value").cast("decimal(18,2)"))
    out = tb.daily_sum(ev, "event_type", "ts", "value")
    return out.withColumn("value", F.col("value").cast("double"))
