import datetime as dt
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewater.plans import tables
from tidewater.session import scratch_path
from tidewater.sinks import rolling
from tidewater.sinks.rolling import folder_files, idle_hours, roll_hours, sized_hours
from tidewater.sinks.tables import hourly_files

DDL = "id long, ts timestamp_ntz, note string"


def rows(spark, n, hot=3):
    """Every third row in one hour, the others over 40 hours."""
    minute = F.when(F.col("id") % hot == 0, F.col("id") % 60).otherwise(F.col("id") * 37 % 2400)
    ts = F.timestamp_add("MINUTE", minute, F.lit("2024-03-01 00:00:00").cast("timestamp_ntz"))
    return spark.range(n).select("id", ts.alias("ts"), F.repeat(F.lit("é"), (F.col("id") % 30).cast("int")).alias("note"))


def parts(spark, path):
    found = folder_files(spark, path).where("path LIKE '%/part=%'")
    return {(r.hour, int(r.path.split("/part=")[1].split("/")[0])): r.bytes for r in found.collect()}


@pytest.mark.parametrize("target", [700, 10**9])
def test_files_of_a_size(spark, target):
    df, path = rows(spark, 3000).repartition(6), scratch_path(spark, "sized")
    sized_hours(df, path, "ts", target)
    back = spark.read.schema(f"{DDL}, hour string, part int").json(path)
    assert back.select("id", "ts", "note").exceptAll(df).count() == 0 and back.count() == 3000
    assert back.where("hour <> date_format(ts, 'yyyy-MM-dd--HH')").count() == 0
    sizes = parts(spark, path)
    hours = {}
    for (hour, part), n in sizes.items():
        hours.setdefault(hour, []).append((part, n))
    assert all(n <= target + 200 for n in sizes.values())
    for files in hours.values():
        assert [p for p, _ in sorted(files)] == list(range(len(files)))  # one file a part, no part left out
        assert len(files) <= -(-sum(n for _, n in files) // target)
    assert (len(hours["2024-03-01--00"]) > 50) == (target == 700)


def test_parts_are_in_time_order_and_repeatable(spark):
    df, path = rows(spark, 900).repartition(4), scratch_path(spark, "sized")
    for _ in range(2):  # the second run replaces what the first wrote
        sized_hours(df, path, "ts", 500)
        back = spark.read.schema(f"{DDL}, hour string, part int").json(path)
        assert back.count() == 900
    spans = back.groupBy("hour", "part").agg(F.min("ts").alias("a"), F.max("ts").alias("b")).collect()
    for r in spans:
        assert all(o.a >= r.b for o in spans if o.hour == r.hour and o.part > r.part)


def test_rows_without_a_time_and_empty(spark):
    path = scratch_path(spark, "sized")
    sized_hours(spark.createDataFrame([(1, None, "a"), (2, dt.datetime(2024, 1, 1), None)], DDL), path, "ts", 10)
    assert spark.read.schema(f"{DDL}, hour string, part int").json(path).where("hour IS NULL").count() == 1
    empty = scratch_path(spark, "sized")
    sized_hours(spark.createDataFrame([], DDL), empty, "ts", 10)


def test_running_bytes_over_batches():
    def batch(hours, sizes):
        return pa.RecordBatch.from_arrays([pa.array(hours, pa.string()), pa.array(["x"] * len(hours)), pa.array(sizes, pa.int64()),
                                           pa.array([0] * len(hours), pa.int32())], names=["hour", "value", "bytes", "task"])

    got = pa.Table.from_batches(rolling._running_bytes([batch(["a", "a", "b"], [1, 2, 3]), batch([], []), batch(["b", "b"], [4, 5]), batch(["b", "c", "c"], [6, 7, 8]),
                                                        batch(["d"], [9])]))
    assert got["before"].to_pylist() == [0, 1, 0, 3, 7, 12, 0, 7, 0]


def test_idle_hours_are_rolled_once_and_again_after_new_rows(spark):
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "rolled")
    df = rows(spark, 600)
    hourly_files(df.where("id % 2 = 0"), landing, "ts")
    schema = f"{DDL}, hour string, part int"
    roll_hours(spark, landing, out, "ts", DDL, idle_s=3600)
    assert idle_hours(spark, landing, out, 3600).count() == 0  # nothing has been quiet for an hour
    later = dt.datetime.now() + dt.timedelta(hours=2)
    roll_hours(spark, landing, out, "ts", DDL, 3600, 500, later)
    assert spark.read.schema(schema).json(out).count() == 300 and idle_hours(spark, landing, out, 3600, later).count() == 0
    time.sleep(1.1)  # file times may be whole seconds
    hourly_files(df.where("id % 2 = 1 AND ts < timestamp_ntz'2024-03-01 01:00:00'"), landing, "ts")
    assert [r.hour for r in idle_hours(spark, landing, out, 3600, later).collect()] == ["2024-03-01--00"]
    roll_hours(spark, landing, out, "ts", DDL, 3600, 500, later)
    want = df.where("id % 2 = 0 OR ts < timestamp_ntz'2024-03-01 01:00:00'")
    got = spark.read.schema(schema).json(out).select("id", "ts", "note")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    assert all(n <= 700 for n in parts(spark, out).values())


def test_a_hot_hour_lands_from_many_tasks(spark, tmp_path, monkeypatch):
    ts = F.timestamp_add("MINUTE", F.col("event_id") * 37 % 2400, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    spark.range(2000).withColumnRenamed("id", "event_id").select(
        "event_id", ts.alias("ts"), F.col("event_id").alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.5).alias("value"),
        F.lit("{}").alias("props")).write.parquet(f"{tmp_path}/events.parquet")
    landed = []
    monkeypatch.setattr(tables, "roll_hours", lambda s, landing, *a, **k: landed.append(landing) or roll_hours(s, landing, *a, **k))
    got = tables.rolled_hours(spark, str(tmp_path)).collect()
    assert folder_files(spark, landed[0]).where("hour = '2024-01-05--07'").count() > 3 * 2  # three loads, which two tasks each wrote before
    assert sum(r.rows for r in got) == 2000 and sum(r.ids for r in got) == sum(range(2000))
