"""One key holding a third of all rows must not land in a single task."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.contracts import duplicate_rows
from tidewater.functions.indexing import with_row_index
from tidewater.operators import timebuckets as tb
from tidewater.session import scratch_path
from tidewater.sinks.tables import hourly_files, newest_per_key


def skewed(spark, n=30000):
    # key 0 holds a third of the rows; the rest spread over 1000 keys
    return spark.range(0, n, 1, 6).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("k"),
        (F.col("id") * 7 % 86400).alias("sec"))


def test_row_index_splits_a_hot_group(spark):
    df = skewed(spark)
    out = with_row_index(df.withColumn("t", F.spark_partition_id()), "ix", ["id"], ["k"])
    hot = out.where("k = 0")
    assert sorted(r["ix"] for r in hot.select("ix").collect()) == list(range(10000))
    # the range sort the index relies on spreads the hot key over several tasks
    spread = df.repartitionByRange(8, "k", "id").withColumn("p", F.spark_partition_id())
    assert spread.where("k = 0").select("p").distinct().count() >= 2
    ref = df.withColumn("ix", F.row_number().over(Window.partitionBy("k").orderBy("id")) - 1)
    assert out.drop("t").exceptAll(ref).count() == 0


def test_duplicate_report_under_a_hot_key(spark):
    df = skewed(spark)
    got = duplicate_rows(df, ["k"], "exclude_first", order_by="id")
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("id"))).where("rn > 1").drop("rn")
    assert got.count() == ref.count() and got.exceptAll(ref).count() == 0


def test_newest_per_key_of_a_hot_key(spark):
    df = skewed(spark).withColumnRenamed("id", "v")
    newest = newest_per_key(df, None, ["k"], ["v"])
    assert "partial_max_by" in newest._jdf.queryExecution().executedPlan().toString()
    got = {r["k"]: r["v"] for r in newest.collect()}
    want = {r["k"]: r["m"] for r in df.groupBy("k").agg(F.max("v").alias("m")).collect()}
    assert got == want


def test_a_hot_hour_is_written_by_several_tasks(spark):
    rows = spark.range(20000).select(F.timestamp_seconds(F.lit(3600 * 500) + F.col("id") % 3600).cast("timestamp_ntz").alias("ts"))
    path = scratch_path(spark, "hot-hour")
    hourly_files(rows, path, "ts", fmt="parquet")
    back = spark.read.parquet(path)
    assert back.count() == 20000 and back.select("hour").distinct().count() == 1
    assert back.select(F.input_file_name()).distinct().count() > 2


def test_bursts_spread_a_hot_key_over_buckets(spark):
    df = skewed(spark).select("k", F.timestamp_seconds(F.col("sec")).cast("timestamp_ntz").alias("ts"))
    b = tb.bursts(df, "k", "ts", "15 minutes", 3, sort=False)
    hot = b.where("k = 0")
    assert hot.count() == 96 and hot.agg(F.sum("events")).first()[0] == 10000
