"""Topic sinks: rows to keyed topic records, written to the broker or as files in the topic schema.

With bootstrap servers the records go to ``format("kafka")`` (at-least-once, per the connector; the
broker assigns offsets). A topic with a ``path`` is a folder of Parquet files in the topic record
schema: batches append to it, streams use Spark's file sink, which is exactly-once per checkpoint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.sources.topics import TOPIC_COLUMNS, TopicSpec


def hashed_uuid(*cols: str | Column) -> Column:
    """A UUID-shaped key derived from the row (deterministic, so replays agree)."""
    h = F.sha2(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"),
                                                    F.lit("\u0000")) for c in cols]), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


# JSON timestamp formats with microsecond precision (the default keeps milliseconds).
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def json_value(df: DataFrame, columns: list[str] | None = None, keep_nulls: bool = False) -> Column:
    """The row (or ``columns``) as JSON text, timestamps to the microsecond."""
    cols = columns or df.columns
    opts = dict(JSON_OPTIONS, **({"ignoreNullFields": "false"} if keep_nulls else {}))
    return F.to_json(F.struct(*[F.col(c) for c in cols]), opts)


def to_topic(df: DataFrame, topic: str, value: Column, key: Column | None = None, partitions: int = 3,
             timestamp: Column | None = None, partition: Column | None = None, offset: Column | None = None,
             headers: Column | None = None) -> DataFrame:
    """Rows to topic records: key, value (binary), partition (default pmod(xxhash64(key), partitions)).

    Offsets belong to the broker: they are null unless the rows themselves carry them (``offset``).
    """
    key = key if key is not None else F.expr("uuid()")
    headers = headers if headers is not None else F.lit(None).cast("array<struct<key:string,value:binary>>")
    # The key is materialized once, so a random key and its partition agree.
    keyed = df.select("*", key.cast("string").alias("_topic_key"))
    part = partition if partition is not None else F.pmod(F.xxhash64("_topic_key"), F.lit(partitions))
    return keyed.select(
        F.col("_topic_key").cast("binary").alias("key"), value.cast("binary").alias("value"), F.lit(topic).alias("topic"),
        part.cast("int").alias("partition"), (offset if offset is not None else F.lit(None)).cast("bigint").alias("offset"),
        (timestamp if timestamp is not None else F.current_timestamp()).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"), headers.alias("headers")).select(*TOPIC_COLUMNS)


def _kafka(writer, spec: TopicSpec):
    return writer.format("kafka").option("kafka.bootstrap.servers", spec.bootstrap_servers).option("topic", spec.name)


def write_topic(records: DataFrame, spec: TopicSpec) -> None:
    """Append records to the topic."""
    if spec.path is None:
        _kafka(records.select("key", "value", "headers").write, spec).save()
    else:
        records.write.mode("append").parquet(spec.path)
