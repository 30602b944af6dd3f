"""Small file-system helpers over the Hadoop FileSystem of the session.

They work the same on local disk, HDFS and object stores, because they go
through the file system Spark itself uses for the path.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(p))


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs_and_path(spark, path)
    stream = fs.open(p)
    try:
        jvm = spark.sparkContext._jvm
        data = jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    finally:
        stream.close()
    return bytes(data).decode("utf-8")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, replacing what was there."""
    fs, p = _fs_and_path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs_and_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)
