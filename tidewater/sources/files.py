"""File sources: many-object folders, Avro container files, positional CSV."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.avro_types import legal_names, loose, parse_avro, record_schema

AVRO_FORMAT = "org.apache.spark.sql.avro.AvroFileFormat"


def read_objects(spark: SparkSession, path: str, fmt: str = "json", schema: str | None = None,
                 object_col: str = "object", object_from: str = "file", **options) -> DataFrame:
    """One read over a folder of many objects, tagged with the object name taken
    from the ``_metadata`` column (no per-file driver loop): ``object_from="file"``
    uses the file stem (one object per file); ``"dir"`` the parent folder name
    (value after ``=`` for ``key=value`` folders, so many files per object)."""
    reader = spark.read.format(fmt).option("recursiveFileLookup", True).options(**options)
    if schema:
        reader = reader.schema(schema)
    df = reader.load(path)
    if object_from == "file":
        name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[^.]*)?$", 1)
    elif object_from == "dir":
        name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/=]+)/[^/]+$", 1)
    else:
        raise ValueError("object_from must be 'file' or 'dir'")
    return df.withColumn(object_col, name)


def read_avro_files(spark: SparkSession, path: str, reader_schema=None) -> DataFrame:
    """Avro container files; a reader schema fills defaults for fields the files lack.

    Field names that Avro doesn't allow are those of ``legal_names`` in the files and the reader's own in the frame."""
    reader = spark.read.format(AVRO_FORMAT)
    if reader_schema is None:
        return reader.load(path)
    legal = legal_names(reader_schema)
    back = reader.option("avroSchema", json.dumps(legal)).load(path)
    return back if legal == parse_avro(reader_schema) else _renamed(back, record_schema(reader_schema))


def stream_avro_files(spark: SparkSession, path: str, reader_schema, **options) -> DataFrame:
    """New Avro container files of a folder as a stream, each file resolved from its writer's schema to the reader's.

    A query may go on from its checkpoint after the writer's schema has changed, and with a newer reader schema: it reads what it has
    not read yet as that schema says."""
    legal = legal_names(reader_schema)
    rows = spark.readStream.format(AVRO_FORMAT).schema(record_schema(legal)).option("avroSchema", json.dumps(legal)).options(**options).load(path)
    return rows if legal == parse_avro(reader_schema) else _renamed(rows, record_schema(reader_schema))


def write_avro_files(df: DataFrame, path: str, schema=None, mode: str = "errorifexists") -> None:
    """Avro container files; see ``read_avro_files`` for names that Avro doesn't allow."""
    if schema is not None and legal_names(schema) != parse_avro(schema):
        df, schema = _renamed(df.select(*[f"`{f.name}`" for f in record_schema(schema)]), record_schema(legal_names(schema))), legal_names(schema)
    w = df.write.format(AVRO_FORMAT).mode(mode)
    if schema is not None:
        w = w.option("avroSchema", schema if isinstance(schema, str)
                     else json.dumps(schema))
    w.save(path)


def _renamed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns, by place, under the names of a schema of the same shape."""
    return df.select(*[F.col(f"`{c}`").cast(loose(f.dataType)).alias(f.name) for c, f in zip(df.columns, schema)])


def read_positional_csv(spark: SparkSession, paths: list[str], names: list[str], ddl: str | None = None,
                        skip_header: bool = True) -> DataFrame:
    """CSV files whose header row is skipped and whose columns are named by position."""
    reader = spark.read.option("header", skip_header).option("enforceSchema", True)
    if ddl:
        return reader.schema(ddl).csv(paths)
    return reader.csv(paths).toDF(*names)
