"""Catalog tables that follow a record schema as it grows.

A field that a newer schema version adds becomes a column whose stored default answers for the rows written before:
old files aren't rewritten, Spark fills the column in when it reads them.  Days that are computed anew replace
exactly their own partitions.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.avro_types import field_defaults, record_schema


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _literal(value: Any, dtype: T.DataType) -> str:
    """SQL of a default: a literal cast to the column's type."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, (dict, list)):
        raise ValueError(f"a default of type {dtype.simpleString()} isn't a literal")
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    text = f"'{escaped}'"
    return text if isinstance(dtype, T.StringType) else f"CAST({text} AS {dtype.simpleString()})"


def create_table(spark: SparkSession, table: str, schema, partition_by: tuple[str, ...] = (), extra: str = "", fmt: str = "parquet",
                 location: str | None = None) -> None:
    """CREATE TABLE for an Avro record schema, defaults kept; extra: more column DDL, such as partition columns; location: an
    external folder instead of the warehouse's."""
    defaults = field_defaults(schema)
    columns = [f"{_quoted(f.name)} {f.dataType.simpleString()}" + (f" DEFAULT {_literal(defaults[f.name], f.dataType)}" if f.name in defaults else "")
               for f in record_schema(schema)] + ([extra] if extra else [])
    by = f" PARTITIONED BY ({', '.join(map(_quoted, partition_by))})" if partition_by else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {table} ({', '.join(columns)}) USING {fmt}{by}{place}")


def evolve_table(spark: SparkSession, table: str, schema) -> list[str]:
    """Add the columns that a newer Avro record schema has and the table lacks; returns their names.

    A new field needs a default (or to be nullable): rows written before answer with it.  A field whose type has changed
    is refused, as the files written before would no longer be read as the table says; fields that the schema dropped stay.
    """
    have = {f.name: f.dataType for f in spark.table(table).schema}
    defaults, new, changed = field_defaults(schema), [], []
    for f in record_schema(schema):
        if f.name in have:
            if have[f.name] != f.dataType:
                changed.append(f"{f.name}: {have[f.name].simpleString()} to {f.dataType.simpleString()}")
        elif f.name in defaults or f.nullable:
            new.append((f.name, f"{_quoted(f.name)} {f.dataType.simpleString()} DEFAULT {_literal(defaults.get(f.name), f.dataType)}"))
        else:
            changed.append(f"{f.name}: new, without a default")
    if changed:
        raise ValueError(f"{table} can't follow the schema: {'; '.join(changed)}")
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(ddl for _, ddl in new)})")
    return [name for name, _ in new]


def _by_name(df: DataFrame, table: str) -> DataFrame:
    """The table's columns in its order; those that df lacks take their stored default."""
    fields = df.sparkSession.table(table).schema.fields
    unknown = set(df.columns) - {f.name for f in fields}
    if unknown:
        raise ValueError(f"{table} has no columns {sorted(unknown)}; evolve it first")
    columns = []
    for f in fields:
        if f.name in df.columns:
            columns.append(F.col(_quoted(f.name)).cast(f.dataType).alias(f.name))
        else:
            columns.append(F.expr((f.metadata or {}).get("CURRENT_DEFAULT", "NULL")).cast(f.dataType).alias(f.name))
    return df.select(*columns)


def insert_rows(df: DataFrame, table: str) -> None:
    """INSERT by column name; an older producer's rows take the defaults of the columns they lack."""
    _by_name(df, table).write.insertInto(table)


def back_fill(df: DataFrame, table: str) -> None:
    """Replace exactly the partitions that df has rows of; a repeated run replaces them again."""
    rows, conf, name = _by_name(df, table), df.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(name, "static")
    conf.set(name, "dynamic")  # insertInto takes it from the session only
    try:
        rows.write.insertInto(table, overwrite=True)
    finally:
        conf.set(name, before)
