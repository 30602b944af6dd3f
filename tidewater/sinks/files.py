"""File outputs: one CSV folder (and DDL text) per relationalized object."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewater import fs
from tidewater.operators.relational import ddl_for


def write_tables(tables: dict[str, DataFrame], base: str, fmt: str = "csv", ddl_schema: str | None = "public",
                 mode: str = "errorifexists") -> dict[str, str]:
    """Write each table to ``base/<name>`` (CSV with header by default) and its
    CREATE TABLE text, which replaces an older one, to ``base/DDL_<name>.sql``. Returns name -> path."""
    out = {}
    for name, df in tables.items():
        path = f"{base.rstrip('/')}/{name}"
        w = df.write.mode(mode).format(fmt)
        if fmt == "csv":
            w = w.option("header", True)
        w.save(path)
        if ddl_schema is not None:
            fs.write_text(df.sparkSession, f"{base.rstrip('/')}/DDL_{name}.sql",
                          ddl_for(df, name, ddl_schema))
        out[name] = path
    return out
