"""Compare a plan's Spark result with its DuckDB oracle: same column names,
same row multiset (order-insensitive; floats to 10 significant digits)."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duckdb_views(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


EXACT = os.environ.get("TIDEWATER_EXACT_FLOATS") == "1"


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else (v if EXACT else float(f"{v:.10g}"))
    if isinstance(v, decimal.Decimal):
        return float(v) if EXACT else float(f"{float(v):.10g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True))
    return v


def canonical(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark_cols, spark_rows, duck_cols, duck_rows) -> str | None:
    """None when equal, else a short description of the difference."""
    if sorted(spark_cols) != sorted(duck_cols):
        return f"columns spark={sorted(spark_cols)} duck={sorted(duck_cols)}"
    a, b = canonical(spark_cols, spark_rows), canonical(duck_cols, duck_rows)
    if a == b:
        return None
    sa, sb = set(a), set(b)
    return f"spark {len(a)} rows, duck {len(b)}; only spark {list(sa - sb)[:2]}; only duck {list(sb - sa)[:2]}"
