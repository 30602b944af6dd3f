"""Column-level helpers. All are built-in Spark expressions (codegen, no Python)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def table_name_for_topic(topic: str) -> str:
    """Lake table name for a topic: dashes become underscores."""
    return topic.replace("-", "_")


def strip_suffix(col: str | Column, n: int) -> Column:
    """Drop the last ``n`` characters; shorter strings become '' and null stays null."""
    c = _c(col)
    return F.left(c, F.greatest(F.length(c) - F.lit(n), F.lit(0)))


def path_segment(col: str | Column, index: int, sep: str = "/") -> Column:
    """0-based element of ``split(col, sep)``; out of range gives null."""
    return F.get(F.split(_c(col), _regex_literal(sep)), F.lit(index))


def split_path(df: DataFrame, col: str | Column, names: dict[str, int], sep: str = "/",
               drop: str | None = None) -> DataFrame:
    """Add one column per named path segment (``{name: index}``); optionally drop a column."""
    out = df.withColumns({name: path_segment(col, idx, sep) for name, idx in names.items()})
    return out.drop(drop) if drop else out


def _regex_literal(sep: str) -> str:
    special = set(".^$*+?()[]{}|\\")
    return "".join("\\" + ch if ch in special else ch for ch in sep)


_NTZ_EPOCH = "1970-01-01 00:00:00"


def epoch_ms_to_timestamp(col: str | Column, ntz: bool = True) -> Column:
    """Epoch milliseconds to a timestamp: NTZ (UTC wall clock) by default, computed
    by NTZ arithmetic so the session time zone does not matter; else LTZ."""
    ms = _c(col).cast("bigint")
    if ntz:
        return F.timestamp_add("MILLISECOND", ms, F.lit(_NTZ_EPOCH).cast("timestamp_ntz"))
    return F.timestamp_millis(ms)


def timestamp_to_epoch_ms(col: str | Column, ntz: bool = True) -> Column:
    """Timestamp to epoch milliseconds (truncating): an NTZ value is read as a UTC
    wall clock without consulting the session zone; ``ntz=False`` for LTZ."""
    if ntz:
        return F.timestamp_diff("MILLISECOND", F.lit(_NTZ_EPOCH).cast("timestamp_ntz"), _c(col))
    return F.unix_millis(_c(col))


def render_row(*cols: str | Column, sep: str = " | ") -> Column:
    """A row rendered as ``v1 | v2 | ...`` (nulls skipped, as concat_ws does)."""
    return F.concat_ws(sep, *[_c(c).cast("string") for c in cols])


def wire_schema_id(value: str | Column) -> Column:
    """Schema id from a wire-format message: bytes 2..5, big-endian."""
    return F.conv(F.hex(F.substring(_c(value), 2, 4)), 16, 10).cast("int")


def wire_magic_ok(value: str | Column) -> Column:
    """True when the first byte is the wire-format magic byte 0."""
    return F.hex(F.substring(_c(value), 1, 1)) == F.lit("00")


def wire_body(value: str | Column) -> Column:
    """The message body after the 5-byte header (stays binary)."""
    return F.substring(_c(value), 6, 2147483647)
