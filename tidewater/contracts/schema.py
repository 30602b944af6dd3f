"""Versioned column contracts: declaration, JSON/YAML round trip, dtype mapping."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidewater import fs
from tidewater.contracts.checks import Check, checks_from_serial, checks_to_serial

SCHEMA_VERSION = "0.18.0"

# Contract dtype names and the Spark type each one means.
# "object" accepts any type.
DTYPES: dict[str, T.DataType | None] = {
    "int64": T.LongType(), "int32": T.IntegerType(), "int16": T.ShortType(), "int8": T.ByteType(),
    "int": T.LongType(), "float64": T.DoubleType(), "float": T.DoubleType(), "float32": T.FloatType(),
    "str": T.StringType(), "string": T.StringType(), "bool": T.BooleanType(), "boolean": T.BooleanType(),
    "datetime64[ns]": T.TimestampNTZType(), "datetime64": T.TimestampNTZType(), "timestamp": T.TimestampType(),
    "date": T.DateType(), "object": None,
}

_PY_TYPES = {int: "int64", float: "float64", str: "str", bool: "bool"}


def spark_type(dtype) -> T.DataType | None:
    """Contract dtype (name, Python type or Spark type) to a Spark type; None = any."""
    if dtype is None:
        return None
    if isinstance(dtype, T.DataType):
        return dtype
    if isinstance(dtype, type) and dtype in _PY_TYPES:
        dtype = _PY_TYPES[dtype]
    if dtype in DTYPES:
        return DTYPES[dtype]
    return T._parse_datatype_string(str(dtype))


def dtype_name(dtype) -> str | None:
    if dtype is None or isinstance(dtype, str):
        return dtype
    if isinstance(dtype, type) and dtype in _PY_TYPES:
        return _PY_TYPES[dtype]
    return dtype.simpleString()


def dtype_matches(expected: T.DataType | None, actual: T.DataType) -> bool:
    if expected is None:
        return True
    if isinstance(expected, (T.TimestampNTZType, T.TimestampType)):
        return isinstance(actual, (T.TimestampNTZType, T.TimestampType))
    return expected == actual


def _set(**values) -> dict:
    """The values that say something: options at their default aren't written."""
    return {k: v for k, v in values.items() if v is not None}


def _read_text(path: str) -> str:
    """Through the session's file systems, so that a shared path works from any driver; plain without a session."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        with open(path, encoding="utf-8") as fh:
            return fh.read()
    return fs.read_text(spark, path)


def _write_text(path: str, text: str) -> None:
    spark = SparkSession.getActiveSession()
    if spark is None:
        with open(path, "w", encoding="utf-8") as fh:
            fh.write(text)
    else:
        fs.write_text(spark, path, text)


@dataclass(frozen=True)
class ColumnSpec:
    dtype: Any = None
    checks: tuple[Check, ...] = ()
    nullable: bool = False
    unique: bool = False
    coerce: bool = False
    required: bool = True
    regex: bool = False
    title: str | None = None
    description: str | None = None
    default: Any = None
    metadata: dict | None = None

    @property
    def spark_type(self) -> T.DataType | None:
        return spark_type(self.dtype)

    def to_serial(self) -> dict:
        return {"title": self.title, "description": self.description, "dtype": dtype_name(self.dtype),
                "nullable": self.nullable, "checks": checks_to_serial(list(self.checks)),
                "unique": self.unique, "coerce": self.coerce, "required": self.required,
                "regex": self.regex, **_set(default=self.default, metadata=self.metadata)}

    @staticmethod
    def from_serial(d: dict) -> ColumnSpec:
        return ColumnSpec(dtype=d.get("dtype"), checks=tuple(checks_from_serial(d.get("checks"))),
                          nullable=bool(d.get("nullable", False)), unique=bool(d.get("unique", False)),
                          coerce=bool(d.get("coerce", False)), required=bool(d.get("required", True)),
                          regex=bool(d.get("regex", False)), title=d.get("title"),
                          description=d.get("description"), default=d.get("default"),
                          metadata=d.get("metadata"))


def Column(dtype=None, checks=None, **kw) -> ColumnSpec:  # noqa: N802 - mirrors the declaration style
    if isinstance(checks, Check):
        checks = [checks]
    return ColumnSpec(dtype=dtype, checks=tuple(checks or ()), **kw)


@dataclass(frozen=True)
class IndexSpec:
    """Index checks. Spark has no row index: they apply to a named row-number column."""

    dtype: Any = "int64"
    checks: tuple[Check, ...] = ()
    nullable: bool = False
    unique: bool = False
    coerce: bool = False
    name: str | None = None
    title: str | None = None
    description: str | None = None

    def to_serial(self) -> dict:
        return {"title": self.title, "description": self.description, "dtype": dtype_name(self.dtype),
                "nullable": self.nullable, "checks": checks_to_serial(list(self.checks)),
                "name": self.name, "unique": self.unique, "coerce": self.coerce}

    @staticmethod
    def from_serial(d: dict) -> IndexSpec:
        return IndexSpec(dtype=d.get("dtype"), checks=tuple(checks_from_serial(d.get("checks"))),
                         nullable=bool(d.get("nullable", False)), unique=bool(d.get("unique", False)),
                         coerce=bool(d.get("coerce", False)), name=d.get("name"), title=d.get("title"),
                         description=d.get("description"))


@dataclass(frozen=True)
class Contract:
    """A dataframe contract. Immutable: ``add_columns`` and friends return new contracts."""

    columns: dict[str, ColumnSpec] = field(default_factory=dict)
    checks: tuple[Check, ...] = ()
    index: tuple[IndexSpec, ...] = ()
    dtype: Any = None
    coerce: bool = False
    strict: bool | str = False
    name: str | None = None
    ordered: bool = False
    unique: tuple[str, ...] | None = None
    report_duplicates: str = "all"
    unique_column_names: bool = False
    add_missing_columns: bool = False
    title: str | None = None
    description: str | None = None
    metadata: dict | None = None
    drop_invalid_rows: bool = False

    def __post_init__(self):
        if self.report_duplicates not in ("all", "exclude_first", "exclude_last"):
            raise ValueError("report_duplicates must be all, exclude_first or exclude_last")
        if isinstance(self.unique, str):
            object.__setattr__(self, "unique", (self.unique,))

    # --- validation ------------------------------------------------------
    def validate(self, df, mode: str = "raise", **kw):
        """``contract.validate(df)``; see ``tidewater.contracts.validate``."""
        from tidewater.contracts.validate import validate
        return validate(self, df, mode, **kw)

    def __call__(self, df, **kw):
        """``contract(df)``: validate in the default (raise) mode."""
        return self.validate(df, **kw)

    def report(self, df, **kw):
        return self.validate(df, "report", **kw)

    # --- evolution -------------------------------------------------------
    def add_columns(self, extra: dict[str, ColumnSpec]) -> Contract:
        return replace(self, columns={**self.columns, **extra})

    def remove_columns(self, names: list[str]) -> Contract:
        return replace(self, columns={k: v for k, v in self.columns.items() if k not in set(names)})

    def update_column(self, name: str, **changes) -> Contract:
        return replace(self, columns={**self.columns, name: replace(self.columns[name], **changes)})

    def with_options(self, **changes) -> Contract:
        return replace(self, **changes)

    # --- serialization ---------------------------------------------------
    def to_dict(self) -> dict:
        return {
            "schema_type": "dataframe", "version": SCHEMA_VERSION,
            "columns": {k: v.to_serial() for k, v in self.columns.items()},
            "checks": checks_to_serial(list(self.checks)),
            "index": [i.to_serial() for i in self.index] or None,
            "dtype": dtype_name(self.dtype), "coerce": self.coerce, "strict": self.strict,
            "name": self.name, "ordered": self.ordered,
            "unique": list(self.unique) if self.unique else None,
            "report_duplicates": self.report_duplicates,
            "unique_column_names": self.unique_column_names,
            "add_missing_columns": self.add_missing_columns,
            "title": self.title, "description": self.description,
            **_set(metadata=self.metadata, drop_invalid_rows=self.drop_invalid_rows or None),
        }

    @staticmethod
    def from_dict(d: dict) -> Contract:
        if d.get("schema_type", "dataframe") != "dataframe":
            raise ValueError("only dataframe contracts are supported")
        return Contract(
            columns={k: ColumnSpec.from_serial(v or {}) for k, v in (d.get("columns") or {}).items()},
            checks=tuple(checks_from_serial(d.get("checks"))),
            index=tuple(IndexSpec.from_serial(i) for i in (d.get("index") or [])),
            dtype=d.get("dtype"), coerce=bool(d.get("coerce", False)), strict=d.get("strict", False),
            name=d.get("name"), ordered=bool(d.get("ordered", False)),
            unique=tuple(d["unique"]) if d.get("unique") else None,
            report_duplicates=d.get("report_duplicates") or "all",
            unique_column_names=bool(d.get("unique_column_names", False)),
            add_missing_columns=bool(d.get("add_missing_columns", False)),
            title=d.get("title"), description=d.get("description"), metadata=d.get("metadata"),
            drop_invalid_rows=bool(d.get("drop_invalid_rows", False)))

    def to_json(self, path: str | None = None, indent: int | None = 4) -> str:
        text = json.dumps(self.to_dict(), indent=indent)
        if path:
            _write_text(path, text)
        return text

    @staticmethod
    def from_json(source: str) -> Contract:
        text = source if source.lstrip().startswith("{") else _read_text(source)
        return Contract.from_dict(json.loads(text))

    def to_yaml(self, path: str | None = None) -> str:
        import yaml
        text = yaml.safe_dump(self.to_dict(), sort_keys=False)
        if path:
            _write_text(path, text)
        return text

    @staticmethod
    def from_yaml(source: str) -> Contract:
        import yaml
        text = source if "\n" in source else _read_text(source)
        return Contract.from_dict(yaml.safe_load(text))

    def struct_type(self) -> T.StructType:
        """The Spark schema the contract describes (``object`` columns as string)."""
        fields = []
        for name, spec in self.columns.items():
            if spec.regex:
                continue
            dt = spark_type(self.dtype) if self.dtype is not None else spec.spark_type
            fields.append(T.StructField(name, dt or T.StringType(), spec.nullable,
                                        {"title": spec.title, "description": spec.description}
                                        if (spec.title or spec.description) else {}))
        return T.StructType(fields)
