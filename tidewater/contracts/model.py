"""Class-style contract declaration.

    class Cities(ContractModel):
        state: str = Field(isin=["FL", "CA"])
        city: str = Field(unique=True)
        price: int = Field(in_range={"min_value": 5, "max_value": 20})

``Cities.to_contract()`` gives the Contract; ``typed(rows_or_df, Cities)`` builds
and validates in one step (validate on construction).
"""

from __future__ import annotations

import datetime as dt
import types
from typing import Any, Union, get_args, get_origin, get_type_hints

from pyspark.sql import DataFrame, SparkSession

from tidewater.contracts.checks import Check
from tidewater.contracts.schema import ColumnSpec, Contract
from tidewater.contracts.validate import spark_frame

_HINTS = {int: "int64", float: "float64", str: "str", bool: "bool", dt.datetime: "datetime64[ns]",
          dt.date: "date"}

_FIELD_CHECKS = ("ge", "gt", "le", "lt", "eq", "ne", "isin", "notin", "str_startswith",
                 "str_endswith", "str_contains", "str_matches")


class FieldInfo:
    def __init__(self, **kw: Any):
        self.kw = kw


def Field(**kw: Any) -> Any:  # noqa: N802 - declaration style
    """Column options: checks (ge, le, isin, in_range, str_length, ...) and flags
    (nullable, unique, coerce, required, title, description, default)."""
    return FieldInfo(**kw)


class ContractModel:
    """Subclass and annotate columns; options go into a nested ``Config`` class."""

    class Config:
        pass

    @classmethod
    def to_contract(cls) -> Contract:
        hints = get_type_hints(cls)
        columns: dict[str, ColumnSpec] = {}
        for name, hint in hints.items():
            if name.startswith("_"):
                continue
            info = getattr(cls, name, None)
            kw = dict(info.kw) if isinstance(info, FieldInfo) else {}
            checks = []
            for key in _FIELD_CHECKS:
                if key in kw:
                    checks.append(getattr(Check, key)(kw.pop(key)))
            if "in_range" in kw:
                checks.append(Check.in_range(**kw.pop("in_range")))
            if "str_length" in kw:
                checks.append(Check.str_length(**kw.pop("str_length")))
            args = [a for a in get_args(hint) if a is not type(None)]
            if get_origin(hint) in (Union, types.UnionType) and len(args) == 1:
                hint = args[0]                     # Optional[X]: X, nullable
                kw.setdefault("nullable", True)
            columns[name] = ColumnSpec(dtype=_HINTS.get(hint, hint), checks=tuple(checks), **kw)
        opts = {k: v for k, v in vars(cls.Config).items() if not k.startswith("_")}
        opts.setdefault("name", cls.__name__)
        return Contract(columns=columns, **opts)

    @classmethod
    def validate(cls, df: DataFrame, mode: str = "raise", **kw):
        from tidewater.contracts.validate import validate
        return validate(cls.to_contract(), df, mode, **kw)

    @classmethod
    def to_yaml(cls, path: str | None = None) -> str:
        return cls.to_contract().to_yaml(path)


def typed(data, model: type[ContractModel], spark: SparkSession | None = None) -> DataFrame:
    """Build a DataFrame (from a Spark or pandas-on-Spark frame, a dict of lists or a list of rows) and validate it."""
    data = spark_frame(data)
    if not isinstance(data, DataFrame):
        spark = spark or SparkSession.getActiveSession()
        contract = model.to_contract()
        if isinstance(data, dict):
            names = list(data)
            rows = list(zip(*[data[n] for n in names]))
        else:
            rows, names = list(data), list(contract.columns)
        schema = contract.struct_type()
        if [f.name for f in schema.fields] == names:
            data = spark.createDataFrame(rows, schema)
        else:
            data = spark.createDataFrame(rows, names)
    return model.validate(data)
