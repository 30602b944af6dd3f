"""Checks: named, serializable predicates compiled to Spark Column expressions.

A check is element-wise (one boolean per row, nulls and NaN skipped) or an
aggregate (one boolean for the whole column, evaluated inside the same single
``agg`` job as every other check of the contract).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Short aliases accepted for the serialized check names.
ALIASES = {
    "ge": "greater_than_or_equal_to", "gt": "greater_than",
    "le": "less_than_or_equal_to", "lt": "less_than",
    "eq": "equal_to", "ne": "not_equal_to",
}


@dataclass(frozen=True)
class Check:
    """One check. ``name`` plus ``args`` is the serialized form; ``fn`` is a custom check.

    A custom ``fn`` maps the column (or, for dataframe-wide checks, the
    dataframe's columns by name) to a Column. With ``aggregate=True`` it must
    return an aggregate boolean expression, e.g.
    ``lambda c: F.max(F.size(F.split(c, "_"))) == 2``.
    """

    name: str
    args: Any = None
    fn: Callable[..., Column] | None = field(default=None, compare=False)
    aggregate: bool = False
    ignore_na: bool = True

    # Constructors mirroring the serialized names.
    @staticmethod
    def greater_than_or_equal_to(v): return Check("greater_than_or_equal_to", v)
    @staticmethod
    def greater_than(v): return Check("greater_than", v)
    @staticmethod
    def less_than_or_equal_to(v): return Check("less_than_or_equal_to", v)
    @staticmethod
    def less_than(v): return Check("less_than", v)
    @staticmethod
    def equal_to(v): return Check("equal_to", v)
    @staticmethod
    def not_equal_to(v): return Check("not_equal_to", v)
    ge, gt, le, lt, eq, ne = (greater_than_or_equal_to, greater_than, less_than_or_equal_to,
                              less_than, equal_to, not_equal_to)

    @staticmethod
    def in_range(min_value, max_value, include_min=True, include_max=True):
        return Check("in_range", {"min_value": min_value, "max_value": max_value,
                                  "include_min": include_min, "include_max": include_max})

    @staticmethod
    def isin(values): return Check("isin", list(values))
    @staticmethod
    def notin(values): return Check("notin", list(values))
    @staticmethod
    def str_startswith(s): return Check("str_startswith", s)
    @staticmethod
    def str_endswith(s): return Check("str_endswith", s)
    @staticmethod
    def str_contains(pattern): return Check("str_contains", pattern)
    @staticmethod
    def str_matches(pattern): return Check("str_matches", pattern)

    @staticmethod
    def str_length(min_value=None, max_value=None):
        return Check("str_length", {"min_value": min_value, "max_value": max_value})

    @staticmethod
    def unique_values_eq(values): return Check("unique_values_eq", list(values))

    @staticmethod
    def custom(fn: Callable[..., Column], name: str = "custom", aggregate: bool = False):
        return Check(name, None, fn=fn, aggregate=aggregate)

    @property
    def label(self) -> str:
        return self.name

    @property
    def is_aggregate(self) -> bool:
        return self.aggregate or self.name == "unique_values_eq"

    def to_serial(self):
        return self.args


def _lit_for(value, dtype: T.DataType | None) -> Column:
    lit = F.lit(value)
    if dtype is not None and isinstance(value, str) and not isinstance(dtype, T.StringType):
        return lit.cast(dtype)
    return lit


def element_predicate(check: Check, c: Column, dtype: T.DataType | None) -> Column:
    """Boolean Column that is true where the row passes (null where undecided)."""
    name, a = ALIASES.get(check.name, check.name), check.args
    if check.fn is not None:
        return check.fn(c)
    if name == "greater_than_or_equal_to":
        return c >= _lit_for(a, dtype)
    if name == "greater_than":
        return c > _lit_for(a, dtype)
    if name == "less_than_or_equal_to":
        return c <= _lit_for(a, dtype)
    if name == "less_than":
        return c < _lit_for(a, dtype)
    if name == "equal_to":
        return c == _lit_for(a, dtype)
    if name == "not_equal_to":
        return c != _lit_for(a, dtype)
    if name == "in_range":
        lo, hi = _lit_for(a["min_value"], dtype), _lit_for(a["max_value"], dtype)
        left = (c >= lo) if a.get("include_min", True) else (c > lo)
        right = (c <= hi) if a.get("include_max", True) else (c < hi)
        return left & right
    if name == "isin":
        return c.isin(list(a))
    if name == "notin":
        return ~c.isin(list(a))
    if name == "str_startswith":
        return c.startswith(a)
    if name == "str_endswith":
        return c.endswith(a)
    if name == "str_contains":
        return c.rlike(a)
    if name == "str_matches":
        return c.rlike(f"^(?:{a})")
    if name == "str_length":
        n = F.length(c)
        ok = F.lit(True)
        if a.get("min_value") is not None:
            ok = ok & (n >= a["min_value"])
        if a.get("max_value") is not None:
            ok = ok & (n <= a["max_value"])
        return ok
    raise ValueError(f"unknown check {check.name!r}")


def aggregate_predicate(check: Check, c: Column) -> Column:
    """Aggregate boolean Column, true when the whole column passes."""
    if check.fn is not None:
        return check.fn(c)
    if check.name == "unique_values_eq":
        vals = list(check.args)
        outside = F.count_if(c.isNotNull() & ~c.isin(vals))
        present = F.size(F.collect_set(F.when(c.isin(vals), c)))  # a set of len(vals) at most; streams can keep it
        return (outside == 0) & (present == len(vals))
    raise ValueError(f"{check.name!r} is not an aggregate check")


def checks_from_serial(serial) -> list[Check]:
    """Check objects, order kept, from ``{"isin": [...], "in_range": {...}}`` (or null), or from the list form
    ``[{"check": name, "args": ..., "ignore_na": false}, ...]``."""
    if not serial:
        return []
    if isinstance(serial, dict):
        return [Check(name, args) for name, args in serial.items()]
    return [Check(d["check"], d.get("args"), ignore_na=d.get("ignore_na", True)) for d in serial]


def checks_to_serial(checks: list[Check]):
    """A mapping by name where that says all; the list form for repeated names and checks that see nulls."""
    custom = [c.name for c in checks if c.fn is not None]
    if custom:
        raise ValueError(f"checks that are functions can't be saved: {custom}")
    names = [c.name for c in checks]
    if len(set(names)) == len(names) and all(c.ignore_na for c in checks):
        return {c.name: c.to_serial() for c in checks} or None
    return [{"check": c.name, "args": c.to_serial()} | ({} if c.ignore_na else {"ignore_na": False}) for c in checks]
