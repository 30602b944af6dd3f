"""Deterministic synthetic rows from an Avro schema or a contract.

Every value is a Column expression of ``xxhash64(seed, field path, row id,
element index ...)``: generation runs entirely in the JVM, and a row's values
depend only on its id — identical at 1 or 1000 partitions and on recompute
after a lost executor (``rand``/``uuid`` would not be).
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import string
from collections.abc import Callable
from functools import lru_cache, reduce
from itertools import product
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.contracts.checks import ALIASES, Check
from tidewater.contracts.schema import Contract, spark_type
from tidewater.functions.avro_types import (collapsed_union_type, named_types, non_null_branches,
                                            parse_avro, resolve)
from tidewater.operators.patterns import Language, language, string_arrays, string_column

# Generator ranges and sizes.
INT_RANGE = (0, 2**31 - 1)
LONG_RANGE = (0, 2**63 - 1)
FLOAT_RANGE = (0.0, 3.4e38)
DOUBLE_RANGE = (0.0, 1.797e308)   # 1.8e308 would be infinity
ARRAY_LENGTH = (1, 2)
MAP_SIZE = 3
STRING_LETTERS = "abcdef"
STRING_LENGTH = 10
ALPHANUMERIC = string.ascii_letters + string.digits

_POS = (1 << 63) - 1
_FRAC = 1 << 53
_MOST_DIGITS = 36
_PER_HASH = 10   # 36**10 < 2**53: ten digits per hash
_TABLE_TEXTS = 1 << 13  # at most, of a table of texts


@lru_cache(None)
def _texts_of(alphabet: str) -> tuple[int, bytes]:
    """(k, all texts of k letters, in the order of the numbers they stand for, one after the other)"""
    k = 1
    while len(alphabet) > 1 and len(alphabet) ** (k + 1) <= _TABLE_TEXTS and k < _PER_HASH:
        k += 1
    return k, "".join(map("".join, product(alphabet, repeat=k))).encode()


class _Gen:
    def __init__(self, seed: int, rid: Column, base_ms: int, null_fraction: float, qualify_names: bool,
                 named: dict, attempt: Column | None = None):
        self.seed, self.rid, self.base_ms, self.attempt = seed, rid, base_ms, [] if attempt is None else [attempt]
        self.null_fraction, self.qualify, self.named = null_fraction, qualify_names, named

    def h(self, path: str, extra: list) -> Column:
        # The (seed, path) pair is folded into one stable 64-bit literal on the driver,
        # so each leaf hashes only longs.
        digest = hashlib.blake2b(f"{self.seed}|{path}".encode(), digest_size=8).digest()
        salt = int.from_bytes(digest, "big", signed=True)
        return F.xxhash64(F.lit(salt), self.rid, *extra, *self.attempt).bitwiseAND(F.lit(_POS))

    def unit(self, path: str, extra: list) -> Column:
        return self.h(path, extra).bitwiseAND(F.lit(_FRAC - 1)).cast("double") / F.lit(float(_FRAC))

    def int_in(self, lo: int, hi: int, path: str, extra: list) -> Column:
        span = hi - lo + 1
        if span > _POS:
            return self.h(path, extra) + F.lit(lo)
        return F.lit(lo) + F.pmod(self.h(path, extra), F.lit(span))

    def chars(self, alphabet: str, n: int | Column, path: str, extra: list, max_len: int | None = None) -> Column:
        """``n`` characters of an ASCII ``alphabet``: each hash gives ten places of numbers below len(alphabet).

        Up to 36 symbols these are digits of one number, the first one leading, and some digits together are a place in a
        table of all their texts; a larger alphabet is indexed by each number, the last one leading.  Tables are binary, whose
        parts are found without counting characters.
        """
        base = len(alphabet)
        total = n if isinstance(n, int) else int(max_len)
        pieces = []
        for j in range((total + _PER_HASH - 1) // _PER_HASH):
            h = self.h(path, extra + [F.lit(j)])
            if base <= _MOST_DIGITS:
                each, table = _texts_of(alphabet)
                left = _PER_HASH
                while left:
                    left -= (k := left % each or each)
                    number = F.pmod(F.call_function("div", h, F.lit(base ** left)) if left else h, F.lit(base ** k))
                    pieces.append(F.substring(F.lit(table), (number * each + (each - k + 1)).cast("int"), F.lit(k)))
            else:
                r = F.pmod(h, F.lit(base ** _PER_HASH))
                wanted = min(_PER_HASH, total - j * _PER_HASH)
                places = [F.pmod(F.floor(r / F.lit(base ** i)) if i else r, F.lit(base)) for i in range(wanted)]
                pieces += [F.substring(F.lit(alphabet.encode()), (p + 1).cast("int"), F.lit(1)) for p in places]
        if not pieces:
            return F.lit("")
        text = F.concat(*pieces).cast("string")
        if isinstance(n, int):
            return text if total % _PER_HASH == 0 or base > _MOST_DIGITS else F.substring(text, 1, total)
        return F.substring(text, 1, n.cast("int"))

    def uuid(self, path: str, extra: list) -> Column:
        hx = F.sha2(F.concat_ws("|", F.lit(str(self.seed)), F.lit(path), self.rid.cast("string"),
                                *[e.cast("string") for e in extra]), 256)
        return F.concat_ws("-", *[F.substring(hx, a, b) for a, b in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])

    def primitive(self, s, path: str, extra: list) -> Column:
        t = s if isinstance(s, str) else s["type"]
        props = {} if isinstance(s, str) else s
        logical = props.get("logicalType")
        if t == "string" and logical == "uuid":
            return self.uuid(path, extra)
        if t == "long" and logical == "timestamp-millis":
            return F.timestamp_millis(F.lit(self.base_ms))
        if t == "int":
            return self.int_in(props.get("min_value", INT_RANGE[0]), props.get("max_value", INT_RANGE[1]),
                               path, extra).cast("int")
        if t == "long":
            return self.int_in(props.get("min_value", LONG_RANGE[0]), props.get("max_value", LONG_RANGE[1]),
                               path, extra).cast("bigint")
        if t in ("float", "double"):
            lo_d, hi_d = FLOAT_RANGE if t == "float" else DOUBLE_RANGE
            lo, hi = float(props.get("min_value", lo_d)), float(props.get("max_value", hi_d))
            v = F.lit(lo) + self.unit(path, extra) * F.lit(hi - lo)
            return v.cast("float" if t == "float" else "double")
        if t == "string":
            return self.chars(STRING_LETTERS, STRING_LENGTH, path, extra)
        if t == "boolean":
            return self.h(path, extra).bitwiseAND(F.lit(1)) == 1
        raise ValueError(f"unsupported Avro type {t!r}")

    def gen(self, s, path: str, extra: list, namespace: str | None = None) -> Column:
        """A value of the schema.

        An element of an array or map is written once, as a function of its place: written out place by place, nested ones grow
        to methods that the JIT refuses, which then run as bytecode.
        """
        s = resolve(parse_avro(s), self.named)
        if isinstance(s, list):
            branches = non_null_branches(s)
            if len(branches) == 1:
                out = self.gen(branches[0], path, extra, namespace)
            else:
                pick = F.pmod(self.h(path + "#branch", extra), F.lit(len(branches)))
                collapsed = collapsed_union_type(branches, self.named)
                if collapsed is not None:
                    out = None
                    for i, b in enumerate(branches):
                        val = self.gen(b, f"{path}#{i}", extra, namespace).cast(collapsed)
                        out = F.when(pick == i, val) if out is None else out.when(pick == i, val)
                else:
                    out = F.struct(*[F.when(pick == i, self.gen(b, f"{path}#{i}", extra, namespace)).alias(f"member{i}")
                                     for i, b in enumerate(branches)])
            if "null" in s and self.null_fraction > 0:
                out = F.when(self.unit(path + "#null", extra) >= F.lit(self.null_fraction), out)
            return out
        if isinstance(s, str):
            return self.primitive(s, path, extra)
        t = s["type"]
        if t == "record":
            ns = s.get("namespace", namespace)
            fields = []
            for f in s["fields"]:
                name = f["name"]
                ftype = resolve(parse_avro(f["type"]), self.named)
                if self.qualify and ns and isinstance(ftype, dict) and ftype.get("type") == "record":
                    name = f"{ns}.{name}"
                ftype_in = f["type"]
                bounds = {k: f[k] for k in ("min_value", "max_value") if k in f}
                if bounds and isinstance(ftype, str):
                    ftype_in = {"type": ftype, **bounds}  # range given on the field instead of the type
                fields.append(self.gen(ftype_in, f"{path}.{f['name']}", extra, ns).alias(name))
            return F.struct(*fields)
        if t == "array":
            lo, hi = ARRAY_LENGTH
            n = self.int_in(lo, hi, path + "#len", extra)
            places = F.slice(F.array(*[F.lit(i) for i in range(hi)]), 1, n.cast("int"))
            return F.transform(places, lambda i: self.gen(s["items"], path + "[]", extra + [i], namespace))
        if t == "map":
            keys, places = ([F.lit(x) for x in xs] for xs in ([f"key{i}" for i in range(MAP_SIZE)], range(MAP_SIZE)))
            values = F.transform(F.array(*places), lambda i: self.gen(s["values"], path + "{}", extra + [i], namespace))
            return F.map_from_arrays(F.array(*keys), values)
        if t == "enum":
            syms = s["symbols"]
            return F.element_at(F.array(*[F.lit(x) for x in syms]),
                                (F.pmod(self.h(path, extra), F.lit(len(syms))) + 1).cast("int"))
        if t == "fixed":
            return self.chars(ALPHANUMERIC, int(s["size"]), path, extra).cast("binary")
        return self.primitive(s, path, extra)


def conforms(value: Column, schema, named: dict | None = None) -> Column:
    """True where a value is one that the Avro schema describes, within the default or declared ranges."""
    s = parse_avro(schema)
    named = named_types(s) if named is None else named
    s = resolve(s, named)
    if isinstance(s, list):
        branches = non_null_branches(s)
        if len(branches) == 1:
            return conforms(value, branches[0], named)
        if collapsed_union_type(branches, named) is not None:
            fits = [conforms(value, b, named) for b in branches]
        else:
            members = [value.getField(f"member{i}") for i in range(len(branches))]
            given = sum(m.isNotNull().cast("int") for m in members)
            fits = [(given == 1) & m.isNotNull() & conforms(m, b, named) for m, b in zip(members, branches)]
        ok = fits[0]
        for f in fits[1:]:
            ok = F.coalesce(ok, F.lit(False)) | F.coalesce(f, F.lit(False))
        return ok
    t = s if isinstance(s, str) else s["type"]
    props = {} if isinstance(s, str) else s
    if t == "record":
        ok = value.isNotNull()
        for f in s["fields"]:
            bounds = {k: f[k] for k in ("min_value", "max_value") if k in f}
            kind = resolve(parse_avro(f["type"]), named)
            kind = {"type": kind, **bounds} if bounds and isinstance(kind, str) else f["type"]
            ok = ok & conforms(value.getField(f["name"]), kind, named)
        return F.coalesce(ok, F.lit(False))
    if t == "array":
        return F.size(value).between(*ARRAY_LENGTH) & F.forall(value, lambda x: conforms(x, s["items"], named))
    if t == "map":
        return (F.size(value) == MAP_SIZE) & F.forall(F.map_values(value), lambda x: conforms(x, s["values"], named))
    if t == "enum":
        return value.isin(*s["symbols"])
    if t == "fixed":
        return value.cast("string").rlike(f"^[A-Za-z0-9]{{{int(s['size'])}}}$")
    if t == "boolean":
        return value.isNotNull()
    if t == "string":
        pattern = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$" if props.get("logicalType") == "uuid" \
            else f"^[{STRING_LETTERS}]{{{STRING_LENGTH}}}$"
        return value.rlike(pattern)
    if props.get("logicalType"):
        return value.isNotNull()
    lo, hi = {"int": INT_RANGE, "long": LONG_RANGE, "float": FLOAT_RANGE, "double": DOUBLE_RANGE}[t]
    return value.cast("double").between(float(props.get("min_value", lo)), float(props.get("max_value", hi)))


def _ids(spark: SparkSession, n: int | None, ids: DataFrame | None, id_col: str) -> DataFrame:
    if ids is not None:
        return ids.select(F.col(id_col).cast("bigint").alias("_id"))
    return spark.range(int(n)).select(F.col("id").alias("_id"))


def _base_ms(base_ts: dt.datetime | None) -> int:
    base = base_ts or dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    if base.tzinfo is None:
        base = base.replace(tzinfo=dt.timezone.utc)
    return int(base.timestamp() * 1000)


def synthesize(spark: SparkSession, schema, n: int | None = None, seed: int = 0, ids: DataFrame | None = None,
               id_col: str = "id", keep_id: bool = False, base_ts: dt.datetime | None = None,
               null_fraction: float = 0.0, qualify_names: bool = False) -> DataFrame:
    """Rows for an Avro record schema: one per id in ``ids[id_col]`` or per 0..n-1.

    ``null_fraction`` makes nullable unions null that often (default never);
    ``qualify_names`` prefixes nested-record field names with the enclosing
    namespace (off by default: it breaks conformance with the schema).
    """
    s = parse_avro(schema)
    named = named_types(s)
    base = _ids(spark, n, ids, id_col)
    g = _Gen(seed, F.col("_id"), _base_ms(base_ts), null_fraction, qualify_names, named)
    rec = g.gen(s, s.get("name", "root"), [], s.get("namespace"))
    out = base.select(*(["_id"] if keep_id else []), rec.alias("_rec")).select(
        *([F.col("_id").alias(id_col)] if keep_id else []), "_rec.*")
    return out


# ---------------------------------------------------------------- from a contract

def _bounds(checks) -> tuple[Any, Any, bool, bool]:
    lo = hi = None
    lo_open = hi_open = False
    for c in checks:
        name, a = ALIASES.get(c.name, c.name), c.args
        if name == "greater_than_or_equal_to":
            lo = a
        elif name == "greater_than":
            lo, lo_open = a, True
        elif name == "less_than_or_equal_to":
            hi = a
        elif name == "less_than":
            hi, hi_open = a, True
        elif name == "in_range":
            lo, hi = a["min_value"], a["max_value"]
            lo_open, hi_open = not a.get("include_min", True), not a.get("include_max", True)
    return lo, hi, lo_open, hi_open


def _within(rid: Column, last: int, name: str) -> Column:
    """The row id as a distinct choice 0..last; more rows than choices can't be unique and fail the query."""
    stop = F.raise_error(F.lit(f"column {name!r} is unique and has only {last + 1} possible values; more ids were given"))
    return F.when((rid >= 0) & (rid <= last), rid).otherwise(stop.cast("bigint"))


PATTERNS = ("str_matches", "str_contains")
MORE_ATTEMPTS = (50, 500)  # draws for the rows that are rejected again and again, then for those rejected in all of these, too


def _excluded(spec) -> list:
    out = []
    for c in spec.checks:
        name = ALIASES.get(c.name, c.name)
        out += list(c.args) if name == "notin" else [c.args] if name == "not_equal_to" else []
    return out


def _text_language(spec) -> Language:
    """The strings that a text column's checks allow."""
    args: dict[str, list] = {}
    for c in spec.checks:
        args.setdefault(ALIASES.get(c.name, c.name), []).append(c.args)
    if any(len(args.get(k, [])) > 1 for k in ("str_startswith", "str_endswith")):
        raise NotImplementedError("two prefixes or suffixes")
    low = [a["min_value"] for a in args.get("str_length", []) if a.get("min_value") is not None]
    high = [a["max_value"] for a in args.get("str_length", []) if a.get("max_value") is not None]
    return language(args.get("str_matches", []), args.get("str_contains", []), (args.get("str_startswith") or [""])[0], (args.get("str_endswith") or [""])[0],
                    [str(v) for v in _excluded(spec)], max(low, default=1), min(high, default=None))


def _passes(spec, v) -> bool:
    """Whether a listed value passes the column's other checks."""
    lo, hi, lo_open, hi_open = _bounds(spec.checks)
    if not isinstance(v, str):
        return (lo is None or (v > lo if lo_open else v >= lo)) and (hi is None or (v < hi if hi_open else v <= hi))
    tests = {"str_startswith": v.startswith, "str_endswith": v.endswith, "str_matches": lambda p: re.match(p, v, re.A), "str_contains": lambda p: re.search(p, v, re.A),
             "str_length": lambda a: (a.get("min_value") or 0) <= len(v) and (a.get("max_value") is None or len(v) <= a["max_value"])}
    return all(tests[c.name](c.args) for c in spec.checks if c.name in tests)


def _around(g: _Gen, lo: int, hi: int, out: list[int], name: str, unique: bool) -> Column:
    """An integer of lo..hi that isn't in out: the j-th of those left, by stepping over each one left out."""
    gone = sorted({v for v in out if lo <= v <= hi})
    last = hi - lo - len(gone)
    if last < 0:
        raise ValueError(f"column {name!r}: no value satisfies the checks")
    v = F.lit(lo) + (_within(g.rid, last, name) if unique else g.int_in(0, last, name, []))
    for x in gone:
        v = v + F.when(v >= x, 1).otherwise(0)
    return v


def _drawn_by_automaton(spec, dtype: T.DataType) -> bool:
    """Whether a column's texts come out of ``operators.patterns``."""
    names = {ALIASES.get(c.name, c.name) for c in spec.checks}
    if isinstance(dtype, (T.IntegralType, T.DoubleType, T.FloatType, T.TimestampType, T.TimestampNTZType, T.DateType, T.BooleanType)):
        return False
    return not names & {"isin", "equal_to", "unique_values_eq"} and bool(_excluded(spec) or names & set(PATTERNS))


def _text_key(g: _Gen, name: str, spec, words: Language) -> Column:
    return _within(g.rid, min(words.total, 1 << 62) - 1, name) if spec.unique else g.h(name, [])


def _contract_column(g: _Gen, name: str, spec, dtype: T.DataType) -> Column:
    checks = {ALIASES.get(c.name, c.name): c for c in spec.checks}
    out = _excluded(spec)
    for one in ("equal_to", "unique_values_eq"):
        if one in checks and "isin" not in checks:
            args = checks[one].args
            checks["isin"] = Check.isin([args] if one == "equal_to" else args)
    if "isin" in checks:
        vals = [v for v in checks["isin"].args if v not in out and _passes(spec, v)]
        if not vals:
            raise ValueError(f"column {name!r}: no value satisfies the checks")
        if "unique_values_eq" in checks and not spec.unique:
            pick = F.pmod(g.rid, F.lit(len(vals)))  # every value stands in as many rows as there are values
        elif spec.unique:
            pick = _within(g.rid, len(vals) - 1, name)
        else:
            pick = F.pmod(g.h(name, []), F.lit(len(vals)))
        return F.element_at(F.array(*[F.lit(v) for v in vals]), (pick + 1).cast("int")).cast(dtype)
    lo, hi, lo_open, hi_open = _bounds(spec.checks)
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        lo_i = int(lo) + (1 if lo_open and float(lo).is_integer() else 0) if lo is not None else 0
        if lo is not None and not float(lo).is_integer():
            lo_i = int(float(lo)) + 1
        hi_i = int(hi) - (1 if hi_open and float(hi).is_integer() else 0) if hi is not None else lo_i + 999
        if out:
            top = 2**63 - 1 - lo_i if spec.unique and hi is None else hi_i
            return _around(g, lo_i, top, [int(v) for v in out], name, spec.unique).cast(dtype)
        if spec.unique:
            return (F.lit(lo_i) + (g.rid if hi is None else _within(g.rid, hi_i - lo_i, name))).cast(dtype)
        return g.int_in(lo_i, hi_i, name, []).cast(dtype)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        lo_f = float(lo) if lo is not None else 0.0
        hi_f = float(hi) if hi is not None else lo_f + 1000.0
        span = hi_f - lo_f

        def drawn(path):
            u = g.unit(path, [])
            if lo_open or hi_open:
                u = F.lit(0.001) + u * F.lit(0.998)
            return (F.lit(lo_f) + u * F.lit(span)).cast(dtype)

        value = drawn(name)
        for k in range(4 if out else 0):  # a draw that is left out is drawn again
            value = F.when(value.isin([float(v) for v in out]), drawn(f"{name}#{k}")).otherwise(value)
        return value
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        lo_t = dt.datetime.fromisoformat(str(lo)) if lo is not None else dt.datetime(2020, 1, 1)
        hi_t = dt.datetime.fromisoformat(str(hi)) if hi is not None else lo_t + dt.timedelta(days=365)
        secs = int((hi_t - lo_t).total_seconds()) - (1 if hi_open else 0)
        gone = [(dt.datetime.fromisoformat(str(v)) - lo_t).total_seconds() for v in out]
        off = _around(g, 1 if lo_open else 0, max(secs, 0), [int(x) for x in gone if x.is_integer()], name, False)
        base = F.lit(lo_t.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
        return F.timestamp_add("SECOND", off, base).cast(dtype)
    if isinstance(dtype, T.BooleanType):
        left = [v for v in (False, True) if v not in out]
        if len(left) == 1:
            return F.lit(left[0])
        return g.h(name, []).bitwiseAND(F.lit(1)) == 1
    # strings
    if _drawn_by_automaton(spec, dtype):
        words = _text_language(spec)
        return string_column(words, spec.unique)(_text_key(g, name, spec, words))
    prefix = checks["str_startswith"].args if "str_startswith" in checks else ""
    suffix = checks["str_endswith"].args if "str_endswith" in checks else ""
    length = checks.get("str_length")
    lmin = (length.args.get("min_value") or 1) if length else 8
    lmax = (length.args.get("max_value") or lmin + 8) if length else 8
    body_min = max(lmin - len(prefix) - len(suffix), 0)
    body_max = max(lmax - len(prefix) - len(suffix), body_min)
    if spec.unique:
        sid = g.rid.cast("string")
        body = F.when(F.length(sid) >= body_min, sid).otherwise(F.lpad(sid, max(body_min, 1), "0"))
    else:
        n = g.int_in(body_min, body_max, name + "#len", [])
        body = g.chars(STRING_LETTERS, n, name, [], max_len=body_max)
    return F.concat(F.lit(prefix), body, F.lit(suffix))


class _Fields:
    """Accessor handed to frame-wide checks: ``cols.x`` / ``cols["x"]`` is a field of one drawn row."""

    def __init__(self, row: Column):
        self._row = row

    def __getattr__(self, name: str) -> Column:
        return self._row.getField(name)

    __getitem__ = __getattr__


def synthesize_contract(spark: SparkSession, contract: Contract, n: int | None = None, seed: int = 0,
                        ids: DataFrame | None = None, id_col: str = "id", attempts: int = 12) -> DataFrame:
    """Rows that satisfy the contract: bounds, lists, values left out, affixes, lengths, patterns, unique columns, and
    checks that are functions of a column or of the row.

    Pattern columns are drawn from the automaton of all their rules (``operators.patterns``).  A row that a function rejects is drawn
    again, up to ``attempts`` times, each draw a hash of its id and the attempt.  Of many rows some are rejected that often by
    chance: only these are drawn ``MORE_ATTEMPTS`` times more; if none passes then, the query fails.
    Unique columns are functions of the id alone. Checks over all rows (aggregates) aren't inverted, but for
    ``unique_values_eq``, whose values take turns.
    """
    base = _ids(spark, n, ids, id_col)
    specs = {name: spec for name, spec in contract.columns.items() if not spec.regex}

    def row(attempt: int) -> Column:
        g = _Gen(seed if not attempt else seed + 1_000_003 * attempt, F.col("_id"), 0, 0.0, False, {})
        return F.struct(*[_contract_column(g, name, spec, spark_type(contract.dtype or spec.dtype) or T.StringType()).alias(name)
                          for name, spec in specs.items()])

    own = [(name, c) for name, spec in specs.items() for c in spec.checks if c.fn is not None and not c.is_aggregate]
    whole = [c for c in contract.checks if c.fn is not None and not c.is_aggregate]
    if not own and not whole:
        return base.select(row(0).alias("_row")).select("_row.*")

    def passes(r: Column) -> Column:
        tests = [F.coalesce(c.fn(r.getField(name)), F.lit(True)) for name, c in own] + [F.coalesce(c.fn(_Fields(r)), F.lit(True)) for c in whole]
        return reduce(Column.__and__, tests)

    tried = [F.get(F.filter(F.array(row(k)), passes), F.lit(0)) for k in range(attempts)]
    rows = base.select("_id", F.explode(F.array(F.coalesce(*tried))).alias("_row"))  # exploded, so that it is worked out once
    kind, done = rows.schema["_row"].dataType, 0
    for more in MORE_ATTEMPTS:
        rows, done = _drawn_more(rows, specs, contract, kind, passes, seed, done, more), done + more
    stop = F.raise_error(F.lit(f"no row passes the checks in {attempts + done} attempts")).cast(kind)
    return rows.select(F.explode(F.array(F.coalesce("_row", stop))).alias("_row")).select("_row.*")


def _drawn_more(rows: DataFrame, specs: dict, contract: Contract, kind: T.StructType, passes: Callable[[Column], Column], seed: int, done: int,
                more: int) -> DataFrame:
    """Rows (_id, _row) with the first passing one of ``more`` further draws where _row is null; the others cost nothing more."""
    tries = F.when(F.col("_row").isNull(), F.sequence(F.lit(done), F.lit(done + more - 1))).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn("_tries", tries)

    def gen(attempt: Column | None) -> _Gen:
        return _Gen(seed, F.col("_id"), 0, 0.0, False, {}, attempt)

    # texts of patterns are drawn outside the lambda: all of a row's tries in one array
    texts = {n: (s, _text_language(s)) for n, s in specs.items() if _drawn_by_automaton(s, kind[n].dataType)}
    strings = [string_arrays(words, s.unique)(F.transform("_tries", lambda a: _text_key(gen(a), n, s, words))).alias(f"_text{i}")
               for i, (n, (s, words)) in enumerate(texts.items())]
    rows = rows.select("_id", "_row", "_tries", *strings)
    place = {n: i for i, n in enumerate(texts)}

    def row(attempt: Column) -> Column:
        return F.struct(*[(F.get(F.col(f"_text{place[n]}"), attempt - done) if n in place else _contract_column(gen(attempt), n, s, kind[n].dataType)).alias(n)
                          for n, s in specs.items()])

    found = F.get(F.filter(F.transform("_tries", row), passes), F.lit(0))
    return rows.select("_id", F.explode(F.array(F.coalesce("_row", found.cast(kind)))).alias("_row"))


# ---------------------------------------------------------------- fixed generators

def pageviews(ids: DataFrame, id_col: str = "id", with_extras: bool = True) -> DataFrame:
    """Pageview rows for ids i: viewtime = int('10' + i), User_i, Page_i, Address_i
    (and the producer's extra Column_i, i)."""
    i = F.col(id_col).cast("string")
    out = ids.select(F.concat(F.lit("10"), i).cast("bigint").alias("viewtime"),
                     F.concat(F.lit("User_"), i).alias("userid"), F.concat(F.lit("Page_"), i).alias("pageid"),
                     F.concat(F.lit("Address_"), i).alias("address"),
                     *([F.concat(F.lit("Column_"), i).alias("column"), F.col(id_col).alias("column2")]
                       if with_extras else []))
    return out


# Word lists for the fake-people generator.
FIRST_NAMES = ["Ada", "Ben", "Cleo", "Dev", "Eli", "Fay", "Gus", "Hana", "Ivo", "Jun"]
CITIES = ["Austin", "Boston", "Denver", "Miami", "Orlando", "Portland", "Reno", "Salem", "Tampa", "Tucson"]
STATES = ["AZ", "CA", "CO", "FL", "MA", "NV", "OR", "TX", "UT", "WA"]

PEOPLE_SCHEMA = {
    "type": "record", "name": "person", "fields": [
        {"name": "uuid", "type": {"type": "string", "logicalType": "uuid"}},
        {"name": "first_name", "type": {"type": "enum", "name": "first", "symbols": FIRST_NAMES}},
        {"name": "city", "type": {"type": "enum", "name": "city", "symbols": CITIES}},
        {"name": "state", "type": {"type": "enum", "name": "state", "symbols": STATES}},
    ]}


def fake_people(spark: SparkSession, n: int = 10, seed: int = 0, ids: DataFrame | None = None) -> DataFrame:
    return synthesize(spark, PEOPLE_SCHEMA, n=n, seed=seed, ids=ids)
