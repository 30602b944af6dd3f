"""Records read by the schema they were written with, as the reader's schema.

Writer and reader schema are resolved once per schema id, on the driver, into one projection of Column expressions: fields by name or
alias, defaults for what the writer lacked, numeric promotions, string and bytes, enums, and unions widened branch by branch.
A topic of many versions is then one scan whose rows take the projection of the id in their header.  The rules
are those of the Avro specification; values are in the Spark types of ``functions.avro_types``.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.avro_types import (PRIMITIVES, collapsed_union_type, loose, named_types, non_null_branches, parse_avro, record_schema,
                                            resolve, to_spark)
from tidewater.operators.decode import split_wire

# Writer type -> the reader types that it is promoted to.
PROMOTIONS = {"int": ("long", "float", "double"), "long": ("float", "double"), "float": ("double",), "string": ("bytes",), "bytes": ("string",)}
MOST_IDS = 500  # schemas of one subject that a query compiles


class ResolutionError(ValueError):
    """No value of the writer's schema can be read with the reader's."""


class _Resolver:
    def __init__(self, writer, reader):
        self.w_named, self.r_named = named_types(writer), named_types(reader)

    def type(self, r) -> T.DataType:
        return loose(to_spark(r, self.r_named))

    def default(self, r, value: Any) -> Column:
        """A declared default as a value of the reader's type."""
        r = resolve(r, self.r_named)
        dtype = self.type(r)
        if isinstance(r, list):  # a union's default is one of its first branch
            if value is None or r[0] == "null":
                return F.lit(None).cast(dtype)
            return self._branch(r, non_null_branches(r).index(r[0]), self.default(r[0], value))
        if isinstance(dtype, T.BinaryType):
            return F.unhex(F.lit(value.encode("latin-1").hex()))
        if isinstance(r, dict) and r["type"] == "record":
            given = [self.default(f["type"], value.get(f["name"], f.get("default"))).alias(f["name"]) for f in r["fields"]]
            return F.struct(*given)
        if isinstance(r, dict) and r["type"] == "array":
            return F.array(*[self.default(r["items"], x) for x in value]).cast(dtype)
        if isinstance(r, dict) and r["type"] == "map":
            pairs = [c for k, x in value.items() for c in (F.lit(k), self.default(r["values"], x))]
            return F.create_map(*pairs).cast(dtype)
        return F.lit(value).cast(dtype)

    def _branch(self, union: list, i: int, value: Column) -> Column:
        """A value of non-null branch i as the union's Spark type."""
        branches, dtype = non_null_branches(union), self.type(union)
        if len(branches) == 1 or collapsed_union_type(branches, self.r_named) is not None:
            return value.cast(dtype)
        members = [F.when(value.isNotNull(), value).cast(f.dataType) if j == i else F.lit(None).cast(f.dataType) for j, f in enumerate(dtype)]
        return F.when(value.isNotNull(), F.struct(*[m.alias(f.name) for m, f in zip(members, dtype)]))

    def read(self, w, r, v: Column, path: str) -> tuple[Column, Column | None]:
        """(reader's value of the writer's value v, whether it has one; None: it always has)."""
        w, r = resolve(w, self.w_named), resolve(r, self.r_named)
        if isinstance(w, list):
            return self._from_union(w, r, v, path)
        if w == "null":
            if r != "null" and not (isinstance(r, list) and "null" in r):
                raise ResolutionError(f"{path}: null can't be read as {_name(r)}")
            return F.lit(None).cast(self.type(r)), None
        if isinstance(r, list):
            return self._to_union(w, r, v, path)
        kind, want = _name(w), _name(r)
        if kind != want:
            if want not in PROMOTIONS.get(kind, ()) or _logical(w) or _logical(r):
                raise ResolutionError(f"{path}: {kind} can't be read as {want}")
            return v.cast(self.type(r)), None
        if kind == "record":
            return self._record(w, r, v, path)
        if kind == "array":
            return self._each(F.transform, F.forall, v, v, w["items"], r["items"], f"{path}[]")
        if kind == "map":
            return self._each(lambda c, f: F.transform_values(c, lambda _, x: f(x)), F.forall, v, F.map_values(v), w["values"], r["values"], f"{path}{{}}")
        if kind == "enum":
            known = v.isin(r["symbols"])
            if "default" in r:
                return F.when(v.isNotNull(), F.when(known, v).otherwise(F.lit(r["default"]))), None
            return F.when(known, v), (None if set(w["symbols"]) <= set(r["symbols"]) else known)
        if kind == "fixed" and w["size"] != r["size"]:
            raise ResolutionError(f"{path}: fixed({w['size']}) can't be read as fixed({r['size']})")
        if _logical(w) != _logical(r):
            raise ResolutionError(f"{path}: {_logical(w) or kind} can't be read as {_logical(r) or want}")
        return v.cast(self.type(r)), None

    def _record(self, w: dict, r: dict, v: Column, path: str) -> tuple[Column, Column | None]:
        if path and _simple(w["name"]) not in [_simple(n) for n in (r["name"], *r.get("aliases", []))]:
            raise ResolutionError(f"{path}: record {w['name']} can't be read as {r['name']}")
        written, fields, oks = {f["name"]: f for f in w["fields"]}, [], []
        for f in r["fields"]:
            at = f"{path}.{f['name']}" if path else f["name"]
            name = next((n for n in (f["name"], *f.get("aliases", [])) if n in written), None)
            if name is None:
                if "default" not in f:
                    raise ResolutionError(f"{at}: the writer lacks it and it has no default")
                fields.append(self.default(f["type"], f["default"]).alias(f["name"]))
                continue
            value, ok = self.read(written[name]["type"], f["type"], v.getField(name), at)
            fields.append(value.alias(f["name"]))
            oks.append(ok)
        return F.when(v.isNotNull(), F.struct(*fields)), _all([None if ok is None else v.isNull() | ok for ok in oks])

    def _each(self, transform, forall, v, values, w, r, path):
        oks = []

        def one(x):
            value, ok = self.read(w, r, x, path)
            oks.append(ok)
            return value

        out = transform(v, one).cast(T.ArrayType(self.type(r)) if values is v else T.MapType(T.StringType(), self.type(r)))
        ok = None if oks[0] is None else forall(values, lambda x: F.coalesce(self.read(w, r, x, path)[1], F.lit(False)))
        return out, None if ok is None else v.isNull() | ok

    def _from_union(self, w: list, r, v: Column, path: str) -> tuple[Column, Column | None]:
        branches, nullable = non_null_branches(w), "null" in w
        null_ok = r == "null" or (isinstance(r, list) and "null" in r)
        widened = collapsed_union_type(branches, self.w_named)
        if not branches:
            return self.read("null", r, v, path)
        if len(branches) == 1 or widened is not None:
            only = branches[0] if len(branches) == 1 else next(k for k, t in PRIMITIVES.items() if t == widened)
            out, ok = self.read(only, r, v, path)
            oks = [] if ok is None else [v.isNull() | ok]
            return out, _all([*oks, v.isNotNull() if nullable and not null_ok else None])
        dtype = self.type(r)
        out, right, errors = F.lit(None).cast(dtype), F.lit(null_ok and nullable), []
        for i, b in reversed(list(enumerate(branches))):
            member = v.getField(f"member{i}")
            try:
                value, ok = self.read(b, r, member, path)
            except ResolutionError as e:  # such values are dead letters, others of the union are read
                value, ok = F.lit(None).cast(dtype), F.lit(False)
                errors.append(str(e))
            out = F.when(member.isNotNull(), value).otherwise(out)
            right = F.when(member.isNotNull(), F.lit(True) if ok is None else F.coalesce(ok, F.lit(False))).otherwise(right)
        if len(errors) == len(branches):
            raise ResolutionError("; ".join(errors))
        return out, right

    def _to_union(self, w, r: list, v: Column, path: str) -> tuple[Column, Column | None]:
        branches = non_null_branches(r)
        same = [i for i, b in enumerate(branches) if _alike(w, resolve(b, self.r_named))]
        for i in same + [i for i in range(len(branches)) if i not in same]:
            try:
                value, ok = self.read(w, branches[i], v, path)
            except ResolutionError:
                continue
            return self._branch(r, i, value), ok
        raise ResolutionError(f"{path}: {_name(w)} is in no branch of {[_name(resolve(b, self.r_named)) for b in r]}")


def _name(s) -> str:
    return s if isinstance(s, str) else "union" if isinstance(s, list) else s["type"]


def _logical(s) -> str | None:
    return s.get("logicalType") if isinstance(s, dict) else None


def _simple(name: str) -> str:
    return name.rpartition(".")[2]


def _alike(w, r) -> bool:
    """Of one type and, where types have names, one name."""
    return _name(w) == _name(r) and _logical(w) == _logical(r) and (
        not isinstance(w, dict) or _simple(w.get("name", "")) == _simple(r.get("name", "")))


def _all(oks: list[Column | None]) -> Column | None:
    out = None
    for ok in oks:
        out = ok if out is None else out if ok is None else out & ok
    return out


def resolved_row(writer, reader, row: Column) -> tuple[Column, Column | None]:
    """(the reader's record, whether the row has one) of a struct column in the writer's Spark type."""
    w, r = parse_avro(writer), parse_avro(reader)
    return _Resolver(w, r).read(w, r, row, "")


def subject_schemas(registry: DataFrame, subject: str | None = None) -> dict[int, str]:
    """{id: schema text}; a subject has few versions, and more than MOST_IDS are refused, not cut."""
    rows = registry if subject is None else registry.where(F.col("subject") == subject)
    found = rows.select("id", "schema").distinct().limit(MOST_IDS + 1).collect()
    if len(found) > MOST_IDS:
        raise ValueError(f"more than {MOST_IDS} schemas; name the subject")
    out: dict[int, str] = {}
    for row in found:
        if out.setdefault(row["id"], row["schema"]) != row["schema"]:
            raise ValueError(f"schema id {row['id']} has two schemas")
    return out


def decode_by_writer(records: DataFrame, registry: DataFrame, reader, subject: str | None = None, keep: list[str] | None = None,
                     body: str = "json") -> tuple[DataFrame, DataFrame]:
    """(good, dead letters) of framed records, each read with the schema that its header names, as the reader's schema.

    good: ``keep`` columns, schema_id, and the reader's fields.  Dead letters: ``keep``, schema_id, value and a reason: ``null value``,
    ``header``, ``unknown schema id``, ``malformed``, ``missing:<field>`` (one the writer's schema requires), ``value`` (one the
    reader's types can't hold, as a union branch or enum symbol it lacks), or why no record of that schema can be read.
    body: ``json``, or ``avro`` through Spark's own ``from_avro``.  Lazy; also for streams, whose schemas are those known at the start.
    """
    keep = keep or []
    target, rows = loose(record_schema(reader)), split_wire(records)
    schemas = subject_schemas(registry, subject)
    reasons, parsed = F.lit("unknown schema id"), {}
    row = F.lit(None).cast(target)
    for i, text in sorted(schemas.items()):
        here, writer = F.col("schema_id") == i, record_schema(text)
        column = F.col(f"_w{i}")
        try:
            value, ok = resolved_row(text, reader, column)
        except ResolutionError as e:
            reasons = F.when(here, F.lit(str(e))).otherwise(reasons)
            continue
        parsed[i] = F.when(here & F.col("magic_ok"), _parse(F.col("body"), text, writer, body))
        bad = F.when(column.isNull() | F.col(f"_w{i}._corrupt").isNotNull(), F.lit("malformed")) if body == "json" else \
            F.when(column.isNull(), F.lit("malformed"))
        for f in writer if body == "json" else []:
            if not f.nullable:
                bad = bad.when(F.col(f"_w{i}.`{f.name}`").isNull(), F.lit(f"missing:{f.name}"))
        if ok is not None:
            bad = bad.when(~F.coalesce(ok, F.lit(False)), F.lit("value"))
        reasons = F.when(here, bad).otherwise(reasons)
        row = F.when(here, value).otherwise(row)
    framed = rows.select(*keep, "value", "schema_id", "magic_ok", *[c.alias(f"_w{i}") for i, c in parsed.items()])
    reason = F.when(F.col("value").isNull(), F.lit("null value")).when((F.length("value") < 5) | ~F.col("magic_ok"), F.lit("header")).otherwise(reasons)
    # through a generator, past which no filter on the reason is pushed: each body is parsed once
    once = F.explode(F.array(F.struct(reason.alias("reason"), row.cast(target).alias("_row")))).alias("_d")
    out = framed.select(*keep, "schema_id", "value", once).select(*keep, "schema_id", "value", "_d.*")
    good = out.where("reason IS NULL").select(*keep, "schema_id", *[F.col(f"_row.`{f.name}`").alias(f.name) for f in target])
    return good, out.where("reason IS NOT NULL").select(*keep, "schema_id", "value", "reason")


def _parse(body: Column, text: str, writer: T.StructType, form: str) -> Column:
    if form == "avro":
        from pyspark.sql.avro.functions import from_avro

        return from_avro(body, json.dumps(parse_avro(text)), {"mode": "PERMISSIVE"})
    fields = T.StructType([*loose(writer), T.StructField("_corrupt", T.StringType())])
    return F.from_json(body.cast("string"), fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
