"""Nested records to linked relational tables, and JSON choice-type resolution.

``relationalize`` walks the *static* schema (no data sampling): structs become
``{col}_{field}`` columns at any depth, every array or map becomes a child
table keyed by the parent key plus a ``{col}_index`` position, recursively.
Each output table is a narrow projection / ``posexplode`` of the input — no
shuffle; persist the input first if many tables are written from it.
"""

from __future__ import annotations

import json
import sys
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.decode import json_path
from tidewater.session import ensure_checkpoint_dir


def _walk(prefix: str, expr: Column, dtype: T.DataType, sep: str, scalars: list, nested: list) -> None:
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            name = f"{prefix}{sep}{f.name}" if prefix else f.name
            _walk(name, expr.getField(f.name), f.dataType, sep, scalars, nested)
    elif isinstance(dtype, (T.ArrayType, T.MapType)):
        nested.append((prefix, expr, dtype))
    else:
        scalars.append((prefix, expr))


def _place(name: str, keys: list[str], sep: str) -> str:
    """The index or key column of a list; one directly inside another list gets a number."""
    n, unique = 1, name
    while unique in keys:
        n, unique = n + 1, f"{name}{sep}{n + 1}"
    return unique


def _emit(frame: DataFrame, keys: list[str], columns: list[tuple[str, Column, T.DataType]], table: str,
          out: dict[str, DataFrame], sep: str, keep_empty: bool, strip: str = "", piece: str | None = None) -> None:
    scalars: list = []
    nested: list = []
    for name, expr, dtype in columns:
        _walk(name, expr, dtype, sep, scalars, nested)
    own = frame if piece is None else frame.where(F.col(f"`{piece}`")["number"] == 0)
    out[table] = own.select(*[F.col(k) for k in keys], *[e.alias(n) for n, e in scalars])
    for at, (name, expr, dtype) in enumerate(nested):
        # Inside a child table, names carry the list's prefix; child tables and
        # their index columns are named by the nested list's own path.
        short = name[len(strip):] if strip and name.startswith(strip) else name
        child = f"{table}{sep}{short}"
        if isinstance(dtype, T.ArrayType):
            idx = _place(f"{short}{sep}index", keys, sep)
            gen = F.posexplode_outer(expr) if keep_empty else F.posexplode(expr)
            exploded = _counted_on(frame.select(*_key_columns(keys, piece), gen.alias(idx, "_elem")), keys, idx, "_elem", piece, at)
            _emit(exploded, keys + [idx], [(short, F.col("_elem"), dtype.elementType)], child, out, sep,
                  keep_empty, short + sep)
        else:
            idx = _place(f"{short}{sep}key", keys, sep)
            gen = F.explode_outer(expr) if keep_empty else F.explode(expr)
            exploded = _counted_on(frame.select(*_key_columns(keys, piece), gen.alias(idx, "_val")), keys, idx, "_val", piece, None)
            _emit(exploded, keys + [idx], [(short, F.col("_val"), dtype.valueType)], child, out, sep,
                  keep_empty, short + sep)


def _key_columns(keys: list[str], piece: str | None) -> list[Column]:
    return [F.col(k) for k in keys] + ([] if piece is None else [F.col(f"`{piece}`").alias("_piece")])


def _counted_on(exploded: DataFrame, keys: list[str], idx: str, value: str, piece: str | None, at: int | None) -> DataFrame:
    """The elements of a list that lies in pieces, with their positions in the whole list; a map's keys stay as they are."""
    if piece is None:
        return exploded
    some = exploded.where((F.col("_piece")["number"] == 0) | F.col(f"`{idx}`").isNotNull())  # only the first piece stands for an empty list
    place = F.col(f"`{idx}`") if at is None else (F.col(f"`{idx}`") + F.col("_piece")["before"][at]).cast("int")
    return some.select(*[F.col(k) for k in keys], place.alias(idx), value)


def relationalize(df: DataFrame, key: str | list[str], name: str, sep: str = "_",
                  keep_empty: bool = True, materialize: bool = False, piece: str | None = None) -> dict[str, DataFrame]:
    """Split a nested frame into ``{name: parent, name_list: child, ...}``.

    ``keep_empty`` keeps one all-null child row for a null or empty list (as an
    outer explode does); ``False`` drops those rows. ``materialize`` writes the
    nested input once (reliable checkpoint) so writing several output tables does
    not recompute it (e.g. a join or grouping that built the nesting). ``piece`` names
    the column of a frame in which ``nest`` left long lists in pieces.
    """
    if materialize and not df.isStreaming:
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    keys = [key] if isinstance(key, str) else list(key)
    cols = [(f.name, F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields if f.name not in keys and f.name != piece]
    out: dict[str, DataFrame] = {}
    _emit(df, keys, cols, name, out, sep, keep_empty, piece=piece)
    return out


CHUNK = 10_000  # elements of a list that one group collects
_MAP_PARTS = 16


def nest(tables: dict[str, DataFrame], schema: T.StructType, key: str | list[str], name: str, sep: str = "_", chunk: int = CHUNK,
         piece: str | None = None) -> DataFrame:
    """The nested frame that ``relationalize`` split into these tables; ``schema`` is its schema, ``key`` its (not null) key.

    Built bottom-up, a level at a time. A list is collected in groups of ``chunk`` neighbours by their index, then its
    groups, already in arrays, are put in order: a parent with very many elements is assembled by many tasks, and only its
    finished array, which is one value of the result, is one task's. Maps go by hashes of their keys.
    A list without rows is null, as null and empty lists look the same in the tables; so is a struct whose fields are all null.

    A record is one value of one task, at most 2 GB of it. With ``piece`` a record whose own lists have more than ``chunk`` elements is
    several rows instead, and no task holds more than a group: each row has one group of every list, the first one also all the
    rest, and the column ``piece`` says which row it is (``number``) and how many elements of each list lie in the rows ``before``.
    Maps, and lists within a list's elements, stay whole. ``relationalize`` with the same ``piece`` reads it.
    """
    keys = [key] if isinstance(key, str) else list(key)

    def value(path: str, dtype: T.DataType) -> Column:
        if not isinstance(dtype, T.StructType):
            return F.col(f"`{path}`")
        parts = [(f.name, value(f"{path}{sep}{f.name}", f.dataType)) for f in dtype]
        return F.when(reduce(Column.__or__, [p.isNotNull() for _, p in parts]), F.struct(*[p.alias(n) for n, p in parts]))

    def build(keys: list[str], columns: list[tuple[str, T.DataType]], table: str, strip: str) -> DataFrame:
        scalars: list = []
        nested: list = []
        for path, dtype in columns:
            _walk(path, _Typed(dtype), dtype, sep, scalars, nested)
        frame = tables[table]
        if piece is not None and table == name:
            return in_pieces(frame, keys, columns, [p for p, _ in scalars], [(p, dtype) for p, _, dtype in nested])
        for path, _, dtype in nested:
            short = path[len(strip):] if strip and path.startswith(strip) else path
            frame = frame.join(collected(keys, short, dtype, f"{table}{sep}{short}").withColumnRenamed("_list", path), keys, "left")
        return frame.select(*[F.col(f"`{k}`") for k in keys], *[value(path, dtype).alias(path) for path, dtype in columns])

    def in_pieces(frame: DataFrame, keys: list[str], columns: list[tuple[str, T.DataType]], scalars: list[str],
                  nested: list[tuple[str, T.DataType]]) -> DataFrame:
        own, number = [F.col(f"`{k}`") for k in keys], F.col("_number")
        w = Window.partitionBy(*own).orderBy("_part")  # of rows without elements: one per group
        lists, wholes, most = [], [], []
        for i, (path, dtype) in enumerate(nested):
            if isinstance(dtype, T.MapType):
                wholes.append((path, collected(keys, path, dtype, f"{name}{sep}{path}").withColumnRenamed("_list", path)))
                continue
            rows, index, at = elements(keys, path, dtype, f"{name}{sep}{path}")
            sizes = rows.groupBy(*own, at.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
            before = F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
            places = sizes.select(*own, (F.row_number().over(w) - 1).alias("_number"), F.col("_part").alias(f"_part{i}"), before.alias(f"_before{i}"))
            most.append(places.groupBy(*own).agg(F.max("_number").alias(f"_most{i}")))
            lists.append((path, i, places, grouped(rows, keys, path, index, at).withColumnRenamed("_part", f"_part{i}")))
        for m in most:
            frame = frame.join(m, keys, "left")
        last = F.greatest(F.lit(0), F.lit(0), *[F.col(m.columns[-1]) for m in most])
        frame = frame.withColumn("_number", F.explode(F.sequence(F.lit(0), last)))
        for path, whole in wholes:
            frame = frame.join(whole, keys, "left")
        frame = frame.withColumns({p: F.when(number == 0, F.col(f"`{p}`")) for p in [*scalars, *[p for p, _ in wholes]]})
        for path, i, places, groups in lists:
            frame = frame.join(places, [*keys, "_number"], "left")
            some = groups.select(*own, f"_part{i}", F.transform(_by_index("_some"), lambda e: e["v"]).alias(path))
            frame = frame.join(some, [*keys, f"_part{i}"], "left")
        counts = {i: F.coalesce(F.col(f"_before{i}"), F.lit(0).cast("bigint")) for _, i, _, _ in lists}
        before = F.array(*[counts.get(i, F.lit(0).cast("bigint")) for i in range(len(nested))]).cast("array<bigint>")
        return frame.select(*own, *[value(path, dtype).alias(path) for path, dtype in columns],
                            F.struct(number.alias("number"), before.alias("before")).alias(piece))

    def elements(keys: list[str], short: str, dtype: T.DataType, table: str) -> tuple[DataFrame, str, Column]:
        """Rows of a list or map (keys, place, value), the column of their place and the group each one goes to."""
        is_list = isinstance(dtype, T.ArrayType)
        index = _place(f"{short}{sep}{'index' if is_list else 'key'}", keys, sep)
        rows = build([*keys, index], [(short, dtype.elementType if is_list else dtype.valueType)], table, short + sep).where(F.col(f"`{index}`").isNotNull())
        at = F.floor(F.col(f"`{index}`") / chunk) if is_list else F.pmod(F.xxhash64(f"`{index}`"), F.lit(_MAP_PARTS))
        return rows, index, at

    def grouped(rows: DataFrame, keys: list[str], short: str, index: str, at: Column) -> DataFrame:
        entry = F.struct(F.col(f"`{index}`").alias("i"), F.col(f"`{short}`").alias("v"))
        return rows.groupBy(*[F.col(f"`{k}`") for k in keys], at.alias("_part")).agg(F.collect_list(entry).alias("_some"))

    def collected(keys: list[str], short: str, dtype: T.DataType, table: str) -> DataFrame:
        own, is_list = [F.col(f"`{k}`") for k in keys], isinstance(dtype, T.ArrayType)
        rows, index, at = elements(keys, short, dtype, table)
        parts = grouped(rows, keys, short, index, at).groupBy(*own).agg(F.collect_list(F.struct(F.col("_part").alias("i"), _by_index("_some").alias("v"))).alias("_parts"))
        entries = F.flatten(F.transform(_by_index("_parts"), lambda p: p["v"]))
        whole = F.transform(entries, lambda e: e["v"]) if is_list else F.map_from_entries(entries)
        return parts.select(*own, whole.alias("_list"))

    columns = [(f.name, f.dataType) for f in schema if f.name not in keys]
    out = build(keys, columns, name, "")
    return out.select(*[F.col(f"`{f.name}`") for f in schema], *([] if piece is None else [F.col(f"`{piece}`")]))


class _Typed:
    """Stands for a column where only its type is walked."""

    def __init__(self, dtype: T.DataType):
        self.dtype = dtype

    def getField(self, name: str) -> _Typed:
        return _Typed(self.dtype[name].dataType)


def _by_index(column: str) -> Column:
    """Entries (i, v) in the order of i, whatever v is; maps have no order, so only i is compared."""
    return F.array_sort(column, lambda a, b: F.when(a["i"] < b["i"], -1).when(a["i"] > b["i"], 1).otherwise(0))


# Spark simple type name -> SQL DDL type.
_DDL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "SMALLINT",
              "double": "DOUBLE PRECISION", "float": "REAL", "string": "VARCHAR", "boolean": "BOOLEAN",
              "timestamp": "TIMESTAMPTZ", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "binary": "BYTEA"}


def ddl_for(df: DataFrame, table: str, schema: str = "public") -> str:
    """CREATE TABLE text for a flat frame (nested types as a JSON-text column)."""
    lines = []
    for f in df.schema.fields:
        simple = f.dataType.simpleString()
        sql_type = _DDL_TYPES.get(simple)
        if sql_type is None:
            sql_type = f"NUMERIC{simple[7:]}" if simple.startswith("decimal") else "VARCHAR"
        lines.append(f'    "{f.name}" {sql_type}')
    return f'CREATE TABLE IF NOT EXISTS "{schema}"."{table}" (\n' + ",\n".join(lines) + "\n);"


# ---------------------------------------------------------------- JSON choice types

# How each resolved kind is read out of a VARIANT.
KIND_TYPES = {"int": "bigint", "float": "double", "str": "string", "bool": "boolean", "array": "string"}

ELEMENT = None  # the path segment of an array's elements; every other segment is a key, whatever it holds
Path = tuple[str | None, ...]
_PATHS = "array<struct<element: boolean, key: string>>"


def _kind(v: Column) -> Column:
    """object, array, int, float, bool, str, or null for a JSON null."""
    t = F.schema_of_variant(v)
    return (F.when(t == "VOID", F.lit(None)).when(t.startswith("OBJECT"), "object").when(t.startswith("ARRAY"), "array")
            .when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "int").when(t == "BOOLEAN", "bool")
            .when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"), "float").otherwise("str"))


# Bit of each kind in a path's set of kinds; a JSON null has none.
_BITS = {"object": 1, "array": 2, "int": 4, "float": 8, "str": 16, "bool": 32}
MOST_PATHS = 20_000  # paths of all objects that the driver takes
_HELD_PATHS = 50_000  # paths that a task holds before it hands them on


class _Kinds:
    """The kinds seen at a path, and the paths below it; two of them merge path by path, in any order."""

    __slots__ = ("bits", "fields", "element")

    def __init__(self):
        self.bits, self.fields, self.element = 0, {}, None

    def add(self, v) -> int:
        """Take in a parsed JSON value; returns the number of new paths."""
        if isinstance(v, dict):
            self.bits |= 1
            new = 0
            for key, x in v.items():
                child = self.fields.get(key)
                if child is None:
                    child = self.fields[key] = _Kinds()
                    new += 1
                new += child.add(x)
            return new
        if isinstance(v, list):
            self.bits |= 2
            new = 0
            for x in v:
                if self.element is None:
                    self.element = _Kinds()
                    new += 1
                new += self.element.add(x)
            return new
        if isinstance(v, bool):
            self.bits |= 32
        elif isinstance(v, int):
            self.bits |= 4 if -(1 << 63) <= v < 1 << 63 else 8
        elif isinstance(v, float):
            self.bits |= 8
        elif v is not None:
            self.bits |= 16
        return 0

    def rows(self, path: tuple = ()):
        yield path, self.bits
        for key, child in self.fields.items():
            yield from child.rows((*path, key))
        if self.element is not None:
            yield from self.element.rows((*path, ELEMENT))


def _task_kinds(batches):
    """(object, path as JSON, bits) of a task's documents."""
    sys.setrecursionlimit(10_000)  # a document may nest as deeply as Spark's parser lets it, 1,000 levels
    read, seen, held = json.JSONDecoder().raw_decode, {}, 0

    def rows():
        out = [(name, json.dumps(path), bits) for name, kinds in seen.items() for path, bits in kinds.rows()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.string(), pa.int32()))],
                                          names=["object", "path", "bits"])

    for batch in batches:
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            kinds = seen.get(name)
            if kinds is None:
                kinds = seen[name] = _Kinds()
                held += 1
            held += kinds.add(read(text.as_py().lstrip(" \t\r\n"))[0])
            if held >= _HELD_PATHS:
                yield rows()
                seen, held = {}, 0
    if seen:
        yield rows()


def infer_object_types(df: DataFrame, col: str, object_col: str | None = None, most_paths: int = MOST_PATHS) -> dict[str | None, dict[Path, set[str]]]:
    """{object: {path: JSON kinds seen there}} of a text column: int, float, str, bool, array; objects are only their fields.

    One job: each task folds its documents into a tree of paths and kinds, the cluster merges the trees' rows by path, and the
    driver receives one row per object and path, which is the schema that any columns made from it have anyway.
    Documents whose keys are data have as many paths as keys; beyond ``most_paths`` of them this raises, naming
    some, instead of filling the driver.  Text that is no JSON is left out.
    """
    name = F.lit(None).cast("string") if object_col is None else F.col(object_col).cast("string")
    texts = df.where(F.try_parse_json(F.col(col)).isNotNull()).select(name.alias("object"), F.col(col).cast("string").alias("text"))
    merged = texts.mapInArrow(_task_kinds, "object string, path string, bits int").groupBy("object", "path").agg(F.bit_or("bits").alias("bits"))
    rows = merged.limit(most_paths + 1).collect()
    if len(rows) > most_paths:
        raise ValueError(f"more than {most_paths} paths: some keys must be data, such as {sorted(r['path'] for r in rows)[-3:]}")
    found: dict[str | None, dict[Path, set[str]]] = {}
    for r in rows:
        found.setdefault(r["object"], {})[tuple(json.loads(r["path"]))] = {k for k, bit in _BITS.items() if r["bits"] & bit}
    return {o: _column_paths(kinds) for o, kinds in found.items()}


def _column_paths(kinds: dict[Path, set[str]]) -> dict[Path, set[str]]:
    kinds = {p: k for p, k in kinds.items() if p}
    if any(p[0] is ELEMENT for p in kinds):
        kinds[()] = {"array"}  # documents that are arrays themselves
    # an object is its fields, unless it never has any
    parents = {p[:-1] for p in kinds if p and p[-1] is not ELEMENT}
    return {p: k - {"object"} for p, k in kinds.items() if not (k <= {"object"} and (p in parents or "object" in k))}


def infer_json_types(df: DataFrame, col: str, most_paths: int = MOST_PATHS) -> dict[Path, set[str]]:
    """Per path, the set of JSON kinds seen in all documents; see ``infer_object_types``."""
    return infer_object_types(df, col, most_paths=most_paths).get(None, {})


def choice_label(kinds: set[str]) -> str:
    return "c-" + "-".join(sorted(kinds)) if len(kinds) > 1 else next(iter(kinds), "void")


# Choice resolution rules (a choice set -> one kind).
DEFAULT_RULES = {frozenset({"float", "int"}): "float"}


def resolve_choices(types: dict[Path, set[str]], rules: dict | None = None,
                    sep: str = "_") -> dict[Path, list[tuple[str, str, str]]]:
    """{path: [(out_column, spark_type, kind)]}: a rule collapses a choice to one column,
    an unresolved choice splits into ``{path}_{kind}`` columns, a single kind stays. Paths inside arrays are left to
    ``json_tables``. Paths that would share a column name are told apart by a number."""
    rules = DEFAULT_RULES if rules is None else rules
    out: dict[Path, list[tuple[str, str, str]]] = {}
    taken: set[str] = set()

    def fresh(name: str) -> str:
        n, unique = 1, name
        while unique.lower() in taken:
            n += 1
            unique = f"{name}{sep}{n}"
        taken.add(unique.lower())
        return unique

    for path in sorted(p for p in types if p and ELEMENT not in p):
        kinds = set(types[path]) or {"str"}
        name = sep.join(path)
        if len(kinds) == 1 or frozenset(kinds) in rules:
            kind = next(iter(kinds)) if len(kinds) == 1 else rules[frozenset(kinds)]
            out[path] = [(fresh(name), KIND_TYPES[kind], kind)]
        else:
            out[path] = [(fresh(f"{name}{sep}{k}"), KIND_TYPES[k], k) for k in sorted(kinds)]
    return out


def _typed(frame: DataFrame, resolved: dict[Path, list[tuple[str, str, str]]], keep: list[str]) -> DataFrame:
    """Typed columns out of the variant ``_v``."""
    cols = []
    for path, outs in resolved.items():
        where = json_path(list(path))
        v = F.try_variant_get(F.col("_v"), where, "variant")
        for name, typ, kind in outs:
            value = F.try_variant_get(F.col("_v"), where, typ)
            cols.append((value if len(outs) == 1 else F.when(_kind(v) == kind, value)).alias(name))
    return frame.select(*[F.col(f"`{k}`") for k in keep], *cols)


def convert_json(df: DataFrame, col: str, resolved: dict[Path, list[tuple[str, str, str]]],
                 keep: list[str] | None = None) -> DataFrame:
    """Typed columns out of a JSON text column, following ``resolve_choices``; an array is its JSON text."""
    keep = keep or []
    return _typed(df.select(*keep, F.try_parse_json(F.col(col)).alias("_v")), resolved, keep)


def convert_objects(df: DataFrame, col: str, object_col: str, types: dict[str | None, dict[Path, set[str]]], keep: list[str] | None = None,
                    rules: dict | None = None, sep: str = "_") -> DataFrame:
    """Typed columns out of the JSON texts of several objects, each by its own types, in one scan.

    A path has one column for all objects that agree on its type; where they don't, a column per kind, named
    ``{path}_{kind}`` as an unresolved choice is.  Rows of an object without a path have null there.
    """
    resolved = {o: resolve_choices(t, rules, sep) for o, t in types.items()}
    wanted: dict[Path, dict[tuple[str, str], list]] = {}
    for o, paths in resolved.items():
        for path, outs in paths.items():
            for name, typ, kind in outs:
                wanted.setdefault(path, {}).setdefault((typ, kind), []).append((o, name, len(outs) == 1))
    taken: set[str] = set()
    cols = []
    for path in sorted(wanted):
        alike = {typ for typ, _ in wanted[path]}
        split = len(alike) > 1 or any(not alone for users in wanted[path].values() for _, _, alone in users)
        for (typ, kind), users in sorted(wanted[path].items()):
            name, n = sep.join(path) + (f"{sep}{kind}" if split else ""), 1
            while name.lower() in taken:
                n, name = n + 1, f"{name}{sep}{n + 1}"
            taken.add(name.lower())
            where = json_path(list(path))
            value, own = F.try_variant_get(F.col("_v"), where, typ), _kind(F.try_variant_get(F.col("_v"), where, "variant")) == kind
            alone, shared = [[o for o, _, a in users if a is flag] for flag in (True, False)]
            by = F.when(_is_any(object_col, alone), value) if alone else F.when(F.lit(False), value)
            cols.append((by.when(_is_any(object_col, shared) & own, value) if shared else by).alias(name))
    parsed = df.select("*", F.try_parse_json(F.col(col)).alias("_v"))
    return parsed.select(*[F.col(f"`{k}`") for k in keep or []], *cols)


def _is_any(column: str, names: list[str | None]) -> Column:
    known = [n for n in names if n is not None]
    out = F.coalesce(F.col(column).isin(known), F.lit(False)) if known else F.lit(False)
    return out | F.col(column).isNull() if None in names else out


def json_tables(df: DataFrame, col: str, key: str | list[str], name: str, sep: str = "_", rules: dict | None = None,
                types: dict[Path, set[str]] | None = None) -> dict[str, DataFrame]:
    """Raw JSON documents as linked tables: ``{name: documents, name_list: its elements, ...}``.

    Objects become columns named by their path, mixed kinds are resolved as ``resolve_choices`` does, and every
    array, at any depth, becomes a child table with the parent's keys, the element's position ``{list}_index`` and
    its columns. No shuffle beyond the inference of the types (pass ``types`` to skip it).
    """
    types = infer_json_types(df, col) if types is None else types
    keys = [key] if isinstance(key, str) else list(key)
    out: dict[str, DataFrame] = {}

    def build(frame: DataFrame, keys: list[str], table: str, base: Path, prefix: str) -> None:
        own = {p[len(base):]: k for p, k in types.items() if p[: len(base)] == base}
        scalars = {p: k - {"array"} for p, k in own.items() if ELEMENT not in p and (k - {"array"} or not k)}
        plain = resolve_choices({(prefix, *p) if prefix else p: k for p, k in scalars.items()}, rules, sep)
        out[table] = _typed(frame, {p[1:] if prefix else p: c for p, c in plain.items()}, keys)
        for p, kinds in own.items():
            if ELEMENT in p or "array" not in kinds:
                continue
            short = sep.join(p) or (f"{prefix}{sep}list" if prefix else "list")
            index = f"{short}{sep}index"
            listed = frame.select(*[F.col(f"`{k}`") for k in keys], F.try_variant_get("_v", json_path(list(p)), "variant").alias("_l"))
            listed = listed.where(_kind(F.col("_l")) == "array")
            elements = df.sparkSession.sql(f"SELECT {', '.join(f's.`{k}`' for k in keys)}, e.pos AS `{index}`, e.value AS _v "
                                           "FROM {src} AS s, LATERAL variant_explode(s._l) AS e", src=listed)
            build(elements, [*keys, index], f"{table}{sep}{short}", (*base, *p, ELEMENT), short)

    build(df.select(*[F.col(f"`{k}`") for k in keys], F.try_parse_json(F.col(col)).alias("_v")), keys, name, (), "")
    return out
