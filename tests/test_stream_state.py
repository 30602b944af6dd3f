import time
from collections import Counter
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidewater import fs
from tidewater.contracts import Check, Column, Contract, ContractError, validate
from tidewater.session import scratch_path
from tidewater.streaming.clock import clock_windows, settled
from tidewater.streaming.ingest import IngestSpec, run_ingest
from tidewater.streaming.runner import at_rest, input_read, keyed_state, run_until_rest
from tidewater.streaming.unique import _Accepted
from tidewater.streaming.validate import last_report, report_stream, reports, validate_stream
from tidewater.sinks.tables import TableSpec
from tidewater.sources.topics import TopicSpec


DDL = "id long, ts timestamp_ntz, kind string, v double"


@pytest.fixture
def source(spark):
    """(add rows, stream of one file per micro-batch)"""
    path = scratch_path(spark, "rows")

    def add(rows):
        df = rows if not isinstance(rows, list) else spark.createDataFrame(rows, DDL)
        df.coalesce(1).write.mode("append").parquet(path)

    def stream(**options):
        return spark.readStream.schema(DDL).options(maxFilesPerTrigger=1, **options).parquet(path)

    return add, stream


def at(minute, second=0):
    import datetime as dt
    return dt.datetime(2024, 1, 1, 0, minute, second)


def test_windows_close_by_the_clock(spark, source):
    """Three files, the first start stopped with windows open; nulls, negative values, and a null key."""
    add, stream = source
    out, ckpt = scratch_path(spark, "clock"), scratch_path(spark, "ckpt")
    first = [(1, at(0, 10), "a", 1.25), (2, at(0, 50), "a", None), (3, at(1, 5), "b", -2.5), (4, at(1, 6), None, 4.0), (5, at(9), "c", None)]
    add(first)
    windows = clock_windows(stream(), "ts", "kind", "v", grace_s=5)
    assert windows.columns == ["kind", "window_end", "total", "rows"]
    run_until_rest(windows, out, ckpt, "200 milliseconds", 60, done=input_read)
    second = [(6, at(0, 59), "a", 10.0), (7, at(1, 59), "b", 0.5)]
    add(second)
    add([(8, at(2), "b", 7.0)])
    closed = run_until_rest(clock_windows(stream(), "ts", "kind", "v", grace_s=1), out, ckpt, "200 milliseconds", 90)
    got = {(r.kind, r.window_end.minute): r.window_sales for r in settled(closed, ["kind"], "0.5").collect()}
    assert got == {("a", 1): 5.625, ("b", 2): -1.0, (None, 2): 2.0, ("c", 10): None, ("b", 3): 3.5}
    assert closed.agg(F.sum("rows")).first()[0] == 8


def test_a_late_row_makes_one_more_part(spark, source):
    add, stream = source
    out, ckpt = scratch_path(spark, "clock"), scratch_path(spark, "ckpt")
    for value in (1.0, 2.5):
        add([(1, at(0, 10), "a", value)])
        closed = run_until_rest(clock_windows(stream(), "ts", "kind", "v", grace_s=0.2), out, ckpt, "200 milliseconds", 60)
    assert sorted(r.total for r in closed.collect()) == [Decimal("1"), Decimal("2.5")]
    assert [r.window_sales for r in settled(closed, ["kind"], None).collect()] == [3.5]


def test_rows_placed_by_the_clock(spark, source):
    add, stream = source
    add([(i, None, "a", 0.5) for i in range(20)])
    started = time.time()
    closed = run_until_rest(clock_windows(stream(), None, ["kind"], "v", "2 seconds", grace_s=0), every="200 milliseconds", timeout_s=60)
    row = closed.first()
    assert closed.count() == 1 and (row.total, row.rows) == (Decimal("10"), 20)
    assert started < row.window_end.timestamp() <= time.time() and row.window_end.second % 2 == 0


def test_rest_is_neither_input_nor_state():
    progress = {"numInputRows": 0, "stateOperators": [{"numRowsTotal": 2}]}
    assert input_read(progress) and not at_rest(progress)
    assert at_rest({"numInputRows": 0, "stateOperators": []}) and not at_rest({"numInputRows": 1, "stateOperators": []})


UNIQUE = Contract(columns={"id": Column("int64", unique=True, nullable=True), "v": Column("float64", Check.le(100.0), nullable=True)})


def outcome(spark, path, query=None):
    try:
        rows = spark.read.parquet(path)
    except Exception:  # noqa: BLE001 - nothing written
        return Counter()
    return Counter((r.id, r.kind, ",".join(r["_reasons"]) if "_reasons" in rows.columns else "ok") for r in rows.collect())


def run(spark, stream, places, contract=UNIQUE, **kw):
    q = validate_stream(stream, contract, *places, **kw)
    q.awaitTermination()
    return outcome(spark, places[0]) + outcome(spark, places[1])


def places(spark):
    return scratch_path(spark, "valid"), scratch_path(spark, "bad"), scratch_path(spark, "ckpt")


def test_unique_across_batches_restarts_and_replays(spark, source):
    """Accepted keys are refused later, rejected ones aren't taken; a replayed micro-batch meets the state it met first."""
    add, stream = source
    p = places(spark)
    add([(1, None, "a", 1.0), (2, None, "a", 500.0), (3, None, "a", 1.0), (3, None, "b", 1.0), (None, None, "a", 1.0)])
    add([(1, None, "c", 1.0), (2, None, "c", 1.0), (3, None, "c", 2.0), (None, None, "c", 1.0), (1, None, "d", 900.0)])
    want = Counter({(1, "a", "ok"): 1, (2, "a", "v:less_than_or_equal_to"): 1, (3, "a", "id:unique"): 1, (3, "b", "id:unique"): 1, (None, "a", "ok"): 1,
                    (2, "c", "ok"): 1, (3, "c", "ok"): 1, (None, "c", "id:unique"): 1, (1, "c", "id:unique"): 1,
                    (1, "d", "v:less_than_or_equal_to,id:unique"): 1})
    assert run(spark, stream(), p) == want
    fs.delete(spark, f"{p[2]}/commits/1")  # as if the driver was lost before the second micro-batch was committed
    assert run(spark, stream(), p) == want
    add([(2, None, "e", 1.0), (9, None, "e", 1.0)])
    assert run(spark, stream(), p) == want + Counter({(2, "e", "id:unique"): 1, (9, "e", "ok"): 1})


def test_history_is_not_read(spark, source):
    """Without the accepted table, keys accepted before are still refused: they are in the state."""
    add, stream = source
    p = places(spark)
    add([(1, None, "a", 1.0)])
    run(spark, stream(), p)
    fs.delete(spark, p[0])
    add([(1, None, "b", 1.0), (2, None, "b", 1.0)])
    assert run(spark, stream(), p) == Counter({(1, "b", "id:unique"): 1, (2, "b", "ok"): 1})


def test_a_new_query_starts_from_the_table(spark, source):
    add, stream = source
    valid, bad, ckpt = places(spark)
    add([(1, None, "a", 1.0)])
    run(spark, stream(), (valid, bad, ckpt))
    other = scratch_path(spark, "ckpt")
    got = run(spark, stream(), (valid, bad, other))
    assert got == Counter({(1, "a", "ok"): 1, (1, "a", "id:unique"): 1})


@pytest.mark.parametrize("how", ["exclude_first", "exclude_last"])
def test_first_or_last_of_a_batch(spark, source, how):
    add, stream = source
    contract = Contract(columns={"id": Column("int64", unique=True)}, report_duplicates=how)
    rows = [(1, at(1), "x", 1.0), (1, at(2), "y", 1.0), (1, at(2), "z", 1.0), (1, None, "n", 1.0), (2, None, "n", 1.0), (3, None, "p", 1.0), (3, None, "q", 1.0)]
    add(rows)
    p = places(spark)
    got = run(spark, stream(), p, contract, order_by="ts")
    good, bad = validate(contract, spark.createDataFrame(rows, DDL), "quarantine", order_by="ts")
    assert got == Counter((r.id, r.kind, "ok") for r in good.collect()) + Counter((r.id, r.kind, ",".join(r["_reasons"])) for r in bad.collect())
    with pytest.raises(ValueError, match="order_by"):
        validate_stream(stream(), contract, *places(spark))


GROUP = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3))), min_size=1, max_size=8)


@settings(max_examples=200, deadline=None)
@given(GROUP, st.sampled_from(["all", "exclude_first", "exclude_last"]))
def test_duplicates_of_a_group(values, how):
    rows = [Row("n", "o")(i, v[0]) for i, v in enumerate(values)]
    got = {r.n: dup for r, dup in _Accepted(how, "o", None, [])._kept(iter(rows))}
    order = [r.o for r in rows if r.o is not None]
    best = (min if how == "exclude_first" else max)(order) if order else None
    many = len(rows) > 1
    assert got == {r.n: many and (how == "all" or r.o is None or r.o != best) for r in rows}


class Handle:
    """State of one bucket, and how often it was asked for something."""

    def __init__(self):
        self.values, self.calls = [], 0

    def getListState(self, *_):
        return self

    def get(self):
        self.calls += 1
        return iter(list(self.values))

    def appendValue(self, value):
        self.calls += 1
        self.values.append(value)


def test_state_is_asked_for_once_a_bucket():
    """However many keys a bucket has, a micro-batch reads its state once and appends to it once; a hot key's rows aren't held."""
    p = _Accepted("all", None, None, ["k", "x", "_ok", "_duplicate", "_seen"], ["k", "x"])
    handle, made = Handle(), Row("k", "x", "_ok", "_key_bucket")
    p.init(handle)
    rows = [made(f"a\n{i}", 0.5, i != 7, 3) for i in range(1000)] + [made(None, 0.0, True, 3), made(None, -0.0, True, 3), made("n", float("nan"), True, 3)]
    got = list(p.handleInputRows((3,), iter(rows), None))
    assert handle.calls == 2 and len(handle.values) == 1
    assert Counter((r["_duplicate"], r["_seen"]) for r in got) == {(False, False): 1001, (True, False): 2}
    assert {r.k for r in got if r["_duplicate"]} == {None} and "_key_bucket" not in got[0]
    again = {(r.k, str(r.x)): r["_seen"] for r in p.handleInputRows((3,), iter(rows[:10] + rows[-1:]), None)}
    assert again == {(f"a\n{i}", "0.5"): i != 7 for i in range(10)} | {("n", "nan"): True}
    left = iter([made("hot", 1.0, True, 3)] * 3)
    marked = p.handleInputRows((3,), left, None)
    next(marked)
    assert len(list(left)) == 1  # handed on at the second row


def test_keys_of_any_type(spark):
    """A key of many types is refused in the second batch, with a negative zero, and by a query that starts from the table."""
    path, cells = scratch_path(spark, "typed"), {
        "b": ("binary", "cast('x' as binary)"), "f": ("double", "0.0D"), "s": ("struct<x:int,y:double>", "named_struct('x', 1, 'y', 2.5D)"),
        "t": ("timestamp", "timestamp'2024-01-01 00:00:00.000001'"), "d": ("decimal(10,2)", "1.5")}
    schema = ", ".join(f"{c} {kind}" for c, (kind, _) in cells.items())
    contract = Contract(columns={c: Column(required=False) for c in cells}, unique=list(cells))
    valid, bad, ckpt = places(spark)
    for f in ("0.0D", "-0.0D"):
        spark.range(1).select(*[F.expr(f if c == "f" else v).cast(kind).alias(c) for c, (kind, v) in cells.items()]).write.mode("append").parquet(path)
        validate_stream(spark.readStream.schema(schema).parquet(path), contract, valid, bad, ckpt).awaitTermination()
    assert (spark.read.parquet(valid).count(), spark.read.parquet(bad).count()) == (1, 1)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    validate_stream(stream, contract, valid, bad, scratch_path(spark, "ckpt")).awaitTermination()
    assert (spark.read.parquet(valid).count(), spark.read.parquet(bad).count()) == (1, 3)


def test_keys_are_forgotten_after_their_time(spark, source):
    add, stream = source
    add([(7, None, "x", 1.0)])
    p = places(spark)
    with pytest.raises(ValueError, match="time to live"):
        validate_stream(stream(), UNIQUE, *p, unique_ttl_s=1)
    q = validate_stream(stream(), UNIQUE, *p, unique_ttl_s=2, available_now=False, processing_time="200 milliseconds")
    try:
        for kind in "ab":
            add([(1, None, kind, 1.0)])
            end = time.time() + 60
            while (1, kind, "ok") not in outcome(spark, p[0]) and time.time() < end and q.isActive:
                time.sleep(0.3)
            time.sleep(3)
    finally:
        q.stop()
    assert outcome(spark, p[0]) == Counter({(7, "x", "ok"): 1, (1, "a", "ok"): 1, (1, "b", "ok"): 1})


def test_several_unique_sets_depend_on_each_other(spark, source):
    """A row that one set rejects takes no key of the other."""
    add, stream = source
    contract = Contract(columns={"id": Column("int64", unique=True)}, unique=["kind"])
    add([(1, None, "a", 1.0)])
    add([(1, None, "b", 1.0), (2, None, "a", 1.0), (3, None, "c", 1.0)])
    add([(2, None, "b", 1.0)])
    got = run(spark, stream(), places(spark), contract)
    assert got == Counter({(1, "a", "ok"): 1, (1, "b", "id:unique"): 1, (2, "a", "kind:unique"): 1, (3, "c", "ok"): 1, (2, "b", "ok"): 1})


def test_coerced_rows_keep_what_they_came_with(spark):
    path = scratch_path(spark, "text")
    spark.createDataFrame([("1", "5"), ("x", "7"), ("1", "9")], "id string, n string").coalesce(1).write.parquet(path)
    contract = Contract(coerce=True, columns={"id": Column("int64", unique=True, nullable=True), "n": Column("int64", Check.le(8))})
    p = places(spark)
    validate_stream(spark.readStream.schema("id string, n string").parquet(path), contract, *p).awaitTermination()
    bad = {(r.id, r.n): r["_reasons"] for r in spark.read.parquet(p[1]).collect()}
    assert bad == {("x", "7"): ["id:coerce_dtype('bigint')"], ("1", "5"): ["id:unique"], ("1", "9"): ["n:less_than_or_equal_to", "id:unique"]}
    assert spark.read.parquet(p[0]).count() == 0


WHOLE = Contract(columns={
    "kind": Column("str", [Check.unique_values_eq(["a", "b"]), Check.custom(lambda c: F.avg((c == "a").cast("int")) > 0.5, "mostly_a", aggregate=True)]),
    "v": Column("float64", [Check.le(10.0), Check.custom(lambda c: F.max(c) == 9.0, "max_is_9", aggregate=True)], nullable=True)})


def report(df):
    return {(r["column"], r["check"]): r["failures"] for r in df.collect()}


def test_verdicts_of_every_batch(spark, source):
    """Each micro-batch's report is the batch report of all rows so far, over a restart too."""
    add, stream = source
    out, ckpt = scratch_path(spark, "report"), scratch_path(spark, "ckpt")
    loads = [[(1, None, "a", 1.0), (2, None, "a", 99.0)], [(3, None, "b", None)], [(4, None, "b", 9.0), (5, None, None, 3.0)], [(6, None, "c", 100.0)]]
    for i, rows in enumerate(loads):
        add(rows)
        if i:
            report_stream(stream(), WHOLE, out, ckpt).awaitTermination()
    seen, found = [], reports(spark, out, ckpt)
    assert found.select("batch_id").distinct().count() == 4
    for i, rows in enumerate(loads):
        seen += rows
        assert report(found.where(F.col("batch_id") == i)) == report(validate(WHOLE, spark.createDataFrame(seen, DDL), "report"))
    assert report(last_report(spark, out, ckpt)) == report(found.where("batch_id = 3"))


def test_reports_refuse_what_a_stream_cannot_keep(spark, source):
    add, stream = source
    add([(1, None, "a", 1.0)])
    distinct = Contract(columns={"id": Column(checks=[Check.custom(lambda c: F.count_distinct(c) > 1, "many", aggregate=True)])})
    with pytest.raises(Exception, match="(?i)distinct"):
        report_stream(stream(), distinct, scratch_path(spark, "r"), scratch_path(spark, "c")).awaitTermination()
    with pytest.raises(ContractError, match="structure"):
        report_stream(stream(), Contract(columns={"gone": Column()}), scratch_path(spark, "r"), scratch_path(spark, "c"))
    with pytest.raises(ContractError, match="no check"):
        report_stream(stream(), Contract(columns={"id": Column(nullable=True)}), scratch_path(spark, "r"), scratch_path(spark, "c"))


def test_state_provider_is_set_for_the_start_only(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    with keyed_state(spark):
        assert spark.conf.get(name).endswith("RocksDBStateStoreProvider")
    assert spark.conf.get(name, None) == before


def test_ingest_refuses_formats_that_would_repeat_rows():
    source = TopicSpec("t", path="/tmp/none")
    for fmt in ("iceberg", "hudi"):
        with pytest.raises(ValueError, match="twice"):
            run_ingest(None, IngestSpec(source, TableSpec("t", "/tmp/t", format=fmt), "/tmp/c", "a long", dead_letter_path="discard"))


def test_delta_inserts_name_their_transaction(monkeypatch):
    from tidewater.streaming import ingest

    seen = []
    monkeypatch.setattr(ingest, "append", lambda df, target: seen.append(target.options))
    ingest._append(None, TableSpec("t", "/tmp/t", format="delta", options={"mergeSchema": "true"}), "q", 7)
    assert seen == [{"mergeSchema": "true", "txnAppId": "q", "txnVersion": "7"}]


