import json
import math
import os

import pytest
import yaml
from pyspark.sql import functions as F

from tests.fixtures.contracts import (CITIES, CITIES_YAML, EMPLOYEE_TENURE_CSV, EMPLOYEES, INVALID, READER_YAML,
                                      SCHEMA_JSON, VALID, WRITER_YAML)
from tidewater.contracts import (Check, Column, Contract, ContractError, ContractModel, Field, duplicate_rows,
                                 typed, validate, validated_write)
from tidewater.session import scratch_path


def frame(spark, data, schema=None):
    names = list(data)
    rows = list(zip(*[data[n] for n in names]))
    return spark.createDataFrame(rows, schema or names)


INLINE = Contract(columns={
    "column1": Column(int, Check.le(10)),
    "column2": Column(float, Check.lt(-1.2)),
    "column3": Column(str, [Check.str_startswith("value_"),
                            Check.custom(lambda s: F.max(F.size(F.split(s, "_"))) == 2, "two_parts",
                                         aggregate=True)]),
})


def test_inline_valid_passes(spark):
    df = frame(spark, VALID)
    assert validate(INLINE, df).count() == 5


def test_inline_invalid_reports_rows_0_and_3(spark):
    df = frame(spark, INVALID)
    with pytest.raises(ContractError) as err:
        validate(INLINE, df)
    (col, check, n, examples), = err.value.failures
    assert (col, check, n) == ("column2", "less_than", 2)
    assert sorted(examples) == [6.0, 10.1]
    rep = {(r["column"], r["check"]): r["failures"] for r in validate(INLINE, df, "report").collect()}
    assert rep[("column3", "two_parts")] == 0 and rep[("column3", "str_startswith")] == 0


def test_custom_aggregate_failure(spark):
    df = frame(spark, {"column1": [1], "column2": [-2.0], "column3": ["value_1_x"]})
    rep = {(r["column"], r["check"]): r["failures"] for r in validate(INLINE, df, "report").collect()}
    assert rep[("column3", "two_parts")] == 1


def test_json_round_trip_is_lossless():
    c = Contract.from_dict(SCHEMA_JSON)
    assert c.to_dict() == SCHEMA_JSON
    assert json.loads(Contract.from_json(c.to_json()).to_json()) == SCHEMA_JSON


@pytest.mark.parametrize("text", [READER_YAML, WRITER_YAML, CITIES_YAML])
def test_yaml_round_trip_is_lossless(text):
    assert Contract.from_yaml(text).to_dict() == yaml.safe_load(text)
    assert yaml.safe_load(Contract.from_yaml(text).to_yaml()) == yaml.safe_load(text)


def test_added_column_must_exist(spark, tmp_path):
    c = Contract.from_dict(SCHEMA_JSON).add_columns({"column4": Column(int, Check.ge(0))})
    path = tmp_path / "schema_with_column4.json"
    c.to_json(str(path))
    again = Contract.from_json(str(path))
    assert "column4" in again.columns and again.columns["column4"].dtype == "int64"
    df = frame(spark, {"column1": [5, 6], "column2": ["a", "b"], "column3": ["2011-01-01", "2011-06-01"],
                       "idx": [0, 1]})
    with pytest.raises(ContractError, match="column4"):
        validate(again, df, index_column="idx")


def test_index_checks_need_a_row_number_column(spark):
    df = frame(spark, {"column1": [5], "column2": ["a"], "column3": ["2011-01-01"]})
    with pytest.raises(ContractError, match="index_column"):
        validate(Contract.from_dict(SCHEMA_JSON), df)


def test_schema_json_coerces_and_checks_index(spark):
    c = Contract.from_dict(SCHEMA_JSON)
    df = frame(spark, {"column1": ["5", "20", "21"], "column2": ["a", None, "c"],
                       "column3": ["2010-01-01 00:00:00", "2011-05-05 00:00:00", "2013-01-01 00:00:00"],
                       "idx": [0, 1, 3]})
    rep = {(r["column"], r["check"]): r["failures"] for r in validate(c, df, "report", index_column="idx").collect()}
    assert rep[("column1", "coerce_dtype('bigint')")] == 0
    assert rep[("column1", "less_than_or_equal_to")] == 1
    assert rep[("column2", "not_nullable")] == 1
    assert rep[("column3", "less_than_or_equal_to")] == 1
    assert rep[("idx", "less_than_or_equal_to")] == 1


def test_employee_pipeline_matches_golden(spark):
    reader, writer = Contract.from_yaml(READER_YAML), Contract.from_yaml(WRITER_YAML)
    data = dict(EMPLOYEES, idx=list(range(5)))
    df = validate(reader, frame(spark, data), index_column="idx")
    assert dict(df.dtypes)["age"] == "smallint"
    out = df.withColumn("tenure_percentage", F.col("tenure") / F.col("age") * 100)
    out = validate(writer, out, index_column="idx")
    path = scratch_path(spark, "employee_tenure")
    validated_write(out.drop("idx").orderBy("name"), writer.with_options(index=()),
                    lambda d: d.coalesce(1).write.option("header", True).csv(path))
    written = "".join(open(os.path.join(path.replace("file:", ""), f)).read()
                      for f in sorted(os.listdir(path.replace("file:", ""))) if f.endswith(".csv"))
    assert written == EMPLOYEE_TENURE_CSV


class Schema(ContractModel):
    state: str = Field(isin=["FL", "CA"])
    city: str = Field(unique=True)
    price: int = Field(in_range={"min_value": 5, "max_value": 20})


def test_class_model_serializes_like_the_yaml():
    assert yaml.safe_load(Schema.to_yaml()) == yaml.safe_load(CITIES_YAML)


@pytest.mark.parametrize("price,ok", [(5, True), (20, True), (21, False), (4, False)])
def test_validate_on_construction(spark, price, ok):
    data = dict(CITIES, price=[price] + CITIES["price"][1:])
    if ok:
        assert typed(data, Schema, spark).count() == 6
    else:
        with pytest.raises(ContractError, match="in_range"):
            typed(data, Schema, spark)


def test_yaml_contract_validates_cities(spark):
    c = Contract.from_yaml(CITIES_YAML)
    assert validate(c, frame(spark, CITIES)).count() == 6
    dup = dict(CITIES, city=["Miami"] * 6)
    with pytest.raises(ContractError, match="unique"):
        validate(c, frame(spark, dup))


CHECK_CASES = [
    (Check.ge(3), [3, 4], [2]), (Check.gt(3), [4], [3]), (Check.le(3), [3, 1], [4]), (Check.lt(3), [2], [3]),
    (Check.eq(3), [3], [4]), (Check.ne(3), [4], [3]),
    (Check.in_range(1, 5), [1, 5], [0, 6]), (Check.in_range(1, 5, False, False), [2, 4], [1, 5]),
    (Check.isin([1, 2]), [1, 2], [3]), (Check.notin([1, 2]), [3], [1]),
]
STR_CASES = [
    (Check.str_startswith("ab"), ["abc"], ["xab"]), (Check.str_endswith("yz"), ["xyz"], ["yzx"]),
    (Check.str_contains("b+c"), ["abbc"], ["ac"]), (Check.str_matches("a.c"), ["abcd"], ["xabc"]),
    (Check.str_length(2, 3), ["ab", "abc"], ["a", "abcd"]),
]


@pytest.mark.parametrize("check,good,bad", CHECK_CASES + STR_CASES)
def test_check_valid_invalid_pairs(spark, check, good, bad):
    c = Contract(columns={"x": Column(None, check)})
    df = spark.createDataFrame([(v,) for v in good + bad], ["x"])
    valid, quarantine = validate(c, df, "quarantine")
    assert sorted(r["x"] for r in valid.collect()) == sorted(good)
    assert sorted(str(r["x"]) for r in quarantine.collect()) == sorted(str(v) for v in bad)


def test_unique_values_eq(spark):
    c = Contract(columns={"x": Column("str", Check.unique_values_eq(["a", "b"]))})
    ok = spark.createDataFrame([("a",), ("b",), ("a",)], ["x"])
    bad = spark.createDataFrame([("a",), ("a",)], ["x"])
    assert validate(c, ok).count() == 3
    with pytest.raises(ContractError):
        validate(c, bad)


def test_nulls_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (9.0,)], "x double")
    strict = Contract(columns={"x": Column("float64", Check.le(5.0))})
    rep = {r["check"]: r["failures"] for r in validate(strict, df, "report").collect()}
    assert rep == {"not_nullable": 2, "less_than_or_equal_to": 1}
    lax = Contract(columns={"x": Column("float64", Check.le(5.0), nullable=True)})
    rep = {r["check"]: r["failures"] for r in validate(lax, df, "report").collect()}
    assert rep == {"less_than_or_equal_to": 1}


@pytest.mark.parametrize("how,expected", [("all", [1, 2, 3, 5, 6]), ("exclude_first", [2, 3, 6]),
                                          ("exclude_last", [1, 2, 5])])
def test_duplicate_report_modes(spark, how, expected):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (4, "b"), (5, "c"), (6, "c")], ["id", "k"])
    got = sorted(r["id"] for r in duplicate_rows(df, ["k"], how, order_by="id").collect())
    assert got == expected
    c = Contract(columns={"k": Column("str", unique=True)}, report_duplicates=how)
    rep = validate(c, df, "report").where("check = 'unique'").first()
    assert rep["failures"] == len(expected)
    valid = validate(c, df, "drop", order_by="id")
    assert sorted(r["id"] for r in valid.collect()) == sorted({1, 2, 3, 4, 5, 6} - set(expected))


def test_joint_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], ["n", "k"])
    c = Contract(columns={"n": Column("int64"), "k": Column("str")}, unique=("n", "k"))
    rep = validate(c, df, "report").where("check = 'unique'").first()
    assert (rep["column"], rep["failures"]) == ("n,k", 2)


def test_quarantine_reasons_and_drop(spark):
    df = frame(spark, INVALID)
    valid, bad = validate(INLINE, df, "quarantine")
    assert valid.count() == 3
    reasons = {r["column2"]: r["_reasons"] for r in bad.collect()}
    assert reasons == {6.0: ["column2:less_than"], 10.1: ["column2:less_than"]}
    assert validate(INLINE.with_options(drop_invalid_rows=True), df).count() == 3


def test_coerce_failures_are_violations(spark):
    df = spark.createDataFrame([("1",), ("70000",), ("x",), (None,)], ["v"])
    c = Contract(columns={"v": Column("int16", coerce=True, nullable=True)})
    valid, bad = validate(c, df, "quarantine")
    assert sorted((r["v"] for r in valid.collect()), key=str) == [1, None]
    assert dict(valid.dtypes)["v"] == "smallint"
    assert sorted(r["v"] for r in bad.collect()) == ["70000", "x"]


def test_structure_checks(spark):
    df = spark.createDataFrame([(1, 2, "x")], ["b_key", "a_key", "extra"])
    c = Contract(strict=True, ordered=True, columns={
        "a_key": Column("int64"), "b_key": Column("int64"), "missing": Column("str")})
    rep = {(r["column"], r["check"]) for r in validate(c, df, "report").where("failures > 0").collect()}
    assert ("missing", "column_in_dataframe") in rep
    assert ("extra", "column_in_schema") in rep
    assert ("b_key,a_key", "column_ordered") in rep
    filtered = validate(c.with_options(strict="filter", ordered=False).remove_columns(["missing"]), df)
    assert filtered.columns == ["b_key", "a_key"]


def test_regex_columns_and_dtype_override(spark):
    df = spark.createDataFrame([(1, -2, "z")], "a_key long, b_key long, name string")
    c = Contract(columns={".*_key": Column("int64", Check.ge(0), regex=True)})
    rep = {(r["column"], r["check"]): r["failures"] for r in validate(c, df, "report").collect()}
    assert rep[("b_key", "greater_than_or_equal_to")] == 1 and rep[("a_key", "greater_than_or_equal_to")] == 0
    wide = Contract(dtype="string", columns={"name": Column("int64")})
    assert validate(wide, df).columns == ["a_key", "b_key", "name"]


def test_add_missing_columns(spark):
    df = spark.createDataFrame([(1,)], ["a"])
    c = Contract(add_missing_columns=True, columns={
        "a": Column("int64"), "b": Column("int32", default=42), "c": Column("str", nullable=True)})
    row = validate(c, df).first()
    assert (row["b"], row["c"]) == (42, None)


def test_dataframe_wide_checks(spark):
    df = spark.createDataFrame([(1, 2), (3, 1)], ["lo", "hi"])
    c = Contract(columns={"lo": Column("int64"), "hi": Column("int64")},
                 checks=(Check.custom(lambda cols: cols.lo <= cols.hi, "ordered_pair"),))
    rep = validate(c, df, "report").where("column = '<dataframe>'").first()
    assert rep["failures"] == 1


def test_guarded_write_writes_nothing_on_failure(spark):
    path = scratch_path(spark, "guard")
    with pytest.raises(ContractError):
        validated_write(frame(spark, INVALID), INLINE, lambda d: d.write.parquet(path))
    assert not os.path.exists(path.replace("file:", ""))


def test_timestamp_bounds_compare_as_timestamps(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2011-05-01 00:00:00' AS t UNION ALL SELECT TIMESTAMP_NTZ '2013-01-01 00:00:00'")
    c = Contract(columns={"t": Column("datetime64[ns]", Check.in_range("2010-01-01 00:00:00", "2012-01-01 00:00:00"))})
    rep = validate(c, df, "report").where("check = 'in_range'").first()
    assert rep["failures"] == 1
    assert not math.isnan(rep["failures"])


def test_add_columns_serializes_like_schema_with_column4():
    from tests.fixtures.contracts import SCHEMA_WITH_COLUMN4_JSON
    c = Contract.from_dict(SCHEMA_JSON).add_columns({"column4": Column(int, Check.ge(0))})
    assert c.to_dict() == SCHEMA_WITH_COLUMN4_JSON
    assert Contract.from_dict(SCHEMA_WITH_COLUMN4_JSON).to_dict() == SCHEMA_WITH_COLUMN4_JSON
    # the source contract is unchanged (contracts are immutable)
    assert "column4" not in Contract.from_dict(SCHEMA_JSON).columns


def test_optional_fields_are_nullable(spark):
    from typing import Optional

    class Person(ContractModel):
        name: str = Field(str_startswith="P")
        age: Optional[int] = Field(ge=0)
        city: str | None = Field()

    c = Person.to_contract()
    assert c.columns["age"].nullable and c.columns["city"].nullable and not c.columns["name"].nullable
    assert c.columns["age"].dtype == "int64"
    df = spark.createDataFrame([("Pia", None, None), ("Pat", 3, "x")], "name string, age long, city string")
    assert Person.validate(df).count() == 2


def test_contract_methods(spark):
    df = frame(spark, VALID)
    assert INLINE(df).count() == 5 and INLINE.validate(df).count() == 5
    assert INLINE.report(frame(spark, INVALID)).where("failures > 0").count() == 1


def test_guarded_write_single_pass(spark):
    from tidewater.contracts import guarded_write
    good_path, bad_path, dup_path = (scratch_path(spark, n) for n in ("g", "b", "d"))
    guarded_write(frame(spark, VALID), INLINE, good_path)
    assert spark.read.parquet(good_path).count() == 5
    with pytest.raises(ContractError, match="less_than failed for 2 rows"):
        guarded_write(frame(spark, INVALID), INLINE, bad_path)
    assert not os.path.exists(bad_path.replace("file:", ""))
    uniq = INLINE.update_column("column1", unique=True)
    with pytest.raises(ContractError, match="unique"):
        guarded_write(frame(spark, dict(VALID, column1=[1, 1, 0, 10, 9])), uniq, dup_path)
    assert not os.path.exists(dup_path.replace("file:", ""))
    leftovers = [n for n in os.listdir(os.path.dirname(dup_path.replace("file:", ""))) if "_staging_" in n]
    assert leftovers == []


def split_counts(contract, df, **kw):
    valid, bad = validate(contract, df, "quarantine", **kw)
    return valid.count(), bad.count()


def test_no_row_vanishes_from_both_outputs(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 500.0)], "k long, v double")
    c = Contract(columns={"v": Column("float64", Check("less_than", 100.0, ignore_na=False), nullable=True)})
    assert split_counts(c, df) == (1, 2)
    assert validate(c, df, "report").where("check = 'less_than'").first()["failures"] == 2
    assert validate(c.with_options(drop_invalid_rows=True), df).count() == 1


@pytest.mark.parametrize("how, bad", [("all", 4), ("exclude_first", 3), ("exclude_last", 3)])
def test_duplicates_with_null_order_values(spark, how, bad):
    df = spark.createDataFrame([("a", 1), ("a", None), ("a", 3), ("a", None), ("b", None)], "k string, o int")
    c = Contract(report_duplicates=how, unique=("k",), columns={"k": Column("str")})
    assert split_counts(c, df, order_by="o") == (5 - bad, bad)


def test_duplicate_reports_at_once(spark):
    from tidewater.contracts import duplicate_reports, duplicate_rows
    df = spark.createDataFrame([(i, i % 3) for i in range(8)], "o int, k int")
    at_once = duplicate_reports(df, ["k"], "o")
    for how in ("all", "exclude_first", "exclude_last"):
        want = duplicate_rows(df, ["k"], how, order_by="o")
        got = at_once.where(f"report = '{how}'").drop("report")
        assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_wrong_dtype_does_not_abort_the_report(spark):
    df = spark.createDataFrame([("abc",), ("5",)], "v string")
    rep = {r["check"]: r["failures"] for r in validate(Contract(columns={"v": Column("int64", Check.lt(3))}), df, "report").collect()}
    assert rep == {"dtype('bigint')": 1, "not_nullable": 0, "less_than": 1}


def test_required_pattern_without_a_match(spark):
    df = spark.createDataFrame([(1,)], "v int")
    c = Contract(columns={"x_.*": Column("int64", regex=True)})
    assert [(r["column"], r["check"]) for r in validate(c, df, "report").collect()] == [("x_.*", "column_in_dataframe")]
    optional = Contract(columns={"x_.*": Column("int64", regex=True, required=False)})
    assert validate(optional, df).count() == 1


def test_saving_keeps_everything_or_refuses(tmp_path):
    c = Contract(drop_invalid_rows=True, metadata={"owner": "x"}, columns={
        "a": Column("int64", [Check.ne(7), Check.ne(9), Check("ge", 1, ignore_na=False)], default=3, metadata={"unit": "m"})})
    for back in (Contract.from_json(c.to_json()), Contract.from_yaml(c.to_yaml())):
        assert back == c
    with pytest.raises(ValueError, match="can't be saved"):
        Contract(columns={"a": Column("int64", Check.custom(lambda x: x > 0, "positive"))}).to_json()


def test_contract_files_through_the_session(spark):
    path = f"{scratch_path(spark, 'saved')}.yaml"
    INLINE_LIKE = Contract(name="n", columns={"a": Column("int64", Check.ge(0))})
    INLINE_LIKE.to_yaml(path)
    assert Contract.from_yaml(path) == INLINE_LIKE


def test_pandas_on_spark_frames(spark):
    import pyspark.pandas as ps

    class Cities(ContractModel):
        city: str = Field(str_startswith="C")
        price: int = Field(in_range={"min_value": 5, "max_value": 20})

    frame_ = ps.DataFrame({"city": ["Cork", "Cadiz"], "price": [8, 12]})
    assert typed(frame_, Cities).count() == 2
    assert Cities.validate(frame_).columns == ["city", "price"]
    with pytest.raises(ContractError):
        Cities.validate(ps.DataFrame({"city": ["Cork"], "price": [99]}))
