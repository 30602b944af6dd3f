"""Contract-validation plans over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.contracts import Check, Column, Contract, ContractModel, Field, duplicate_reports, guarded_write, validate
from tidewater.contracts.schema import IndexSpec
from tidewater.functions.indexing import with_row_index
from tidewater.plans.registry import plan, table
from tidewater.session import scratch_path

LINEITEM_CONTRACT = Contract(name="lineitem", columns={
    "l_orderkey": Column("int64"),
    "l_linenumber": Column("int32", [Check.ge(1), Check.le(7)]),
    "l_quantity": Column("float64", Check.in_range(1, 50)),
    "l_discount": Column("float64", Check.in_range(0.0, 0.1)),
    "l_tax": Column("float64", Check.le(0.06)),
    "l_extendedprice": Column("float64", Check.gt(1000.0)),
    "l_returnflag": Column("str", Check.isin(["A", "N", "R"])),
    "l_linestatus": Column("str", Check.isin(["F", "O"])),
    "l_shipdate": Column("datetime64[ns]", Check.in_range("1995-01-01 00:00:00", "1999-12-31 00:00:00",
                                                          include_max=False)),
})


@plan("validate_report_lineitem", "V1 V3 V8 V9 V10", """
SELECT "column", "check", CAST(failures AS BIGINT) AS failures FROM (
SELECT * FROM (
  SELECT 'l_orderkey' AS "column", 'not_nullable' AS "check", count_if(l_orderkey IS NULL) AS failures FROM lineitem
  UNION ALL SELECT 'l_linenumber', 'not_nullable', count_if(l_linenumber IS NULL) FROM lineitem
  UNION ALL SELECT 'l_linenumber', 'greater_than_or_equal_to', count_if(l_linenumber < 1) FROM lineitem
  UNION ALL SELECT 'l_linenumber', 'less_than_or_equal_to', count_if(l_linenumber > 7) FROM lineitem
  UNION ALL SELECT 'l_quantity', 'not_nullable', count_if(l_quantity IS NULL OR isnan(l_quantity)) FROM lineitem
  UNION ALL SELECT 'l_quantity', 'in_range', count_if(NOT (l_quantity >= 1 AND l_quantity <= 50)) FROM lineitem
  UNION ALL SELECT 'l_discount', 'not_nullable', count_if(l_discount IS NULL OR isnan(l_discount)) FROM lineitem
  UNION ALL SELECT 'l_discount', 'in_range', count_if(NOT (l_discount >= 0.0 AND l_discount <= 0.1)) FROM lineitem
  UNION ALL SELECT 'l_tax', 'not_nullable', count_if(l_tax IS NULL OR isnan(l_tax)) FROM lineitem
  UNION ALL SELECT 'l_tax', 'less_than_or_equal_to', count_if(l_tax > 0.06) FROM lineitem
  UNION ALL SELECT 'l_extendedprice', 'not_nullable', count_if(l_extendedprice IS NULL OR isnan(l_extendedprice)) FROM lineitem
  UNION ALL SELECT 'l_extendedprice', 'greater_than', count_if(l_extendedprice <= 1000.0) FROM lineitem
  UNION ALL SELECT 'l_returnflag', 'not_nullable', count_if(l_returnflag IS NULL) FROM lineitem
  UNION ALL SELECT 'l_returnflag', 'isin', count_if(l_returnflag NOT IN ('A', 'N', 'R')) FROM lineitem
  UNION ALL SELECT 'l_linestatus', 'not_nullable', count_if(l_linestatus IS NULL) FROM lineitem
  UNION ALL SELECT 'l_linestatus', 'isin', count_if(l_linestatus NOT IN ('F', 'O')) FROM lineitem
  UNION ALL SELECT 'l_shipdate', 'not_nullable', count_if(l_shipdate IS NULL) FROM lineitem
  UNION ALL SELECT 'l_shipdate', 'in_range', count_if(NOT (l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1999-12-31')) FROM lineitem
)
)
""")
def validate_report_lineitem(spark, sf):
    return validate(LINEITEM_CONTRACT, table(spark, sf, "lineitem"), "report")


@plan("validate_unique", "V7", """
WITH c AS (SELECT o_orderkey, o_custkey, count(*) OVER (PARTITION BY o_custkey) AS n,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders)
SELECT 'all' AS report, o_orderkey, o_custkey FROM c WHERE n > 1
UNION ALL SELECT 'exclude_first', o_orderkey, o_custkey FROM c WHERE n > 1 AND rn > 1
UNION ALL SELECT 'exclude_last', o_orderkey, o_custkey FROM c WHERE n > 1 AND rn < n
""")
def validate_unique(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return duplicate_reports(orders, ["o_custkey"], "o_orderkey")


@plan("validate_quarantine", "V16 V1", """
SELECT *, concat_ws(',',
    CASE WHEN NOT (l_quantity >= 1 AND l_quantity <= 50) THEN 'l_quantity:in_range' END,
    CASE WHEN NOT (l_discount >= 0.0 AND l_discount <= 0.1) THEN 'l_discount:in_range' END,
    CASE WHEN l_tax > 0.06 THEN 'l_tax:less_than_or_equal_to' END,
    CASE WHEN l_extendedprice <= 1000.0 THEN 'l_extendedprice:greater_than' END,
    CASE WHEN NOT (l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1999-12-31') THEN 'l_shipdate:in_range' END
  ) AS reasons
FROM lineitem
WHERE l_tax > 0.06 OR l_extendedprice <= 1000.0 OR NOT (l_quantity >= 1 AND l_quantity <= 50)
   OR NOT (l_discount >= 0.0 AND l_discount <= 0.1)
   OR NOT (l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1999-12-31')
""")
def validate_quarantine(spark, sf):
    _, bad = validate(LINEITEM_CONTRACT, table(spark, sf, "lineitem"), "quarantine")
    return bad.withColumn("reasons", F.concat_ws(",", "_reasons")).drop("_reasons")


NULLS_CONTRACT = Contract(name="nulls", report_duplicates="exclude_first", unique=("user_id",), columns={
    "event_id": Column("int64"),
    "score": Column("float64", Check("less_than_or_equal_to", 400.0, ignore_na=False), nullable=True),
})


@plan("validate_quarantine_nulls", "V16 V7 V3", """
WITH e AS (SELECT event_id, user_id, CASE WHEN event_type = 'signup' THEN NULL ELSE value END AS score,
                  CASE WHEN event_type = 'click' THEN NULL ELSE event_id END AS seq FROM events),
g AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n, min(seq) OVER (PARTITION BY user_id) AS lo FROM e)
SELECT event_id, user_id, score, seq, concat_ws(',', CASE WHEN score IS NULL OR score > 400.0 THEN 'score:less_than_or_equal_to' END,
         CASE WHEN n > 1 AND (seq IS NULL OR lo IS NULL OR seq <> lo) THEN 'user_id:unique' END) AS reasons FROM g
""")
def validate_quarantine_nulls(spark, sf):
    """Valid and quarantined rows together are the input: nulls that a check sees, null order values and all."""
    ev = table(spark, sf, "events")
    rows = ev.select("event_id", "user_id", F.when(F.col("event_type") != "signup", F.col("value")).alias("score"),
                     F.when(F.col("event_type") != "click", F.col("event_id")).alias("seq"))
    good, bad = validate(NULLS_CONTRACT, rows, "quarantine", order_by="seq")
    return good.withColumn("reasons", F.lit("")).unionByName(
        bad.withColumn("reasons", F.array_join("_reasons", ",")).drop("_reasons"))


COERCE_CONTRACT = Contract(coerce=True, columns={
    "event_id": Column("int64"),
    "k": Column("int16", Check.ge(0)),
    "k_scaled": Column("int16"),
})


@plan("validate_coerce", "V2 F16", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS SMALLINT) AS k,
       TRY_CAST(CAST(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) * 1000 AS VARCHAR) AS SMALLINT) AS k_scaled
FROM events
WHERE TRY_CAST(json_extract_string(props, '$.k') AS SMALLINT) IS NOT NULL
  AND TRY_CAST(CAST(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) * 1000 AS VARCHAR) AS SMALLINT) IS NOT NULL
""")
def validate_coerce(spark, sf):
    k = F.get_json_object("props", "$.k")
    raw = table(spark, sf, "events").select(
        "event_id", k.alias("k"), (k.try_cast("bigint") * 1000).cast("string").alias("k_scaled"))
    return validate(COERCE_CONTRACT, raw, "drop")


@plan("validate_custom", "V11 V12 V13 F5 F6", """
SELECT "column", "check", CAST(failures AS BIGINT) AS failures FROM (
SELECT 'c_name' AS "column", 'not_nullable' AS "check", count_if(c_name IS NULL) AS failures FROM customer
UNION ALL SELECT 'c_name', 'str_startswith', count_if(NOT starts_with(c_name, 'Customer#')) FROM customer
UNION ALL SELECT 'c_name', 'two_parts', CASE WHEN max(len(string_split(c_name, '#'))) = 2 THEN 0 ELSE 1 END FROM customer
UNION ALL SELECT 'c_acctbal', 'not_nullable', count_if(c_acctbal IS NULL OR isnan(c_acctbal)) FROM customer
UNION ALL SELECT '<dataframe>', 'machinery_in_credit', count_if(c_mktsegment = 'MACHINERY' AND c_acctbal < 0) FROM customer
UNION ALL SELECT 'p_name', 'not_nullable', count_if(p_name IS NULL) FROM part
UNION ALL SELECT 'p_name', 'two_words', count_if(len(string_split(p_name, ' ')) <> 2) FROM part
UNION ALL SELECT '<dataframe>', 'price_covers_size', count_if(NOT (p_retailprice >= 900 + p_size)) FROM part
)
""")
def validate_custom(spark, sf):
    customer_contract = Contract(
        columns={
            "c_name": Column("str", [Check.str_startswith("Customer#"),
                                     Check.custom(lambda c: F.max(F.size(F.split(c, "#"))) == 2,
                                                  "two_parts", aggregate=True)]),
            "c_acctbal": Column("float64"),
        },
        checks=(Check.custom(lambda cols: ~((cols.c_mktsegment == "MACHINERY") & (cols.c_acctbal < 0)),
                             "machinery_in_credit"),))
    part_contract = Contract(
        columns={"p_name": Column("str", Check.custom(lambda c: F.size(F.split(c, " ")) == 2, "two_words"))},
        checks=(Check.custom(lambda cols: cols.p_retailprice >= F.lit(900) + cols.p_size, "price_covers_size"),))
    a = validate(customer_contract, table(spark, sf, "customer"), "report")
    b = validate(part_contract, table(spark, sf, "part"), "report")
    return a.unionByName(b)


STRUCTURE_CONTRACT = Contract(
    strict=True, ordered=True, unique_column_names=True,
    columns={
        "c_.*key": Column("int64", Check.ge(0), regex=True),
        "c_name": Column("str", Check.str_length(18, 18)),
        "c_phone": Column("str"),
        "c_acctbal": Column("float64", Check.ge(0.0)),
    })


@plan("validate_structure", "V4 V5 V6 V14 V17", """
SELECT "column", "check", CAST(failures AS BIGINT) AS failures FROM (
SELECT * FROM (VALUES ('c_phone', 'column_in_dataframe', 1), ('c_mktsegment', 'column_in_schema', 1),
                      ('c_nationkey', 'dtype(''bigint'')', 1),
                      ('c_custkey,c_name,c_nationkey,c_acctbal', 'column_ordered', 1)) t("column", "check", failures)
UNION ALL SELECT 'c_custkey', 'not_nullable', count_if(c_custkey IS NULL) FROM customer
UNION ALL SELECT 'c_custkey', 'greater_than_or_equal_to', count_if(c_custkey < 0) FROM customer
UNION ALL SELECT 'c_nationkey', 'not_nullable', count_if(c_nationkey IS NULL) FROM customer
UNION ALL SELECT 'c_nationkey', 'greater_than_or_equal_to', count_if(c_nationkey < 0) FROM customer
UNION ALL SELECT 'c_name', 'not_nullable', count_if(c_name IS NULL) FROM customer
UNION ALL SELECT 'c_name', 'str_length', count_if(NOT (length(c_name) >= 18 AND length(c_name) <= 18)) FROM customer
UNION ALL SELECT 'c_acctbal', 'not_nullable', count_if(c_acctbal IS NULL OR isnan(c_acctbal)) FROM customer
UNION ALL SELECT 'c_acctbal', 'greater_than_or_equal_to', count_if(c_acctbal < 0) FROM customer
)
""")
def validate_structure(spark, sf):
    return validate(STRUCTURE_CONTRACT, table(spark, sf, "customer"), "report")


@plan("validate_wrong_dtype", "V2 V1 V14", """
SELECT "column", "check", CAST(failures AS BIGINT) AS failures FROM (
SELECT * FROM (VALUES ('n_name', 'dtype(''bigint'')', 1), ('x_.*', 'column_in_dataframe', 1)) t("column", "check", failures)
UNION ALL SELECT 'n_name', 'not_nullable', count_if(n_name IS NULL) FROM nation
UNION ALL SELECT 'n_name', 'greater_than_or_equal_to', coalesce(count_if(TRY_CAST(n_name AS BIGINT) < 0), 0) FROM nation
UNION ALL SELECT 'n_regionkey', 'not_nullable', count_if(n_regionkey IS NULL) FROM nation
UNION ALL SELECT 'n_regionkey', 'less_than', count_if(n_regionkey >= 3) FROM nation)
""")
def validate_wrong_dtype(spark, sf):
    """A text column declared a number is one failure and the report goes on; so is a required pattern without a match."""
    contract = Contract(columns={"n_name": Column("int64", Check.ge(0)), "n_regionkey": Column(checks=Check.lt(3)),
                                 "x_.*": Column("int64", regex=True)})
    return validate(contract, table(spark, sf, "nation"), "report")


@plan("validate_dtype_override", "V17 V18", """
SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey, 'geography' AS owner,
       'key' AS kind FROM nation
""")
def validate_dtype_override(spark, sf):
    """One dtype for the whole frame, which overrides the columns' own, and metadata that a saved contract keeps."""
    contract = Contract(dtype="str", coerce=True, strict="filter", metadata={"owner": "geography"}, columns={
        "n_nationkey": Column("int64", metadata={"kind": "key"}), "n_name": Column("str"), "n_regionkey": Column("int32")})
    contract = Contract.from_yaml(contract.to_yaml())
    out = validate(contract, table(spark, sf, "nation"))
    return out.withColumns({"owner": F.lit(contract.metadata["owner"]),
                            "kind": F.lit(contract.columns["n_nationkey"].metadata["kind"])})


@plan("validate_add_missing", "V15 V5", """
SELECT r_regionkey, r_name, 'none' AS remark, CAST(NULL AS DOUBLE) AS area, CAST(7 AS BIGINT) AS grade FROM region
""")
def validate_add_missing(spark, sf):
    """Declared columns that the frame lacks are added with their default or null; undeclared ones are filtered out."""
    contract = Contract(add_missing_columns=True, strict="filter", columns={
        "r_regionkey": Column(), "r_name": Column("str"), "remark": Column("str", default="none"),
        "area": Column("float64", nullable=True), "grade": Column("int64", Check.ge(0), default=7)})
    return validate(contract, table(spark, sf, "region").withColumn("undeclared", F.lit(1)))


@plan("contract_saved", "V18 V2", """
SELECT "column", "check", CAST(failures AS BIGINT) AS failures FROM (
SELECT 'p_size' AS "column", 'not_nullable' AS "check", count_if(p_size IS NULL) AS failures FROM part
UNION ALL SELECT 'p_size', 'not_equal_to', count_if(p_size = 7) FROM part
UNION ALL SELECT 'p_size', 'not_equal_to', count_if(p_size = 9) FROM part
UNION ALL SELECT 'half', 'greater_than', count_if(p_size % 2 = 1 OR p_size < 4) FROM part)
""")
def contract_saved(spark, sf):
    """Two checks of one name and one that sees nulls, after a round trip through a JSON file on the shared folder."""
    contract = Contract(name="part", columns={
        "p_size": Column(checks=[Check.ne(7), Check.ne(9)]),
        "half": Column("int64", Check("greater_than", 1, ignore_na=False), nullable=True)})
    path = f"{scratch_path(spark, 'contract')}.json"
    contract.to_json(path)
    halves = table(spark, sf, "part").withColumn("half", F.when(F.col("p_size") % 2 == 0, F.expr("p_size div 2")))
    return validate(Contract.from_json(path), halves, "report")


ROW_NUMBER_CONTRACT = Contract(
    columns={"o_orderkey": Column("int64")},
    index=(IndexSpec("int64", (Check.ge(0), Check.le(9999))),))


@plan("validate_row_number", "V22", """
SELECT "column", "check", CAST(failures AS BIGINT) AS failures FROM (
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_index FROM orders)
SELECT 'o_orderkey' AS "column", 'not_nullable' AS "check", count_if(o_orderkey IS NULL) AS failures FROM r
UNION ALL SELECT 'row_index', 'not_nullable', count_if(row_index IS NULL) FROM r
UNION ALL SELECT 'row_index', 'greater_than_or_equal_to', count_if(row_index < 0) FROM r
UNION ALL SELECT 'row_index', 'less_than_or_equal_to', count_if(row_index > 9999) FROM r
)
""")
def validate_row_number(spark, sf):
    orders = with_row_index(table(spark, sf, "orders").select("o_orderkey"), "row_index", ["o_orderkey"])
    return validate(ROW_NUMBER_CONTRACT, orders, "report", index_column="row_index")


ORDERS_READER = Contract(name="orders_reader", coerce=True, columns={
    "o_orderkey": Column("int64", unique=True),
    "o_custkey": Column("int64"),
    "o_orderstatus": Column("str", Check.isin(["F", "O", "P"])),
})
OPEN_SHARE_WRITER = Contract(name="open_share_writer", strict="filter", columns={
    "o_custkey": Column("int64", unique=True),
    "n_orders": Column("int64", Check.ge(1)),
    "n_open": Column("int64", Check.ge(0)),
    "open_percentage": Column("float64", Check.in_range(0.0, 100.0)),
})


@plan("contract_pipeline", "V21 T5 K14", """
SELECT o_custkey, count(*) AS n_orders, CAST(count_if(o_orderstatus = 'O') AS BIGINT) AS n_open,
       count_if(o_orderstatus = 'O') / count(*) * 100 AS open_percentage
FROM orders GROUP BY o_custkey
""")
def contract_pipeline(spark, sf):
    orders = validate(ORDERS_READER, table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"))
    derived = (orders.groupBy("o_custkey")
               .agg(F.count(F.lit(1)).alias("n_orders"),
                    F.count_if(F.col("o_orderstatus") == "O").alias("n_open"))
               .withColumn("open_percentage", F.col("n_open") / F.col("n_orders") * 100))
    path = scratch_path(spark, "open_share")
    guarded_write(derived, OPEN_SHARE_WRITER, path)
    return spark.read.parquet(path)


class CustomerModel(ContractModel):
    c_custkey: int = Field(ge=0, unique=True)
    c_name: str = Field(str_startswith="Customer#")
    c_acctbal: float = Field(in_range={"min_value": -999.99, "max_value": 9999.99})
    c_mktsegment: str = Field(isin=["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"])

    class Config:
        strict = "filter"


@plan("contract_model", "V18 V19 V20", """
SELECT "column", "check", CAST(failures AS BIGINT) AS failures FROM (
SELECT 'c_custkey' AS "column", 'not_nullable' AS "check", count_if(c_custkey IS NULL) AS failures FROM customer
UNION ALL SELECT 'c_custkey', 'greater_than_or_equal_to', count_if(c_custkey < 0) FROM customer
UNION ALL SELECT 'c_name', 'not_nullable', count_if(c_name IS NULL) FROM customer
UNION ALL SELECT 'c_name', 'str_startswith', count_if(NOT starts_with(c_name, 'Customer#')) FROM customer
UNION ALL SELECT 'c_acctbal', 'not_nullable', count_if(c_acctbal IS NULL OR isnan(c_acctbal)) FROM customer
UNION ALL SELECT 'c_acctbal', 'in_range', count_if(NOT (c_acctbal >= -999.99 AND c_acctbal <= 9999.99)) FROM customer
UNION ALL SELECT 'c_mktsegment', 'not_nullable', count_if(c_mktsegment IS NULL) FROM customer
UNION ALL SELECT 'c_mktsegment', 'isin', count_if(c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')) FROM customer
UNION ALL SELECT 'c_nationkey', 'not_nullable', count_if(c_nationkey IS NULL) FROM customer
UNION ALL SELECT 'c_nationkey', 'in_range', count_if(NOT (c_nationkey >= 0 AND c_nationkey <= 24)) FROM customer
UNION ALL SELECT 'c_custkey', 'unique', coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM customer GROUP BY c_custkey HAVING count(*) > 1)
)
""")
def contract_model(spark, sf):
    # Class-style declaration -> YAML -> contract, then evolve it with one more column.
    contract = Contract.from_yaml(CustomerModel.to_yaml())
    contract = contract.add_columns({"c_nationkey": Column("int32", Check.in_range(0, 24))})
    return validate(contract, table(spark, sf, "customer"), "report")


@plan("validate_drop_lineitem", "V16 V1 A1", """
SELECT l_returnflag, l_linestatus, count(*) AS lines,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM lineitem
WHERE l_quantity >= 1 AND l_quantity <= 50 AND l_discount >= 0.0 AND l_discount <= 0.1 AND l_tax <= 0.06
  AND l_extendedprice > 1000.0 AND l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1999-12-31'
  AND l_returnflag IN ('A', 'N', 'R') AND l_linestatus IN ('F', 'O') AND l_linenumber BETWEEN 1 AND 7
GROUP BY 1, 2
""")
def validate_drop_lineitem(spark, sf):
    """Drop invalid rows (lazy filter, no extra job) and aggregate what remains."""
    valid = validate(LINEITEM_CONTRACT.with_options(drop_invalid_rows=True), table(spark, sf, "lineitem"))
    return valid.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("revenue"))
