"""Every registered plan against its DuckDB oracle at sf0.001 (rows-only where no SQL)."""

import pytest

import __spark_entry__ as entry
from tidewater.plans.oracle import compare, duckdb_views

from tests.conftest import SF_SMALL

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duckdb_views(SF_SMALL)


def test_every_oracle_has_a_plan():
    assert set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["user_id", "bucket_start", "events", "fail_event"]


# Spark simple type -> DuckDB result type of the same values.
DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE",
              "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
              "boolean": "BOOLEAN", "float": "FLOAT", "date": "DATE", "binary": "BLOB"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = df.collect()
    if name not in SQL:
        assert len(rows) > 0
        return
    rel = duck.sql(SQL[name])
    diff = compare(df.columns, rows, rel.columns, rel.fetchall())
    assert diff is None, diff
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    mismatched = [(c, t, duck_types[c]) for c, t in df.dtypes if DUCK_TYPES.get(t, t) != duck_types[c]]
    assert not mismatched, mismatched
