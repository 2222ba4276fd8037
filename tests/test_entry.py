import os
import sys

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))
import check_oracle as check  # noqa: E402

TABLES = check.TABLES


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["skill", "posts", "rank"] and len(rows) > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_equals_sql_twin(spark, duck, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.sql(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    cols, got_rows = check.rows(got)
    _, want_rows = check.rows(want)
    assert got_rows == want_rows
