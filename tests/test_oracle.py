"""Every registered query against its DuckDB twin on sf0.001 (rows-only where no SQL)."""

import duckdb
import pytest

import __spark_entry__ as E
from scripts import compare_oracle
from scripts.compare_oracle import TABLES, rows_of

compare_oracle.EXACT = True   # values must agree bit for bit, floats included

SF = "/root/testdata/sf0.001"
PLAIN = E._catalog().QUERIES   # the training-data queries have tests of their own
@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", [n for n in E.queries() if n in PLAIN])
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF).toPandas()
    sql = E.oracle_sql()[name]   # every query of the reference's operators has one
    want = duck.sql(sql).df()
    c1, r1 = rows_of(got)
    c2, r2 = rows_of(want)
    assert c1 == c2
    assert r1 == r2


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["customer_state", "customer_count", "avg_risk_score", "high_risk_count", "avg_claim_amount"]
    assert df.count() > 0
