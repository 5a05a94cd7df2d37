"""Entitlements as a table: rows decide, versions replace each other, plans that get round them are found."""

import pytest
from pyspark.sql import functions as F

from riskpipe.operators import entitlements as E
from riskpipe.operators import governance as G

ROWS = [("p1", "Colorado", "12345.00"), ("p2", "Utah", "25999.99"), ("p3", "Other States", "70001.00"), ("p4", None, "5.00"), ("p5", "Utah", None)]


@pytest.fixture()
def matrix(spark, scratch):
    df = spark.createDataFrame(ROWS, "policy_number string, customer_state string, a string")
    path = f"{scratch}/matrix"
    df.select("policy_number", "customer_state", F.col("a").cast("decimal(10,2)").alias("claim_amount_filled")).write.parquet(path)
    return path, spark.read.parquet(path)


@pytest.fixture()
def table(spark, scratch):
    t = E.Entitlements(spark, f"{scratch}/entitlements")
    t.publish(spark.createDataFrame(E.default_rows(), E.SCHEMA))
    return t


def _seen(df):
    return {tuple(None if v is None else str(v) for v in r) for r in df.collect()}


@pytest.mark.parametrize("ctx", [G.ADMIN, G.ANALYST, G.CONSUMER, G.OTHER, G.AccessContext(None, None), G.AccessContext("ACCOUNTADMIN", "X_CONSUMER")])
def test_default_rows_are_the_policies(matrix, table, ctx):
    assert _seen(E.governed(matrix[1], ctx, table.read())) == _seen(G.governed(matrix[1], ctx))


def test_a_role_is_a_row(spark, matrix, table):
    desk = G.AccessContext("UTAH_DESK", "MAIN")
    assert not _seen(E.governed(matrix[1], desk, table.read()))
    before = table.versions()[-1]
    table.grant(("UTAH_DESK", None, "Utah", 5000))
    assert _seen(E.governed(matrix[1], desk, table.read())) == {("p2", "Utah", "25000.00"), ("p5", "Utah", None)}
    assert not _seen(E.governed(matrix[1], desk, table.read(before)))
    table.revoke(F.col("role") == "UTAH_DESK")
    assert not _seen(E.governed(matrix[1], desk, table.read()))
    assert _seen(E.governed(matrix[1], G.ANALYST, table.read())) == _seen(G.governed(matrix[1], G.ANALYST))
    assert not _seen(E.governed(matrix[1], G.AccessContext("UTAHXDESK", "MAIN"), table.read(before + 1)))
    with pytest.raises(ValueError):
        table.read(99)


def test_finest_mask_of_all_that_fit(spark, matrix, table):
    table.grant(("PIPELINE_ANALYST", None, "Utah", None), ("AUDIT", None, None, 50000), ("AUDIT", None, "Colorado", 100))
    assert ("p2", "Utah", "25999.99") in _seen(E.governed(matrix[1], G.ANALYST, table.read()))
    audit = _seen(E.governed(matrix[1], G.AccessContext("AUDIT", None), table.read()))
    assert audit == {("p1", "Colorado", "12300.00"), ("p2", "Utah", "0.00"), ("p3", "Other States", "50000.00"), ("p4", None, "0.00"), ("p5", "Utah", None)}


@pytest.mark.parametrize("limit", ["BROADCAST_STATES", "PUSHED_STATES"])
def test_beyond_the_limits(monkeypatch, matrix, table, limit):
    want = _seen(E.governed(matrix[1], G.ANALYST, table.read()))
    monkeypatch.setattr(E, limit, 0)
    assert _seen(E.governed(matrix[1], G.ANALYST, table.read())) == want


def test_no_version_no_rows(spark, scratch, matrix):
    assert not _seen(E.governed(matrix[1], G.ADMIN, E.Entitlements(spark, f"{scratch}/none").read()))


def test_second_publisher_of_a_version_fails(spark, scratch, table, monkeypatch):
    late = E.Entitlements(spark, table.path)
    seen = late.versions()
    table.grant(("A", None, "Utah", 1))
    monkeypatch.setattr(late, "versions", lambda: seen)
    with pytest.raises(RuntimeError):
        late.grant(("B", None, "Utah", 1))
    assert table.read().where("role = 'B'").isEmpty() and not table.read().where("role = 'A'").isEmpty()


def test_bypasses(spark, matrix, table):
    path, df = matrix
    g = E.governed(df, G.ANALYST, table.read())
    assert E.bypasses(g, path, table) == []
    assert E.bypasses(g.groupBy("customer_state").agg(F.max("claim_amount_filled")), path, table) == []
    assert len(E.bypasses(df, path, table)) == 2
    assert E.bypasses(df.select("policy_number"), path, table) == [f"scan of {path} without the entitlements"]
    back = g.select("policy_number").join(df, "policy_number")
    assert "claim_amount_filled of " + path + " without its mask" in E.bypasses(back, path, table)
    g.createOrReplaceTempView("entitled_matrix")
    assert E.bypasses(spark.sql("SELECT policy_number FROM entitled_matrix"), path, table) == []
