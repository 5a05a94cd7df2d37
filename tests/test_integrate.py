import datetime as dt
import re
from decimal import Decimal

from pyspark.sql import functions as F

from riskpipe.operators import integrate as I
from riskpipe.sources import schemas as S

T0 = dt.datetime(2020, 1, 1)
T1 = dt.datetime(2021, 1, 1)


def customers(spark, rows):
    full = [(p, a, None, None, None, Decimal("1000.00"), "M", "College", "x", T0, "INITIAL_LOAD") for p, a in rows]
    return spark.createDataFrame(full, S.CUSTOMER_RAW)


def claims(spark, rows, load=T1):
    full = [(p, None, None, None, None, None, None, None, None, None, amt, fr, load, "f") for p, amt, fr in rows]
    return spark.createDataFrame(full, S.CLAIMS_RAW)


def test_left_join_semantics(spark):
    c = customers(spark, [("a", 30), ("b", 50), (None, 40), ("d", None)])
    cl = claims(spark, [("a", Decimal("80000.00"), True), ("a", Decimal("100.00"), False),
                        ("z", Decimal("5.00"), False), (None, Decimal("1.00"), True)])
    out = I.integrate(c, cl, hot=[]).collect()
    by = {}
    for r in out:
        by.setdefault(r.policy_number, []).append(r)
    assert len(by["a"]) == 2                         # fan-out
    assert all(r.has_claim == 1 and r.last_updated == T1 for r in by["a"])
    assert by["b"][0].has_claim == 0 and by["b"][0].claim_amount_filled == Decimal("0.00")
    assert by["b"][0].fraud_reported_filled is False and by["b"][0].last_updated == T0
    assert len(by[None]) == 1 and by[None][0].has_claim == 0   # NULL keys never match
    assert by[None][0].customer_state == "Other States"
    assert "z" not in by                              # orphan claim dropped
    assert len(out) == 5


def _as_set(df):
    return sorted(tuple(r) for r in df.select(*I.LEVEL1_COLUMNS).collect())


def test_salted_hot_keys_equal_plain_join(spark):
    cust = customers(spark, [(str(i), 20 + i % 50) for i in range(40)] + [("hot", 33), ("hot", 44)])
    rows = [("hot", Decimal(i), i % 3 == 0) for i in range(300)] + \
           [(str(i % 40), Decimal(i * 10), False) for i in range(200)] + [("orphan", Decimal(1), True)]
    cl = claims(spark, rows)
    plain = _as_set(I.integrate(cust, cl, hot=[]))
    given = _as_set(I.integrate(cust, cl, hot=[("hot", 7), ("3", 2)]))
    auto_hot = I.detect_hot_keys(cl, cfg=I.SkewConfig(sample_fraction=1.0, rows_per_task=50)).collect()
    assert [r._hot_key for r in auto_hot] == ["hot"] and auto_hot[0]._n_salts == 6
    auto = _as_set(I.integrate(cust, cl, skew=I.SkewConfig(sample_fraction=1.0, rows_per_task=50)))
    assert plain == given == auto
    assert len(plain) == 2 * 300 + 200 + 0


def test_every_hot_key_is_listed(spark):
    cl = claims(spark, [(str(i % 20), Decimal(1), False) for i in range(2000)])
    hot = I.detect_hot_keys(cl, cfg=I.SkewConfig(sample_fraction=1.0, rows_per_task=10))
    assert hot.count() == 20 and hot.where("_n_salts = 10").count() == 20
    assert I.detect_hot_keys(cl, cfg=I.SkewConfig(mode="off")).isEmpty()


def test_equal_claims_spread_over_all_salts(spark, scratch):
    path = f"{scratch}/claims"
    claims(spark, [("hot", Decimal(1), False)] * 10_000).repartition(4).write.parquet(path)
    rows = I.with_locator(spark.read.parquet(path)).select(F.pmod("_row", F.lit(16)).alias("salt"))
    sizes = [r["count"] for r in rows.groupBy("salt").count().collect()]
    assert len(sizes) == 16 and min(sizes) > 400


def test_level2_plan_is_jvm_only(spark):
    from riskpipe.plans import catalog
    plan = catalog.level2(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_adapter_expected_counts(spark):
    """FIXTURES §3 figures at sf0.01."""
    from riskpipe.plans import catalog
    m = catalog.level2(spark, "/root/testdata/sf0.01")
    r = m.agg(F.count("*").alias("n"), F.sum("total_risk_score").alias("s"),
              F.count_distinct("policy_number").alias("p")).first()
    assert (r.n, r.s, r.p) == (12222, 630335, 1492)
    lv = dict(m.groupBy("risk_level").count().collect())
    assert lv == {"HIGH": 2745, "MEDIUM": 4829, "LOW": 4648}
    st = dict(m.groupBy("customer_state").count().collect())
    assert st == {"Colorado": 3824, "Other States": 3742, "Wyoming": 2512, "Utah": 2144}


def test_auto_salting_on_adapter_data_matches_plain(spark):
    """With a tiny rows-per-task target every busy policy of the test data is 'hot':
    the salted plan must still give exactly the plain left join."""
    from riskpipe.plans import catalog
    cust, claims = catalog.raw(spark, "/root/testdata/sf0.001")
    hot = I.detect_hot_keys(claims, cfg=I.SkewConfig(sample_fraction=1.0, rows_per_task=3))
    assert not hot.isEmpty()
    salted = I.integrate(cust, claims, hot=hot).select(*I.LEVEL1_COLUMNS)
    plain = I.integrate(cust, claims, hot=[]).select(*I.LEVEL1_COLUMNS)
    assert salted.count() == plain.count()
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_listed_key_without_claims_keeps_its_customer(spark):
    cust = customers(spark, [("a", 30), ("nohit", 40)])
    cl = claims(spark, [("a", Decimal(i), False) for i in range(20)])
    out = I.integrate(cust, cl, hot=[("a", 4), ("nohit", 4)])
    assert out.where("policy_number = 'nohit' AND has_claim = 0").count() == 1
    assert out.where("policy_number = 'a'").count() == 20


def test_salted_scan_reads_needed_columns_only(spark):
    from riskpipe.plans import catalog
    df = catalog.salted_level1(spark, "/root/testdata/sf0.001").select("customer_state", "claim_amount_filled")
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
    orders = [x for x in scans if "o_custkey" in x]
    assert orders and all("o_orderdate" not in x and "o_orderstatus" not in x for x in orders)
