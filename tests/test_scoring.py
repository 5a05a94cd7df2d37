from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskpipe.functions import scoring as S

AGES = [None, 17, 24, 25, 34, 35, 44, 45, 54, 55, 64, 65, 66, 90]
AMOUNTS = [None, Decimal("0.00"), Decimal("25000.00"), Decimal("25000.01"), Decimal("75000.00"),
           Decimal("75000.01"), Decimal("600000.00")]
FRAUD = [None, True, False]


def expected_age_score(a):
    if a is None:
        return 0
    return 25 if a < 25 else 15 if a < 35 else 5 if a < 55 else 10


def expected_category(a):
    if a is None:
        return "Unknown"
    return ("Young Driver" if a < 25 else "Middle Age" if a < 45 else
            "Mature Driver" if a < 65 else "Senior Driver")


def expected_total(a, m, f):
    claim = 5 if m is None else 40 if m > 75000 else 20 if m > 25000 else 5
    return expected_age_score(a) + claim + (50 if f else 0)


@pytest.fixture(scope="module")
def grid(spark):
    rows = [(a, m, f) for a in AGES for m in AMOUNTS for f in FRAUD]
    return spark.createDataFrame(rows, "age int, amount decimal(10,2), fraud boolean")


def test_boundaries(grid):
    out = grid.select("age", "amount", "fraud",
                      S.age_risk_score("age").alias("s"), S.driver_age_category("age").alias("c"),
                      S.total_risk_score("age", "amount", "fraud").alias("t"),
                      S.risk_level(S.total_risk_score("age", "amount", "fraud")).alias("lvl"),
                      S.risk_factors("age", "amount", "fraud").alias("rf")).collect()
    assert len(out) == len(AGES) * len(AMOUNTS) * len(FRAUD)
    for r in out:
        assert r.s == expected_age_score(r.age)
        assert r.c == expected_category(r.age)
        assert r.t == expected_total(r.age, r.amount, r.fraud)
        assert r.lvl == ("HIGH" if r.t >= 80 else "MEDIUM" if r.t >= 40 else "LOW")
        exp_rf = [x for x, c in [("Young Driver", r.age is not None and r.age < 25),
                                 ("Senior Driver", r.age is not None and r.age > 65),
                                 ("High Claim Amount", r.amount is not None and r.amount > 75000),
                                 ("Fraud History", r.fraud is True)] if c]
        assert list(r.rf) == exp_rf


def test_properties(grid):
    t = S.total_risk_score("age", "amount", "fraud")
    bad = grid.where(~t.between(5, 115)
                     | (F.coalesce(F.col("fraud"), F.lit(False)) & (t < 55))
                     | ((S.risk_level(t) == "HIGH") & ~F.coalesce(F.col("fraud"), F.lit(False)))).count()
    assert bad == 0
    # age 65 is a Senior Driver by category but carries no Senior Driver factor
    r = grid.where(F.col("age") == 65).select(S.driver_age_category("age").alias("c"),
                                              S.risk_factors("age", "amount", "fraud").alias("f")).first()
    assert r.c == "Senior Driver" and "Senior Driver" not in r.f


def test_udf_selfcheck_sql_functions(spark):
    S.register_sql_functions(spark)
    r = spark.sql("""SELECT categorize_driver_age(22) AS cat, calculate_age_risk_score(22) AS s,
                            calculate_total_risk_score(22, 80000, TRUE) AS hi,
                            calculate_total_risk_score(45, 15000, FALSE) AS lo,
                            calculate_age_risk_score(NULL) AS n""").first()
    assert (r.cat, r.s, r.hi, r.lo, r.n) == ("Young Driver", 25, 115, 10, 0)


def test_sql_functions_have_no_python(spark, grid):
    S.register_sql_functions(spark)
    grid.createOrReplaceTempView("grid")
    plan = spark.sql("SELECT calculate_total_risk_score(age, amount, fraud) FROM grid") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_state_hash_modes(spark):
    df = spark.createDataFrame([(str(i),) for i in range(3000)] + [(None,)], "k string")
    portable = dict(df.groupBy(S.state_from_hash("k").alias("s")).count().collect())
    assert set(portable) == set(S.STATES)
    assert portable["Other States"] > portable["Utah"]
    signed = df.select(S.hash_bucket10("k", "signed").alias("m")).where("m < 0").count()
    assert signed > 0          # a signed hash yields negative remainders
    nul = df.where("k IS NULL").select(S.state_from_hash("k").alias("s")).first().s
    assert nul == "Other States"
