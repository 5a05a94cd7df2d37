import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from riskpipe.operators import quality as Q
from riskpipe.sources import schemas as S


def _claims(spark):
    amounts = [Decimal("99.99"), Decimal("100.00"), Decimal("500000.00"), Decimal("500000.01"), None]
    keys = [None, None, "a", "a", "b"]
    rows = [(k, None, None, None, None, None, None, None, None, None, m, None, dt.datetime(2020, 1, 1 + i), "f")
            for i, (k, m) in enumerate(zip(keys, amounts))]
    return spark.createDataFrame(rows, S.CLAIMS_RAW)


def _customers(spark):
    ages = [17, 18, 85, 86, None]
    rows = [(str(i) if i else None, a, None, None, None, None, None, None, None, dt.datetime(2020, 1, 1), "f")
            for i, a in enumerate(ages)]
    return spark.createDataFrame(rows, S.CUSTOMER_RAW)


def test_metric_values(spark):
    m = dict((r.metric_name, r.value) for r in Q.run_metrics(_claims(spark), Q.CLAIMS_SPECS, "claims_raw").collect())
    assert m == {"INVALID_CLAIM_AMOUNT_COUNT": 2, "NULL_COUNT": 2, "DUPLICATE_COUNT": 2}
    c = dict((r.metric_name, r.value) for r in Q.run_metrics(_customers(spark), Q.CUSTOMER_SPECS, "customer_raw").collect())
    assert c == {"INVALID_CUSTOMER_AGE_COUNT": 2, "NULL_COUNT": 1, "ROW_COUNT": 5}


def test_one_aggregate_pass(spark):
    df = Q.run_metrics(_claims(spark), Q.CLAIMS_SPECS, "claims_raw")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") + plan.count("LocalTableScan") == 1


def test_results_history_score_trend_alerts(spark, scratch):
    reg = Q.default_registry()
    tables = {"claims_raw": _claims(spark), "customer_raw": _customers(spark)}
    for i in range(2):
        res = Q.results(tables, reg, measured_at=F.lit(dt.datetime(2024, 1, 1, 0, 5 * i)).cast("timestamp_ntz"))
        Q.append_results(res, scratch + "/results")
    hist = spark.read.parquet(scratch + "/results")
    assert hist.count() == 12
    srt = Q.results_sorted(hist).collect()
    assert srt[0].change_commit_time >= srt[-1].change_commit_time
    tr = Q.trend(hist.withColumnRenamed("measurement_time", "batch")).where("previous_value IS NOT NULL").collect()
    assert len(tr) == 6 and all(r.change == 0 for r in tr)
    al = {(r.table_name, r.metric_name) for r in Q.alerts(res).collect()}
    assert ("claims_raw", "DUPLICATE_COUNT") in al and ("customer_raw", "NULL_COUNT") in al
    sc = Q.quality_score(tables["claims_raw"], Q.CLAIMS_SPECS, "claims_raw").first()
    assert sc.violations == 6 and sc.rules == 3 and sc.quality_score == 60.0


def test_registry_attach_detach(spark):
    reg = Q.default_registry()
    assert len(reg.specs) == 6
    reg.detach("DUPLICATE_COUNT", "claims_raw")
    assert [s.name for s in reg.for_table("claims_raw")] == ["INVALID_CLAIM_AMOUNT_COUNT", "NULL_COUNT"]
    listing = Q.registry_listing(reg).collect()
    assert len(listing) == 5 and all(r.schedule == "5 MINUTE" for r in listing)


def test_load_validation(spark):
    r = Q.load_validation(_claims(spark), count_name="total_claims").first()
    assert (r.check_type, r.total_claims, r.unique_policies) == ("INITIAL LOAD STATUS", 5, 2)
    assert r.first_loaded == dt.datetime(2020, 1, 1) and r.last_loaded == dt.datetime(2020, 1, 5)
