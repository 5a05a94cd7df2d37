"""Property tests: by-name binding under random header orders and column subsets."""

import datetime as dt
import os
import uuid
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riskpipe.sources import csv_ingest as C
from riskpipe.sources import schemas as S

COLS = [f.name for f in S.CLAIMS_DATA.fields]
VALUES = {"policy_number": "P1", "incident_date": "2015-03-02 00:00:00.000", "incident_type": "Parked Car",
          "incident_severity": "Minor Damage", "authorities_contacted": "Police", "incident_hour_of_the_day": "7",
          "number_of_vehicles_involved": "2", "bodily_injuries": "1", "witnesses": "3",
          "police_report_available": "NO", "claim_amount": "123.45", "fraud_reported": "true"}
TYPED = dict(VALUES, incident_date=dt.datetime(2015, 3, 2), incident_hour_of_the_day=7,
             number_of_vehicles_involved=2, bodily_injuries=1, witnesses=3, claim_amount=Decimal("123.45"),
             fraud_reported=True)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(order=st.permutations(COLS), keep=st.lists(st.booleans(), min_size=len(COLS), max_size=len(COLS)),
       upper=st.booleans(), extra=st.booleans())
def test_binding_by_name(spark, scratch, order, keep, upper, extra):
    cols = [c for c, k in zip(order, keep) if k] or ["policy_number"]
    header = [c.upper() if upper else c for c in cols] + (["UNRELATED"] if extra else [])
    row = [VALUES[c] for c in cols] + (["zzz"] if extra else [])
    d = f"{scratch}/{uuid.uuid4().hex}"
    os.makedirs(d)
    with open(f"{d}/CLAIMS_DATA_p.csv", "w") as f:
        f.write(",".join(header) + "\n" + ",".join(row) + "\n")
    r = C.read_csv_by_name(spark, [f"file:{d}/CLAIMS_DATA_p.csv"], S.CLAIMS_DATA).first()
    assert list(r._rejected) == []
    for c in COLS:
        assert r[c] == (TYPED[c] if c in cols else None), c


@settings(max_examples=1, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 130)),
                               st.one_of(st.none(), st.decimals(min_value=0, max_value=99999999, places=2,
                                                                allow_nan=False, allow_infinity=False)),
                               st.one_of(st.none(), st.booleans())), min_size=50, max_size=200))
def test_score_properties(spark, rows):
    """score ∈ [5, 115]; fraud ⇒ score ≥ 55 ⇒ never LOW; HIGH ⇒ fraud; factors match the rules."""
    from pyspark.sql import functions as F

    from riskpipe.functions import scoring as SC
    df = spark.createDataFrame(rows, "age int, amount decimal(10,2), fraud boolean")
    t = SC.total_risk_score("age", "amount", "fraud")
    fraud = F.coalesce(F.col("fraud"), F.lit(False))
    bad = df.where(~t.between(5, 115) | (fraud & (t < 55)) | (fraud & (SC.risk_level(t) == "LOW"))
                   | ((SC.risk_level(t) == "HIGH") & ~fraud)
                   | (F.array_contains(SC.risk_factors("age", "amount", "fraud"), "Fraud History") != fraud))
    assert bad.count() == 0


ROLES = st.one_of(st.none(), st.sampled_from(["ACCOUNTADMIN", "PIPELINE_ANALYST", "accountadmin", "PUBLIC"]),
                  st.text(alphabet="ABCDEFGHIJKLMNOPQRSTUVWXYZ_", max_size=12))
ACCOUNTS = st.one_of(st.none(), st.sampled_from(["MAIN", "A_CONSUMER_1", "a_consumer_1", "CONSUMER", "XCONSUMERX"]),
                     st.text(alphabet="ABCDEFGHIJKLMNOPQRSTUVWXYZ_", max_size=12))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(role=ROLES, account=ACCOUNTS)
def test_governance_matches_the_rules(spark, role, account):
    """G4/G5 against a plain statement of the rules, for arbitrary caller contexts."""
    from riskpipe.operators import governance as G
    states = ["Colorado", "Utah", "Wyoming", "Other States", None]
    rows = [(str(i), states[i % 5], Decimal(i * 1234) / 10) for i in range(25)]
    df = spark.createDataFrame(rows, "policy_number string, customer_state string, claim_amount_filled decimal(10,2)")
    ctx = G.AccessContext(role, account)
    admin = role == "ACCOUNTADMIN"
    broker = role == "PIPELINE_ANALYST" or (account is not None and "CONSUMER" in account)
    want = {}
    for p, s, amt in rows:
        if admin or (broker and s in ("Colorado", "Utah", "Wyoming")):
            want[p] = amt if admin else (amt // 10000) * 10000
    got = {r.policy_number: r.claim_amount_filled for r in G.governed(df, ctx).collect()}
    assert got == want
