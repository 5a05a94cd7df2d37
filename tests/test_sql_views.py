"""Report SQL text runs against the registered views and agrees with the DataFrame reports."""


from riskpipe.operators import governance as G
from riskpipe.plans import catalog, reports
from riskpipe.plans import sql_views as V

SF = "/root/testdata/sf0.01"

OVERVIEW_SQL = """
SELECT COUNT(*) AS total_customers,
       COUNT(CASE WHEN risk_level = 'HIGH' THEN 1 END) AS high_risk_count,
       ROUND(AVG(total_risk_score), 1) AS avg_risk_score,
       ROUND(AVG(claim_amount_filled), 0) AS avg_claim_amount
FROM risk_score_matrix"""

ROLE_SQL = """
SELECT COUNT(*) AS visible_records, COUNT(DISTINCT customer_state) AS visible_states,
       MAX(claim_amount_filled) AS max_claim_amount
FROM broker_risk_view"""


def test_report_sql_on_views(spark):
    cust, claims = catalog.raw(spark, SF)
    V.register_views(spark, cust, claims, ctx=G.ADMIN)
    r = spark.sql(OVERVIEW_SQL).first()
    o = reports.overview(catalog.level2(spark, SF)).first()
    assert (r.total_customers, r.high_risk_count, float(r.avg_risk_score), float(r.avg_claim_amount)) == \
        (o.total_customers, o.high_risk_count, o.avg_risk_score, o.avg_claim_amount)
    assert spark.sql("SELECT categorize_driver_age(22) AS c").first().c == "Young Driver"
    assert spark.sql("SELECT COUNT(*) FROM customer_claims_integrated").first()[0] == 12222

    V.use_context(spark, G.ANALYST)
    a = spark.sql(ROLE_SQL).first()
    assert (a.visible_records, a.visible_states) == (8480, 3)
    assert spark.sql("SELECT COUNT(*) FROM risk_score_matrix").first()[0] == 8480
    assert spark.sql("SELECT MAX(claim_amount_filled % 10000) FROM risk_score_matrix").first()[0] == 0
    V.use_context(spark, G.OTHER)
    assert spark.sql("SELECT COUNT(*) FROM risk_score_matrix").first()[0] == 0
    V.use_context(spark, G.ADMIN)
    assert spark.sql("SELECT COUNT(*) FROM risk_score_matrix").first()[0] == 12222
