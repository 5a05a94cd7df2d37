"""SQL surface: the pipeline's tables as temp views, for users who work in SQL.

``register_views`` exposes the raw tables, level 1, the governed level 2 and the
broker view under their table names, plus the three scoring functions, so
report SQL runs as written (only table qualifiers drop).  The mask and row
policy of ``risk_score_matrix`` and ``broker_risk_view`` follow the session's caller
(``use_context``, a call of the driver that SQL text cannot make): every SQL
reader of those names is governed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskpipe.functions.scoring import register_sql_functions
from riskpipe.operators import governance as G
from riskpipe.operators import integrate as I

VIEW_NAMES = ("claims_raw", "customer_raw", "customer_claims_integrated", "risk_score_matrix", "broker_risk_view")


def register_views(spark: SparkSession, customers: DataFrame, claims: DataFrame, *,
                   ctx: G.AccessContext | None = None, level1: DataFrame | None = None,
                   level2: DataFrame | None = None) -> None:
    """Register the five views (levels default to a recompute from the raw frames;
    pass the written level tables in production)."""
    l1 = level1 if level1 is not None else I.integrate(customers, claims)
    l2 = level2 if level2 is not None else I.risk_matrix(l1)
    customers.createOrReplaceTempView("customer_raw")
    claims.createOrReplaceTempView("claims_raw")
    l1.createOrReplaceTempView("customer_claims_integrated")
    register_sql_functions(spark)
    G.declare_context_variables(spark, ctx or G.AccessContext())
    G.register_governed_view(spark, l2, "risk_score_matrix", columns=None, require_state=False)
    G.register_governed_view(spark, l2, "broker_risk_view")


def use_context(spark: SparkSession, ctx: G.AccessContext) -> None:
    """``USE ROLE`` for the SQL views: later queries see what ``ctx`` may see."""
    G.set_context_variables(spark, ctx)
