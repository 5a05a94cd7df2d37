"""Registry of named queries: Spark builders and their DuckDB oracle SQL.

Every builder takes ``(spark, sf_dir)``, reads the parquet tables of ``sf_dir``
(through the raw-table adapter) and returns a ``DataFrame`` whose columns follow
the comparison conventions of ``plans.oracle``.
"""

from __future__ import annotations

import functools
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskpipe.functions import scoring
from riskpipe.operators import entitlements as ent
from riskpipe.operators import governance as gov
from riskpipe.operators import integrate as integ
from riskpipe.plans import oracle as O
from riskpipe.plans import reports
from riskpipe.session import scratch_path
from riskpipe.sources import adapters

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}

CONTEXTS = {"admin": gov.ADMIN, "analyst": gov.ANALYST, "consumer": gov.CONSUMER, "other": gov.OTHER}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def comparable(df: DataFrame) -> DataFrame:
    """Decimals → double, timestamps → text, string arrays → '|'-joined text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, "|")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ---------------------------------------------------------------------------
# shared building blocks (lazy plans)

_PLANS: dict[tuple, DataFrame] = {}


def _stamp(spark: SparkSession, sf_dir: str, table: str) -> tuple:
    """Names, sizes and times of a table's files: a plan made for other files is not used again."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{table}.parquet")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tuple((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(path))


def _memo(spark: SparkSession, sf_dir: str, what: str, build) -> DataFrame:
    """Plan definitions (not data) are built once per application and state of the input files,
    like view definitions; every execution still scans the parquet files."""
    key = (spark.sparkContext.applicationId, sf_dir, _stamp(spark, sf_dir, "customer"), _stamp(spark, sf_dir, "orders"), what)
    if key not in _PLANS:
        _PLANS[key] = build()
    return _PLANS[key]


def raw(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return (_memo(spark, sf_dir, "customer_raw",
                  lambda: adapters.customer_raw(adapters.read_table(spark, sf_dir, "customer"))),
            _memo(spark, sf_dir, "claims_raw",
                  lambda: adapters.claims_raw(adapters.read_table(spark, sf_dir, "orders"))))


def level1(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build():
        cust, claims = raw(spark, sf_dir)
        return integ.integrate(cust, claims)
    return _memo(spark, sf_dir, "level1", build)


def level2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _memo(spark, sf_dir, "level2", lambda: integ.risk_matrix(level1(spark, sf_dir)))


# ---------------------------------------------------------------------------
# M1: scoring rules, levels 1 and 2


@register("udf_selfcheck", O.with_ctes(O.CUSTOMER_RAW) + f"""
SELECT age, {O.AGE_CATEGORY} AS age_category,
       CAST({O.AGE_SCORE} AS INTEGER) AS age_risk_score,
       CAST({O.total_score('age', '80000', 'TRUE')} AS INTEGER) AS high_risk_total,
       CAST({O.total_score('age', '15000', 'FALSE')} AS INTEGER) AS low_risk_total,
       CAST({O.total_score('age', '75000.004', 'TRUE')} AS INTEGER) AS just_above_total
FROM (SELECT DISTINCT age FROM customer_raw)""")
def q_udf_selfcheck(spark, sf_dir):
    """U4 through the SQL-registered functions, over every distinct age on file."""
    cust, _ = raw(spark, sf_dir)
    scoring.register_sql_functions(spark)
    return cust.select("age").distinct().select(
        "age",
        F.expr("categorize_driver_age(age)").alias("age_category"),
        F.expr("calculate_age_risk_score(age)").alias("age_risk_score"),
        F.expr("calculate_total_risk_score(age, 80000, TRUE)").alias("high_risk_total"),
        F.expr("calculate_total_risk_score(age, 15000, FALSE)").alias("low_risk_total"),
        F.expr("calculate_total_risk_score(age, 75000.004, TRUE)").alias("just_above_total"))


@register("age_risk_score", O.with_ctes(O.CUSTOMER_RAW) + f"""
SELECT policy_number, age, CAST({O.AGE_SCORE} AS INTEGER) AS age_risk_score FROM customer_raw""")
def q_age_risk_score(spark, sf_dir):
    cust, _ = raw(spark, sf_dir)
    return cust.select("policy_number", "age", scoring.age_risk_score("age").alias("age_risk_score"))


@register("age_category", O.with_ctes(O.CUSTOMER_RAW) + f"""
SELECT policy_number, age, {O.AGE_CATEGORY} AS age_category FROM customer_raw""")
def q_age_category(spark, sf_dir):
    cust, _ = raw(spark, sf_dir)
    return cust.select("policy_number", "age", scoring.driver_age_category("age").alias("age_category"))


@register("total_risk_score", O.with_ctes(*O.BASE_L1) + f"""
SELECT policy_number, age, CAST(claim_amount_filled AS DOUBLE) AS claim_amount_filled, fraud_reported_filled,
       CAST({O.total_score('age', 'claim_amount_filled', 'fraud_reported_filled')} AS INTEGER) AS total_risk_score
FROM l1""")
def q_total_risk_score(spark, sf_dir):
    l1 = level1(spark, sf_dir)
    return comparable(l1.select(
        "policy_number", "age", "claim_amount_filled", "fraud_reported_filled",
        scoring.total_risk_score("age", "claim_amount_filled", "fraud_reported_filled").alias("total_risk_score")))


@register("risk_level", O.with_ctes(*O.BASE_L2) + """
SELECT policy_number, total_risk_score, risk_level FROM l2""")
def q_risk_level(spark, sf_dir):
    return level2(spark, sf_dir).select("policy_number", "total_risk_score", "risk_level")


@register("risk_factors", O.with_ctes(*O.BASE_L2) + """
SELECT policy_number, age, CAST(claim_amount_filled AS DOUBLE) AS claim_amount_filled, fraud_reported_filled,
       array_to_string(risk_factors, '|') AS risk_factors
FROM l2""")
def q_risk_factors(spark, sf_dir):
    return comparable(level2(spark, sf_dir).select(
        "policy_number", "age", "claim_amount_filled", "fraud_reported_filled", "risk_factors"))


@register("customer_state", O.with_ctes(O.CUSTOMER_RAW) + f"""
SELECT policy_number,
       {O.STATE_CASE.replace('m <=', "('0x' || substr(md5(policy_number), 1, 8))::BIGINT % 10 <=")} AS customer_state
FROM customer_raw""")
def q_customer_state(spark, sf_dir):
    cust, _ = raw(spark, sf_dir)
    return cust.select("policy_number", scoring.state_from_hash("policy_number").alias("customer_state"))


_L1_SQL_COLS = ", ".join(
    (f"CAST({c} AS DOUBLE) AS {c}" if c in ("policy_deductable", "policy_annual_premium", "claim_amount",
                                            "claim_amount_filled")
     else f"{O.ts(c)} AS {c}" if c in ("policy_start_date", "incident_date", "last_updated")
     else c)
    for c in integ.LEVEL1_COLUMNS)


@register("l1_integrated", O.with_ctes(*O.BASE_L1) + f"SELECT {_L1_SQL_COLS} FROM l1")
def q_l1(spark, sf_dir):
    return comparable(level1(spark, sf_dir))


# splits every policy with at least 16 claims, so the salted plan runs at any scale
FORCED_SKEW = integ.SkewConfig(sample_fraction=1.0, rows_per_task=8)


def salted_level1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integ.integrate(*raw(spark, sf_dir), skew=FORCED_SKEW)


@register("l1_salted", O.with_ctes(*O.BASE_L1) + f"SELECT {_L1_SQL_COLS} FROM l1")
def q_l1_salted(spark, sf_dir):
    """J1/T1 with hot keys split."""
    return comparable(salted_level1(spark, sf_dir))


_L2_SQL_COLS = ", ".join(
    (f"CAST({c} AS DOUBLE) AS {c}" if c in ("policy_annual_premium", "claim_amount_filled")
     else f"{O.ts(c)} AS {c}" if c == "last_updated"
     else f"array_to_string({c}, '|') AS {c}" if c == "risk_factors"
     else c)
    for c in integ.LEVEL2_COLUMNS)


@register("l2_risk_matrix", O.with_ctes(*O.BASE_L2) + f"SELECT {_L2_SQL_COLS} FROM l2")
def q_l2(spark, sf_dir):
    return comparable(level2(spark, sf_dir))


# ---------------------------------------------------------------------------
# M2: reports


# The reports' twins read one relation of exact sums, a row for each group that any report tells apart.
_SUMS = {"n": "COUNT(*)", "score": "SUM(total_risk_score)", "age_score": "SUM(age_risk_score)", "claim": "SUM(claim_amount_filled)",
         "premium": "SUM(policy_annual_premium)", "premiums": "COUNT(policy_annual_premium)", "newest": "MAX(last_updated)"}
SUMMARY = "summary AS (SELECT age_category, customer_state, risk_level, " + ", ".join(f"{x} AS {n}" for n, x in _SUMS.items()) + " FROM l2 GROUP BY ALL)"


def _n(name: str, level: str | None = None) -> str:
    """Rows, or those of one risk level."""
    return f"CAST(COALESCE(SUM(n){'' if level is None else f" FILTER (risk_level = '{level}')"}, 0) AS BIGINT) AS {name}"


def _mean(name: str, of: str, digits: int, rows: str = "n") -> str:
    return f"CAST(ROUND(SUM({of}) / CAST(SUM({rows}) AS DOUBLE), {digits}) AS DOUBLE) AS {name}"


def _report_sql(*columns: str, by: str | None = None, order: str = "") -> str:
    group = f" GROUP BY {by} ORDER BY {order}, {by}" if by else ""
    return O.with_ctes(*O.BASE_L2, SUMMARY) + "SELECT " + ", ".join([by] * (by is not None) + list(columns)) + " FROM summary" + group


@register("risk_overview", _report_sql(
    _n("total_customers"), *[_n(f"{x.lower()}_risk_count", x) for x in ("HIGH", "MEDIUM", "LOW")],
    _mean("avg_risk_score", "score", 1), _mean("avg_claim_amount", "claim", 0), f"{O.ts('MAX(newest)')} AS last_refresh"))
def q_risk_overview(spark, sf_dir):
    return comparable(reports.overview(level2(spark, sf_dir)))


@register("by_age_category", _report_sql(
    _n("customer_count"), _mean("avg_age_risk_score", "age_score", 1), _mean("avg_total_risk_score", "score", 1), _n("high_risk_count", "HIGH"),
    by="age_category", order="avg_total_risk_score DESC"))
def q_by_age_category(spark, sf_dir):
    return reports.by_age_category(level2(spark, sf_dir))


@register("by_state", _report_sql(
    _n("customer_count"), _mean("avg_risk_score", "score", 1), _n("high_risk_count", "HIGH"), _mean("avg_claim_amount", "claim", 0),
    by="customer_state", order="customer_count DESC"))
def q_by_state(spark, sf_dir):
    return reports.by_state(level2(spark, sf_dir))


@register("by_risk_level", _report_sql(
    _n("count"), _mean("avg_score", "score", 1), _mean("avg_claim", "claim", 0), _mean("avg_premium", "premium", 0, "premiums"),
    by="risk_level", order="avg_score DESC"))
def q_by_risk_level(spark, sf_dir):
    return reports.by_risk_level(level2(spark, sf_dir))


@register("high_risk_share", _report_sql(
    _n("total_customers"), _n("high_risk_count", "HIGH"), "CAST(ROUND(100 * high_risk_count / NULLIF(CAST(total_customers AS DOUBLE), 0), 1) AS DOUBLE) AS high_risk_pct"))
def q_high_risk_share(spark, sf_dir):
    return reports.high_risk_share(level2(spark, sf_dir))


# ---------------------------------------------------------------------------
# M3: governance


@register("mask_analyst", O.with_ctes(*O.BASE_L2) + f"""
SELECT policy_number, customer_state, CAST({O.MASKED} AS DOUBLE) AS claim_amount_filled, total_risk_score
FROM l2""")
def q_mask_analyst(spark, sf_dir):
    """Mask attached, row policy not yet attached (the reference's intermediate step)."""
    mask_only = gov.RISK_MATRIX_POLICIES.without("broker_access")
    g = gov.governed(level2(spark, sf_dir), gov.ANALYST, mask_only)
    return comparable(g.select("policy_number", "customer_state", "claim_amount_filled", "total_risk_score"))


def _row_policy_sql(ctx: str) -> str:
    return O.with_ctes(*O.BASE_L2, O.governed(ctx)) + """
SELECT policy_number, customer_state, CAST(claim_amount_filled AS DOUBLE) AS claim_amount_filled,
       total_risk_score, risk_level FROM g"""


def _row_policy(ctx_name: str) -> Builder:
    def build(spark, sf_dir):
        g = gov.governed(level2(spark, sf_dir), CONTEXTS[ctx_name])
        return comparable(g.select("policy_number", "customer_state", "claim_amount_filled",
                                   "total_risk_score", "risk_level"))
    build.__name__ = f"q_row_policy_{ctx_name}"
    return build


for _ctx in ("analyst", "consumer"):
    register(f"row_policy_{_ctx}", _row_policy_sql(_ctx))(_row_policy(_ctx))

_SEES = {"admin": "TRUE", "analyst": f"customer_state IN {O.BROKER_STATES_SQL}",
         "consumer": f"customer_state IN {O.BROKER_STATES_SQL}", "other": "FALSE"}


_DESK = gov.AccessContext("UTAH_DESK", "MAIN")
_ENTITLED = {"analyst": gov.ANALYST, "consumer": gov.CONSUMER, "utah_desk": _DESK, "other": gov.OTHER}


@register("row_policy_entitled", O.with_ctes(*O.BASE_L2) + """
, e(role_name, state, step) AS (
  SELECT unnest(['analyst', 'consumer']), s, 10000 FROM (SELECT unnest(['Colorado', 'Utah', 'Wyoming']) AS s)
  UNION ALL SELECT 'utah_desk', 'Utah', 5000)
SELECT role_name, policy_number, customer_state, CAST(floor(claim_amount_filled / step) * step AS DOUBLE) AS claim_amount_filled, total_risk_score
FROM l2 JOIN e ON customer_state = state""")
def q_row_policy_entitled(spark, sf_dir):
    """G5, G6, G8 by a table: its first version holds the policies, a second one adds a role as a row; what four callers see under it."""
    table = ent.Entitlements(spark, scratch_path(spark, "entitlements") + "/risk_score_matrix")
    table.publish(spark.createDataFrame(ent.default_rows(), ent.SCHEMA))
    table.grant((_DESK.role, None, "Utah", 5000))
    rows = table.read()
    parts = [ent.governed(level2(spark, sf_dir), ctx, rows).select(F.lit(name).alias("role_name"), "policy_number", "customer_state", "claim_amount_filled",
                                                                   "total_risk_score") for name, ctx in _ENTITLED.items()]
    return comparable(functools.reduce(DataFrame.unionByName, parts))


@register("row_policy_other", O.with_ctes(*O.BASE_L2) + "\nUNION ALL\n".join(
    f"SELECT '{k}' AS role_name, CAST(COUNT_IF({c}) AS BIGINT) AS visible, CAST(COUNT(*) - COUNT_IF({c}) AS BIGINT) AS hidden FROM l2"
    for k, c in _SEES.items()))
def q_row_policy_other(spark, sf_dir):
    """G5 in numbers: rows that each kind of caller sees and does not see; a caller of no kind sees none."""
    m = level2(spark, sf_dir).select("customer_state")
    seen = [F.count_if(gov.broker_access(F.col("customer_state"), c)).alias(k) for k, c in CONTEXTS.items()]
    one = m.agg(F.count(F.lit(1)).alias("n"), *seen)
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("role_name"), F.col(k).alias("visible"), (F.col("n") - F.col(k)).alias("hidden"))
                                         for k in CONTEXTS])))


_BV_SQL_COLS = ", ".join(
    (f"CAST({c} AS DOUBLE) AS {c}" if c in ("policy_annual_premium", "claim_amount_filled")
     else f"{O.ts(c)} AS {c}" if c == "last_updated"
     else f"array_to_string({c}, '|') AS {c}" if c == "risk_factors"
     else c)
    for c in gov.BROKER_VIEW_COLUMNS)


def _broker_view(ctx_name: str) -> Builder:
    def build(spark, sf_dir):
        return comparable(gov.broker_view(level2(spark, sf_dir), CONTEXTS[ctx_name]))
    build.__name__ = f"q_broker_view_{ctx_name}"
    return build


for _ctx in ("admin", "analyst"):
    register(f"broker_view_{_ctx}",
             O.with_ctes(*O.BASE_L2, O.broker(_ctx)) + f"SELECT {_BV_SQL_COLS} FROM bv")(_broker_view(_ctx))


_ROLE_SUMMARY_SQL = O.with_ctes(*O.BASE_L2, *[O.broker(k, f"g_{k}", f"bv_{k}") for k in CONTEXTS]) + \
    "\nUNION ALL\n".join(
        f"""SELECT '{k}' AS role_name, CAST(COUNT(*) AS BIGINT) AS visible_records,
       CAST(COUNT(DISTINCT customer_state) AS BIGINT) AS visible_states,
       CAST(ROUND(AVG(claim_amount_filled), 0) AS DOUBLE) AS avg_claim_amount,
       CAST(MAX(claim_amount_filled) AS DOUBLE) AS max_claim_amount FROM bv_{k}"""
        for k in CONTEXTS)


@register("role_summary", _ROLE_SUMMARY_SQL)
def q_role_summary(spark, sf_dir):
    """R5 for each context (G10 comparison), one row per role."""
    return reports.roles_summary(reports.summary(level2(spark, sf_dir)), CONTEXTS)


@register("governed_sample", O.with_ctes(*O.BASE_L2, O.broker("analyst")) + """
SELECT policy_number, age_category, customer_state, risk_level,
       CAST(claim_amount_filled AS DOUBLE) AS claim_amount_filled, total_risk_score
FROM bv ORDER BY policy_number NULLS LAST, claim_amount_filled NULLS LAST, total_risk_score NULLS LAST
LIMIT 10""")
def q_governed_sample(spark, sf_dir):
    return comparable(reports.sample(gov.broker_view(level2(spark, sf_dir), gov.ANALYST)))


@register("visible_states", O.with_ctes(*O.BASE_L2) + f"""
SELECT DISTINCT 'admin' AS role_name, customer_state FROM l2
UNION ALL
SELECT DISTINCT 'analyst' AS role_name, customer_state FROM l2 WHERE customer_state IN {O.BROKER_STATES_SQL}""")
def q_visible_states(spark, sf_dir):
    """A8 + G10: distinct states per role."""
    m = level2(spark, sf_dir)
    return gov.compare_roles(m, {"admin": gov.ADMIN, "analyst": gov.ANALYST},
                             lambda g: g.select("customer_state").distinct()).select("role_name", "customer_state")


@register("policy_status", O.with_ctes(*O.BASE_L2, O.broker("analyst"),
                                       "n AS (SELECT CAST(COUNT(DISTINCT customer_state) AS VARCHAR) AS v FROM bv)")
          + "\nUNION ALL\n".join(f"SELECT '{f}' AS feature, replace('{st}', '{{n}}', v) AS status, '{i}' AS impact FROM n"
                                 for f, st, i in reports.PANEL))
def q_policy_status(spark, sf_dir):
    return reports.policy_status(gov.broker_view(level2(spark, sf_dir), gov.ANALYST))


# the dashboard as a role sees it: the reports read the governed matrix


def _governed_report(name: str, ctx_name: str, sql: str, build) -> None:
    def query(spark, sf_dir):
        return comparable(build(reports.governed_summary(reports.summary(level2(spark, sf_dir)), CONTEXTS[ctx_name])))
    query.__name__ = f"q_{name}"
    register(name, O.with_ctes(*O.BASE_L2, O.governed(ctx_name)) + sql)(query)


_governed_report("risk_overview_analyst", "analyst", f"""
SELECT CAST(COUNT(*) AS BIGINT) AS total_customers, CAST(COUNT_IF(risk_level = 'HIGH') AS BIGINT) AS high_risk_count,
       CAST(COUNT_IF(risk_level = 'MEDIUM') AS BIGINT) AS medium_risk_count, CAST(COUNT_IF(risk_level = 'LOW') AS BIGINT) AS low_risk_count,
       CAST(ROUND(AVG(total_risk_score), 1) AS DOUBLE) AS avg_risk_score,
       CAST(ROUND(AVG(claim_amount_filled), 0) AS DOUBLE) AS avg_claim_amount, {O.ts('MAX(last_updated)')} AS last_refresh FROM g""",
                 reports.summary_overview)
_governed_report("by_age_category_analyst", "analyst", """
SELECT age_category, CAST(COUNT(*) AS BIGINT) AS customer_count, CAST(ROUND(AVG(age_risk_score), 1) AS DOUBLE) AS avg_age_risk_score,
       CAST(ROUND(AVG(total_risk_score), 1) AS DOUBLE) AS avg_total_risk_score, CAST(COUNT_IF(risk_level = 'HIGH') AS BIGINT) AS high_risk_count
FROM g GROUP BY age_category""", reports.summary_by_age_category)
_governed_report("by_state_consumer", "consumer", """
SELECT customer_state, CAST(COUNT(*) AS BIGINT) AS customer_count, CAST(ROUND(AVG(total_risk_score), 1) AS DOUBLE) AS avg_risk_score,
       CAST(COUNT_IF(risk_level = 'HIGH') AS BIGINT) AS high_risk_count, CAST(ROUND(AVG(claim_amount_filled), 0) AS DOUBLE) AS avg_claim_amount
FROM g GROUP BY customer_state""", reports.summary_by_state)
_governed_report("by_risk_level_analyst", "analyst", """
SELECT risk_level, CAST(COUNT(*) AS BIGINT) AS count, CAST(ROUND(AVG(total_risk_score), 1) AS DOUBLE) AS avg_score,
       CAST(ROUND(AVG(claim_amount_filled), 0) AS DOUBLE) AS avg_claim, CAST(ROUND(AVG(policy_annual_premium), 0) AS DOUBLE) AS avg_premium
FROM g GROUP BY risk_level""", reports.summary_by_risk_level)


@register("by_state_salted", ORACLE["by_state"])
def q_by_state_salted(spark, sf_dir):
    """R3 over level 1 with hot keys split."""
    return reports.by_state(integ.risk_matrix(salted_level1(spark, sf_dir)))
