"""Scoring rules as ``Column`` expressions.

Every rule is a searched ``CASE`` chain (P6: first match wins, a NULL comparison
never matches) of built-in expressions (P8 null tests, F10 arithmetic), so it stays inside
whole-stage codegen; no Python runs on executors.  Each factory takes columns
(or column names) and returns a column, so the same rule serves the batch
tables, streaming refresh and ad-hoc SQL (``register_sql_functions``).
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# fixed values: scoring thresholds and labels
# (below this age, score) in order, then the score above all and the score of an unknown age
AGE_SCORES, AGE_SCORE_ABOVE, AGE_SCORE_NULL = [(25, 25), (35, 15), (55, 5)], 10, 0
# (below this age, category) in order, then the category above all and that of an unknown age
AGE_LADDER, AGE_CATEGORY_ABOVE, AGE_CATEGORY_NULL = [(25, "Young Driver"), (45, "Middle Age"), (65, "Mature Driver")], "Senior Driver", "Unknown"
CLAIM_HIGH, CLAIM_MID = 75000, 25000
CLAIM_SCORE_HIGH, CLAIM_SCORE_MID, CLAIM_SCORE_LOW = 40, 20, 5
FRAUD_SCORE = 50
RISK_HIGH_AT, RISK_MEDIUM_AT = 80, 40
AGE_CATEGORIES = [*[c for _, c in AGE_LADDER], AGE_CATEGORY_ABOVE, AGE_CATEGORY_NULL]
STATES = ["Colorado", "Utah", "Wyoming", "Other States"]
BROKER_STATES = ["Colorado", "Utah", "Wyoming"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _ladder(c: Column, steps, above, null) -> Column:
    out = F.when(c.isNull(), null)
    for limit, value in steps:
        out = out.when(c < limit, value)
    return out.otherwise(above)


def _ladder_sql(c: str, steps, above, null) -> str:
    lit = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    return (f"CASE WHEN {c} IS NULL THEN {lit(null)} " + " ".join(f"WHEN {c} < {k} THEN {lit(v)}" for k, v in steps)
            + f" ELSE {lit(above)} END")


def age_score_sql(age: str = "age") -> str:
    return _ladder_sql(age, AGE_SCORES, AGE_SCORE_ABOVE, AGE_SCORE_NULL)


def age_category_sql(age: str = "age") -> str:
    return _ladder_sql(age, AGE_LADDER, AGE_CATEGORY_ABOVE, AGE_CATEGORY_NULL)


def claim_score_sql(amount: str) -> str:
    return (f"CASE WHEN {amount} IS NULL THEN {CLAIM_SCORE_LOW} WHEN {amount} > {CLAIM_HIGH} THEN {CLAIM_SCORE_HIGH} "
            f"WHEN {amount} > {CLAIM_MID} THEN {CLAIM_SCORE_MID} ELSE {CLAIM_SCORE_LOW} END")


def total_score_sql(age: str, amount: str, fraud: str) -> str:
    return f"({age_score_sql(age)}) + ({claim_score_sql(amount)}) + (CASE WHEN {fraud} THEN {FRAUD_SCORE} ELSE 0 END)"


def age_risk_score(age) -> Column:
    """NULL→0, <25→25, <35→15, <55→5, else 10."""
    return _ladder(_c(age), AGE_SCORES, AGE_SCORE_ABOVE, AGE_SCORE_NULL).cast("int")


def driver_age_category(age) -> Column:
    """NULL→Unknown, <25 Young Driver, <45 Middle Age, <65 Mature Driver, else Senior Driver."""
    return _ladder(_c(age), AGE_LADDER, AGE_CATEGORY_ABOVE, AGE_CATEGORY_NULL)


def claim_risk_score(amount) -> Column:
    """Claim part of U3: NULL→5, >75000→40, >25000→20, else 5 (compared unrounded)."""
    m = _c(amount)
    return (F.when(m.isNull(), CLAIM_SCORE_LOW)
            .when(m > CLAIM_HIGH, CLAIM_SCORE_HIGH)
            .when(m > CLAIM_MID, CLAIM_SCORE_MID)
            .otherwise(CLAIM_SCORE_LOW)).cast("int")


def fraud_risk_score(fraud) -> Column:
    """Fraud part of U3: 50 when TRUE, else 0 (NULL counts as not fraud)."""
    return F.when(_c(fraud), FRAUD_SCORE).otherwise(0).cast("int")


def total_risk_score(age, amount, fraud) -> Column:
    """Age part + claim part + fraud part; range [5, 115]."""
    return (age_risk_score(age) + claim_risk_score(amount) + fraud_risk_score(fraud)).cast("int")


def risk_level(score) -> Column:
    """>=80 HIGH, >=40 MEDIUM, else LOW (pass the score column computed once)."""
    s = _c(score)
    return F.when(s >= RISK_HIGH_AT, "HIGH").when(s >= RISK_MEDIUM_AT, "MEDIUM").otherwise("LOW")


def risk_factors(age, amount, fraud) -> Column:
    """array of applicable factor names without NULLs (possibly empty).

    Note the factor uses ``age > 65`` while the category uses ``>= 65``; both are
    kept as the rules state them.
    """
    a, m, f = _c(age), _c(amount), _c(fraud)
    return F.array_compact(F.array(
        F.when(a < 25, F.lit("Young Driver")),
        F.when(a > 65, F.lit("Senior Driver")),
        F.when(m > CLAIM_HIGH, F.lit("High Claim Amount")),
        F.when(f == F.lit(True), F.lit("Fraud History")),   # P13
    ))


def hash_bucket10(key, mode: str = "portable") -> Column:
    """``MOD(HASH(key), 10)``.

    portable: first 32 bits of MD5 as an unsigned number, mod 10 (reproducible
              in any SQL engine; NULL key → NULL).
    signed:   first 64 bits of MD5 as a signed number, mod 10 (the remainder takes
              the dividend's sign, as with a signed vendor hash; NULL key → NULL).
    """
    k = _c(key)
    if mode == "portable":
        return F.conv(F.substring(F.md5(k), 1, 8), 16, 10).cast("bigint") % 10
    if mode == "signed":
        return F.conv(F.substring(F.md5(k), 1, 16), 16, -10).cast("bigint") % 10
    raise ValueError(f"unknown hash mode {mode!r}")


def state_from_hash(key, mode: str = "portable") -> Column:
    """m<=2 Colorado, m<=4 Utah, m<=6 Wyoming, else Other States (NULL m → Other)."""
    return state_from_bucket(hash_bucket10(key, mode))


def state_from_bucket(m) -> Column:
    """D1 on an already computed ``MOD(HASH(key), 10)`` column."""
    m = _c(m)
    return (F.when(m <= 2, "Colorado")
            .when(m <= 4, "Utah")
            .when(m <= 6, "Wyoming")
            .otherwise("Other States"))


def register_sql_functions(spark: SparkSession) -> None:
    """U1-U3 as SQL functions (inlined by the analyzer, no Python at run time)."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION calculate_age_risk_score(age INT) RETURNS INT
        RETURN CAST({age_score_sql()} AS INT)""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION categorize_driver_age(age INT) RETURNS STRING
        RETURN {age_category_sql()}""")
    # ten decimals: amounts are compared as given, not rounded to cents first
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION calculate_total_risk_score(
            age INT, claim_amount DECIMAL(38, 10), fraud_reported BOOLEAN) RETURNS INT
        RETURN CAST({total_score_sql('age', 'claim_amount', 'fraud_reported')} AS INT)""")
