"""Portfolio reports (R1-R9) over a governed risk matrix.

Each report is one aggregate plan: partial aggregation on every map task, a
shuffle of at most (groups × tasks) rows, and a final aggregation.  Group keys
are low-cardinality labels (levels, categories, states), so a hot group costs
nothing extra.  Reports return ``DataFrame``s (S15); collecting is the caller's job.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from riskpipe.sources.csv_ingest import utc_now

from riskpipe.operators import governance as gov


def _count_level(level: str) -> Column:
    """A4: COUNT(CASE WHEN risk_level = level THEN 1 END)."""
    return F.count(F.when(F.col("risk_level") == level, 1))


def _ravg(c: str, k: int) -> Column:
    """ROUND(AVG(c), k), half away from zero."""
    return F.round(F.avg(F.col(c)), k).cast("double")


def _distinct_states(col: str = "customer_state") -> Column:
    """COUNT(DISTINCT state) for a column drawn from a fixed label set: a bounded
    set per partial aggregate instead of the extra shuffle stage of a distinct
    aggregate (NULLs are ignored either way)."""
    return F.size(F.collect_set(F.col(col))).cast("bigint")


def _order_small(df: DataFrame, *cols) -> DataFrame:
    """Total order of a tiny aggregate in one partition.

    Only for group keys drawn from fixed label sets (≤ 5 states / categories /
    levels): a global ``orderBy`` would add range partitioning with a sampling
    job for a handful of rows."""
    return df.coalesce(1).sortWithinPartitions(*cols)


def overview(matrix: DataFrame) -> DataFrame:
    """Row count (A1), per-level counts, average score and claim, last refresh (A3)."""
    return matrix.agg(
        F.count(F.lit(1)).cast("bigint").alias("total_customers"),
        _count_level("HIGH").cast("bigint").alias("high_risk_count"),
        _count_level("MEDIUM").cast("bigint").alias("medium_risk_count"),
        _count_level("LOW").cast("bigint").alias("low_risk_count"),
        _ravg("total_risk_score", 1).alias("avg_risk_score"),
        _ravg("claim_amount_filled", 0).alias("avg_claim_amount"),
        F.max("last_updated").alias("last_refresh"),
    )


def overview_with_policies(matrix: DataFrame) -> DataFrame:
    """R1 variant (ours): the row count counts one row per claim (the join fans
    out), so the distinct policy count is added next to it."""
    return matrix.agg(
        F.count(F.lit(1)).cast("bigint").alias("total_rows"),
        F.count_distinct("policy_number").cast("bigint").alias("distinct_policies"),
        _count_level("HIGH").cast("bigint").alias("high_risk_count"))


def by_age_category(matrix: DataFrame) -> DataFrame:
    """R2: per age category (A7); sorted by average total score, descending (O1; category breaks ties)."""
    return (matrix.groupBy("age_category")
            .agg(F.count(F.lit(1)).cast("bigint").alias("customer_count"),
                 _ravg("age_risk_score", 1).alias("avg_age_risk_score"),
                 _ravg("total_risk_score", 1).alias("avg_total_risk_score"),
                 _count_level("HIGH").cast("bigint").alias("high_risk_count"))
            .transform(lambda d: _order_small(d, F.desc("avg_total_risk_score"), "age_category")))


def by_state(matrix: DataFrame) -> DataFrame:
    """Per state; sorted by row count."""
    return (matrix.groupBy("customer_state")
            .agg(F.count(F.lit(1)).cast("bigint").alias("customer_count"),
                 _ravg("total_risk_score", 1).alias("avg_risk_score"),
                 _count_level("HIGH").cast("bigint").alias("high_risk_count"),
                 _ravg("claim_amount_filled", 0).alias("avg_claim_amount"))
            .transform(lambda d: _order_small(d, F.desc("customer_count"), "customer_state")))


def by_risk_level(matrix: DataFrame) -> DataFrame:
    """Per risk level; sorted by average score."""
    return (matrix.groupBy("risk_level")
            .agg(F.count(F.lit(1)).cast("bigint").alias("count"),
                 _ravg("total_risk_score", 1).alias("avg_score"),
                 _ravg("claim_amount_filled", 0).alias("avg_claim"),
                 _ravg("policy_annual_premium", 0).alias("avg_premium"))
            .transform(lambda d: _order_small(d, F.desc("avg_score"), "risk_level")))


def high_risk_share(matrix: DataFrame) -> DataFrame:
    """HIGH rows as a percentage of all rows, 1 decimal; NULL when empty."""
    o = matrix.agg(F.count(F.lit(1)).alias("total"), _count_level("HIGH").alias("high"))
    return o.select(
        F.col("total").cast("bigint").alias("total_customers"),
        F.col("high").cast("bigint").alias("high_risk_count"),
        F.when(F.col("total") > 0, F.round(F.col("high") * 100.0 / F.col("total"), 1))
         .cast("double").alias("high_risk_pct"))


def role_summary(view: DataFrame, role_name: str | None) -> DataFrame:
    """What the current role sees in the broker view (A2: distinct states)."""
    return view.agg(
        F.lit(role_name).cast("string").alias("role_name"),
        F.count(F.lit(1)).cast("bigint").alias("visible_records"),
        _distinct_states().alias("visible_states"),
        _ravg("claim_amount_filled", 0).alias("avg_claim_amount"),
        F.max("claim_amount_filled").cast("double").alias("max_claim_amount"),
    )


def sample(view: DataFrame, n: int = 10) -> DataFrame:
    """Six columns, ``n`` rows (O3).  Ordered first so the rows are reproducible;
    the plan is a per-partition top-n plus a merge (no full sort)."""
    return (view.select("policy_number", "age_category", "customer_state", "risk_level",
                        "claim_amount_filled", "total_risk_score")
            .orderBy(F.asc_nulls_last("policy_number"), F.asc_nulls_last("claim_amount_filled"),
                     F.asc_nulls_last("total_risk_score"))
            .limit(n))


def refresh_lag(matrix: DataFrame) -> DataFrame:
    """T4: newest ``last_updated``, its time of day, and seconds behind now."""
    return matrix.agg(F.max("last_updated").alias("last_refresh")).select(
        "last_refresh",
        F.date_format("last_refresh", "HH:mm:ss").alias("last_refresh_time"),
        (F.unix_timestamp(utc_now())
         - F.unix_timestamp(F.col("last_refresh"))).cast("bigint").alias("lag_seconds"))


def display_overview(matrix: DataFrame) -> DataFrame:
    """the overview formatted for display (``{:,}``, ``${:,.0f}``, ``{:.1f}``)."""
    o = overview(matrix)
    return o.select(
        F.format_number("total_customers", 0).alias("total_customers"),
        F.concat(F.lit("$"), F.format_number("avg_claim_amount", 0)).alias("avg_claim_amount"),
        F.format_number("avg_risk_score", 1).alias("avg_risk_score"),
        F.date_format("last_refresh", "HH:mm:ss").alias("last_refresh_time"))


# fixed values: the governance panel (feature, status, impact); {n} is the number of visible states
PANEL = [
    ("Data Masking", "✅ Active (Claim amounts masked)", "Protects sensitive financial data"),
    ("Row Access Control", "✅ Active (Territory-based)", "Ensures appropriate data access"),
    ("Geographic Restriction", "✅ Active ({n} states only)", "Maintains broker territory boundaries"),
    ("Real-time Enforcement", "✅ Active (Policy-enforced)", "Zero configuration for consumers"),
]


def _panel(states: DataFrame) -> DataFrame:
    """The panel rows from the one row of ``states`` (visible_states)."""
    n = F.col("visible_states").cast("string")
    return states.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.replace(F.lit(s), F.lit("{n}"), n).alias("status"), F.lit(i).alias("impact"))
        for f, s, i in PANEL])))


def policy_status(view: DataFrame) -> DataFrame:
    """The governance panel over what the role sees."""
    return _panel(view.agg(_distinct_states().alias("visible_states")))


# ---------------------------------------------------------------------------
# All reports of all roles from one summary

SUMMARY_KEYS = ["age_category", "customer_state", "risk_level"]


def summary(matrix: DataFrame, *more: str) -> DataFrame:
    """Counts and sums of the risk matrix by age category, state and level (and ``more`` columns): at most
    5 x 4 x 3 rows of each, with the claim amounts as they are and as they are masked."""
    masked = gov.floor_mask(F.col("claim_amount_filled"))
    return matrix.withColumn("_masked", masked).groupBy(*more, *SUMMARY_KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("total_risk_score").alias("score"), F.count("total_risk_score").alias("score_n"),
        F.sum("age_risk_score").alias("age_score"), F.count("age_risk_score").alias("age_score_n"),
        F.sum("policy_annual_premium").alias("premium"), F.count("policy_annual_premium").alias("premium_n"),
        F.count("claim_amount_filled").alias("amount_n"),
        F.sum("claim_amount_filled").alias("true_amount"), F.max("claim_amount_filled").alias("true_max"),
        F.sum("_masked").alias("masked_amount"), F.max("_masked").alias("masked_max"),
        F.max("last_updated").alias("last_updated"))


def governed_summary(s: DataFrame, ctx: gov.AccessContext, policies: gov.PolicySet = gov.RISK_MATRIX_POLICIES) -> DataFrame:
    """What ``ctx`` may see of a summary: the row policy on its states, the mask by choice of the amounts."""
    for rp in policies.rows:
        s = s.where(rp.fn(F.col(rp.column), ctx))
    kind = "masked" if policies.masks and not ctx.is_admin else "true"
    return s.withColumns({"amount": F.col(f"{kind}_amount"), "amount_max": F.col(f"{kind}_max")})


def _mean(total: str, k: int, n: str | None = None) -> Column:
    count = F.sum(n or f"{total}_n")
    return F.round(F.sum(total) / F.when(count > 0, count), k).cast("double")


def _n(level: str | None = None) -> Column:
    c = F.sum("n") if level is None else F.sum(F.when(F.col("risk_level") == level, F.col("n")).otherwise(0))
    return F.coalesce(c, F.lit(0)).cast("bigint")


def summary_overview(g: DataFrame) -> DataFrame:
    """R1 of a governed summary."""
    return g.agg(_n().alias("total_customers"), _n("HIGH").alias("high_risk_count"), _n("MEDIUM").alias("medium_risk_count"),
                 _n("LOW").alias("low_risk_count"), _mean("score", 1).alias("avg_risk_score"),
                 _mean("amount", 0).alias("avg_claim_amount"), F.max("last_updated").alias("last_refresh"))


def summary_by_age_category(g: DataFrame) -> DataFrame:
    """R2 of a governed summary."""
    return _order_small(g.groupBy("age_category").agg(
        _n().alias("customer_count"), _mean("age_score", 1).alias("avg_age_risk_score"),
        _mean("score", 1).alias("avg_total_risk_score"), _n("HIGH").alias("high_risk_count")),
        F.desc("avg_total_risk_score"), "age_category")


def summary_by_state(g: DataFrame) -> DataFrame:
    """R3 of a governed summary."""
    return _order_small(g.groupBy("customer_state").agg(
        _n().alias("customer_count"), _mean("score", 1).alias("avg_risk_score"), _n("HIGH").alias("high_risk_count"),
        _mean("amount", 0).alias("avg_claim_amount")), F.desc("customer_count"), "customer_state")


def summary_by_risk_level(g: DataFrame) -> DataFrame:
    """R4 of a governed summary."""
    return _order_small(g.groupBy("risk_level").agg(
        _n().alias("count"), _mean("score", 1).alias("avg_score"), _mean("amount", 0).alias("avg_claim"),
        _mean("premium", 0).alias("avg_premium")), F.desc("avg_score"), "risk_level")


def summary_role(g: DataFrame, role_name: str | None) -> DataFrame:
    """R5 of a governed summary (the broker view leaves out rows without a state)."""
    return g.where(F.col("customer_state").isNotNull()).agg(
        F.lit(role_name).cast("string").alias("role_name"), _n().alias("visible_records"),
        _distinct_states().alias("visible_states"), _mean("amount", 0).alias("avg_claim_amount"),
        F.max("amount_max").cast("double").alias("max_claim_amount"))


def roles_summary(s: DataFrame, contexts: dict[str, gov.AccessContext]) -> DataFrame:
    """R5 for several contexts over one summary: its few rows fan out to the contexts that see them."""
    broker = F.col("customer_state").isin(*gov.BROKER_STATES)
    rows = [F.struct(F.lit(k).alias("role_name"), F.lit(i).alias("place"),
                     (F.lit(True) if c.is_admin else broker if c.is_broker else F.lit(False)).alias("sees"), F.lit(c.is_admin).alias("admin"))
            for i, (k, c) in enumerate(contexts.items())]
    g = s.where(F.col("customer_state").isNotNull()).select("*", F.inline(F.array(*rows)))
    mine = lambda c: F.when(F.col("sees"), c)
    amount, most = (F.when(F.col("admin"), F.col(f"true_{x}")).otherwise(F.col(f"masked_{x}")) for x in ("amount", "max"))
    out = g.groupBy("role_name", "place").agg(
        F.coalesce(F.sum(mine(F.col("n"))), F.lit(0)).cast("bigint").alias("visible_records"),
        F.size(F.collect_set(mine(F.col("customer_state")))).cast("bigint").alias("visible_states"),
        F.round(F.sum(mine(amount)) / F.sum(mine(F.col("amount_n"))), 0).cast("double").alias("avg_claim_amount"),
        F.max(mine(most)).cast("double").alias("max_claim_amount"))
    return _order_small(out, "place").drop("place")


ANALYTICS_LIFE, GOVERNANCE_LIFE = 30.0, 60.0   # fixed values: seconds that shared report results live


class ReportCache:
    """The summary, computed once and shared by all reports and roles until it is too old.

    Its rows (at most 60) are held, not the matrix behind them."""

    def __init__(self, matrix: Callable[[], DataFrame], life: float = ANALYTICS_LIFE, clock: Callable[[], float] = time.monotonic):
        self._matrix, self._life, self._clock = matrix, life, clock
        self._rows, self._at = None, None

    def summary(self) -> DataFrame:
        if self._rows is None or self._clock() - self._at >= self._life:
            s = summary(self._matrix())
            self._rows = s.sparkSession.createDataFrame(s.collect(), s.schema)   # at most 60 rows
            self._at = self._clock()
        return self._rows

    def report(self, name: str, ctx: gov.AccessContext) -> DataFrame:
        g = governed_summary(self.summary(), ctx)
        return {"overview": summary_overview, "by_age_category": summary_by_age_category, "by_state": summary_by_state,
                "by_risk_level": summary_by_risk_level}[name](g)
