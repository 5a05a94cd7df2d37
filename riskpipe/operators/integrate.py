"""Level 1 (customer ⟕ claims integration) and level 2 (risk matrix).

Level 1 is a left outer equi-join on ``policy_number``: every customer row is
kept, each matching claim fans out one row, unmatched claims are dropped and
NULL keys never match.

Skew.  A single policy may own a large share of all claims.  Spark's adaptive
skew handling can only split the *preserved* side of an outer join, which here
is the customer side, so a hot key in claims would land in one task.  We
therefore split hot keys explicitly:

* hot keys are given by the frequency sketches that ingest keeps (``streaming.heavy``) or else are
  those with many claims in a sample of the claim keys (partial
  aggregation, so a hot key costs one row per map task).  Each has at least
  ``2 * rows_per_task`` claims, so there are at most ``claims / (2 * rows_per_task)``
  of them; the list stays a table and is broadcast only while it is small;
* claims of a hot key are spread over ``n_salts`` sub-keys by the place of the row
  in its file, so equal claims spread as well and a recomputed task (after an
  executor is lost) gives the same salt;
* customer rows of a hot key are replicated once per salt and joined on
  ``(key, salt)``; cold keys join on ``(key, 0)``, so one sort-merge join (one
  scan and one shuffle per side) serves both.  Only keys that do have claims when
  the query runs are split, so for them the left join equals the inner join and
  replicas that drew no claim are dropped; a listed key without claims stays cold;
* the claims side has no size bound, so it is never broadcast.

The hot-key list only changes the *plan*, never the result: a key missed by the
sample is joined by the ordinary path, a stale one does no harm.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskpipe.functions import scoring
from riskpipe.session import scratch_path
from riskpipe.sources.schemas import AMOUNT

CUSTOMER_PART = ["policy_number", "age", "insured_sex", "insured_education_level", "insured_occupation",
                 "policy_start_date", "policy_length_month", "policy_deductable", "policy_annual_premium"]
CLAIM_PART = ["incident_date", "incident_type", "incident_severity", "authorities_contacted",
              "incident_hour_of_the_day", "number_of_vehicles_involved", "bodily_injuries", "witnesses",
              "police_report_available", "claim_amount", "fraud_reported"]
LEVEL1_COLUMNS = CUSTOMER_PART + CLAIM_PART + [
    "has_claim", "claim_amount_filled", "fraud_reported_filled", "customer_state", "last_updated"]
LEVEL2_COLUMNS = ["policy_number", "age", "insured_sex", "insured_education_level", "insured_occupation",
                  "policy_annual_premium", "claim_amount_filled", "fraud_reported_filled", "customer_state",
                  "age_category", "age_risk_score", "total_risk_score", "risk_level", "risk_factors",
                  "last_updated"]


@dataclass(frozen=True)
class SkewConfig:
    """How to look for hot join keys.

    mode:            'auto' (sample the claim keys) or 'off'
    sample_fraction: share of claim rows sampled to estimate key counts
    rows_per_task:   target number of claim rows per join task for a hot key
    """
    mode: str = "auto"
    # A key is hot from 2 x rows_per_task claims (4M by default); at a 1e-4 sample it is
    # still expected ~400 times in the sample (reliable detection), while the sample of
    # a 10^12-row table stays ~10^8 keys.  A key the sample misses is joined exactly anyway.
    sample_fraction: float = 1e-4
    rows_per_task: int = 2_000_000
    seed: int = 7


HOT_KEY_SCHEMA = T.StructType([T.StructField("_hot_key", T.StringType(), False),
                               T.StructField("_n_salts", T.IntegerType(), False)])
# rows of a hot-key list that are still broadcast (about 40 MB); a longer one is joined as Spark sees fit
HOT_BROADCAST_ROWS = 1_000_000


def detect_hot_keys(claims: DataFrame, key: str = "policy_number", cfg: SkewConfig = SkewConfig()) -> DataFrame:
    """(_hot_key, _n_salts) of the keys whose estimated claim count is at least twice ``rows_per_task``.

    Reads only the key column; the sampled counts are partially aggregated per map task."""
    f = min(cfg.sample_fraction, 1.0)
    keys = claims.select(F.col(key).alias("_hot_key")).where(F.col("_hot_key").isNotNull())
    if cfg.mode == "off":
        keys = keys.limit(0)
    sampled = keys if f >= 1.0 else keys.sample(fraction=f, seed=cfg.seed)
    least = 2 * max(1, math.ceil(cfg.rows_per_task * f))
    return (sampled.groupBy("_hot_key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
            .select("_hot_key", F.greatest(F.lit(2), F.ceil(F.col("n") / (f * cfg.rows_per_task))).cast("int").alias("_n_salts")))


def with_locator(claims: DataFrame) -> DataFrame:
    """``claims`` with ``_row``: a hash of the row's place (file and row number), the same in every run of a task.

    Rows that do not come from files are written to the shared scratch folder first: a place in a
    shuffled plan may differ when a task runs again."""
    if "_row" in claims.columns:
        return claims
    place = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias("_row")
    try:
        return claims.select("*", place)
    except AnalysisException:
        spark = claims.sparkSession
        path = scratch_path(spark, "located")
        claims.write.parquet(path)
        return spark.read.schema(claims.schema).parquet(path).select("*", place)


def _claims_side(claims: DataFrame, *more: str) -> DataFrame:
    return claims.select(
        F.col("policy_number").alias("_cl_key"),
        *CLAIM_PART,
        F.col("load_timestamp").alias("_cl_load"), *more)


def _customer_side(customers: DataFrame) -> DataFrame:
    return customers.select(*CUSTOMER_PART, F.col("load_timestamp").alias("_c_load"))


# The claims side grows with the data and has no size bound, so the main join is
# always a sort-merge join (hint placed right before it): it is never broadcast,
# not even when AQE measures it small at test scale, and it spills gracefully.
UNBOUNDED = "shuffle_merge"


def left_join_claims(customers: DataFrame, claims: DataFrame, hot: DataFrame | None = None, live: bool = False) -> DataFrame:
    """Customers ⟕ claims on policy_number; hot keys split over salted sub-keys.

    ``hot`` is a table (_hot_key, _n_salts), not empty, or None.  With hot keys there is
    still one scan and one shuffle per side: the join key becomes ``(policy_number, salt)``;
    cold keys use salt 0, a hot key's claims get a salt in ``[0, n)`` by their place and its
    customer rows are replicated once per salt.  Each claim meets exactly one replica.
    ``live`` says that every listed key has claims; otherwise the claims are asked first."""
    cust = _customer_side(customers)
    if hot is None:
        cl = _claims_side(claims)
        return cust.join(cl.hint(UNBOUNDED), cust["policy_number"] == cl["_cl_key"], "left")

    small = hot.limit(HOT_BROADCAST_ROWS + 1).count() <= HOT_BROADCAST_ROWS
    bounded = F.broadcast if small else (lambda d: d)
    # of the listed keys, those that have claims now: replicas without a claim may then go
    keys = hot if live else (claims.select(F.col("policy_number").alias("_hot_key")).join(bounded(hot), "_hot_key")
                             .groupBy("_hot_key").agg(F.max("_n_salts").alias("_n_salts")))
    hot_df = bounded(keys)
    n = F.col("_n_salts")
    cust_t = (cust.join(hot_df, cust["policy_number"] == hot_df["_hot_key"], "left").drop("_hot_key")
              .withColumn("_salt", F.explode(F.when(n.isNull(), F.array(F.lit(0)))
                                             .otherwise(F.sequence(F.lit(0), n - 1)))))
    hot_c = bounded(keys.withColumnRenamed("_n_salts", "_cl_n_salts"))
    cl = _claims_side(with_locator(claims), "_row")
    cl_t = (cl.join(hot_c, cl["_cl_key"] == hot_c["_hot_key"], "left").drop("_hot_key")
            .withColumn("_cl_salt", F.when(F.col("_cl_n_salts").isNull(), F.lit(0))
                        .otherwise(F.pmod(F.col("_row"), F.col("_cl_n_salts").cast("long")).cast("int")))
            .drop("_cl_n_salts", "_row"))
    j = cust_t.join(cl_t.hint(UNBOUNDED), (cust_t["policy_number"] == cl_t["_cl_key"])
                    & (cust_t["_salt"] == cl_t["_cl_salt"]), "left")
    return j.where(n.isNull() | F.col("_cl_key").isNotNull()).drop("_n_salts", "_salt", "_cl_salt")


def _hot_table(claims: DataFrame, hot, skew: SkewConfig | None) -> DataFrame | None:
    """The hot-key table to use, or None for the plain join: what ``skew`` finds, or the given pairs or table."""
    spark = claims.sparkSession
    if hot is None:
        found = detect_hot_keys(claims, cfg=skew or SkewConfig())
        path = scratch_path(spark, "hot_keys")   # written once: read by the size check and by both sides of the join
        found.write.parquet(path)
        hot = spark.read.schema(found.schema).parquet(path)
    elif not isinstance(hot, DataFrame):
        if not hot:
            return None
        hot = spark.createDataFrame([(str(k), int(m)) for k, m in hot], HOT_KEY_SCHEMA)
    hot = hot.where(F.col("_n_salts") > 1)
    return None if hot.isEmpty() else hot


def integrate(customers: DataFrame, claims: DataFrame, *, state_mode: str = "portable",
              skew: SkewConfig | None = None, hot=None, live: bool = False) -> DataFrame:
    """Level-1 table ``customer_claims_integrated``.

    ``hot`` (pairs of key and salts, or a table of them, each key once; ``[]``: none) overrides detection;
    otherwise ``skew`` decides.  ``live``: every key in ``hot`` is known to have claims.
    """
    j = left_join_claims(customers, claims, _hot_table(claims, hot, skew), live and hot is not None)
    # the hash remainder is computed once in its own projection, not once per CASE branch
    j = j.withColumn("_m", scoring.hash_bucket10(F.col("policy_number"), state_mode))
    return j.select(                                                       # P1 projection
        *CUSTOMER_PART,
        *CLAIM_PART,
        F.when(F.col("_cl_key").isNotNull(), 1).otherwise(0).alias("has_claim"),                 # P4
        F.coalesce(F.col("claim_amount"), F.lit(0)).cast(AMOUNT).alias("claim_amount_filled"),  # P5/F1
        F.coalesce(F.col("fraud_reported"), F.lit(False)).alias("fraud_reported_filled"),       # P5/F1
        scoring.state_from_bucket(F.col("_m")).alias("customer_state"),                          # D1/P6
        F.greatest(F.col("_c_load"), F.coalesce(F.col("_cl_load"), F.col("_c_load"))).alias("last_updated"),  # F2
    )


def risk_matrix(integrated: DataFrame) -> DataFrame:
    """Level-2 table ``risk_score_matrix``; the total score is computed once."""
    age, amt, fraud = F.col("age"), F.col("claim_amount_filled"), F.col("fraud_reported_filled")
    return (integrated
            .select("policy_number", "age", "insured_sex", "insured_education_level", "insured_occupation",
                    "policy_annual_premium", "claim_amount_filled", "fraud_reported_filled", "customer_state",
                    scoring.driver_age_category(age).alias("age_category"),
                    scoring.age_risk_score(age).alias("age_risk_score"),
                    scoring.total_risk_score(age, amt, fraud).alias("total_risk_score"),
                    scoring.risk_factors(age, amt, fraud).alias("risk_factors"),
                    "last_updated")
            .withColumn("risk_level", scoring.risk_level(F.col("total_risk_score")))
            .select(*LEVEL2_COLUMNS))


def orphan_claims(customers: DataFrame, claims: DataFrame) -> DataFrame:
    """Claims whose policy has no customer row (dropped by the level-1 left join).

    A left anti join: the claims side is the one AQE may split when a key is hot,
    and only the distinct customer keys are shuffled from the other side."""
    keys = (customers.select(F.col("policy_number").alias("_c_key")).where(F.col("_c_key").isNotNull())
            .distinct().hint("shuffle_merge"))   # grows with the data: never broadcast
    return claims.join(keys, claims["policy_number"] == keys["_c_key"], "left_anti")
