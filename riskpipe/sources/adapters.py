"""Adapter from the generic parquet test tables to the two raw tables.

``customer`` becomes ``customer_raw`` and ``orders`` becomes ``claims_raw``.
Every derived column is a deterministic function of the source key, written
with built-in column functions only, so the adapter is a narrow projection
(no shuffle) that reads only the source columns it needs.

The same expressions, in DuckDB SQL, live in ``plans.oracle`` so that both
engines see identical raw tables.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpipe.sources.schemas import AMOUNT, DEFAULT_FILE_NAME

# fixed values: adapter vocabularies (index = key modulo list length)
EDUCATION_LEVELS = ["College", "Associate", "High School", "Masters", "PhD", "JD", "MD"]
INCIDENT_TYPES = ["Single Vehicle Collision", "Multi-vehicle Collision", "Vehicle Theft", "Parked Car"]
SEVERITIES = ["Trivial Damage", "Minor Damage", "Major Damage", "Total Loss"]
AUTHORITIES = [None, "Police", "Ambulance", "Fire", "Other"]
POLICE_REPORT = ["YES", "NO", "?"]

CUSTOMER_LOAD_TS = "1998-01-01 00:00:00"   # a wall-clock literal: independent of any time zone
POLICY_START_BASE = _dt.date(2010, 1, 1)


def _pick(values: list, index: Column) -> Column:
    """values[index] for a 0-based integer column (NULL entries allowed)."""
    arr = F.array(*[F.lit(v).cast("string") for v in values])
    return F.element_at(arr, (index + 1).cast("int"))


def customer_raw(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        F.when(k % 211 == 7, F.lit(None).cast("string")).otherwise(k.cast("string")).alias("policy_number"),
        F.when(k % 97 == 5, F.lit(None)).otherwise(15 + k % 75).cast("int").alias("age"),
        F.date_add(F.lit(POLICY_START_BASE), (k % 1500).cast("int")).cast("timestamp_ntz").alias("policy_start_date"),
        (100 + k % 281).cast("int").alias("policy_length_month"),
        F.when(k % 3 == 0, 500).when(k % 3 == 1, 1000).otherwise(2000).cast(AMOUNT).alias("policy_deductable"),
        (800 + (k * 37) % 1200).cast(AMOUNT).alias("policy_annual_premium"),
        F.when(k % 2 == 0, "M").otherwise("F").alias("insured_sex"),
        _pick(EDUCATION_LEVELS, k % 7).alias("insured_education_level"),
        F.col("c_mktsegment").alias("insured_occupation"),
        F.lit(CUSTOMER_LOAD_TS).cast("timestamp_ntz").alias("load_timestamp"),   # string → NTZ
        F.lit(DEFAULT_FILE_NAME).alias("file_name"),
    )


def claims_raw(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    r = k % 50
    amount = (F.when(r == 0, F.lit(50))
              .when(r == 1, F.lit(600000))
              .when(r == 2, F.lit(None))
              .otherwise(F.floor(F.col("o_totalprice") / 4)))
    ck = F.col("o_custkey")
    # every order becomes a claim; one customer in five gets an unmatched policy
    # number, which leaves customers without claims and claims without customers
    policy = F.when(ck % 5 == 0, F.concat(F.lit("U"), ck.cast("string"))).otherwise(ck.cast("string"))
    return (orders
            .select(
                policy.alias("policy_number"),
                F.col("o_orderdate").cast("timestamp_ntz").alias("incident_date"),
                _pick(INCIDENT_TYPES, k % 4).alias("incident_type"),
                _pick(SEVERITIES, F.expr("o_orderkey div 4") % 4).alias("incident_severity"),
                _pick(AUTHORITIES, k % 5).alias("authorities_contacted"),
                (1 + k % 23).cast("int").alias("incident_hour_of_the_day"),
                (1 + k % 4).cast("int").alias("number_of_vehicles_involved"),
                (k % 3).cast("int").alias("bodily_injuries"),
                (k % 4).cast("int").alias("witnesses"),
                _pick(POLICE_REPORT, k % 3).alias("police_report_available"),
                amount.cast(AMOUNT).alias("claim_amount"),
                F.when(F.col("o_orderstatus") == "F", True)
                 .when(F.col("o_orderstatus") == "O", False).alias("fraud_reported"),
                F.col("o_orderdate").cast("timestamp_ntz").alias("load_timestamp"),
                F.lit(DEFAULT_FILE_NAME).alias("file_name"),
            ))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A parquet table scan (columns and filters are pruned by the plans that use it)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(customer_raw, claims_raw) derived from the parquet tables in ``sf_dir``."""
    return (customer_raw(read_table(spark, sf_dir, "customer")),
            claims_raw(read_table(spark, sf_dir, "orders")))
