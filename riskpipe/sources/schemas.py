"""Declared schemas of the two raw tables and of the derived tables.

Raw tables have a fixed DDL; derived tables take their schema from the query
that builds them (``operators.integrate``), so only the raw ones live here.
``NUMBER`` columns used as integers are ``int``; ``NUMBER(10,2)`` is
``decimal(10,2)``; ``TIMESTAMP_NTZ`` is ``timestamp_ntz``.
"""

from __future__ import annotations

from pyspark.sql import types as T

AMOUNT = T.DecimalType(10, 2)

# fixed values: the raw column lists in declared order
CLAIMS_COLUMNS = [
    ("policy_number", T.StringType()),
    ("incident_date", T.TimestampNTZType()),
    ("incident_type", T.StringType()),
    ("incident_severity", T.StringType()),
    ("authorities_contacted", T.StringType()),
    ("incident_hour_of_the_day", T.IntegerType()),
    ("number_of_vehicles_involved", T.IntegerType()),
    ("bodily_injuries", T.IntegerType()),
    ("witnesses", T.IntegerType()),
    ("police_report_available", T.StringType()),
    ("claim_amount", AMOUNT),
    ("fraud_reported", T.BooleanType()),
]

CUSTOMER_COLUMNS = [
    ("policy_number", T.StringType()),
    ("age", T.IntegerType()),
    ("policy_start_date", T.TimestampNTZType()),
    ("policy_length_month", T.IntegerType()),
    ("policy_deductable", AMOUNT),
    ("policy_annual_premium", AMOUNT),
    ("insured_sex", T.StringType()),
    ("insured_education_level", T.StringType()),
    ("insured_occupation", T.StringType()),
]

# Declared maximum lengths of VARCHAR(n) columns (checked on load).
VARCHAR_LIMITS = {
    "claims": {"policy_number": 50, "incident_type": 100, "incident_severity": 50,
               "authorities_contacted": 50, "police_report_available": 10},
    "customers": {"policy_number": 50, "insured_sex": 10, "insured_education_level": 50,
                  "insured_occupation": 100},
}

AUDIT_COLUMNS = [
    ("load_timestamp", T.TimestampNTZType()),
    ("file_name", T.StringType()),
]

DEFAULT_FILE_NAME = "INITIAL_LOAD"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def _struct(cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


CLAIMS_DATA = _struct(CLAIMS_COLUMNS)
CUSTOMER_DATA = _struct(CUSTOMER_COLUMNS)
CLAIMS_RAW = _struct(CLAIMS_COLUMNS + AUDIT_COLUMNS)
CUSTOMER_RAW = _struct(CUSTOMER_COLUMNS + AUDIT_COLUMNS)

RAW_SCHEMAS = {"claims": CLAIMS_RAW, "customers": CUSTOMER_RAW}
DATA_SCHEMAS = {"claims": CLAIMS_DATA, "customers": CUSTOMER_DATA}
