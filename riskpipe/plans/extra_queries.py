"""Registered queries for quality, ingest, classification, export and streaming (M4-M7)."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from riskpipe.operators import classify as K
from riskpipe.operators import governance as gov
from riskpipe.operators import integrate as INTEG
from riskpipe.operators import quality as Q
from riskpipe.plans import oracle as O
from riskpipe.plans import reports as RP
from riskpipe.plans.catalog import _L1_SQL_COLS, _L2_SQL_COLS, FORCED_SKEW, SUMMARY, _mean, _n, comparable, level1, level2, raw, register
from riskpipe.session import scratch_path
from riskpipe.sources import csv_ingest as C
from riskpipe.sources import schemas as S
from riskpipe.streaming import heavy as H
from riskpipe.streaming import ingest as I
from riskpipe.streaming import monitor as MON
from riskpipe.streaming import refresh as R
from riskpipe.streaming import summary as SM

# ---------------------------------------------------------------------------
# M6: quality metrics

def _outside(bounds: tuple[int, int]):
    return lambda c: f"COALESCE(SUM(CASE WHEN {c} NOT BETWEEN {bounds[0]} AND {bounds[1]} THEN 1 ELSE 0 END), 0)"


# what each metric function counts, in SQL; range checks by the column that they are for
_BODIES = {Q.null_count: lambda c: f"COUNT(*) - COUNT({c})",
           Q.duplicate_count: lambda c: f"COUNT(*) - COUNT(DISTINCT {c}) - CAST(COUNT(*) > COUNT({c}) AS INTEGER)",
           Q.row_count: lambda: "COUNT(*)"}
_RANGES = {"claim_amount": _outside(Q.CLAIM_AMOUNT_RANGE), "age": _outside(Q.CUSTOMER_AGE_RANGE)}
_METRICS_SQL = {t: [(m.name, _BODIES.get(m.expr, _RANGES.get(m.columns[0] if m.columns else None))(*m.columns)) for m in specs]
                for t, specs in (("claims_raw", Q.CLAIMS_SPECS), ("customer_raw", Q.CUSTOMER_SPECS))}


def _metrics_sql(table: str, extra_cols: str = "", group: str = "") -> str:
    """One SELECT per metric of ``table`` (DuckDB), UNION ALL."""
    parts = []
    for name, expr in _METRICS_SQL[table]:
        parts.append(f"SELECT {extra_cols}{O.ts('MAX(load_timestamp)')} AS change_commit_time, "
                     f"'{table}' AS table_name, '{name}' AS metric_name, CAST({expr} AS BIGINT) AS value "
                     f"FROM {table} {group}")
    return "\nUNION ALL\n".join(parts)


def _metrics(spark, sf_dir):
    cust, claims = raw(spark, sf_dir)
    return {"claims_raw": claims, "customer_raw": cust}


@register("dq_claims", O.with_ctes(O.CLAIMS_RAW) + _metrics_sql("claims_raw"))
def q_dq_claims(spark, sf_dir):
    return comparable(Q.run_metrics(_metrics(spark, sf_dir)["claims_raw"], Q.CLAIMS_SPECS, "claims_raw"))


@register("dq_customers", O.with_ctes(O.CUSTOMER_RAW) + _metrics_sql("customer_raw"))
def q_dq_customers(spark, sf_dir):
    return comparable(Q.run_metrics(_metrics(spark, sf_dir)["customer_raw"], Q.CUSTOMER_SPECS, "customer_raw"))


_RESULTS_SQL = (O.with_ctes(O.CUSTOMER_RAW, O.CLAIMS_RAW)
                + "SELECT change_commit_time, 'riskpipe' AS table_database, 'raw_data' AS table_schema, "
                  "table_name, metric_name, value FROM (\n"
                + _metrics_sql("claims_raw") + "\nUNION ALL\n" + _metrics_sql("customer_raw")
                + "\n) r ORDER BY change_commit_time DESC, table_name, metric_name")


@register("dq_results_sorted", _RESULTS_SQL)
def q_dq_results_sorted(spark, sf_dir):
    """Q8 results in the monitoring shape, filtered and sorted (measurement time left out:
    it is the wall clock of the run)."""
    res = Q.results(_metrics(spark, sf_dir), Q.default_registry())
    return comparable(Q.results_sorted(res).drop("measurement_time"))


_REGISTRY_SQL = (O.with_ctes(O.CUSTOMER_RAW, O.CLAIMS_RAW)
                 + "SELECT metric_name, table_name AS ref_entity_name, '5 MINUTE' AS schedule, "
                   "'STARTED' AS schedule_status, value FROM (\n"
                 + _metrics_sql("claims_raw") + "\nUNION ALL\n" + _metrics_sql("customer_raw") + "\n) r")


@register("dq_registry", _REGISTRY_SQL)
def q_dq_registry(spark, sf_dir):
    """Q6/Q7: attached metrics of both tables (O4 union) with their latest value."""
    reg = Q.default_registry()
    tables = _metrics(spark, sf_dir)
    latest = Q.run_metrics(tables["claims_raw"], reg.for_table("claims_raw"), "claims_raw").unionByName(
        Q.run_metrics(tables["customer_raw"], reg.for_table("customer_raw"), "customer_raw"))
    return Q.registry_listing(reg, latest)


def _score_sql(table: str) -> str:
    viol = [e for n, e in _METRICS_SQL[table] if n != "ROW_COUNT"]
    k = len(viol)
    total = " + ".join(f"({e})" for e in viol)
    return (f"SELECT '{table}' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count, "
            f"CAST({total} AS BIGINT) AS violations, CAST({k} AS BIGINT) AS rules, "
            f"CAST(CASE WHEN COUNT(*) * {k} > 0 THEN ROUND(GREATEST(0.0, LEAST(100.0, "
            f"100.0 * (1.0 - CAST({total} AS BIGINT) / CAST(COUNT(*) * {k} AS DOUBLE)))), 2) END AS DOUBLE) "
            f"AS quality_score FROM {table}")


@register("dq_score", O.with_ctes(O.CUSTOMER_RAW, O.CLAIMS_RAW)
          + _score_sql("claims_raw") + "\nUNION ALL\n" + _score_sql("customer_raw"))
def q_dq_score(spark, sf_dir):
    t = _metrics(spark, sf_dir)
    return Q.quality_score(t["claims_raw"], Q.CLAIMS_SPECS, "claims_raw").unionByName(
        Q.quality_score(t["customer_raw"], Q.CUSTOMER_SPECS, "customer_raw"))


def _history(spark, sf_dir):
    """Metric history: one measurement per load year (a batch), grouped in one pass per table."""
    t = _metrics(spark, sf_dir)
    parts = [Q.run_metrics(df.withColumn("batch", F.year("load_timestamp").cast("bigint")),
                           Q.CLAIMS_SPECS if name == "claims_raw" else Q.CUSTOMER_SPECS, name, by=["batch"])
             for name, df in t.items()]
    return parts[0].unionByName(parts[1])


_HISTORY_SQL = ("h AS (" + _metrics_sql("claims_raw", "CAST(year(load_timestamp) AS BIGINT) AS batch, ",
                                        "GROUP BY year(load_timestamp)")
                + "\nUNION ALL\n" + _metrics_sql("customer_raw", "CAST(year(load_timestamp) AS BIGINT) AS batch, ",
                                                 "GROUP BY year(load_timestamp)") + ")")


@register("dq_trend", O.with_ctes(O.CUSTOMER_RAW, O.CLAIMS_RAW, _HISTORY_SQL) + """
SELECT batch, table_name, metric_name, value,
       LAG(value) OVER (PARTITION BY table_name, metric_name ORDER BY batch) AS previous_value,
       value - LAG(value) OVER (PARTITION BY table_name, metric_name ORDER BY batch) AS change
FROM h""")
def q_dq_trend(spark, sf_dir):
    return Q.trend(_history(spark, sf_dir))


_TH_SQL = "th(t_table, t_metric, max_value, severity) AS (VALUES " + ", ".join(
    f"('{t}', '{m}', {v}, '{s}')" for t, m, v, s in Q.DEFAULT_THRESHOLDS) + ")"


@register("dq_alerts", O.with_ctes(O.CUSTOMER_RAW, O.CLAIMS_RAW, _TH_SQL,
                                   "r AS (" + _metrics_sql("claims_raw") + "\nUNION ALL\n"
                                   + _metrics_sql("customer_raw") + ")") + """
SELECT table_name, metric_name, value, CAST(max_value AS BIGINT) AS threshold, severity
FROM r JOIN th ON r.table_name = th.t_table AND r.metric_name = th.t_metric
WHERE value > max_value""")
def q_dq_alerts(spark, sf_dir):
    res = Q.results(_metrics(spark, sf_dir), Q.default_registry())
    return Q.alerts(res)


_MONTHS_SQL = ("h AS (" + _metrics_sql("claims_raw", "date_trunc('month', load_timestamp) AS measurement_time, ", "GROUP BY date_trunc('month', load_timestamp)")
               + "\nUNION ALL\n" + _metrics_sql("customer_raw", "date_trunc('month', load_timestamp) AS measurement_time, ", "GROUP BY date_trunc('month', load_timestamp)") + ")")


@register("dq_alert_episodes", O.with_ctes(O.CUSTOMER_RAW, O.CLAIMS_RAW, _MONTHS_SQL) + f""",
m AS (SELECT *, (SUM(value) OVER k * 110) // (100 * COUNT(*) OVER k) AS hi, (SUM(value) OVER k * 100) // (100 * COUNT(*) OVER k) AS lo
      FROM h WINDOW k AS (PARTITION BY table_name, metric_name)),
s AS (SELECT *, COALESCE(LAST_VALUE(CASE WHEN value > hi THEN 1 WHEN value <= lo THEN 0 END IGNORE NULLS) OVER k, 0) AS up
      FROM m WINDOW k AS (PARTITION BY table_name, metric_name ORDER BY measurement_time ROWS UNBOUNDED PRECEDING)),
c AS (SELECT *, CASE WHEN up = 1 AND COALESCE(LAG(up) OVER k, 0) = 0 THEN 1 ELSE 0 END AS opens FROM s WINDOW k AS (PARTITION BY table_name, metric_name ORDER BY measurement_time)),
e AS (SELECT *, CAST(SUM(opens) OVER (PARTITION BY table_name, metric_name ORDER BY measurement_time ROWS UNBOUNDED PRECEDING) AS BIGINT) AS episode FROM c),
g AS (SELECT table_name, metric_name, episode, MIN(measurement_time) AS o, MIN(measurement_time) FILTER (up = 0) AS z, MAX(measurement_time) FILTER (up = 1) AS newest,
             MAX(value) FILTER (up = 1) AS peak, COUNT(*) FILTER (up = 1) AS measurements FROM e WHERE episode > 0 GROUP BY ALL)
SELECT table_name, metric_name, episode, {O.ts('o')} AS opened_at, {O.ts('z')} AS closed_at,
       CAST(epoch(COALESCE(z, newest)) - epoch(o) AS BIGINT) AS seconds, peak, measurements FROM g""")
def q_dq_alert_episodes(spark, sf_dir):
    """Q11 over a stored history with a measurement of each load month: when each metric was above its usual level, and for how long."""
    path = scratch_path(spark, "metric_history") + "/results"
    for name, df in _metrics(spark, sf_dir).items():
        specs = Q.CLAIMS_SPECS if name == "claims_raw" else Q.CUSTOMER_SPECS
        month = df.withColumn("measurement_time", F.date_trunc("month", "load_timestamp").cast("timestamp_ntz"))
        Q.append_results(Q.run_metrics(month, specs, name, by=["measurement_time"]), path)
    history = spark.read.parquet(path)
    return comparable(Q.alert_episodes(history, Q.usual_thresholds(history)))


def _load_validation_sql(table: str, count_name: str) -> str:
    """From one row for each policy."""
    return (f", per AS (SELECT policy_number, COUNT(*) AS n, MIN(load_timestamp) AS lo, MAX(load_timestamp) AS hi FROM {table} GROUP BY ALL) "
            f"SELECT 'INITIAL LOAD STATUS' AS check_type, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS {count_name}, COUNT(policy_number) AS unique_policies, "
            f"{O.ts('MIN(lo)')} AS first_loaded, {O.ts('MAX(hi)')} AS last_loaded FROM per")


@register("load_validation_claims", O.with_ctes(O.CLAIMS_RAW) + _load_validation_sql("claims_raw", "total_claims"))
def q_load_validation_claims(spark, sf_dir):
    return comparable(Q.load_validation(_metrics(spark, sf_dir)["claims_raw"], count_name="total_claims"))


@register("load_validation_customers",
          O.with_ctes(O.CUSTOMER_RAW) + _load_validation_sql("customer_raw", "total_customers"))
def q_load_validation_customers(spark, sf_dir):
    return comparable(Q.load_validation(_metrics(spark, sf_dir)["customer_raw"], count_name="total_customers"))


# ---------------------------------------------------------------------------
# M4: by-name CSV ingest over landing files derived from the tables


CLAIM_DATA_COLS = [f.name for f in S.CLAIMS_DATA.fields]
CUSTOMER_DATA_COLS = [f.name for f in S.CUSTOMER_DATA.fields]
# rows whose text is made unconvertible in the derived "dirty" drop
BAD_AMOUNT = "witnesses = 0 AND bodily_injuries = 1"
BAD_FRAUD = "incident_hour_of_the_day = 7"


def _claims_text(claims, dirty: bool):
    df = claims.select(*CLAIM_DATA_COLS)
    if dirty:
        df = (df.withColumn("claim_amount", F.when(F.expr(BAD_AMOUNT), F.lit("n/a"))
                            .otherwise(F.col("claim_amount").cast("string")))
              .withColumn("fraud_reported", F.when(F.expr(BAD_FRAUD), F.lit("maybe"))
                          .otherwise(F.col("fraud_reported").cast("string"))))
    return df


def write_drop(df, directory: str, prefix: str, data_cols: list[str], split_col: str) -> list[str]:
    """Two landing files per half: one half with the declared upper-case header,
    the other with a lower-case header in reverse order (by-name binding matters)."""
    even = F.coalesce(F.col(split_col), F.lit(0)) % 2 == 0
    a = C.write_named_csv(df.where(even), directory, f"{prefix}_A",
                          column_order=data_cols, header_case="upper")
    b = C.write_named_csv(df.where(~even), directory, f"{prefix}_B",
                          column_order=list(reversed(data_cols)), header_case="lower")
    return a + b


def _sql_cols(cols) -> str:
    conv = {"claim_amount": "CAST(claim_amount AS DOUBLE) AS claim_amount",
            "incident_date": f"{O.ts('incident_date')} AS incident_date"}
    return ", ".join(conv.get(c, c) for c in cols)


@register("csv_by_name_load", O.with_ctes(O.CLAIMS_RAW) + f"SELECT {_sql_cols(CLAIM_DATA_COLS)} FROM claims_raw")
def q_csv_by_name_load(spark, sf_dir):
    """Strict load of a derived drop whose files disagree on header order."""
    _, claims = raw(spark, sf_dir)
    root = scratch_path(spark, "csv_strict")
    files = write_drop(_claims_text(claims, False), f"{root}/landing", "CLAIMS_DATA", CLAIM_DATA_COLS,
                       "incident_hour_of_the_day")
    C.load_batch(spark, files, "claims", f"{root}/claims_raw", on_error="abort")
    return comparable(spark.read.parquet(f"{root}/claims_raw").select(*CLAIM_DATA_COLS))


def _lenient(spark, sf_dir):
    _, claims = raw(spark, sf_dir)
    root = scratch_path(spark, "csv_lenient")
    files = write_drop(_claims_text(claims, True), f"{root}/landing", "CLAIMS_DATA", CLAIM_DATA_COLS,
                       "incident_hour_of_the_day")
    C.load_batch(spark, files, "claims", f"{root}/claims_raw", on_error="continue",
                 quarantine=f"{root}/quarantine")
    return root


@register("csv_lenient_load", O.with_ctes(O.CLAIMS_RAW)
          + f"SELECT {_sql_cols(CLAIM_DATA_COLS)} FROM claims_raw WHERE NOT ({BAD_AMOUNT}) AND NOT ({BAD_FRAUD})")
def q_csv_lenient_load(spark, sf_dir):
    """S5 semantics in batch: good rows load, bad rows are skipped."""
    root = _lenient(spark, sf_dir)
    return comparable(spark.read.parquet(f"{root}/claims_raw").select(*CLAIM_DATA_COLS))


@register("csv_quarantine", O.with_ctes(O.CLAIMS_RAW) + f"""
SELECT policy_number,
       concat_ws(',', CASE WHEN {BAD_AMOUNT} THEN 'claim_amount' END,
                      CASE WHEN {BAD_FRAUD} THEN 'fraud_reported' END) AS rejected_columns
FROM claims_raw WHERE ({BAD_AMOUNT}) OR ({BAD_FRAUD})""")
def q_csv_quarantine(spark, sf_dir):
    root = _lenient(spark, sf_dir)
    q = spark.read.parquet(f"{root}/quarantine")
    return q.select(F.split("raw_record", ",").getItem(0).alias("policy_number"), "rejected_columns")


@register("file_inventory", O.with_ctes(O.CLAIMS_RAW) + """
SELECT 'CLAIMS_DATA_A' AS drop_name, COUNT_IF(incident_hour_of_the_day % 2 = 0) > 0 AS has_bytes FROM claims_raw
UNION ALL SELECT 'CLAIMS_DATA_B', COUNT_IF(incident_hour_of_the_day % 2 <> 0) > 0 FROM claims_raw""")
def q_file_inventory(spark, sf_dir):
    """The landing files of a derived drop, by drop (paths, times and numbers of files differ from run to run)."""
    _, claims = raw(spark, sf_dir)
    root = scratch_path(spark, "inventory")
    write_drop(_claims_text(claims, False), f"{root}/landing", "CLAIMS_DATA", CLAIM_DATA_COLS,
               "incident_hour_of_the_day")
    files = C.file_inventory(spark, f"{root}/landing", C.CLAIMS_PATTERN)
    return (files.groupBy(F.regexp_extract("path", r"([^/]+)_[0-9]+\.csv$", 1).alias("drop_name"))
            .agg((F.sum("length") > 0).alias("has_bytes")))


@register("csv_typed_edges", O.with_ctes(O.CLAIMS_RAW) + """
SELECT policy_number, CASE WHEN incident_hour_of_the_day = 2 THEN '2015-03-08 02:30:00' ELSE strftime(incident_date, '%Y-%m-%d %H:%M:%S') END AS incident_date,
       fraud_reported FROM claims_raw""")
def q_csv_typed_edges(spark, sf_dir):
    """S3: words for true and false, and times that a session's zone does not have, loaded in such a session."""
    _, claims = raw(spark, sf_dir)
    root = scratch_path(spark, "csv_typed")
    text = claims.select("policy_number", F.when(F.col("incident_hour_of_the_day") == 2, F.lit("2015-03-08 02:30:00.000"))
                         .otherwise(F.date_format("incident_date", S.TIMESTAMP_FORMAT)).alias("incident_date"),
                         F.when(F.col("fraud_reported"), "on").when(~F.col("fraud_reported"), "OFF").alias("fraud_reported"))
    files = C.write_named_csv(text, f"{root}/landing", "CLAIMS_DATA")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Denver")
        C.load_batch(spark, files, "claims", f"{root}/claims_raw", on_error="abort")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    return comparable(spark.read.parquet(f"{root}/claims_raw").select("policy_number", "incident_date", "fraud_reported"))


# ---------------------------------------------------------------------------
# M5: streaming ingest and keyed refresh


def _run(query):
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def _stream_claims(spark, sf_dir):
    _, claims = raw(spark, sf_dir)
    root = scratch_path(spark, "stream_ingest")
    layout = I.Layout(root)
    write_drop(_claims_text(claims, True), f"{root}/landing", "CLAIMS_DATA", CLAIM_DATA_COLS,
               "incident_hour_of_the_day")
    _run(I.start_ingest(spark, f"{root}/landing", "claims", layout, max_files_per_trigger=2))
    return layout


@register("stream_ingest_claims", O.with_ctes(O.CLAIMS_RAW)
          + f"SELECT {_sql_cols(CLAIM_DATA_COLS)} FROM claims_raw WHERE NOT ({BAD_AMOUNT}) AND NOT ({BAD_FRAUD})")
def q_stream_ingest_claims(spark, sf_dir):
    """File stream (availableNow, 2 files per trigger) into the raw table."""
    layout = _stream_claims(spark, sf_dir)
    return comparable(I.read_raw(spark, layout, "claims").select(*CLAIM_DATA_COLS))


@register("ingest_log", O.with_ctes(O.CLAIMS_RAW) + f"""
SELECT 'claims' AS feed, CAST(COUNT_IF(NOT ({BAD_AMOUNT}) AND NOT ({BAD_FRAUD})) AS BIGINT) AS rows_loaded,
       CAST(COUNT_IF(({BAD_AMOUNT}) OR ({BAD_FRAUD})) AS BIGINT) AS rows_rejected FROM claims_raw""")
def q_ingest_log(spark, sf_dir):
    """The ingest log of the claims stream, summed over its batches."""
    layout = _stream_claims(spark, sf_dir)
    return I.ingest_log(spark, layout).groupBy("feed").agg(
        F.sum("rows_loaded").alias("rows_loaded"), F.sum("rows_rejected").alias("rows_rejected"))


_DROPS = ("CASE WHEN incident_hour_of_the_day % 2 = 0 THEN 'A' ELSE 'B' END", f"({BAD_AMOUNT}) OR ({BAD_FRAUD})")


@register("load_history", O.with_ctes(O.CLAIMS_RAW) + f"""
SELECT {_DROPS[0]} AS drop_name, COUNT(*) AS rows_parsed, COUNT_IF(COALESCE(NOT ({_DROPS[1]}), TRUE)) AS rows_loaded, COUNT_IF({_DROPS[1]}) AS rows_rejected,
       TRUE AS errors_located FROM claims_raw GROUP BY ALL""")
def q_load_history(spark, sf_dir):
    """The load history of the claims stream by drop, and whether the files with rejected records, and only they, name the
    place of the first (how rows are spread over files differs from run to run)."""
    history = I.load_history(spark, _stream_claims(spark, sf_dir))
    placed = F.coalesce(F.col("first_error_row").between(1, F.col("rows_parsed")) & F.col("first_error_columns").isNotNull(), F.lit(False))
    return (history.groupBy(F.regexp_extract("file", r"CLAIMS_DATA_([AB])_", 1).alias("drop_name"))
            .agg(*[F.sum(c).alias(c) for c in ("rows_parsed", "rows_loaded", "rows_rejected")],
                 F.every(placed == (F.col("rows_rejected") > 0)).alias("errors_located")))


@register("stream_ingest_nested", O.with_ctes(O.CLAIMS_RAW) + f"SELECT {_sql_cols(CLAIM_DATA_COLS)} FROM claims_raw")
def q_stream_ingest_nested(spark, sf_dir):
    """Files whose folder, not their name, matches the feed's pattern."""
    _, claims = raw(spark, sf_dir)
    root = scratch_path(spark, "stream_nested")
    layout = I.Layout(root)
    C.write_named_csv(_claims_text(claims, False), f"{root}/landing/CLAIMS_DATA", "part", column_order=CLAIM_DATA_COLS)
    _run(I.start_ingest(spark, f"{root}/landing", "claims", layout))
    return comparable(I.read_raw(spark, layout, "claims").select(*CLAIM_DATA_COLS))


_L2_STREAM_COLS = [c for c in ("policy_number", "age", "insured_sex", "insured_education_level",
                               "insured_occupation", "policy_annual_premium", "claim_amount_filled",
                               "fraud_reported_filled", "customer_state", "age_category", "age_risk_score",
                               "total_risk_score", "risk_level", "risk_factors")]


def _l2_sql_cols() -> str:
    conv = {"policy_annual_premium": "CAST(policy_annual_premium AS DOUBLE) AS policy_annual_premium",
            "claim_amount_filled": "CAST(claim_amount_filled AS DOUBLE) AS claim_amount_filled",
            "risk_factors": "array_to_string(risk_factors, '|') AS risk_factors"}
    return ", ".join(conv.get(c, c) for c in _L2_STREAM_COLS)


REFRESH_BUCKETS = 8   # key buckets of the refreshed levels at test scale


@register("stream_refresh_l2", O.with_ctes(*O.BASE_L2) + f"SELECT {_l2_sql_cols()} FROM l2")
def q_stream_refresh_l2(spark, sf_dir):
    """Files arrive as half of the claims, then all customers, then the
    other half of the claims; after each arrival the keyed refresh runs.  The
    final level 2 equals the batch recompute (load times aside)."""
    cust, claims = raw(spark, sf_dir)
    root = scratch_path(spark, "stream_refresh")
    layout = I.Layout(root)
    landing = f"{root}/landing"
    text = _claims_text(claims, False)
    even = F.col("incident_hour_of_the_day") % 2 == 0
    steps = [
        ("claims", lambda: C.write_named_csv(text.where(even), landing, "CLAIMS_DATA_EARLY",
                                             column_order=CLAIM_DATA_COLS)),
        ("customers", lambda: write_drop(cust.select(*CUSTOMER_DATA_COLS), landing, "CUSTOMER_DATA",
                                         CUSTOMER_DATA_COLS, "age")),
        ("claims", lambda: C.write_named_csv(text.where(~even), landing, "CLAIMS_DATA_LATE",
                                             column_order=list(reversed(CLAIM_DATA_COLS)), header_case="lower")),
    ]
    for feed, arrive in steps:
        arrive()
        _run(I.start_ingest(spark, landing, feed, layout, buckets=REFRESH_BUCKETS))
        _run(R.start_refresh(spark, layout, buckets=REFRESH_BUCKETS))
    return comparable(R.level(spark, layout, 2).select(*_L2_STREAM_COLS))


@register("initial_then_stream_l2", O.with_ctes(*O.BASE_L2) + f"SELECT {_l2_sql_cols()} FROM l2")
def q_initial_then_stream_l2(spark, sf_dir):
    """An initial load and landing files afterwards fill the same tables; the refresh joins both.
    The initial files lie in the landing folder still, and are not loaded again."""
    cust, claims = raw(spark, sf_dir)
    root = scratch_path(spark, "initial_stream")
    layout, landing = I.Layout(root), f"{root}/landing"
    text, people = _claims_text(claims, False), cust.select(*CUSTOMER_DATA_COLS)
    first = {"claims": F.col("incident_hour_of_the_day") % 2 == 0, "customers": F.coalesce(F.col("age"), F.lit(0)) % 2 == 0}
    for feed, df, prefix, cols in (("claims", text, "CLAIMS_DATA", CLAIM_DATA_COLS), ("customers", people, "CUSTOMER_DATA", CUSTOMER_DATA_COLS)):
        C.write_named_csv(df.where(first[feed]), landing, prefix, file_name="initial_{n}/{prefix}.csv", column_order=cols)
        I.load_initial(spark, landing, feed, layout, buckets=REFRESH_BUCKETS)
        C.write_named_csv(df.where(~first[feed]), landing, f"{prefix}_LATER", column_order=list(reversed(cols)), header_case="lower")
    for feed in ("claims", "customers"):
        _run(I.start_ingest(spark, landing, feed, layout, buckets=REFRESH_BUCKETS))
    _run(R.start_refresh(spark, layout, buckets=REFRESH_BUCKETS))
    return comparable(R.level(spark, layout, 2).select(*_L2_STREAM_COLS))


@register("ingest_after_reset", O.with_ctes(O.CLAIMS_RAW) + f"SELECT {_sql_cols(CLAIM_DATA_COLS)} FROM claims_raw")
def q_ingest_after_reset(spark, sf_dir):
    """A stream, a compaction, the stream created anew with more files, and a load by force of files that the
    compaction took in: each file's rows are there once."""
    _, claims = raw(spark, sf_dir)
    root = scratch_path(spark, "ingest_reset")
    layout, landing = I.Layout(root), f"{root}/landing"
    text = _claims_text(claims, False)
    early = F.col("incident_hour_of_the_day") % 2 == 0
    first = C.write_named_csv(text.where(early), landing, "CLAIMS_DATA_EARLY", column_order=CLAIM_DATA_COLS)
    I.copy_into(spark, first, "claims", layout, buckets=REFRESH_BUCKETS)
    _run(I.start_ingest(spark, landing, "claims", layout, buckets=REFRESH_BUCKETS))
    I.compact_raw(spark, layout, "claims")
    C.write_named_csv(text.where(~early), landing, "CLAIMS_DATA_LATE", column_order=list(reversed(CLAIM_DATA_COLS)), header_case="lower")
    _run(I.start_ingest(spark, landing, "claims", layout, buckets=REFRESH_BUCKETS, checkpoint=layout.checkpoint("created_anew")))
    I.copy_into(spark, first, "claims", layout, buckets=REFRESH_BUCKETS, force=True)
    return comparable(I.read_raw(spark, layout, "claims").select(*CLAIM_DATA_COLS))


@register("l1_kept_keys", O.with_ctes(*O.BASE_L1) + f"SELECT * EXCLUDE last_updated FROM (SELECT {_L1_SQL_COLS} FROM l1)")
def q_l1_kept_keys(spark, sf_dir):
    """Claims come in two loads, each keeping sketches of its keys; the join splits the hot keys that the
    merged sketches list, without a look at the claims before it (load times aside)."""
    cust, claims = raw(spark, sf_dir)
    root = scratch_path(spark, "kept_keys")
    layout = I.Layout(root)
    paths = write_drop(_claims_text(claims, False), f"{root}/landing", "CLAIMS_DATA", CLAIM_DATA_COLS, "incident_hour_of_the_day")
    for drop in ("CLAIMS_DATA_A", "CLAIMS_DATA_B"):     # two loads, however many files each has
        if mine := [x for x in paths if x.rsplit("/", 1)[-1].startswith(f"{drop}_")]:
            I.copy_into(spark, mine, "claims", layout, buckets=REFRESH_BUCKETS)
    state = I.commits(spark, layout, "claims").state()
    hot = H.hot_keys(spark, layout.heavy("claims"), state, FORCED_SKEW)
    kept = I.read_raw(spark, layout, "claims", state=state)
    return comparable(INTEG.integrate(cust, kept, hot=hot, live=H.certain(state)).drop("last_updated"))


_LATE_KEY = "(SELECT MIN(policy_number) FROM claims0 WHERE policy_number IN (SELECT policy_number FROM customer_raw))"
_LATE_CLAIMS = (O.CLAIMS_RAW.replace("claims_raw AS", "claims0 AS", 1) + f""",
claims_raw AS (SELECT * FROM claims0 UNION ALL
  SELECT * REPLACE (CAST(60000 AS DECIMAL(10, 2)) AS claim_amount, TRUE AS fraud_reported) FROM claims0 WHERE policy_number = {_LATE_KEY})""")


def _with_late_claims(spark, sf_dir, name: str, after=lambda spark, layout: None) -> I.Layout:
    """Everything loaded and refreshed, then late claims of one policy; ``after`` runs after each refresh."""
    cust, claims = raw(spark, sf_dir)
    root = scratch_path(spark, name)
    layout, landing = I.Layout(root), f"{root}/landing"
    text = _claims_text(claims, False)
    files = {"claims": C.write_named_csv(text, landing, "CLAIMS_DATA_ALL", column_order=CLAIM_DATA_COLS),
             "customers": C.write_named_csv(cust.select(*CUSTOMER_DATA_COLS), landing, "CUSTOMER_DATA_ALL", column_order=CUSTOMER_DATA_COLS)}
    for feed, paths in files.items():
        I.copy_into(spark, paths, feed, layout, buckets=REFRESH_BUCKETS)
    _run(R.start_refresh(spark, layout, buckets=REFRESH_BUCKETS))
    after(spark, layout)
    key = text.join(cust.select("policy_number"), "policy_number", "left_semi").agg(F.min("policy_number").alias("policy_number"))
    late = text.join(F.broadcast(key), "policy_number", "left_semi").withColumns({"claim_amount": F.lit("60000.00"), "fraud_reported": F.lit("true")})
    C.write_named_csv(late, landing, "CLAIMS_DATA_LATE", column_order=CLAIM_DATA_COLS)
    _run(I.start_ingest(spark, landing, "claims", layout, buckets=REFRESH_BUCKETS))
    _run(R.start_refresh(spark, layout, buckets=REFRESH_BUCKETS))
    after(spark, layout)
    return layout


@register("stream_refresh_one_key", O.with_ctes(O.CUSTOMER_RAW, _LATE_CLAIMS, O.L1, O.L2)
          + f"SELECT {_l2_sql_cols()}, policy_number IS NOT DISTINCT FROM {_LATE_KEY} AS refreshed FROM l2")
def q_stream_refresh_one_key(spark, sf_dir):
    """Everything is loaded and refreshed, then late claims of one policy arrive.  Level 2 afterwards, and
    which of its rows the last refresh wrote: those of that policy."""
    layout = _with_late_claims(spark, sf_dir, "refresh_key")
    last = max(R.level_commits(spark, layout).state().live)
    return comparable(R.level(spark, layout, 2, with_load=True).select(*_L2_STREAM_COLS, (F.col("load") == last).alias("refreshed")))


@register("by_state_maintained", O.with_ctes(O.CUSTOMER_RAW, _LATE_CLAIMS, O.L1, O.L2, SUMMARY) + "SELECT customer_state, " + ", ".join((
    _n("customer_count"), _mean("avg_risk_score", "score", 1), _n("high_risk_count", "HIGH"), _mean("avg_claim_amount", "claim", 0)))
    + " FROM summary GROUP BY customer_state ORDER BY customer_count DESC, customer_state")
def q_by_state_maintained(spark, sf_dir):
    """R3 from the maintained summary, after late claims changed one bucket of it: no row of level 2 is read."""
    layout = _with_late_claims(spark, sf_dir, "maintained", SM.update)
    return RP.summary_by_state(RP.governed_summary(SM.summary(spark, layout), gov.ADMIN))


# ---------------------------------------------------------------------------
# Governed export


@register("governed_export", O.with_ctes(*O.BASE_L2, O.broker("consumer")) + """
SELECT policy_number, age_category, insured_occupation, CAST(policy_annual_premium AS DOUBLE) AS policy_annual_premium,
       CAST(claim_amount_filled AS DOUBLE) AS claim_amount_filled, customer_state, total_risk_score, risk_level,
       array_to_string(risk_factors, '|') AS risk_factors, strftime(last_updated, '%Y-%m-%d %H:%M:%S') AS last_updated
FROM bv""")
def q_governed_export(spark, sf_dir):
    """The consumer's broker view materialised as parquet, read back."""
    path = scratch_path(spark, "export") + "/broker_consumer"
    gov.export_governed(level2(spark, sf_dir), gov.CONSUMER, path)
    return comparable(spark.read.parquet(path))


# ---------------------------------------------------------------------------
# M7: classification and tags


_L2_TYPES = {f.name: f.dataType.simpleString() for f in S.CUSTOMER_RAW.fields} | {
    "claim_amount_filled": "decimal(10,2)", "fraud_reported_filled": "boolean", "customer_state": "string", "age_category": "string",
    "age_risk_score": "int", "total_risk_score": "int", "risk_level": "string", "risk_factors": "array<string>", "last_updated": "timestamp_ntz"}


def _classified_sql(table: str) -> str:
    """Null rates and value matches by DuckDB, name rules on the (fixed) column names."""
    def lit(v):
        return "NULL" if v is None else f"'{v}'"
    parts = []
    for c in INTEG.LEVEL2_COLUMNS:
        name = next(((sem, priv) for rx, sem, priv in K.NAME_RULES if re.search(rx, c)), (None, None))
        text = _L2_TYPES[c] == "string"
        match = [(f"COALESCE(COUNT_IF(trim({c}) IN ({', '.join(map(lit, rule))}))" if isinstance(rule, list)
                  else f"COALESCE(COUNT_IF(regexp_matches(trim({c}), '{rule}'))") + f" / NULLIF(COUNT({c}), 0), 0) >= {K.ClassificationProfile().value_match_threshold}"
                 for rule, _, _ in K.VALUE_RULES] if text else []
        value = lambda k: "CASE " + " ".join(f"WHEN {m} THEN {lit(r[k])}" for m, r in zip(match, K.VALUE_RULES)) + " END" if match else "NULL"  # noqa: E731,B023
        sem = f"COALESCE({value(1)}, {lit(name[0])})"
        parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, '{_L2_TYPES[c]}' AS data_type, CAST({sem} AS VARCHAR) AS semantic_category, "
                     f"CAST(COALESCE({value(2)}, {lit(name[1])}) AS VARCHAR) AS privacy_category, "
                     f"CAST(CASE WHEN {value(1)} = {lit(name[0])} THEN 'HIGH' WHEN {sem} IS NOT NULL THEN 'MEDIUM' END AS VARCHAR) AS confidence, "
                     f"CAST(CASE WHEN COUNT(*) > 0 THEN 1.0 - CAST(COUNT({c}) AS DOUBLE) / COUNT(*) END AS DOUBLE) AS null_rate FROM l2")
    return "\nUNION ALL\n".join(parts)


@register("classify_columns", O.with_ctes(*O.BASE_L2) + _classified_sql("risk_score_matrix"))
def q_classify_columns(spark, sf_dir):
    """Classification of every column of the risk matrix (one profiling pass)."""
    return K.classify(level2(spark, sf_dir), "risk_score_matrix").drop("classified_at")


@register("column_tags", O.with_ctes(*O.BASE_L2, f"k AS ({_classified_sql('risk_score_matrix')})") + """
SELECT table_name, column_name, 'SEMANTIC_CATEGORY' AS tag_name, semantic_category AS tag_value FROM k WHERE semantic_category IS NOT NULL
UNION ALL SELECT table_name, column_name, 'PRIVACY_CATEGORY', privacy_category FROM k WHERE semantic_category IS NOT NULL""")
def q_column_tags(spark, sf_dir):
    """A profile set on the schema classifies both levels and stores tags; those of the risk matrix, read back."""
    path = scratch_path(spark, "classification") + "/results"
    K.SchemaProfile(path).run(spark, {"risk_score_matrix": level2(spark, sf_dir), "customer_claims_integrated": level1(spark, sf_dir)})
    return K.stored_tags(spark, path).where("table_name = 'risk_score_matrix'")


# ---------------------------------------------------------------------------
# S13 batch materialisation, T4 lag, F12/F13 display


@register("l2_materialized", O.with_ctes(*O.BASE_L2) + f"SELECT {_L2_SQL_COLS} FROM l2")
def q_l2_materialized(spark, sf_dir):
    """Levels 1 and 2 written as bucket-partitioned parquet tables, level 2 read back."""
    cust, claims = raw(spark, sf_dir)
    layout = I.Layout(scratch_path(spark, "materialized"))
    R.materialize_levels(spark, cust, claims, layout, buckets=REFRESH_BUCKETS)
    return comparable(R.level(spark, layout, 2).drop("bucket"))


@register("refresh_lag", O.with_ctes(*O.BASE_L2) + f"""
SELECT {O.ts('MAX(last_updated)')} AS last_refresh, strftime(MAX(last_updated), '%H:%M:%S') AS last_refresh_time,
       MAX(last_updated) <= CAST(now() AS TIMESTAMP) AS lag_not_negative FROM l2""")
def q_refresh_lag(spark, sf_dir):
    """T4: newest last_updated of the risk matrix; the lag itself is the wall clock of the run, so only its sign is compared."""
    return comparable(RP.refresh_lag(level2(spark, sf_dir)).select(
        "last_refresh", "last_refresh_time", (F.col("lag_seconds") >= 0).alias("lag_not_negative")))


@register("risk_overview_display", O.with_ctes(*O.BASE_L2, SUMMARY, "o AS (SELECT SUM(n) AS n, SUM(score) AS score, SUM(claim) AS claim, MAX(newest) AS newest FROM summary)") + """
SELECT format('{:,}', CAST(n AS BIGINT)) AS total_customers, '$' || format('{:,.0f}', ROUND(claim / CAST(n AS DOUBLE), 0)) AS avg_claim_amount,
       format('{:,.1f}', ROUND(score / CAST(n AS DOUBLE), 1)) AS avg_risk_score, strftime(newest, '%H:%M:%S') AS last_refresh_time FROM o""")
def q_risk_overview_display(spark, sf_dir):
    """the overview formatted for display."""
    return RP.display_overview(level2(spark, sf_dir))


@register("orphan_claims", O.with_ctes(O.CUSTOMER_RAW, O.CLAIMS_RAW) + f"""
SELECT {_sql_cols(CLAIM_DATA_COLS)} FROM claims_raw cl
WHERE NOT EXISTS (SELECT 1 FROM customer_raw c WHERE c.policy_number = cl.policy_number)""")
def q_orphan_claims(spark, sf_dir):
    """Claims without a customer (left anti join; ours, for operations)."""
    cust, claims = raw(spark, sf_dir)
    return comparable(INTEG.orphan_claims(cust, claims).select(*CLAIM_DATA_COLS))


@register("stream_quality_monitor", O.with_ctes(O.CUSTOMER_RAW, O.CLAIMS_RAW)
          + "SELECT table_name, metric_name, value FROM (\n" + _metrics_sql("claims_raw")
          + "\nUNION ALL\n" + _metrics_sql("customer_raw") + "\n) r")
def q_stream_quality_monitor(spark, sf_dir):
    """Q8 cadence: both feeds stream in from derived drops, the monitor measures once
    new data arrived; the latest measurement per metric is returned."""
    cust, claims = raw(spark, sf_dir)
    root = scratch_path(spark, "stream_monitor")
    layout = I.Layout(root)
    landing = f"{root}/landing"
    write_drop(_claims_text(claims, False), landing, "CLAIMS_DATA", CLAIM_DATA_COLS, "incident_hour_of_the_day")
    write_drop(cust.select(*CUSTOMER_DATA_COLS), landing, "CUSTOMER_DATA", CUSTOMER_DATA_COLS, "age")
    for feed in ("claims", "customers"):
        _run(I.start_ingest(spark, landing, feed, layout, buckets=REFRESH_BUCKETS))
    _run(MON.start_quality_monitor(spark, layout, f"{root}/quality", available_now=True))
    return MON.latest_results(spark, f"{root}/quality").select("table_name", "metric_name", "value")


_PARTS = 3
_part = lambda c: F.coalesce(F.col(c), F.lit(0)) % _PARTS


def _stored_parts_sql() -> str:
    """The metrics after each of the parts arrived."""
    out = []
    for i in range(_PARTS):
        for t, c in (("claims_raw", "incident_hour_of_the_day"), ("customer_raw", "age")):
            rows = f"(SELECT * FROM {t} WHERE COALESCE({c}, 0) % {_PARTS} <= {i}) {t}"
            out += [f"SELECT {i + 1} AS measurement, '{t}' AS table_name, '{n}' AS metric_name, CAST({e} AS BIGINT) AS value FROM {rows}" for n, e in _METRICS_SQL[t]]
    return "\nUNION ALL\n".join(out)


@register("dq_trend_stored", O.with_ctes(O.CUSTOMER_RAW, O.CLAIMS_RAW, f"h AS ({_stored_parts_sql()})") + """
SELECT CAST(measurement AS BIGINT) AS measurement, table_name, metric_name, value, LAG(value) OVER k AS previous_value, value - LAG(value) OVER k AS change
FROM h WINDOW k AS (PARTITION BY table_name, metric_name ORDER BY measurement)""")
def q_dq_trend_stored(spark, sf_dir):
    """Q8, Q10: claims and customers arrive in three parts, the monitor measures after each and stores what it measured;
    the trend reads the stored measurements only (their times, the clock of the run, are left out)."""
    cust, claims = raw(spark, sf_dir)
    root = scratch_path(spark, "stored_trend")
    layout, landing, results = I.Layout(root), f"{root}/landing", f"{root}/quality"
    text, people = _claims_text(claims, False), cust.select(*CUSTOMER_DATA_COLS)
    for i in range(_PARTS):
        C.write_named_csv(text.where(_part("incident_hour_of_the_day") == i), landing, f"CLAIMS_DATA_{i}", column_order=CLAIM_DATA_COLS)
        C.write_named_csv(people.where(_part("age") == i), landing, f"CUSTOMER_DATA_{i}", column_order=CUSTOMER_DATA_COLS)
        for feed in ("claims", "customers"):
            _run(I.start_ingest(spark, landing, feed, layout, buckets=REFRESH_BUCKETS))
        _run(MON.start_quality_monitor(spark, layout, results, available_now=True))
    return Q.stored_trend(spark.read.parquet(results)).select("measurement", "table_name", "metric_name", "value", "previous_value", "change")


_KEPT = {"claims_raw": (("DUPLICATE_COUNT", "claim_amount", Q.duplicate_count), ("DISTINCT_COUNT", "incident_date", Q.distinct_count),
                        ("DUPLICATE_KEYS", "policy_number", Q.duplicate_count)),
         "customer_raw": (("DUPLICATE_COUNT", "policy_start_date", Q.duplicate_count), ("DISTINCT_COUNT", "age", Q.distinct_count))}


def _kept_sql() -> str:
    """Distinct and duplicate values after each of the parts arrived."""
    out = []
    for i in range(_PARTS):
        for t, c in (("claims_raw", "incident_hour_of_the_day"), ("customer_raw", "age")):
            for n, col, body in _KEPT[t]:
                e = f"COUNT(DISTINCT {col})" if body is Q.distinct_count else f"COUNT(*) - COUNT(DISTINCT {col}) - CAST(COUNT_IF({col} IS NULL) > 0 AS BIGINT)"
                out.append(f"SELECT CAST({i + 1} AS BIGINT) AS measurement, '{t}' AS table_name, '{n}' AS metric_name, CAST({e} AS BIGINT) AS value "
                           f"FROM {t} WHERE COALESCE({c}, 0) % {_PARTS} <= {i}")
    return "\nUNION ALL\n".join(out)


@register("dq_distinct_kept", O.with_ctes(O.CUSTOMER_RAW, O.CLAIMS_RAW) + _kept_sql())
def q_dq_distinct_kept(spark, sf_dir):
    """Claims and customers arrive in three parts; after each the monitor measures duplicates and distinct values of
    columns that are not the key, from value counts that take in the new loads only."""
    cust, claims = raw(spark, sf_dir)
    root = scratch_path(spark, "distinct_kept")
    layout, landing, results = I.Layout(root), f"{root}/landing", f"{root}/quality"
    registry = Q.MetricRegistry([Q.MetricSpec(n, t, (c,), body) for t, specs in _KEPT.items() for n, c, body in specs])
    text, people = _claims_text(claims, False), cust.select(*CUSTOMER_DATA_COLS)
    for i in range(_PARTS):
        C.write_named_csv(text.where(_part("incident_hour_of_the_day") == i), landing, f"CLAIMS_DATA_{i}", column_order=CLAIM_DATA_COLS)
        C.write_named_csv(people.where(_part("age") == i), landing, f"CUSTOMER_DATA_{i}", column_order=CUSTOMER_DATA_COLS)
        for feed in ("claims", "customers"):
            _run(I.start_ingest(spark, landing, feed, layout, buckets=REFRESH_BUCKETS))
        _run(MON.start_quality_monitor(spark, layout, results, registry=registry, available_now=True, value_buckets=REFRESH_BUCKETS))
    return Q.stored_trend(spark.read.parquet(results)).select("measurement", "table_name", "metric_name", "value")


@register("risk_overview_policies", O.with_ctes(*O.BASE_L2) + """
SELECT CAST(COUNT(*) AS BIGINT) AS total_rows, CAST(COUNT(DISTINCT policy_number) AS BIGINT) AS distinct_policies,
       CAST(COUNT(CASE WHEN risk_level = 'HIGH' THEN 1 END) AS BIGINT) AS high_risk_count
FROM l2""")
def q_risk_overview_policies(spark, sf_dir):
    """R1 variant: rows (one per claim) next to distinct policies."""
    return RP.overview_with_policies(level2(spark, sf_dir))


@register("customer_state_signed", O.with_ctes(O.CUSTOMER_RAW) + f"""
SELECT customer_state, CAST(COUNT(*) AS BIGINT) AS customers FROM (
  SELECT {O.STATE_CASE} AS customer_state FROM (
    SELECT (CASE WHEN h >= 9223372036854775808 THEN h - 18446744073709551616 ELSE h END) % 10 AS m
    FROM (SELECT CAST(('0x' || substr(md5(policy_number), 1, 16))::UBIGINT AS HUGEINT) AS h FROM customer_raw)))
GROUP BY customer_state""")
def q_customer_state_signed(spark, sf_dir):
    """D1 with a signed 64-bit hash: reproduces the skew of a signed vendor hash
    (negative remainders fall to the first state)."""
    from riskpipe.functions import scoring
    cust, _ = raw(spark, sf_dir)
    return (cust.select(scoring.state_from_hash("policy_number", mode="signed").alias("customer_state"))
            .groupBy("customer_state").agg(F.count(F.lit(1)).cast("bigint").alias("customers")))
