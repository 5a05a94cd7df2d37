"""Data-quality metrics (Q1-Q12).

A metric is an aggregate ``Column`` factory attached to (table, columns).  All
metrics of one table run in **one** aggregate pass (``run_metrics``): every map
task pre-aggregates, so the shuffle carries one partial row per task, whatever
the table size.  The one distinct-based metric (duplicate count) makes Spark
shuffle partially de-duplicated keys: a hot key costs one row per map task.
Results are unpivoted to the long format of a monitoring-results table.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from riskpipe.sources.csv_ingest import utc_now

MetricExpr = Callable[..., Column]


# ---------------------------------------------------------------------------
# metric bodies (each returns an aggregate Column over the named columns)


def invalid_range_count(lo, hi) -> MetricExpr:
    """P9 + A5: count of non-NULL values outside [lo, hi] (bounds are valid)."""
    def expr(col: str) -> Column:
        c = F.col(col)
        return F.count_if(c.isNotNull() & ((c < lo) | (c > hi)))
    expr.additive = True   # a count: per-partition values sum to the total
    return expr


def null_count(col: str) -> Column:
    return F.count_if(F.col(col).isNull())


def duplicate_count(col: str) -> Column:
    """Rows beyond the first of each value, NULL counted as one value."""
    c = F.col(col)
    return (F.count(F.lit(1)) - F.count_distinct(c)
            - F.when(F.count_if(c.isNull()) > 0, 1).otherwise(0))


def distinct_count(col: str) -> Column:
    """Different values, NULL left out."""
    return F.count_distinct(F.col(col))


def row_count() -> Column:
    return F.count(F.lit(1))


@dataclass(frozen=True)
class MetricSpec:
    """One attachment (U5: a table-argument metric function): ``expr(*columns)`` measured on ``table``."""
    name: str
    table: str
    columns: tuple[str, ...]
    expr: MetricExpr
    kind: str = "violation"   # 'violation' counts bad rows; 'volume' does not

    def column(self) -> Column:
        return self.expr(*self.columns).cast("bigint")


# fixed values: the six attachments, range bounds and the schedule
CLAIM_AMOUNT_RANGE = (100, 500000)
CUSTOMER_AGE_RANGE = (18, 85)
SCHEDULE = "5 MINUTE"

CLAIMS_SPECS = (
    MetricSpec("INVALID_CLAIM_AMOUNT_COUNT", "claims_raw", ("claim_amount",), invalid_range_count(*CLAIM_AMOUNT_RANGE)),
    MetricSpec("NULL_COUNT", "claims_raw", ("policy_number",), null_count),
    MetricSpec("DUPLICATE_COUNT", "claims_raw", ("policy_number",), duplicate_count),
)
CUSTOMER_SPECS = (
    MetricSpec("INVALID_CUSTOMER_AGE_COUNT", "customer_raw", ("age",), invalid_range_count(*CUSTOMER_AGE_RANGE)),
    MetricSpec("NULL_COUNT", "customer_raw", ("policy_number",), null_count),
    MetricSpec("ROW_COUNT", "customer_raw", (), row_count, kind="volume"),
)


@dataclass
class MetricRegistry:
    """Q6: attach / detach metrics per table, with a schedule per table."""
    specs: list[MetricSpec] = field(default_factory=list)
    schedules: dict[str, str] = field(default_factory=dict)

    def attach(self, spec: MetricSpec) -> "MetricRegistry":
        self.specs.append(spec)
        return self

    def detach(self, name: str, table: str) -> "MetricRegistry":
        self.specs = [s for s in self.specs if not (s.name == name and s.table == table)]
        return self

    def set_schedule(self, table: str, schedule: str) -> "MetricRegistry":
        self.schedules[table] = schedule
        return self

    def for_table(self, table: str) -> list[MetricSpec]:
        return [s for s in self.specs if s.table == table]


def default_registry() -> MetricRegistry:
    reg = MetricRegistry()
    for s in CLAIMS_SPECS + CUSTOMER_SPECS:
        reg.attach(s)
    reg.set_schedule("claims_raw", SCHEDULE).set_schedule("customer_raw", SCHEDULE)
    return reg


def _stack(specs, prefix: str = "_m") -> Column:
    """stack(n, 'NAME1', _m0, 'NAME2', _m1, ...) as (metric_name, value)."""
    args = ", ".join(f"'{s.name}', {prefix}{i}" for i, s in enumerate(specs))
    return F.expr(f"stack({len(specs)}, {args}) AS (metric_name, value)")


def run_metrics(df: DataFrame, specs, table: str, *, ts_col: str | None = "load_timestamp",
                by: list[str] | None = None) -> DataFrame:
    """Q8: all metrics of ``table`` in one aggregate, unpivoted to
    (``by``..., change_commit_time, table_name, metric_name, value).

    ``change_commit_time`` is the newest ``ts_col`` seen (the last data change).
    ``by`` groups the measurement (e.g. per load batch) in the same single pass.
    """
    specs = list(specs)
    aggs = [s.column().alias(f"_m{i}") for i, s in enumerate(specs)]
    aggs.append((F.max(ts_col) if ts_col else F.lit(None).cast("timestamp_ntz")).alias("change_commit_time"))
    by = by or []
    wide = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    return wide.select(*by, "change_commit_time", F.lit(table).alias("table_name"), _stack(specs))


def results(df_by_table: dict[str, DataFrame], registry: MetricRegistry, *,
            database: str = "riskpipe", schema: str = "raw_data",
            measured_at: Column | None = None) -> DataFrame:
    """Q8: one measurement of every registered table in the monitoring-results shape."""
    parts = []
    for table, df in df_by_table.items():
        specs = registry.for_table(table)
        if not specs:
            continue
        parts.append(run_metrics(df, specs, table))
    if not parts:
        raise ValueError("no registered metric applies to the given tables")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    mt = measured_at if measured_at is not None else utc_now()
    return out.select("change_commit_time", mt.alias("measurement_time"),
                      F.lit(database).alias("table_database"), F.lit(schema).alias("table_schema"),
                      "table_name", "metric_name", F.col("value").cast("bigint").alias("value"))


def results_sorted(res: DataFrame, tables=("claims_raw", "customer_raw"), *,
                   database: str = "riskpipe", schema: str = "raw_data") -> DataFrame:
    """P12 + O2: filter the results table and sort newest change first."""
    return (res.where((F.col("table_database") == database) & (F.col("table_schema") == schema)
                      & F.col("table_name").isin(*tables))
            .orderBy(F.desc("change_commit_time"), "table_name", "metric_name"))


def append_results(res: DataFrame, path: str) -> None:
    """Append one measurement to the parquet results history."""
    res.write.mode("append").parquet(path)


def registry_listing(registry: MetricRegistry, latest: DataFrame | None = None) -> DataFrame:
    """Q7: metric, table, schedule, status (O4 union of both tables); with the
    latest measured value when a results frame is given."""
    spark = latest.sparkSession if latest is not None else None
    rows = [(s.name, s.table, registry.schedules.get(s.table), "STARTED") for s in registry.specs]
    schema = "metric_name string, ref_entity_name string, schedule string, schedule_status string"
    if spark is None:
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
    reg = spark.createDataFrame(rows, schema)
    if latest is None:
        return reg
    # registry has one row per attachment: a bounded broadcast side
    return (latest.join(F.broadcast(reg), (latest["table_name"] == reg["ref_entity_name"])
                        & (latest["metric_name"] == reg["metric_name"]), "inner")
            .select(reg["metric_name"], "ref_entity_name", "schedule", "schedule_status", "value"))


def quality_score(df: DataFrame, specs, table: str) -> DataFrame:
    """Q9: 100 × (1 − violations / (rows × rules)), clipped to [0, 100]; one pass."""
    viol = [s for s in specs if s.kind == "violation"]
    aggs = [s.column().alias(f"_m{i}") for i, s in enumerate(viol)] + [F.count(F.lit(1)).alias("_rows")]
    w = df.agg(*aggs)
    total = sum((F.col(f"_m{i}") for i in range(len(viol))), F.lit(0)).cast("bigint")
    k = len(viol)
    score = F.when(F.col("_rows") * k > 0,
                   F.round(F.greatest(F.lit(0.0), F.least(F.lit(100.0),
                       100.0 * (1.0 - total / (F.col("_rows") * F.lit(k)).cast("double")))), 2))
    return w.select(F.lit(table).alias("table_name"), F.col("_rows").cast("bigint").alias("row_count"),
                    total.alias("violations"), F.lit(k).cast("bigint").alias("rules"),
                    score.cast("double").alias("quality_score"))


def trend(history: DataFrame, order_col: str = "batch") -> DataFrame:
    """Q10: each measurement with the previous value of the same metric and the change.

    Window partitions are (table, metric): one row per measurement, tiny."""
    w = Window.partitionBy("table_name", "metric_name").orderBy(order_col)
    prev = F.lag("value").over(w)
    return history.select(order_col, "table_name", "metric_name", "value",
                          prev.alias("previous_value"), (F.col("value") - prev).alias("change"))


# fixed values: default alert thresholds (metric → highest acceptable value)
DEFAULT_THRESHOLDS = [
    ("claims_raw", "INVALID_CLAIM_AMOUNT_COUNT", 0, "HIGH"),
    ("claims_raw", "NULL_COUNT", 0, "HIGH"),
    ("claims_raw", "DUPLICATE_COUNT", 0, "MEDIUM"),
    ("customer_raw", "INVALID_CUSTOMER_AGE_COUNT", 0, "MEDIUM"),
    ("customer_raw", "NULL_COUNT", 0, "HIGH"),
]


def alerts(res: DataFrame, thresholds=None) -> DataFrame:
    """Q11: measurements above their threshold.  The threshold table has one row
    per (table, metric) attachment, so it is a bounded broadcast side."""
    spark = res.sparkSession
    th = spark.createDataFrame(thresholds or DEFAULT_THRESHOLDS,
                               "t_table string, t_metric string, max_value bigint, severity string")
    j = res.join(F.broadcast(th), (res["table_name"] == th["t_table"]) & (res["metric_name"] == th["t_metric"]))
    return (j.where(F.col("value") > F.col("max_value"))
            .select("table_name", "metric_name", "value", F.col("max_value").alias("threshold"), "severity"))


# -- over the stored history of measurements ----------------------------------------------------
# Windows and groups are those of one metric of one table: one row for each measurement ever made.


def as_of(history: DataFrame, at: Column) -> DataFrame:
    """The stored measurement of each (table, metric) that held at a time: the newest one not after it."""
    newest = history.where(F.col("measurement_time") <= at).groupBy("table_name", "metric_name").agg(
        F.max(F.struct("measurement_time", "value", "change_commit_time")).alias("m"))
    return newest.select("table_name", "metric_name", "m.measurement_time", "m.value", "m.change_commit_time")


def stored_trend(history: DataFrame) -> DataFrame:
    """Q10: the stored measurements in order, each with the one before it, the change, the seconds between the two and
    the change an hour (NULL for the first; measurements need not be evenly spaced)."""
    w = Window.partitionBy("table_name", "metric_name").orderBy("measurement_time")
    apart = F.unix_seconds(F.col("measurement_time").cast("timestamp")) - F.unix_seconds(F.lag("measurement_time").over(w).cast("timestamp"))
    out = history.select("table_name", "metric_name", "measurement_time", F.row_number().over(w).cast("long").alias("measurement"), "value",
                         F.lag("value").over(w).alias("previous_value"), apart.alias("seconds"))
    change = F.col("value") - F.col("previous_value")
    return out.withColumns({"change": change, "change_per_hour": F.when(F.col("seconds") > 0, change * 3600.0 / F.col("seconds"))})


def usual_thresholds(history: DataFrame, above: int = 110, below: int = 100) -> DataFrame:
    """(table_name, metric_name, max_value, clear_value): ``above`` and ``below`` hundredths of a metric's mean so far, in whole numbers."""
    mean = "sum(value) * {} div (100 * count(value))"
    return history.groupBy("table_name", "metric_name").agg(F.expr(mean.format(above)).alias("max_value"), F.expr(mean.format(below)).alias("clear_value"))


def alert_episodes(history: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Q11 over time: an episode opens with a measurement above ``max_value`` and closes with the first one at or below
    ``clear_value``; between the two levels a metric stays as it was.

    Returns (table_name, metric_name, episode, opened_at, closed_at, seconds, peak, measurements); an open episode has no
    ``closed_at`` and lasts until its newest measurement.  ``thresholds`` has a row for each metric, as ``usual_thresholds``;
    NULL values say nothing."""
    h = history.where("value IS NOT NULL").join(F.broadcast(thresholds), ["table_name", "metric_name"])   # a row for each attachment
    by = Window.partitionBy("table_name", "metric_name").orderBy("measurement_time")
    h = h.withColumn("said", F.expr("CASE WHEN value > max_value THEN 1 WHEN value <= clear_value THEN 0 END"))
    h = h.withColumn("on", F.coalesce(F.last("said", ignorenulls=True).over(by), F.lit(0)))
    opens = ((F.col("on") == 1) & (F.coalesce(F.lag("on").over(by), F.lit(0)) == 0)).cast("long")
    h = h.withColumn("opens", opens).withColumn("episode", F.sum("opens").over(by)).where("episode > 0")
    at = "measurement_time"
    out = h.groupBy("table_name", "metric_name", "episode").agg(
        F.min(at).alias("opened_at"), F.min(F.when(F.col("on") == 0, F.col(at))).alias("closed_at"), F.max(F.when(F.col("on") == 1, F.col(at))).alias("_last"),
        F.max(F.when(F.col("on") == 1, F.col("value"))).alias("peak"), F.count_if(F.col("on") == 1).alias("measurements"))
    until = F.unix_seconds(F.coalesce("closed_at", "_last").cast("timestamp")) - F.unix_seconds(F.col("opened_at").cast("timestamp"))
    return out.select("table_name", "metric_name", "episode", "opened_at", "closed_at", until.alias("seconds"), "peak", "measurements")


def load_validation(df: DataFrame, label: str = "INITIAL LOAD STATUS", count_name: str = "total_rows") -> DataFrame:
    """Q12: label (P3 constant), row count (A1), distinct policies (A2), first/last load (A3); one pass."""
    return df.agg(
        F.lit(label).alias("check_type"),
        F.count(F.lit(1)).cast("bigint").alias(count_name),
        F.count_distinct("policy_number").cast("bigint").alias("unique_policies"),
        F.min("load_timestamp").alias("first_loaded"),
        F.max("load_timestamp").alias("last_loaded"))
