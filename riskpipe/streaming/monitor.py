"""Scheduled quality measurement (Q8 cadence, default every 5 minutes), incremental.

Re-scanning a 100 TB raw table every five minutes is not an option, so the
monitor keeps **per-bucket partial values** and recomputes only the buckets new
data touched:

* the raw tables are partitioned by ``bucket`` of ``policy_number`` (NULL keys
  in bucket -1), so every policy lives in exactly one bucket;
* then each of the six metrics is additive over buckets: the count metrics
  obviously, and the duplicate count on the bucketing key too, because
  ``rows_b - distinct_b - [NULL in b]`` summed over buckets equals
  ``rows - distinct - [any NULL]`` when all NULLs share bucket -1;
* per trigger: touched buckets of each feed (from the ingest ``changes`` log,
  at most buckets + 1 ids) → one grouped aggregate over just those bucket
  partitions → dynamic overwrite of those partial rows → the totals are a sum
  over the partial table (one row per bucket and metric) → written as the
  batch's own partition of the results history (a replayed batch replaces it).

Distinct and duplicate counts on other columns come from value counts that are kept
beside the raw tables (``streaming.distinct``), which read the rows of new loads only.
Any other metric that is not additive over key buckets (a user metric) makes the
monitor fall back to a full measurement.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskpipe.operators import quality as Q
from riskpipe.sources.csv_ingest import utc_now
from riskpipe.streaming.distinct import VALUE_BUCKETS, DistinctState
from riskpipe.streaming.ingest import Layout, _overwrite_partitions, read_raw
from riskpipe.streaming.refresh import CHANGES_SCHEMA, ensure_dir

FEED_TABLES = {"claims": "claims_raw", "customers": "customer_raw"}
BUCKET_KEY = "policy_number"
ADDITIVE_BODIES = {Q.null_count, Q.row_count}
PARTIALS_SCHEMA = T.StructType([
    T.StructField("bucket", T.IntegerType()), T.StructField("change_commit_time", T.TimestampNTZType()),
    T.StructField("metric_name", T.StringType()), T.StructField("value", T.LongType()),
    T.StructField("table_name", T.StringType())])


def additive_over_buckets(spec: Q.MetricSpec) -> bool:
    if spec.expr is Q.duplicate_count:
        return spec.columns == (BUCKET_KEY,)
    return spec.expr in ADDITIVE_BODIES or getattr(spec.expr, "additive", False)


KEPT_VALUES = {Q.duplicate_count: "duplicates", Q.distinct_count: "distinct_values"}


def kept_values(spec: Q.MetricSpec) -> str | None:
    """The kept measure (``DistinctState.measured``) that is this metric, if it is one."""
    return None if additive_over_buckets(spec) else KEPT_VALUES.get(spec.expr)


def partials_path(layout: Layout) -> str:
    return f"{layout.root}/quality_partials"


def update_partials(spark: SparkSession, layout: Layout, registry: Q.MetricRegistry,
                    touched: dict[str, list[int]]) -> None:
    """Recompute per-bucket metric values for the touched buckets of each feed."""
    for feed, buckets in touched.items():
        table = FEED_TABLES[feed]
        specs = [s for s in registry.for_table(table) if additive_over_buckets(s)]
        raw = read_raw(spark, layout, feed, buckets) if specs and buckets else None   # touched folders only
        if not specs or raw is None:
            continue
        part = (Q.run_metrics(raw, specs, table, by=["bucket"])
                .select(F.col("bucket").cast("int"), "change_commit_time", "metric_name",
                        F.col("value").cast("long"), "table_name"))
        _overwrite_partitions(part, partials_path(layout), "table_name", "bucket")


def update_values(spark: SparkSession, layout: Layout, registry: Q.MetricRegistry, value_buckets: int = VALUE_BUCKETS) -> None:
    """Take new loads into the kept value counts of every column that a metric needs."""
    for feed, table in FEED_TABLES.items():
        for column in sorted({s.columns[0] for s in registry.for_table(table) if kept_values(s)}):
            DistinctState(spark, layout, feed, column, value_buckets).update()


def totals(spark: SparkSession, layout: Layout, measured_at=None, *, database: str = "riskpipe",
           schema: str = "raw_data", registry: Q.MetricRegistry | None = None) -> DataFrame:
    """Current metric values: a sum over the per-bucket partials and, for the distinct metrics of ``registry``,
    over the kept counts of counts (both tiny input)."""
    mt = measured_at if measured_at is not None else utc_now()
    parts = []
    for feed, table in FEED_TABLES.items():
        kept = [s for s in (registry.for_table(table) if registry else []) if kept_values(s)]
        for column in sorted({s.columns[0] for s in kept}):
            one = DistinctState(spark, layout, feed, column).measured()
            parts += [one.where("change_commit_time IS NOT NULL").select(
                F.lit(table).alias("table_name"), F.lit(s.name).alias("metric_name"), F.col(kept_values(s)).cast("bigint").alias("value"), "change_commit_time")
                for s in kept if s.columns[0] == column]
    if registry is None or any(additive_over_buckets(s) for s in registry.specs):
        p = spark.read.schema(PARTIALS_SCHEMA).parquet(partials_path(layout))
        parts.append(p.groupBy("table_name", "metric_name")
                     .agg(F.sum("value").cast("bigint").alias("value"), F.max("change_commit_time").alias("change_commit_time")))
    out = functools.reduce(DataFrame.unionByName, parts)
    return out.select("change_commit_time", mt.alias("measurement_time"), F.lit(database).alias("table_database"),
                      F.lit(schema).alias("table_schema"), "table_name", "metric_name", "value")


def _publish(res: DataFrame, results_path: str, batch_id: int) -> None:
    """Results of one monitor batch; a replayed batch replaces its own rows (idempotent)."""
    _overwrite_partitions(res.withColumn("monitor_batch", F.lit(batch_id).cast("long")),
                          results_path, "monitor_batch")


def measure_full(spark: SparkSession, layout: Layout, registry: Q.MetricRegistry, results_path: str,
                 batch_id: int = 0) -> None:
    """Fallback: one full measurement of every registered raw table."""
    tables = {}
    for feed, table in FEED_TABLES.items():
        raw = read_raw(spark, layout, feed)
        if raw is not None and registry.for_table(table):
            tables[table] = raw
    if tables:
        _publish(Q.results(tables, registry), results_path, batch_id)


def start_quality_monitor(spark: SparkSession, layout: Layout, results_path: str, *,
                          registry: Q.MetricRegistry | None = None, every: str = "5 minutes",
                          available_now: bool = False, value_buckets: int = VALUE_BUCKETS) -> StreamingQuery:
    reg = registry or Q.default_registry()
    incremental = all(additive_over_buckets(s) or kept_values(s) for s in reg.specs)
    ensure_dir(spark, layout.changes("monitor"))
    changes = (spark.readStream.schema(CHANGES_SCHEMA).option("cleanSource", "delete")
               .parquet(layout.changes("monitor")).select("feed", "bucket"))

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        # (feed, bucket) pairs touched since the last trigger: at most 2 × (buckets + 1)
        pairs = batch.distinct().collect()
        if not pairs:
            return
        session = batch.sparkSession
        if not incremental:
            measure_full(session, layout, reg, results_path, batch_id)
            return
        touched: dict[str, list[int]] = {}
        for r in pairs:
            touched.setdefault(r["feed"], []).append(int(r["bucket"]))
        update_partials(session, layout, reg, touched)
        update_values(session, layout, reg, value_buckets)
        _publish(totals(session, layout, registry=reg), results_path, batch_id)

    w = (changes.writeStream.foreachBatch(run_batch)
         .option("checkpointLocation", layout.checkpoint("quality_monitor")))
    trig = {"availableNow": True} if available_now else {"processingTime": every}
    return w.trigger(**trig).start()


def latest_results(spark: SparkSession, results_path: str) -> DataFrame:
    """The newest measurement of each (table, metric)."""
    res = spark.read.parquet(results_path)
    newest = res.groupBy("table_name", "metric_name").agg(F.max("measurement_time").alias("_t"))
    return (res.join(newest, ["table_name", "metric_name"])
            .where(F.col("measurement_time") == F.col("_t")).drop("_t"))
