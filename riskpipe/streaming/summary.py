"""Report summary maintained beside the levels (R1-R5, R9): sums for each key bucket.

The reports read counts, sums and maxima by age category, state and risk level.  A sum could be
corrected by what a refresh took back, a maximum could not, so the summary is kept for each key
bucket: ``update`` finds the buckets that refreshes touched since its last run, sums up level 2 of
these buckets once, whatever number of refreshes there were, and publishes the new rows with one commit.  A bucket's newest rows
count.  Reports add up the buckets and read no row of level 2.

A bucket that has no rows any more gets a row of zeros.  Before the first update the
summary is empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskpipe.plans import reports as RP
from riskpipe.streaming import refresh as R
from riskpipe.streaming.commits import Commits, remove
from riskpipe.streaming.ingest import Layout

MERGE_AFTER = 32   # updates kept side by side


def _path(layout: Layout) -> str:
    return f"{layout.root}/summary"


def _log(spark: SparkSession, layout: Layout) -> Commits:
    return Commits(spark, layout.commits("summary"))


def _schema(spark: SparkSession) -> T.StructType:
    empty = spark.createDataFrame([], R.level_schema(spark, 2))
    return T.StructType([*RP.summary(empty, "bucket").schema.fields, T.StructField("load", T.StringType())])


def _version(load: str) -> int:
    return int(load.split(".")[0])


def update(spark: SparkSession, layout: Layout) -> int:
    """Bring the summary up to the levels as published; returns the number of buckets summed up (-1: all)."""
    levels, log = R.level_commits(spark, layout).state(), _log(spark, layout)
    state = log.state()
    done = max(map(_version, state.live), default=0)
    new = sorted(x for x in levels.live if _version(x) > done)
    if not new:
        return 0
    rows, touched = R.level(spark, layout, 2), None
    if done and not any(R.is_base(x) for x in new):
        keys = spark.read.schema(R.KEYS_SCHEMA).parquet(layout.level_keys()).where(F.col("load").isin(new))
        touched = sorted(r[0] for r in keys.select("bucket").distinct().collect())   # at most buckets + 1 numbers
        rows = rows.where(F.col("bucket").isin(touched))
    sums = RP.summary(rows, "bucket")
    if touched is not None:
        marks = spark.createDataFrame([(b,) for b in touched], "bucket int").withColumns({"n": F.lit(0).cast("long")})
        sums = sums.unionByName(marks, allowMissingColumns=True)
    load = f"{max(map(_version, new)):012d}.sums.{uuid.uuid4().hex[:8]}"
    sums.withColumn("load", F.lit(load)).coalesce(1).write.mode("append").partitionBy("load").parquet(_path(layout))
    log.add(load)
    if len(state.live) >= MERGE_AFTER:
        _merge(spark, layout)
    return -1 if touched is None else len(touched)


def _newest(spark: SparkSession, layout: Layout, loads: set[str]) -> DataFrame:
    rows = spark.read.schema(_schema(spark)).parquet(_path(layout)).where(F.col("load").isin(sorted(loads)))
    newest = rows.groupBy(F.col("bucket").alias("b")).agg(F.max("load").alias("newest"))
    return rows.join(F.broadcast(newest), (F.col("bucket") == F.col("b")) & (F.col("load") == F.col("newest")), "left_semi")   # a row for each bucket


def _merge(spark: SparkSession, layout: Layout) -> None:
    log = _log(spark, layout)
    state = log.state()
    load = f"{max(map(_version, state.live)):012d}.sums.{uuid.uuid4().hex[:8]}"
    _newest(spark, layout, state.live).withColumn("load", F.lit(load)).coalesce(1).write.mode("append").partitionBy("load").parquet(_path(layout))
    log.swap(load, state, state.live)
    remove(spark, _path(layout), state.replaced, 0)


def summary(spark: SparkSession, layout: Layout) -> DataFrame:
    """The rows of ``reports.summary``, for each bucket: what the reports of a governed summary take."""
    live = _log(spark, layout).state().live
    if not live:
        return spark.createDataFrame([], _schema(spark)).drop("load")
    return _newest(spark, layout, live).where("n > 0").drop("load")
