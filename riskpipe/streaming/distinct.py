"""Distinct and duplicate values of a raw column, kept up to date.

A count of distinct values is not a sum over loads or key buckets, so three tables are kept for a column:

* ``parts``: how often each value occurs in each load.  A load's part is made once, from that load's rows alone;
  where batches of a load count no longer, it is made again under another name.
* ``totals``: how often each value occurs in all loads that count, by bucket of the value.  An update writes the values
  whose total changes; the newest version of a value holds.  The change of a value is the sum of the new loads' parts
  less those of the loads that are gone, so compactions and repeated loads take back what they replace.
* ``coc``: how many values occur how often (count of counts), by bucket of the value, as differences between versions.
  Its sums give rows, distinct values and duplicates.

So an update reads the raw rows of new loads, and totals in the value buckets that change, whatever the raw table holds.  It
counts from the moment its commit file, which lists the loads taken in, appears; a replay finds nothing to do.  Sixteen versions
are merged into one.  Values are compared as text.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpipe.streaming import commits as CM
from riskpipe.streaming import ingest as I

VALUE_BUCKETS = 256
MERGE_AT = 16
PART = "value string, n long, at timestamp_ntz, part string"
CHANGE = "value string, change long, at timestamp_ntz, value_bucket int"
TOTAL = "value string, before long, total long, at timestamp_ntz, value_bucket int, version string"
COC = "value_bucket int, is_null boolean, times long, n long, at timestamp_ntz, version string"
_EMPTY = {"number": 0, "parts": [], "versions": [], "earlier": []}


class DistinctState:
    """The kept counts of one column of a feed's raw table.

    ``value_buckets`` holds from the first update on (about 1 GB of different values each)."""

    def __init__(self, spark: SparkSession, layout: I.Layout, feed: str, column: str, value_buckets: int = VALUE_BUCKETS):
        self.spark, self.layout, self.feed, self.column, self.value_buckets = spark, layout, feed, column, value_buckets
        self.path = f"{layout.root}/distinct_values/{feed}.{column}"
        self._commits = CM.Commits(spark, f"{self.path}/_versions")

    def manifest(self) -> dict:
        names = sorted(n for n in CM._names(self.spark, self._commits.path) if n.startswith("version="))
        return self._commits._read(names[-1]) if names else dict(_EMPTY)

    def update(self) -> bool:
        """Take in the loads that count now; returns whether there was anything to do."""
        state, old = I.commits(self.spark, self.layout, self.feed).state(), self.manifest()
        live = {_part_of(load, state): load for load in state.live}
        new, gone = sorted(live.keys() - set(old["parts"])), sorted(set(old["parts"]) - live.keys())
        if not new and not gone:
            return False
        if new:
            self._write_parts({live[p]: p for p in new}, state)
        buckets = old.get("value_buckets", self.value_buckets)
        version = f"{old['number'] + 1:09d}-{uuid.uuid4().hex}"
        self._write_changes(version, new, gone, buckets)
        self._write_totals(version, old["versions"])
        body = {"number": old["number"] + 1, "parts": sorted(live), "versions": [*old["versions"], version], "earlier": old["earlier"], "value_buckets": buckets}
        if len(body["versions"]) >= MERGE_AT:
            self._remove(body["earlier"])           # readers of those have had a whole merge's time
            body["earlier"], body["versions"] = body["versions"], [self._merge(body["versions"])]
        name = f"version={body['number']:09d}"
        self._commits._create(name, json.dumps(body))
        if self._commits._read(name)["versions"] != body["versions"]:
            raise RuntimeError(f"{self.path} was updated meanwhile; start again")
        self._delete(f"{self.path}/changes/{version}")
        for p in gone:
            self._delete(f"{self.path}/parts/part={p}")
        return True

    def measured(self) -> DataFrame:
        """One row: rows, distinct_values (without NULL), duplicates (rows beyond the first of each value, NULL as one), change_commit_time."""
        got = self._read("coc", self.manifest()["versions"], COC)
        values, rows = F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.col("times") * F.col("n")), F.lit(0))
        return got.agg(rows.alias("rows"), F.coalesce(F.sum(F.when(~F.col("is_null"), F.col("n"))), F.lit(0)).alias("distinct_values"),
                       (rows - values).alias("duplicates"), F.max("at").alias("change_commit_time"))

    # -- the steps of an update ---------------------------------------------------------------

    def _read(self, table: str, versions: list[str], schema: str) -> DataFrame:
        folder = f"{self.path}/{table}"
        there = set(CM._names(self.spark, folder))
        paths = [f"{folder}/version={v}" for v in versions if f"version={v}" in there]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", folder).parquet(*paths)

    def _write_parts(self, part_of: dict[str, str], state: CM.State) -> None:
        rows = CM.read(self.spark, self.layout.raw(self.feed), I.raw_schema(self.feed), state)
        names = F.create_map(*[F.lit(x) for pair in part_of.items() for x in pair])
        (rows.where(F.col("load").isin(sorted(part_of)))           # folders of other loads are not read
         .groupBy(F.element_at(names, F.col("load")).alias("part"), F.col(self.column).cast("string").alias("value"))
         .agg(F.count(F.lit(1)).alias("n"), F.max("load_timestamp").alias("at"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(f"{self.path}/parts"))

    def _write_changes(self, version: str, new: list[str], gone: list[str], buckets: int) -> None:
        n = F.when(F.col("part").isin(gone), -F.col("n")).otherwise(F.col("n"))
        change = (self.spark.read.schema(PART).parquet(f"{self.path}/parts").where(F.col("part").isin(new + gone))
                  .groupBy("value").agg(F.sum(n).alias("change"), F.max("at").alias("at")).where("change != 0")
                  .withColumn("value_bucket", F.pmod(F.xxhash64("value"), F.lit(buckets)).cast("int")))
        change.hint("rebalance", "value_bucket").write.partitionBy("value_bucket").parquet(f"{self.path}/changes/{version}")

    def _write_totals(self, version: str, versions: list[str]) -> None:
        folder = f"{self.path}/changes/{version}"
        touched = sorted(int(n.split("=")[1]) for n in CM._names(self.spark, folder) if n.startswith("value_bucket="))
        if not touched:        # as after a compaction
            return
        change = self.spark.read.schema(CHANGE).parquet(folder)
        before = _newest(self._read("totals", versions, TOTAL).where(F.col("value_bucket").isin(touched))).select("value_bucket", "value", F.col("total").alias("before"))
        same = (change["value_bucket"] == before["value_bucket"]) & change["value"].eqNullSafe(before["value"])
        was = F.coalesce(before["before"], F.lit(0))
        rows = change.join(before, same, "left").select(change["value"], was.alias("before"), (was + change["change"]).alias("total"), change["at"],
                                                        change["value_bucket"])
        rows.hint("rebalance", "value_bucket").write.partitionBy("value_bucket").parquet(f"{self.path}/totals/version={version}")
        one = lambda times, n: F.struct(F.col(times).alias("times"), F.lit(n).cast("long").alias("n"))
        (self._read("totals", [version], TOTAL)
         .select("value_bucket", F.col("value").isNull().alias("is_null"), "at", F.inline(F.array(one("before", -1), one("total", 1)))).where("times > 0")
         .groupBy("value_bucket", "is_null", "times").agg(F.sum("n").alias("n"), F.max("at").alias("at"))
         .write.parquet(f"{self.path}/coc/version={version}"))

    def _merge(self, versions: list[str]) -> str:
        version = f"{versions[-1]}-merged"
        (_newest(self._read("totals", versions, TOTAL)).where("total > 0")
         .hint("rebalance", "value_bucket").write.partitionBy("value_bucket").parquet(f"{self.path}/totals/version={version}"))
        (self._read("coc", versions, COC).groupBy("value_bucket", "is_null", "times").agg(F.sum("n").alias("n"), F.max("at").alias("at"))
         .write.parquet(f"{self.path}/coc/version={version}"))
        return version

    def _remove(self, versions: list[str]) -> None:
        for v in versions:
            for table in ("totals", "coc"):
                self._delete(f"{self.path}/{table}/version={v}")

    def _delete(self, path: str) -> None:
        p, fs = CM._fs(self.spark, path)
        fs.delete(p, True)


def _part_of(load: str, state: CM.State) -> str:
    dropped = sorted(state.dropped.get(load, ()))
    return load if not dropped else f"{load}~{hashlib.sha256(','.join(map(str, dropped)).encode()).hexdigest()[:16]}"


def _newest(totals: DataFrame) -> DataFrame:
    """The newest row of each value."""
    newest = F.max_by(F.struct("before", "total", "at"), "version").alias("x")
    return totals.groupBy("value_bucket", "value").agg(newest).select("value_bucket", "value", "x.*")
