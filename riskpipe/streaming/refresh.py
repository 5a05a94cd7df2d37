"""Key-level refresh of level 1 and level 2.

A left join inside a continuously refreshed table must *retract*: a late claim
for a known customer replaces that customer's no-claim row (W4), and a late
customer makes earlier claims visible (W5).  A stream-stream left join cannot
do that (it emits the NULL-extended row once and never takes it back), so the
refresh recomputes the keys that changed:

* the ingest jobs log the keys that each batch touched (``changes/refresh``);
* this query streams that log; per micro-batch the raw rows of these keys, from
  their buckets only, are found by a semi-join, and level 1 and 2 of
  these keys are written as a new load beside those there are.  Few keys also go into
  the scan as a filter: raw files are in key order, so row groups without them are skipped.
  Which of them are split over several join tasks follows from the sketches kept at ingest;
* the keys themselves are written as well (``level_keys``).  Rows of a level that are
  older than the newest refresh of their key no longer count, and a reader
  (``level``) leaves them out: nothing is rewritten to take a row back;
* both levels and the keys are published by one commit (``streaming.commits``), so a reader
  never sees half of a refresh, nor one level without the other;
* ``MERGE_AFTER`` refreshes are merged into one, which writes what they wrote and leaves
  the large base alone; ``compact_levels`` makes a new base.

The result equals a full batch recompute for any arrival order of files.
One refresh query owns both levels.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskpipe.operators import integrate as integ
from riskpipe.sources import schemas as S
from riskpipe.sources.csv_ingest import utc_now
from riskpipe.streaming import heavy
from riskpipe.streaming.commits import Commits, State, read, remove
from riskpipe.streaming.ingest import DEFAULT_BUCKETS, Layout, _fs, _overwrite_partitions, check_buckets, commits, ingest_log, key_bucket, read_raw

CHANGES_SCHEMA = "bucket int, feed string, batch_id long"
KEY_CHANGES_SCHEMA = "policy_number string, " + CHANGES_SCHEMA
KEYS_SCHEMA = "policy_number string, bucket int, load string"
L2_SORT = ("customer_state", "policy_number")
FEW_KEYS = 1000          # as many go into a scan's filter
SMALL_KEYS = 1_000_000   # as many are broadcast to it (about 20 bytes each)
MERGE_AFTER = 16


def ensure_dir(spark: SparkSession, path: str) -> None:
    """Create ``path`` if missing, so a stream can start before the first file arrives."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        fs.mkdirs(p)


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


# -- the tables ---------------------------------------------------------------------------------


def level_commits(spark: SparkSession, layout: Layout) -> Commits:
    return Commits(spark, layout.commits("levels"))


def level_schema(spark: SparkSession, n: int) -> T.StructType:
    l1 = integ.integrate(spark.createDataFrame([], S.CUSTOMER_RAW), spark.createDataFrame([], S.CLAIMS_RAW), hot=[])
    plan = l1 if n == 1 else integ.risk_matrix(l1)
    return T.StructType([*plan.schema.fields, T.StructField("bucket", T.IntegerType()), T.StructField("load", T.StringType())])


def is_base(load: str) -> bool:
    return load.split(".")[1] == "base"


def _new_load(state: State, kind: str) -> str:
    """A name after all names so far, in the order of text."""
    newest = max((int(x.split(".")[0]) for x in state.live | state.replaced), default=0)
    return f"{newest + 1:012d}.{kind}.{uuid.uuid4().hex[:8]}"


def _newest_keys(spark: SparkSession, layout: Layout, loads: list[str]) -> DataFrame:
    """(key, newest): the last of the refreshes ``loads`` that recomputed each key."""
    keys = spark.read.schema(KEYS_SCHEMA).parquet(layout.level_keys()).where(F.col("load").isin(loads))
    return keys.groupBy(F.col("policy_number").alias("key")).agg(F.max("load").alias("newest"))


def _merged(spark: SparkSession, layout: Layout, n: int, loads: list[str], schema: T.StructType | None = None) -> DataFrame:
    """Rows of the loads that no later one of them recomputed, with ``bucket`` and ``load``."""
    rows = spark.read.schema(schema or level_schema(spark, n)).parquet(layout.level(n)).where(F.col("load").isin(loads))
    later = [x for x in loads if not is_base(x)]
    if len(loads) == 1 or not later:
        return rows
    newest = _newest_keys(spark, layout, later)
    rows = rows.join(newest, F.col("policy_number").eqNullSafe(F.col("key")), "left")
    return rows.where(F.col("newest").isNull() | (F.col("load") >= F.col("newest"))).drop("key", "newest")


def level(spark: SparkSession, layout: Layout, n: int, with_load: bool = False) -> DataFrame:
    """Level ``n`` as last published (empty, with its schema, before the first refresh)."""
    schema = level_schema(spark, n)
    live = sorted(level_commits(spark, layout).state().live)
    df = _merged(spark, layout, n, live, schema) if live else spark.createDataFrame([], schema)
    return df if with_load else df.drop("load")


# -- refresh ------------------------------------------------------------------------------------


def _of_keys(rows: DataFrame | None, changed: DataFrame, few: list | None, small: bool) -> DataFrame | None:
    """The rows whose policy is among the changed ones (NULL is a key)."""
    if rows is None:
        return None
    if few is not None:
        known = [k for k in few if k is not None]
        here = F.col("policy_number").isin(known)
        rows = rows.where(here | F.col("policy_number").isNull() if None in few else here)
        return rows
    keys = changed.select(F.col("policy_number").alias("key"))
    return rows.join(F.broadcast(keys) if small else keys, F.col("policy_number").eqNullSafe(F.col("key")), "left_semi")


def refresh_keys(spark: SparkSession, layout: Layout, keys: DataFrame, *, buckets: int = DEFAULT_BUCKETS,
                 state_mode: str = "portable", skew: integ.SkewConfig | None = None) -> str | None:
    """Recompute levels 1 and 2 of ``keys`` (policy_number, bucket) and publish them.  Returns the load's name."""
    check_buckets(spark, layout, buckets)
    log = level_commits(spark, layout)
    state = log.state()
    load = _new_load(state, "keys")
    keys.select("policy_number", "bucket").distinct().withColumn("load", F.lit(load)).write.mode("append").partitionBy("load").parquet(layout.level_keys())
    changed = spark.read.schema(KEYS_SCHEMA).parquet(layout.level_keys()).where(F.col("load") == load)
    n = changed.limit(SMALL_KEYS + 1).count()
    if not n:
        return None
    few = [r[0] for r in changed.select("policy_number").collect()] if n <= FEW_KEYS else None
    touched = [r[0] for r in changed.select("bucket").distinct().collect()]   # at most buckets + 1 numbers
    parts, raw_state = {}, commits(spark, layout, "claims").state()
    hot = heavy.hot_keys(spark, layout.heavy("claims"), raw_state, skew or integ.SkewConfig(), touched)
    for feed, schema in (("customers", S.CUSTOMER_RAW), ("claims", S.CLAIMS_RAW)):
        rows = read_raw(spark, layout, feed, touched, raw_state if feed == "claims" else None)
        if rows is not None and feed == "claims":
            rows = integ.with_locator(rows)          # before the semi-join: the rows still are those of files
        rows = _of_keys(rows, changed, few, n <= SMALL_KEYS)
        parts[feed] = spark.createDataFrame([], schema) if rows is None else rows
    l1 = (integ.integrate(parts["customers"], parts["claims"], state_mode=state_mode, skew=skew, hot=hot, live=heavy.certain(raw_state))
          .withColumn("bucket", key_bucket(F.col("policy_number"), buckets)).withColumn("load", F.lit(load)))
    _overwrite_partitions(l1, layout.level(1), "bucket", "load")
    l1_new = spark.read.schema(l1.schema).parquet(layout.level(1)).where(F.col("load") == load)
    l2 = integ.risk_matrix(l1_new).withColumn("bucket", key_bucket(F.col("policy_number"), buckets)).withColumn("load", F.lit(load))
    # readers filter by state (row policy): cluster each file by state for row-group skipping
    _overwrite_partitions(l2, layout.level(2), "bucket", "load", sort_by=L2_SORT)
    log.add(load)
    refreshes = [x for x in log.state().live if not is_base(x)]
    if len(refreshes) > MERGE_AFTER:
        merge_refreshes(spark, layout)
    return load


def _rewrite(spark: SparkSession, layout: Layout, loads: list[str], load: str, state: State) -> None:
    for n, sort_by in ((1, ()), (2, L2_SORT)):
        rows = _merged(spark, layout, n, loads).drop("load").withColumn("load", F.lit(load))
        _overwrite_partitions(rows, layout.level(n), "bucket", "load", sort_by=sort_by)
    level_commits(spark, layout).swap(load, state, set(loads))
    for table, depth in ((layout.level(1), 1), (layout.level(2), 1), (layout.level_keys(), 0)):   # of the rewrite before this
        remove(spark, table, state.replaced, depth)


def merge_refreshes(spark: SparkSession, layout: Layout) -> None:
    """The refreshes since the base as one: what it costs hangs on what they wrote, not on the base."""
    state = level_commits(spark, layout).state()
    loads = sorted(x for x in state.live if not is_base(x))
    if len(loads) < 2:
        return
    load = _new_load(state, "keys")
    keys = spark.read.schema(KEYS_SCHEMA).parquet(layout.level_keys()).where(F.col("load").isin(loads))
    keys.select("policy_number", "bucket").distinct().withColumn("load", F.lit(load)).write.mode("append").partitionBy("load").parquet(layout.level_keys())
    _rewrite(spark, layout, loads, load, state)


def compact_levels(spark: SparkSession, layout: Layout) -> None:
    """A new base of all that counts (maintenance, between refreshes)."""
    state = level_commits(spark, layout).state()
    if state.live:
        _rewrite(spark, layout, sorted(state.live), _new_load(state, "base"), state)


def start_refresh(spark: SparkSession, layout: Layout, *, buckets: int = DEFAULT_BUCKETS,
                  trigger: dict | None = None, state_mode: str = "portable",
                  query_name: str | None = None) -> StreamingQuery:
    """Keep levels 1 and 2 fresh; ``trigger`` e.g. ``{"processingTime": "1 minute"}``
    (the target lag) or the default ``availableNow``."""
    ensure_dir(spark, layout.changes("refresh"))
    # processed log files are deleted, so the source listing stays small over months of batches
    changes = (spark.readStream.schema(KEY_CHANGES_SCHEMA).option("cleanSource", "delete")
               .parquet(layout.changes("refresh")).select("policy_number", "bucket"))

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        load = refresh_keys(session, layout, batch, buckets=buckets, state_mode=state_mode)
        # one row for each refresh: what was published and when
        log = session.createDataFrame([(int(batch_id), load)], "batch_id long, load string").withColumn("refreshed_at", utc_now())
        log.coalesce(1).write.mode("append").parquet(layout.refresh_log())

    w = (changes.writeStream.foreachBatch(run_batch)
         .option("checkpointLocation", layout.checkpoint("refresh")))
    if query_name:
        w = w.queryName(query_name)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def freshness(spark: SparkSession, layout: Layout, target_lag_seconds: int = 60) -> DataFrame:
    """T3 contract check: per feed, the newest ingest vs the newest refresh.

    ``lag_seconds`` is how long the newest ingested batch waited for (or has been
    waiting for) a refresh; ``within_target`` compares it with the target lag."""
    ingest = ingest_log(spark, layout).groupBy("feed").agg(F.max("loaded_at").alias("last_ingest"))
    last = None
    if _exists(spark, layout.refresh_log()):   # one aggregate value
        last = spark.read.parquet(layout.refresh_log()).agg(F.max("refreshed_at")).first()[0]
    last_refresh = F.lit(last).cast("timestamp_ntz")
    now = utc_now()
    lag = F.when(last_refresh >= F.col("last_ingest"),
                 F.unix_timestamp(last_refresh) - F.unix_timestamp("last_ingest")) \
        .otherwise(F.unix_timestamp(now) - F.unix_timestamp("last_ingest"))
    return ingest.select("feed", "last_ingest", last_refresh.alias("last_refresh"),
                         lag.cast("bigint").alias("lag_seconds"), (lag <= target_lag_seconds).alias("within_target"))


def materialize_levels(spark: SparkSession, customers: DataFrame, claims: DataFrame, layout: Layout, *,
                       buckets: int = DEFAULT_BUCKETS, state_mode: str = "portable",
                       hot: list | None = None) -> None:
    """S13 batch form: full recompute of level 1 and level 2, written partitioned by
    key bucket as a new base, which takes the place of all before it in one step.
    Level 2 is derived from the written level 1."""
    state = level_commits(spark, layout).state()
    load = _new_load(state, "base")
    l1 = (integ.integrate(customers, claims, state_mode=state_mode, hot=hot)
          .withColumn("bucket", key_bucket(F.col("policy_number"), buckets)).withColumn("load", F.lit(load)))
    _overwrite_partitions(l1, layout.level(1), "bucket", "load")
    l1_new = spark.read.schema(l1.schema).parquet(layout.level(1)).where(F.col("load") == load)
    l2 = integ.risk_matrix(l1_new).withColumn("bucket", key_bucket(F.col("policy_number"), buckets)).withColumn("load", F.lit(load))
    _overwrite_partitions(l2, layout.level(2), "bucket", "load", sort_by=L2_SORT)
    level_commits(spark, layout).swap(load, state, state.live)
