"""Continuous, lenient ingest of landing files.

Source: a ``binaryFile`` file stream over the landing folder that selects only
the file path (content is never read by the stream), so each file is tracked
exactly once by the checkpointed file log.  Per micro-batch (``foreachBatch``):

1. the batch's file paths (bounded by ``maxFilesPerTrigger``) are matched
   against the feed pattern, on the whole path; files that the feed has loaded
   before (by path, size and time, also through ``copy_into``) are left out, the
   others parsed by column name (``csv_ingest``) into a staging table;
2. the batch's id follows from its files, so it is the same when the batch is replayed
   and different for any other, whatever checkpoint the stream has;
3. good rows go to ``raw/<feed>`` into folders ``(bucket, load)``, frequency sketches of
   the claims' keys beside them (``heavy``), rejected rows to
   ``quarantine/<feed>``, counts to the ingest log and, for each file, to the load history, files to the list of loaded ones;
4. one commit file makes all of it count (``commits``).  Readers of the raw table, of
   the log and of the list leave out what is not committed;
5. the keys and buckets touched go to one log per consumer (refresh: keys, monitor:
   buckets), and a mark says so.  A commit without the mark is handed on by the next
   batch, so a crash between the two loses no change.

Only file paths, bucket ids and counters reach the driver, never rows.

``copy_into`` loads a fixed list of files into the same tables, strictly or
leniently.  ``compact_raw`` merges the loads of a raw table into one, whose commit
takes the place of theirs; rows keep their batch id, so files loaded again by force still
replace their own rows.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskpipe.sources import csv_ingest as C
from riskpipe.sources import schemas as S
from riskpipe.streaming import heavy
from riskpipe.streaming.commits import Commits, State, _fs, _names, batch_of, read, remove

DEFAULT_BUCKETS = 64
CHANGE_CONSUMERS = ("refresh", "monitor")
FEED_PATTERNS = {"claims": C.CLAIMS_PATTERN, "customers": C.CUSTOMER_PATTERN}
SKETCHED = ("claims",)   # feeds on the many side of the join
_FOLD = "fold"   # loads that a compaction made
BINARY_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def key_bucket(key: Column, buckets: int) -> Column:
    """Bucket of a policy number; NULL keys get their own bucket -1."""
    return F.when(key.isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64(key), F.lit(buckets))).cast("int")


@dataclass(frozen=True)
class Layout:
    """Folders of one deployment, all under a shared (cluster-visible) root."""
    root: str

    def raw(self, feed: str) -> str:
        return f"{self.root}/raw/{feed}"

    def commits(self, table: str) -> str:
        """Commit files of a feed's raw table, or of the levels."""
        return f"{self.root}/_commits/{table}"

    def loaded(self, feed: str) -> str:
        """Files that were loaded (path, size, time)."""
        return f"{self.root}/loaded_files/{feed}"

    def heavy(self, feed: str) -> str:
        """Frequency sketches of the keys of each load."""
        return f"{self.root}/heavy_keys/{feed}"

    def load_history(self) -> str:
        """What became of each file."""
        return f"{self.root}/load_history"

    def quarantine(self, feed: str) -> str:
        return f"{self.root}/quarantine/{feed}"

    def changes(self, consumer: str) -> str:
        """Change log of one consumer stream (each consumer deletes what it processed)."""
        return f"{self.root}/changes/{consumer}"

    def ingest_log(self) -> str:
        return f"{self.root}/ingest_log"

    def level(self, n: int) -> str:
        return f"{self.root}/level{n}"

    def level_keys(self) -> str:
        """The keys that each refresh recomputed."""
        return f"{self.root}/level_keys"

    def refresh_log(self) -> str:
        return f"{self.root}/refresh_log"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"


def _overwrite_partitions(df: DataFrame, path: str, *cols: str, sort_by: tuple[str, ...] = ()) -> None:
    """Dynamic partition overwrite of ``cols`` partitions.

    The REBALANCE hint clusters rows by the partition columns before the write,
    so each partition folder gets about one file instead of one per input task,
    and AQE splits a skewed partition (a hot bucket) over several tasks/files.
    ``sort_by`` orders rows inside each file (after the partition columns, which
    the writer needs first anyway), so parquet min/max statistics can skip row
    groups for filters on those columns.
    """
    out = df.hint("rebalance", *cols)
    if sort_by:
        out = out.sortWithinPartitions(*cols, *sort_by)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*cols).parquet(path))


def _write_partitions(df: DataFrame, path: str, *cols: str) -> None:
    """The same for a table of few rows, without a shuffle."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path)


def check_buckets(spark: SparkSession, layout: Layout, buckets: int) -> None:
    """The bucket count is a property of the tables: kept with them on first use, and no other accepted later."""
    kept = [int(n.split("=")[1]) for n in _names(spark, f"{layout.root}/_buckets") if n.startswith("count=")]
    if not kept:
        p, fs = _fs(spark, f"{layout.root}/_buckets/count={buckets}")
        fs.create(p, True).close()
    elif kept != [buckets]:
        raise ValueError(f"the tables under {layout.root} have {kept[0]} buckets, not {buckets}")


def commits(spark: SparkSession, layout: Layout, feed: str) -> Commits:
    return Commits(spark, layout.commits(feed))


def raw_schema(feed: str) -> T.StructType:
    return T.StructType([*S.RAW_SCHEMAS[feed].fields, T.StructField("batch_id", T.LongType()), T.StructField("bucket", T.IntegerType()), T.StructField("load", T.StringType())])


def read_raw(spark: SparkSession, layout: Layout, feed: str, buckets_touched: list[int] | None = None, state: State | None = None) -> DataFrame | None:
    """The raw table as it is now, or as ``state`` says (of some buckets only, if given), with ``batch_id`` and ``bucket``; None where it has no rows."""
    df = read(spark, layout.raw(feed), raw_schema(feed), state or commits(spark, layout, feed).state(), buckets_touched)
    return None if df is None else df.drop("load")


def _file_facts(spark: SparkSession, paths: list[str]) -> list[tuple[str, int, int]]:
    """(path, size, time) of the files of one batch."""
    out = []
    for x in paths:
        p, fs = _fs(spark, x)
        st = fs.getFileStatus(p)
        out.append((x, st.getLen(), st.getModificationTime()))
    return out


_HISTORY = ("file string, rows_parsed long, rows_loaded long, rows_rejected long, first_error_row long, first_error_columns string, "
            "strict boolean, loaded_at timestamp_ntz")
_LOADED = "path string, size long, modified long, batch_id long"


def _not_loaded(spark: SparkSession, layout: Layout, feed: str, files: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Of ``files`` those that no committed batch has loaded."""
    done = commits(spark, layout, feed).state().batches
    if not files or not done or not _names(spark, layout.loaded(feed)):
        return files
    mine = spark.createDataFrame(files, "path string, size long, modified long")
    seen = _committed(spark, spark.read.schema(_LOADED).parquet(layout.loaded(feed)), {feed: done})
    return [tuple(r) for r in mine.join(seen, ["path", "size", "modified"], "left_anti").collect()]   # at most this batch


def _committed(spark: SparkSession, rows: DataFrame, batches: dict[str, set[str]]) -> DataFrame:
    """The rows whose batch was committed (a few bytes for each batch ever loaded)."""
    done = spark.createDataFrame([(feed, int(b)) for feed, of in batches.items() for b in of if b.lstrip("-").isdigit()], "_feed string, _batch long")
    same = (F.col("batch_id") == F.col("_batch")) & (F.col("feed") == F.col("_feed")) if "feed" in rows.columns else F.col("batch_id") == F.col("_batch")
    return rows.join(F.broadcast(done), same, "left_semi")


def batch_identity(files: list[tuple[str, int, int]]) -> int:
    """A number that follows from the files (path, size, time)."""
    return int(hashlib.md5("\n".join(f"{x}|{n}|{t}" for x, n, t in sorted(files)).encode()).hexdigest()[:15], 16)


def _hand_on(spark: SparkSession, layout: Layout, feed: str, load: str, rows: DataFrame) -> None:
    """Log the keys and buckets of ``rows`` for the consumers, then mark the load.

    Done twice (after a crash) it does no harm: refreshing or measuring again changes nothing."""
    keys = rows.select("policy_number", "bucket").withColumns({"feed": F.lit(feed), "batch_id": F.lit(int(batch_of(load))).cast("long")})
    keys.distinct().write.mode("append").parquet(layout.changes("refresh"))
    keys.select("bucket", "feed", "batch_id").distinct().coalesce(1).write.mode("append").parquet(layout.changes("monitor"))
    commits(spark, layout, feed).log(load)


def hand_on_the_rest(spark: SparkSession, layout: Layout, feed: str) -> None:
    """Hand on the changes of commits that have no mark: an ingest ended between the two."""
    state = commits(spark, layout, feed).state()
    for load in sorted(state.live - state.logged):
        if load.startswith(_FOLD):
            continue
        rows = spark.read.schema(raw_schema(feed)).parquet(layout.raw(feed))
        _hand_on(spark, layout, feed, load, rows.where((F.col("load") == load) | (F.col("batch_id") == int(batch_of(load)))))


def ingest_files(spark: SparkSession, paths: list[str], feed: str, layout: Layout, batch_id: int | None = None, *,
                 buckets: int = DEFAULT_BUCKETS, on_error: str = "continue", file_name_mode: str = "source", force: bool = False, **read_kw) -> C.LoadResult:
    """Load one batch of files into the layout.  Its id follows from the files unless given; a batch
    that was committed before is not loaded again, or with ``force`` replaces its own rows.

    ``on_error="abort"``: if any row does not convert, all such rows go to the quarantine
    and nothing else is written."""
    check_buckets(spark, layout, buckets)
    hand_on_the_rest(spark, layout, feed)
    files = _file_facts(spark, paths)
    batch_id = batch_identity(files) if batch_id is None else batch_id
    log = commits(spark, layout, feed)
    state = log.state()
    again = str(batch_id) in state.batches
    if again and not force:
        old = ingest_log(spark, layout).where((F.col("feed") == feed) & (F.col("batch_id") == batch_id)).first()
        return C.LoadResult(feed, len(paths), old["rows_loaded"], old["rows_rejected"])
    load = f"{batch_id}.{uuid.uuid4().hex[:8]}" if again else str(batch_id)
    typed = C.read_csv_by_name(spark, paths, S.DATA_SCHEMAS[feed], varchar_limits=S.VARCHAR_LIMITS.get(feed),
                               file_name_mode=file_name_mode, locate=True, **read_kw)
    typed = (typed.withColumn("bucket", key_bucket(F.col("policy_number"), buckets))
             .withColumn("batch_id", F.lit(batch_id).cast("long"))
             .withColumn("_good", F.size("_rejected") == 0)
             .withColumn("_raw_record", F.when(~F.col("_good"), F.col("_raw_record"))))   # only the quarantine has it
    staging = f"{layout.root}/_staging/{uuid.uuid4().hex}"
    typed.write.parquet(staging)   # one parse; what follows reads the typed files.  Folders by _good would sort all rows
    try:
        staged = spark.read.schema(typed.schema).parquet(staging)
        res = _keep_history(spark, layout, feed, batch_id, staged, files, on_error)
        if res.rows_rejected:
            bad = C.bad_rows(staged.where("NOT _good")).withColumn("batch_id", F.lit(batch_id).cast("long"))
            _overwrite_partitions(bad, layout.quarantine(feed), "batch_id")
        if on_error == "abort" and res.rows_rejected:
            raise C.LoadError(f"{res.rows_rejected} of {res.rows_loaded + res.rows_rejected} rows did not convert; nothing loaded. "
                              f"They are in {layout.quarantine(feed)}, batch_id {batch_id}")
        good = staged.where("_good").select(*C.RAW_COLUMNS[feed], "bucket", "batch_id").withColumn("load", F.lit(load))
        # files in key order: a refresh of few keys skips row groups
        _overwrite_partitions(good, layout.raw(feed), "bucket", "load", sort_by=("policy_number",))
        if feed in SKETCHED:
            heavy.keep(good, layout.heavy(feed), load)
        entry = spark.createDataFrame(
            [(feed, int(batch_id), len(paths), res.rows_loaded, res.rows_rejected)],
            "feed string, batch_id long, files int, rows_loaded long, rows_rejected long",
        ).withColumn("loaded_at", C.utc_now()).coalesce(1)
        _write_partitions(entry, layout.ingest_log(), "feed", "batch_id")
        _write_partitions(spark.createDataFrame([(*f, int(batch_id)) for f in files], _LOADED).coalesce(1), layout.loaded(feed), "batch_id")
        touched = good
        if again:      # keys of the rows that go have changed as well
            touched = good.unionByName(read(spark, layout.raw(feed), raw_schema(feed), state).where(F.col("batch_id") == batch_id))
            olds = {x for x in state.live if batch_of(x) == str(batch_id)}
            folds = {x: {str(batch_id)} for x in state.live if x.startswith(_FOLD)}
            log.swap(load, state, olds, {str(batch_id)}, folds)
        else:
            log.add(load)
        _hand_on(spark, layout, feed, load, touched)
        return res
    finally:
        p, fs = _fs(spark, staging)
        fs.delete(p, True)


def _keep_history(spark: SparkSession, layout: Layout, feed: str, batch_id: int, staged: DataFrame, files: list[tuple[str, int, int]], on_error: str) -> C.LoadResult:
    """Write the batch's rows of the load history, which a replay replaces, and sum them up."""
    found = C.file_history(staged, spark.createDataFrame(files, "path string, size long, modified long"))
    found = found.withColumns({"feed": F.lit(feed), "batch_id": F.lit(batch_id).cast("long"), "strict": F.lit(on_error == "abort"), "loaded_at": C.utc_now()})
    _write_partitions(found.coalesce(1), layout.load_history(), "feed", "batch_id")
    kept = spark.read.schema(_HISTORY).parquet(f"{layout.load_history()}/feed={feed}/batch_id={batch_id}")
    n = kept.agg(F.sum("rows_loaded"), F.sum("rows_rejected")).first()
    return C.LoadResult(feed, len(files), int(n[0] or 0), int(n[1] or 0))


def load_history(spark: SparkSession, layout: Layout) -> DataFrame:
    """A row for each file of each load: (feed, batch_id, file, status, rows_parsed, rows_loaded, rows_rejected,
    first_error_row, first_error_columns, loaded_at).

    A strict load with a rejected row is ``LOAD_FAILED`` for all of its files and loads none of their rows.  Other loads are there
    once they are committed: ``LOADED``, or ``PARTIALLY_LOADED`` where rows of the file were rejected."""
    schema = _HISTORY + ", feed string, batch_id long"
    if not _names(spark, layout.load_history()):
        return spark.createDataFrame([], schema).drop("strict").withColumn("status", F.lit(""))
    rows = spark.read.schema(schema).parquet(layout.load_history())
    batch = rows.where("strict").groupBy("feed", "batch_id").agg((F.sum("rows_rejected") > 0).alias("failed"))
    rows = rows.join(batch, ["feed", "batch_id"], "left").withColumn("failed", F.coalesce("failed", F.lit(False)))
    done = _committed(spark, rows.where("NOT failed"), {f: commits(spark, layout, f).state().batches for f in FEED_PATTERNS})
    rows = done.unionByName(rows.where("failed"))
    status = F.when(F.col("failed"), "LOAD_FAILED").when(F.col("rows_rejected") > 0, "PARTIALLY_LOADED").otherwise("LOADED")
    return rows.select("feed", "batch_id", "file", status.alias("status"), "rows_parsed",
                       F.when(F.col("failed"), 0).otherwise(F.col("rows_loaded")).cast("long").alias("rows_loaded"),
                       "rows_rejected", "first_error_row", "first_error_columns", "loaded_at")


def copy_into(spark: SparkSession, paths: list[str], feed: str, layout: Layout, *, on_error: str = "abort", force: bool = False,
              buckets: int = DEFAULT_BUCKETS, **read_kw) -> C.LoadResult:
    """Load a fixed list of files into the raw table that the streams write as well.

    Files that the feed has loaded before are skipped; with ``force`` the batch of exactly these files is
    loaded again and replaces its rows, wherever a compaction has put them."""
    if on_error not in ("abort", "continue"):
        raise ValueError(f"on_error must be 'abort' or 'continue', not {on_error!r}")
    files = _file_facts(spark, sorted(set(paths)))
    if not force:
        files = _not_loaded(spark, layout, feed, files)
    if not files:
        return C.LoadResult(feed, 0, 0, 0)
    return ingest_files(spark, sorted(x for x, _, _ in files), feed, layout, buckets=buckets, on_error=on_error, force=force, **read_kw)


def load_initial(spark: SparkSession, stage: str, feed: str, layout: Layout, **kw) -> C.LoadResult:
    """S7 + S4: the exact initial file of a feed (batch files excluded), loaded strictly."""
    files = C.list_files(spark, stage, C.INITIAL_PATTERNS[feed])
    if not files:
        raise FileNotFoundError(f"no initial {feed} file under {stage}")
    return copy_into(spark, files, feed, layout, file_name_mode="default", **kw)


def start_ingest(spark: SparkSession, landing: str, feed: str, layout: Layout, *,
                 trigger: dict | None = None, max_files_per_trigger: int | None = 1000,
                 buckets: int = DEFAULT_BUCKETS, pattern: str | None = None,
                 query_name: str | None = None, archive_dir: str | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """Start the lenient continuous load of one feed.

    ``checkpoint`` names another checkpoint of the stream; a new one lists the landing folder
    afresh and loads what is not loaded.

    ``archive_dir`` (optional) moves processed landing files there once their batch
    is committed, so the landing listing stays small on a long run; by default files
    stay in place (the staged-file inventory S8 lists them).

    ``trigger`` defaults to ``availableNow`` (process what is there, then stop:
    S9 refresh/backfill); pass ``{"processingTime": "1 minute"}`` to keep running.
    """
    rx = re.compile(pattern or FEED_PATTERNS[feed])
    src = (spark.readStream.format("binaryFile").schema(BINARY_SCHEMA)
           .option("recursiveFileLookup", "true"))   # the pattern is matched on whole paths, per batch
    if max_files_per_trigger:
        src = src.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        src = src.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    files = src.load(landing).select("path")

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.collect()]   # file paths only, ≤ maxFilesPerTrigger
        paths = [p for p in paths if rx.fullmatch(p)]
        new = _not_loaded(batch.sparkSession, layout, feed, _file_facts(batch.sparkSession, sorted(paths)))
        if new:
            ingest_files(batch.sparkSession, sorted(x for x, _, _ in new), feed, layout, buckets=buckets)
        else:
            hand_on_the_rest(batch.sparkSession, layout, feed)

    w = (files.writeStream.foreachBatch(run_batch)
         .option("checkpointLocation", checkpoint or layout.checkpoint(f"ingest_{feed}")))
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def ingest_log(spark: SparkSession, layout: Layout) -> DataFrame:
    """One row per committed ingest batch and feed."""
    feeds = {f: commits(spark, layout, f).state().batches for f in FEED_PATTERNS}
    return _committed(spark, spark.read.parquet(layout.ingest_log()), feeds)


def pipe_status(query: StreamingQuery) -> dict:
    """S10 live view: the stream's status and last progress."""
    return {"status": query.status, "last_progress": query.lastProgress}


def compact_raw(spark: SparkSession, layout: Layout, feed: str) -> int:
    """Merge the loads of a raw table into one, with about one file a bucket.

    Loads committed meanwhile stay beside it.  A failure before the commit changes nothing.
    What an earlier compaction replaced is removed.  Returns the number of buckets."""
    log = commits(spark, layout, feed)
    state = log.state()
    rows = read(spark, layout.raw(feed), raw_schema(feed), state)
    if rows is None:
        return 0
    hand_on_the_rest(spark, layout, feed)
    load = f"{_FOLD}.{uuid.uuid4().hex[:8]}"
    _overwrite_partitions(rows.withColumn("load", F.lit(load)), layout.raw(feed), "bucket", "load", sort_by=("policy_number",))
    if feed in SKETCHED:
        new = spark.read.schema(raw_schema(feed)).parquet(layout.raw(feed)).where(F.col("load") == load)
        heavy.keep(new, layout.heavy(feed), load)
    log.swap(load, state, state.live, state.batches)
    remove(spark, layout.raw(feed), state.replaced)
    heavy.forget(spark, layout.heavy(feed), state.replaced)
    return sum(f"load={load}" in _names(spark, f"{layout.raw(feed)}/{n}") for n in _names(spark, layout.raw(feed)) if n.startswith("bucket="))
