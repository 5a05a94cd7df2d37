"""CSV ingest bound by column name.

Spark's CSV reader binds an explicit schema by *position*, and one read of
several files with different header orders silently mis-binds.  So:

1. the header line of each file is read through the Hadoop FileSystem API on
   the driver (a few bytes per file, concurrently, no Spark job, no rows);
2. files are grouped by header; each group is parsed once, all fields as
   strings, in that group's own column order;
3. each group is projected *by lower-cased name* onto the target schema
   (missing column → NULL, extra column ignored) and the groups are unioned.

Typed conversion is ``try_cast`` based; a field whose text is non-empty but
does not convert is recorded in ``_rejected`` (array of column names), so the
strict and lenient loads share one parse.  Everything after step 1 runs on
executors; only file paths and header strings touch the driver.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskpipe.sources import schemas as S

# fixed values: the file format of the landing files
CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "lineSep": "\n",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "mode": "PERMISSIVE",       # short rows → NULL tail, long rows → extra fields ignored
    "encoding": "UTF-8",        # invalid bytes decode to U+FFFD
    "multiLine": "false",
}
CLAIMS_PATTERN = r".*CLAIMS_DATA.*\.csv"
CUSTOMER_PATTERN = r".*CUSTOMER_DATA.*\.csv"
CLAIMS_INITIAL_PATTERN = r".*CLAIMS_DATA\.csv"
CUSTOMER_INITIAL_PATTERN = r".*CUSTOMER_DATA\.csv"


class LoadError(Exception):
    """Strict load found values that do not convert; nothing was written."""


# ---------------------------------------------------------------------------
# file system helpers (driver side, metadata only)


def _jvm_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(conf)


def list_files(spark: SparkSession, root: str, pattern: str | None = None) -> list[str]:
    """Files under ``root`` (recursive) whose full path matches ``pattern``."""
    p, fs = _jvm_path(spark, root)
    if not fs.exists(p):
        return []
    it = fs.listFiles(p, True)
    rx = re.compile(pattern) if pattern else None
    out = []
    while it.hasNext():
        st = it.next()
        path = st.getPath().toString()
        name = st.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        if rx is None or rx.fullmatch(path):
            out.append(path)
    return sorted(out)


def read_header(spark: SparkSession, path: str, sep: str = ",") -> tuple[str, ...]:
    """The first line of ``path``, split on ``sep``, trimmed and lower-cased."""
    p, fs = _jvm_path(spark, path)
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        line = reader.readLine() or ""
    finally:
        reader.close()
    line = line.lstrip("\ufeff").rstrip("\r")
    return tuple(h.strip().strip('"').lower() for h in line.split(sep))


def read_headers(spark: SparkSession, paths: list[str], sep: str = ",",
                 threads: int = 32) -> dict[str, tuple[str, ...]]:
    """Header line of every path, fetched concurrently (each is one small read; on an
    object store the latency, not the bytes, dominates)."""
    if len(paths) <= 1:
        return {p: read_header(spark, p, sep) for p in paths}
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=min(threads, len(paths))) as pool:
        return dict(zip(paths, pool.map(lambda p: read_header(spark, p, sep), paths)))


# ---------------------------------------------------------------------------
# typed conversion


def _text(c: Column) -> Column:
    """Trim and map the empty field to NULL."""
    t = F.trim(c)
    return F.when(t == "", F.lit(None)).otherwise(t)


def utc_now() -> Column:
    """The time of the query as a zoneless timestamp in UTC, whatever the session's zone."""
    seconds = (F.unix_micros(F.current_timestamp()) / F.lit(1_000_000).cast("decimal(10,0)")).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def convert(text: Column, dtype: T.DataType, timestamp_format: str = S.TIMESTAMP_FORMAT) -> Column:
    """S3: the typed value, or NULL when the text does not convert."""
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, T.IntegerType):
        # NUMBER semantics: '35.5' rounds to 36 instead of failing
        return text.try_cast(T.DecimalType(38, 0)).try_cast(T.IntegerType())
    if isinstance(dtype, T.DecimalType):
        return text.try_cast(dtype)
    if isinstance(dtype, T.BooleanType):
        # fixed values: the words for true and false that the cast does not know
        word = F.lower(text)
        return F.when(word == "on", F.lit(True)).when(word == "off", F.lit(False)).otherwise(text.try_cast(T.BooleanType()))
    if isinstance(dtype, T.TimestampNTZType):
        # read as UTC, then counted from a zoneless epoch: no session zone and no clock change can shift it
        at = F.unix_micros(F.try_to_timestamp(F.concat(text, F.lit(" +00:00")), F.lit(timestamp_format + " XXX")))
        return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=(at / F.lit(1_000_000).cast("decimal(10,0)")).cast("decimal(18,6)"))
    if isinstance(dtype, T.TimestampType):
        return F.try_to_timestamp(text, F.lit(timestamp_format))
    return text.try_cast(dtype)


def typed_projection(df: DataFrame, schema: T.StructType, present: set[str], *,
                     varchar_limits: dict[str, int] | None = None,
                     timestamp_format: str = S.TIMESTAMP_FORMAT, more: tuple[str, ...] = ()) -> DataFrame:
    """Project string columns (lower-case names) onto ``schema`` with reject tracking; ``more`` go through as they are."""
    varchar_limits = varchar_limits or {}
    cols, rejects, raws = [], [], []
    for f in schema.fields:
        if f.name not in present:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        txt = _text(F.col(f"`{f.name}`"))
        val = convert(txt, f.dataType, timestamp_format)
        bad = txt.isNotNull() & val.isNull()
        limit = varchar_limits.get(f.name)
        if limit is not None:
            bad = bad | (F.length(txt) > limit)
        cols.append(val.alias(f.name))
        rejects.append(F.when(bad, F.lit(f.name)))
        raws.append(txt)
    # names are distinct; array_compact is a lambda, under which Spark would interpret every conversion row by row
    rej = F.array_except(F.array(*rejects), F.array(F.lit(None).cast("string"))) if rejects else F.array().cast("array<string>")
    return df.select(*cols, rej.alias("_rejected"),
                     F.concat_ws(",", *[F.coalesce(r, F.lit("")) for r in raws]).alias("_raw_record"),
                     F.col("_source_file"), *more)


def read_csv_by_name(spark: SparkSession, paths: list[str], schema: T.StructType, *,
                     quote: str = "", options: dict | None = None,
                     file_name_mode: str = "default", default_file_name: str = S.DEFAULT_FILE_NAME,
                     varchar_limits: dict[str, int] | None = None,
                     timestamp_format: str = S.TIMESTAMP_FORMAT,
                     load_time: Column | None = None, locate: bool = False) -> DataFrame:
    """Typed rows of ``paths`` bound to ``schema`` by column name.

    Adds ``load_timestamp`` / ``file_name`` audit columns and ``_rejected``
    (names of fields that did not convert) plus ``_raw_record`` (the trimmed
    field texts) for quarantine.

    ``locate`` adds the place of each record, for ``file_history``: ``_block`` (where the part of the file
    that a task reads begins) and ``_at`` (numbers that rise by one from record to record of a part).
    ``_at`` is given anew in each run: write the rows before using it.
    """
    opts = dict(CSV_OPTIONS)
    opts.update(options or {})
    opts["quote"] = quote if quote else "\u0000"   # no enclosure character unless asked
    groups: dict[tuple[str, ...], list[str]] = {}
    headers = read_headers(spark, list(paths), opts["sep"])
    for p in paths:
        groups.setdefault(headers[p], []).append(p)
    wanted = {f.name for f in schema.fields}
    parts = []
    for header, files in groups.items():
        # parse all fields as text in this group's own order, then bind by name
        string_schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(header))])
        df = spark.read.options(**opts).schema(string_schema).csv(files)
        keep, seen = [], set()
        for i, h in enumerate(header):
            if h in wanted and h not in seen:
                keep.append(F.col(f"_c{i}").alias(h))
                seen.add(h)
        place = [F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at")] if locate else []
        df = df.select(*keep, F.col("_metadata.file_path").alias("_source_file"), *place)
        parts.append(typed_projection(df, schema, seen, varchar_limits=varchar_limits, timestamp_format=timestamp_format,
                                      more=("_block", "_at") if locate else ()))
    if not parts:
        empty = spark.createDataFrame([], schema)
        parts = [empty.select("*", F.array().cast("array<string>").alias("_rejected"),
                              F.lit(None).cast("string").alias("_raw_record"),
                              F.lit(None).cast("string").alias("_source_file"),
                              *([F.lit(0).cast("long").alias("_block"), F.lit(0).cast("long").alias("_at")] if locate else []))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    lt = load_time if load_time is not None else utc_now()   # F8
    if file_name_mode == "source":
        fname = F.element_at(F.split(F.col("_source_file"), "/"), -1)
    else:
        fname = F.lit(default_file_name)
    return out.withColumn("load_timestamp", lt).withColumn("file_name", fname)


RAW_COLUMNS = {k: [f.name for f in v.fields] for k, v in S.RAW_SCHEMAS.items()}


def good_rows(typed: DataFrame, feed: str) -> DataFrame:
    return typed.where(F.size("_rejected") == 0).select(*RAW_COLUMNS[feed])


def bad_rows(typed: DataFrame) -> DataFrame:
    """Quarantine shape: source file, rejected columns, raw field texts, load time."""
    return typed.where(F.size("_rejected") > 0).select(
        F.col("_source_file").alias("source_file"),
        F.array_join("_rejected", ",").alias("rejected_columns"),
        F.col("_raw_record").alias("raw_record"),
        "load_timestamp")


def _plain_path(path: Column) -> Column:
    """One spelling of a path: file listings and rows' metadata differ in slashes and escapes."""
    return F.regexp_replace(path, "^([A-Za-z0-9]+):/+", "$1:/")


def file_history(staged: DataFrame, files: DataFrame) -> DataFrame:
    """What became of each file: (file, rows_parsed, rows_loaded, rows_rejected, first_error_row, first_error_columns).

    ``staged``: stored rows of ``read_csv_by_name(locate=True)``; ``files``: (path) of all files, also
    those without a record.  ``first_error_row`` is the number of the first rejected record in its file, from 1
    after the header.  One aggregate, without a sort, with a row for each part of a file that a task read; the records of earlier
    parts are a running sum over these."""
    bad = F.size("_rejected") > 0
    parts = (staged.groupBy("_source_file", "_block")
             .agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad"), F.min("_at").alias("start")))
    # the least struct needs sorted groups, so only rejected records are sorted
    errors = (staged.where(bad).groupBy(F.col("_source_file").alias("_file"), F.col("_block").alias("_of"))
              .agg(F.min(F.struct(F.col("_at"), F.array_join("_rejected", ",").alias("columns"))).alias("error")))
    parts = parts.join(errors, F.col("_source_file").eqNullSafe(F.col("_file")) & F.col("_block").eqNullSafe(F.col("_of")), "left")
    # paths are decoded once for each part, not for each row
    parts = parts.withColumn("file", _plain_path(F.url_decode(F.replace(F.col("_source_file"), F.lit("+"), F.lit("%2B")))))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = F.struct((before + F.col("error._at") - F.col("start") + 1).alias("row"), F.col("error.columns").alias("columns"))
    per = (parts.select("file", "n", "bad", F.when(F.col("error").isNotNull(), first).alias("first"))
           .groupBy("file").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.min("first").alias("first")))
    out = files.select(_plain_path(F.col("path")).alias("_path")).join(per, F.col("_path") == F.col("file"), "left")
    n, rejected = F.coalesce("n", F.lit(0)), F.coalesce("bad", F.lit(0))
    return out.select(F.col("_path").alias("file"), n.alias("rows_parsed"), (n - rejected).alias("rows_loaded"), rejected.alias("rows_rejected"),
                      F.col("first.row").alias("first_error_row"), F.col("first.columns").alias("first_error_columns"))


@dataclass
class LoadResult:
    feed: str
    files: int
    rows_loaded: int
    rows_rejected: int


def _commit_staged(spark: SparkSession, staged: str, target: str, load_id: str) -> str:
    """Publish a finished staging write as partition ``load_id=<id>`` of ``target``
    with one directory rename (no partially committed load is ever visible)."""
    src, fs = _jvm_path(spark, staged)
    dst_root, _ = _jvm_path(spark, target)
    if not fs.exists(dst_root):
        fs.mkdirs(dst_root)
    jvm = spark.sparkContext._jvm
    for st in fs.listStatus(src):          # drop writer markers before publishing
        if st.getPath().getName().startswith(("_", ".")):
            fs.delete(st.getPath(), True)
    dst = jvm.org.apache.hadoop.fs.Path(dst_root, f"load_id={load_id}")
    if fs.exists(dst):                     # a retried commit of the same load replaces it
        fs.delete(dst, True)
    if not fs.rename(src, dst):
        raise OSError(f"could not publish {staged} as {dst.toString()}")
    return dst.toString()


def load_batch(spark: SparkSession, paths: list[str], feed: str, target: str, *,
               on_error: str = "abort", quarantine: str | None = None, staging: str | None = None,
               load_id: str | None = None, **read_kw) -> LoadResult:
    """S4 (abort) / S5 semantics (continue) for a fixed list of files.

    abort:    one pass writes to a staging folder while an observation counts
              rejected rows; on any reject the staging folder is dropped and
              ``LoadError`` raised, else the folder is renamed to partition
              ``load_id=<id>`` of ``target`` (one rename; re-running a load id
              replaces it).
    continue: good rows go to partition ``load_id=<id>`` of ``target``, rejected
              rows to the same partition of ``quarantine`` (dynamic overwrite:
              re-running a load id replaces it); the parsed batch is persisted
              so the files are parsed once.
    """
    from pyspark.sql import Observation

    if on_error not in ("abort", "continue"):
        raise ValueError(f"on_error must be 'abort' or 'continue', not {on_error!r}")
    if not paths:   # nothing to load (and no empty plan whose observation would never report)
        return LoadResult(feed, 0, 0, 0)
    schema = S.DATA_SCHEMAS[feed]
    limits = S.VARCHAR_LIMITS.get(feed)
    typed = read_csv_by_name(spark, paths, schema, varchar_limits=limits, **read_kw)
    if on_error == "abort":
        import uuid
        load_id = load_id or uuid.uuid4().hex[:16]
        obs = Observation("load")
        # staged inside the target folder: the publishing rename never crosses file systems,
        # and readers skip '_'-prefixed folders
        staged = staging or f"{target.rstrip('/')}/_staging_{load_id}"
        (typed.observe(obs, F.count(F.lit(1)).alias("rows"),
                       F.count_if(F.size("_rejected") > 0).alias("rejected"))
         .select(*RAW_COLUMNS[feed]).write.mode("overwrite").parquet(staged))
        m = obs.get
        if m["rejected"]:
            p, fs = _jvm_path(spark, staged)
            fs.delete(p, True)
            sample = (typed.where(F.size("_rejected") > 0)
                      .select("_source_file", "_rejected", "_raw_record").take(3))
            raise LoadError(f"{m['rejected']} of {m['rows']} rows did not convert; nothing loaded. "
                            f"First: {[tuple(r) for r in sample]}")
        _commit_staged(spark, staged, target, load_id)
        return LoadResult(feed, len(paths), int(m["rows"]), 0)
    typed = typed.persist(StorageLevel.MEMORY_AND_DISK)   # parsed once for both outputs
    try:
        import uuid
        load_id = load_id or uuid.uuid4().hex[:16]

        def publish(df: DataFrame, path: str) -> None:
            # partition load_id=<id>: re-running the same load replaces its rows
            (df.withColumn("load_id", F.lit(load_id)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("load_id").parquet(path))

        publish(good_rows(typed, feed), target)
        if quarantine:
            publish(bad_rows(typed), quarantine)
        stats = typed.agg(F.count_if(F.size("_rejected") == 0).alias("good"),
                          F.count_if(F.size("_rejected") > 0).alias("bad")).first()
        return LoadResult(feed, len(paths), int(stats["good"] or 0), int(stats["bad"] or 0))
    finally:
        typed.unpersist()


def file_inventory(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Staged files (path, modification time, size); content is never read."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
          .select("path", "modificationTime", "length"))
    if pattern:
        df = df.where(F.col("path").rlike("^" + pattern + "$"))
    return df


def write_csv(df: DataFrame, path: str, *, header_case: str = "upper", column_order: list[str] | None = None,
              timestamp_format: str = S.TIMESTAMP_FORMAT) -> None:
    """Write ``df`` in the landing-file format (used to derive fixture drops from tables)."""
    cols = column_order or df.columns
    out = df.select(*[F.col(c).alias(c.upper() if header_case == "upper" else c.lower()) for c in cols])
    (out.write.mode("overwrite")
     .option("header", "true").option("sep", ",").option("nullValue", "").option("emptyValue", "")
     .option("timestampNTZFormat", timestamp_format).option("timestampFormat", timestamp_format)
     .csv(path))


def write_named_csv(df: DataFrame, directory: str, prefix: str, *, file_name: str = "{prefix}_{n}.csv", **kw) -> list[str]:
    """Write ``df`` as landing files ``<directory>/<file_name>`` (header in each).

    One file per partition of ``df``, as its input was split: nothing is shuffled.  They are
    written to a hidden staging folder, then renamed into place.
    """
    staging = f"{directory}/_staging_{prefix}"
    write_csv(df, staging, **kw)
    src, fs = _jvm_path(df.sparkSession, staging)
    jvm = df.sparkSession.sparkContext._jvm
    names = []
    parts = sorted((st.getPath() for st in fs.listStatus(src) if st.getPath().getName().startswith("part-")),
                   key=lambda p: p.getName())
    for i, p in enumerate(parts):
        dst = jvm.org.apache.hadoop.fs.Path(directory, file_name.format(prefix=prefix, n=i))
        fs.mkdirs(dst.getParent())
        if not fs.rename(p, dst):
            raise OSError(f"could not publish {dst.toString()}")
        names.append(dst.toString())
    fs.delete(src, True)
    return names


INITIAL_PATTERNS = {"claims": CLAIMS_INITIAL_PATTERN, "customers": CUSTOMER_INITIAL_PATTERN}
