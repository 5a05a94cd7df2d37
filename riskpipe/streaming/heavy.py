"""Heavy join keys, kept at ingest.

The join of customers and claims has to know which policies have very many claims before it
runs.  Looking for them in the claims costs a scan of the key column for each join, so
every load of a raw table keeps a mergeable frequency sketch of its keys instead, one for each
bucket, beside the load (Spark's ``approx_top_k_accumulate``).  A sketch counts with the
commit of its load, and a compaction makes new ones from the rows that it writes, so
what was retracted by a load by force is forgotten then.

``hot_keys`` merges the sketches of the loads that count, by bucket (``approx_top_k_combine``), and
lists the keys that are frequent in the merged ones.  It reads the sketches only, at most
``TRACKED`` keys for each bucket and load.  Every policy lies in one bucket, so a bucket's
sketch knows all of its claims, however they are spread over the loads.  A sketch lists
no key that it has not met, and every key with more than about ``7 / TRACKED`` of its bucket's
rows; between the two a key may be missed, which costs speed and never rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpipe.operators.integrate import SkewConfig
from riskpipe.session import scratch_path
from riskpipe.streaming.commits import State, _names, remove

#: Keys that a sketch keeps track of; about 30 bytes each.
TRACKED = 4096
# what the sketch function returns
SCHEMA = "bucket int, keys struct<sketch: binary, maxItemsTracked: int, itemDataType: string, itemDataTypeDDL: string>, load string"


def keep(rows: DataFrame, path: str, load: str, key: str = "policy_number") -> None:
    """The sketches of one load (``rows`` with ``bucket``), written before its commit; a replay replaces them.

    NULL keys join nothing and are left out."""
    sketches = (rows.where(F.col(key).isNotNull()).groupBy("bucket")
                .agg(F.expr(f"approx_top_k_accumulate({key}, {TRACKED})").alias("keys")))
    sketches.write.mode("overwrite").parquet(f"{path}/load={load}")


def forget(spark: SparkSession, path: str, loads: set[str]) -> None:
    remove(spark, path, loads, 0)


def merged(spark: SparkSession, path: str, state: State, buckets: list[int] | None = None) -> DataFrame | None:
    """(key, claims): estimated counts of the frequent keys in the loads that count, of some buckets only if given.

    None where a load has no sketches (written before they were kept)."""
    if not state.live <= {n[5:] for n in _names(spark, path) if n.startswith("load=")}:
        return None
    kept = spark.read.schema(SCHEMA).option("basePath", path).parquet(*[f"{path}/load={x}" for x in sorted(state.live)])
    if buckets is not None:
        kept = kept.where(F.col("bucket").isin(buckets))
    return (kept.groupBy("bucket").agg(F.expr(f"approx_top_k_combine(keys, {TRACKED})").alias("keys"))
            .selectExpr(f"inline(approx_top_k_estimate(keys, {TRACKED}))").selectExpr("item AS key", "`count` AS claims"))


def hot_keys(spark: SparkSession, path: str, state: State, cfg: SkewConfig = SkewConfig(), buckets: list[int] | None = None):
    """What ``integrate`` takes as ``hot``: a stored table (_hot_key, _n_salts), ``[]`` for none to split,
    or None to look in the claims themselves, where a load has no sketches."""
    if cfg.mode == "off" or not state.live:
        return []
    found = merged(spark, path, state, buckets)
    if found is None:
        return None
    hot = found.where(F.col("claims") >= 2 * cfg.rows_per_task).select(
        F.col("key").alias("_hot_key"), F.greatest(F.lit(2), F.ceil(F.col("claims") / cfg.rows_per_task)).cast("int").alias("_n_salts"))
    stored = scratch_path(spark, "hot_keys")
    hot.write.parquet(stored)
    return spark.read.schema(hot.schema).parquet(stored)


def certain(state: State) -> bool:
    """Whether each key that the sketches list has claims now: no load holds rows that count no longer."""
    return not state.dropped
