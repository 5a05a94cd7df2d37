"""Session construction and shared scratch locations.

Scratch data (CSV drops, stream checkpoints, materialised levels) always lives
under the directory the cluster names in ``spark.checkpoint.dir`` so that every
executor sees it and a lost executor can be replaced without losing files.
Only when that setting is absent (unit tests, a laptop) do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings we rely on.  All are runtime SQL confs except the builder-only ones
# (master, driver memory, ui), so they can also be applied to an existing session.
SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # never let the planner broadcast a side whose size it only guesses
    # beyond 32 MB; explicit broadcasts in this package are size-bounded.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "riskpipe", extra_conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in SQL_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_sql_conf(spark)
    return spark


def cluster_settings(input_bytes: int, *, executors: int = 1000, cores_per_executor: int = 4,
                     split_bytes: int = 512 * 1024 * 1024, shuffled_share: float = 0.25,
                     shuffle_partition_bytes: int = 1024 * 1024 * 1024) -> dict[str, str]:
    """Sizing for a large cluster run (e.g. 100 TB over 1000 executors).

    * file splits of ``split_bytes``;
    * shuffle partitions sized by what is shuffled (``shuffled_share`` of the input: joins carry
      pruned columns, aggregates are combined before), about ``shuffle_partition_bytes`` each, which
      tasks may spill.  Blocks, one for each map task and partition, then stay large enough to fetch;
    * adaptive execution merges small partitions and splits skewed ones.
    """
    cores = executors * cores_per_executor
    shuffle = max(cores * 2, -(-int(input_bytes * shuffled_share) // shuffle_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(int(shuffle)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_partition_bytes // 4),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(shuffle_partition_bytes * 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def apply_cluster_settings(spark: SparkSession, input_bytes: int, **kw) -> None:
    for k, v in cluster_settings(input_bytes, **kw).items():
        spark.conf.set(k, v)


def apply_sql_conf(spark: SparkSession) -> None:
    for k, v in SQL_CONF.items():
        spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint directory of the session; create one only if unset."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # Unset: only happens in tests / local runs.
        root = tempfile.mkdtemp(prefix="riskpipe-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/riskpipe/{name}-{uuid.uuid4().hex[:12]}"


def local_fs_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python code can write files (tests, fixtures)."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path
