"""What the two classifiers share: labelled rows, hashed counts, and a calibrated score."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most labelled rows that a model is fitted on (a documented parameter).  Up to it, all are used;
#: beyond it, those whose ids have the smallest hashes.  It bounds what is broadcast: 16 bytes a row.
MAX_LABELLED = 100_000
#: Fixed by the contract.
PREDICT_AT = 0.3


def crc(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def training_docs(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, limit: int = MAX_LABELLED) -> DataFrame:
    """The texts of labelled rows outside the held-out fold, as (doc_id, text, label).

    Labels without a document or without a value teach nothing; of several for one document the largest
    counts.  At most ``limit`` labels are chosen before the join, so their broadcast has a fixed bound and
    the documents are filtered where they are read."""
    chosen = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out)
              .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def read_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def platt(x: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """a, b of the probability sigmoid(a * x + b) of label 1, by Newton's method on smoothed targets; a is not negative."""
    pos, neg = int((y == 1).sum()), int((y != 1).sum())
    if not pos or not neg:
        return 0.0, float(np.log((pos + 1) / (neg + 1)))
    scale = max(float(np.std(x)), 1e-9)
    z = x / scale
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 0.0, float(np.log((pos + 1) / (neg + 1)))

    def loss(a: float, b: float) -> float:
        m = a * z + b
        return float(np.sum(np.logaddexp(0, m) - t * m)) + 1e-6 * a * a

    now = loss(a, b)
    for _ in range(steps):
        p = sigmoid(a * z + b)
        g = np.array([np.sum((p - t) * z) + 2e-6 * a, np.sum(p - t)])
        w = p * (1 - p)
        h = np.array([[np.sum(w * z * z) + 2e-6, np.sum(w * z)], [np.sum(w * z), np.sum(w)]]) + 1e-9 * np.eye(2)
        d, rate = np.linalg.solve(h, g), 1.0
        while rate > 1e-6 and loss(a - rate * d[0], b - rate * d[1]) > now:
            rate /= 2
        a, b = a - rate * d[0], b - rate * d[1]
        if now - (now := loss(a, b)) < 1e-9:
            break
    if a < 0:
        return 0.0, float(np.log((pos + 1) / (neg + 1)))
    return a / scale, b
