"""Operator 9: quality classifier, naive Bayes with support vectors.

A text's features are indicators of its n-grams: byte 3-grams as written, words and
word pairs in lower case, and n-grams over the text's pattern of repetition (whether a
word equals the one before it, or its pair with the one before it has occurred), as
shares in tenths.  They are hashed to a fixed number of buckets.  Each indicator is
scaled by its class log-count ratio

    r = log((p + a) / |p + a|) - log((q + a) / |q + a|)

from the counts of all training texts, and a linear hinge-loss model is fitted on the
scaled indicators by dual coordinate descent.  As usual for this model its weights are
interpolated with their mean magnitude.  Margins become probabilities by a logistic
curve fitted on training texts that the descent has not seen.

Counts are over all labelled training rows (at most ``labelled.MAX_LABELLED``).  The
descent uses at most ``MAX_VECTORS`` of them (a documented parameter; one in four of the
rows that fit into twice the bound is kept for the curve).  The model is one number per
bucket, so what is sent to the tasks has a fixed size (1 MB).

Defined results: a null or empty text has no n-grams and gets the value of the intercept;
without labels of both kinds every text gets the share of label 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpipe.llm import common, labelled, wordhash

BITS = 18
SIZE = 1 << BITS
SMOOTHING = 1.0
MAX_VECTORS = 6_000
C, EPOCHS, BLEND = 0.1, 12, 0.25


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of the texts' n-grams, text after text, and the end of each text's."""
    w = wordhash.words(texts)
    h = w.hash
    same_doc = w.doc[1:] == w.doc[:-1]
    pair = wordhash.mix(h[:-1] * np.uint64(3) + h[1:])[same_doc]
    pair_doc = w.doc[1:][same_doc]
    raw = np.frombuffer(b"\n".join(texts), np.uint8).astype(np.uint64)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), sizes)[:len(raw)]
    left = (np.cumsum(sizes) - 1)[owner] - np.arange(len(raw))  # bytes from here to the end of the text
    inside = np.flatnonzero(left >= 3)
    gram = raw[inside] << np.uint64(16) | raw[inside + 1] << np.uint64(8) | raw[inside + 2]
    n = w.per_doc()
    stutter = np.bincount(w.doc[1:][same_doc & (h[1:] == h[:-1])], minlength=len(texts))
    order = np.lexsort((pair, pair_doc))
    again = (pair[order][1:] == pair[order][:-1]) & (pair_doc[order][1:] == pair_doc[order][:-1])
    repeated = np.bincount(pair_doc[order][1:][again], minlength=len(texts))
    tenths = [np.where(n > 0, 10 * x // np.maximum(n, 1), 0) for x in (stutter, repeated)]
    docs = np.arange(len(texts))
    parts = [
        (docs[n > 0], wordhash.mix(np.uint64(1 << 60) + t[n > 0].astype(np.uint64) + np.uint64(100 * k))) for k, t in enumerate(tenths)]
    parts += [(w.doc, wordhash.mix(h + np.uint64(1))), (pair_doc, wordhash.mix(pair + np.uint64(2))),
              (owner[inside], wordhash.mix(gram + np.uint64(1 << 58)))]
    key = np.concatenate([(d.astype(np.uint64) << np.uint64(BITS)) | (x >> np.uint64(64 - BITS)) for d, x in parts])
    key = np.unique(key)
    ends = np.cumsum(np.bincount((key >> np.uint64(BITS)).astype(np.int64), minlength=len(texts)))
    return (key & np.uint64(SIZE - 1)).astype(np.int64), ends


def descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, c: float = C, epochs: int = EPOCHS, seed: int = 0) -> np.ndarray:
    """Weights of the hinge-loss model over ratio-scaled indicators, by dual coordinate descent; the last is the intercept."""
    w = np.zeros(len(ratio) + 1)
    alpha = np.zeros(len(rows))
    x = [ratio[r].astype(np.float32) for r in rows]
    norm = np.array([v @ v + 1.0 for v in x])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(len(rows)):
            r, v, s = rows[i], x[i], y[i]
            g = s * (w[r] @ v + w[-1]) - 1
            new = min(max(alpha[i] - g / norm[i], 0.0), c)
            if (d := new - alpha[i]):
                alpha[i] = new
                w[r] += d * s * v
                w[-1] += d * s
                most = max(most, abs(d))
        if most < 1e-4 * c:
            break
    return w


@dataclass
class Model:
    weight: np.ndarray  # by bucket, ratio included
    intercept: float
    curve: tuple[float, float]

    def margins(self, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(self.weight[at], dtype=np.float64)])
        return sums[ends] - sums[np.concatenate([[0], ends[:-1]])] + self.intercept


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = np.zeros((2, SIZE), np.int64)
    for batch in batches:
        for rows, texts in wordhash.chunks(batch):
            at, ends = features(texts)
            good = np.repeat(rows["label"].to_numpy() == 1, np.diff(ends, prepend=0))
            found[1] += np.bincount(at[good], minlength=SIZE)
            found[0] += np.bincount(at[~good], minlength=SIZE)
    at = np.flatnonzero(found.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(found[1][at]), pa.array(found[0][at])], names=["bucket", "good", "bad"])


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in wordhash.chunks(batch):
            at, ends = features(texts)
            yield pa.RecordBatch.from_arrays(
                [rows["doc_id"].cast(pa.int64()), rows["label"].cast(pa.int32()),
                 pa.array([x.astype("<i4").tobytes() for x in np.split(at, ends[:-1])], pa.binary())], names=["doc_id", "label", "buckets"])


def fit(train: DataFrame) -> Model:
    """The model of labelled texts (doc_id, text, label)."""
    counts = train.mapInArrow(_count, "bucket int, good long, bad long").groupBy("bucket").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    got = counts.toArrow()  # at most the number of buckets
    p, q = np.full(SIZE, SMOOTHING), np.full(SIZE, SMOOTHING)
    at = got["bucket"].to_numpy()
    p[at] += got["good"].to_numpy()
    q[at] += got["bad"].to_numpy()
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    # a bounded choice of training rows, by another hash than chose the labels
    order = F.xxhash64("doc_id", F.lit("vectors"))
    share = train.groupBy("label").count().toArrow().to_pydict()
    n = sum(share["count"])
    kept = train if n <= MAX_VECTORS else train.where(F.pmod(order, F.lit(1 << 20)) < int((1 << 20) * MAX_VECTORS / n))
    rows = kept.mapInArrow(_vectors, "doc_id long, label int, buckets binary").toArrow()
    ids = np.argsort(rows["doc_id"].to_numpy(), kind="stable")
    vectors = [np.frombuffer(rows["buckets"][int(i)].as_py(), "<i4") for i in ids]
    label = rows["label"].to_numpy()[ids]
    if len(set(share["label"])) < 2:
        return Model(np.zeros(SIZE, np.float32), 0.0, labelled.platt(np.zeros(len(label)), label))
    y = np.where(label == 1, 1.0, -1.0)
    hold = np.arange(len(y)) % 4 == 3
    w = descend([v for v, h in zip(vectors, hold, strict=True) if not h], y[~hold], ratio)
    weight = ((1 - BLEND) * np.abs(w[:-1]).mean() + BLEND * w[:-1]) * ratio
    model = Model(weight.astype(np.float32), float(w[-1] * BLEND), (0.0, 0.0))
    held = [v for v, h in zip(vectors, hold, strict=True) if h]
    ends = np.cumsum([len(v) for v in held])
    if len(held):
        model.curve = labelled.platt(model.margins(np.concatenate(held), ends), label[hold])
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for rows, texts in wordhash.chunks(batch):
                a, b = m.curve
                yield pa.RecordBatch.from_arrays([rows["doc_id"].cast(pa.int64()), pa.array(labelled.sigmoid(a * m.margins(*features(texts)) + b))],
                                                 names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def op9_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    held_out = labelled.crc(F.col("doc_id")) % 5 == 0
    model = fit(labelled.training_docs(docs, labelled.read_labels(spark, sf_dir), "quality", held_out))
    return scored(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= labelled.PREDICT_AT, 1).otherwise(0).alias("predicted"))
