"""Operator 11: hard negatives by threshold joins in the manner of L2AP.

An anchor's positives are the rows of its label with the largest inner products, its hard
negatives for a positive the rows of other labels whose inner product lies in a window below
the positive's.  Both are found by joins that return all pairs above a threshold:

* **inverted index.** The dimensions are ordered by energy, weakest first, and taken in strips of
  ``STRIP``.  A row's leading strips are left out of the index as long as their norm alone cannot
  reach the threshold; a strip's list holds the rows that do have it in the index.
* **partial scores.** Lists are accumulated from the strongest strip down.  After each, pairs whose
  partial score plus the norms that remain of both sides is below the threshold are dropped; once few are left
  they go on as a list of pairs.  Those that come through get the strips left out of the index.
* **thresholds.** For positives the threshold is the score of an anchor's last positive among
  the rows of one block, which its true positives reach as well.  For negatives it starts close
  below the positive and is lowered by ``levels``, each time only for windows that are not full,
  down to the window's end.  So nothing is approximate.

Rows are cut into blocks and anchors into chunks by hash; a cell (block, chunk) is one task's
work and returns at most the rows that an anchor's positives or windows can take, so no label or
anchor, however common, makes a large group, and pairs are not emitted.  The anchors are the
stated query set; cells keep their number and the replication of both sides in bounds.

Defined results: rows with a null label, a vector that is null or empty or holds a null or a
value that is not finite take no part.  Rows equal in id, label and vector are one row; rows
that share an id otherwise are rows of their own.  Rows without an id can be positives and
negatives (last among equal scores).  Vectors of different dimensions never meet.
Whole numbers beyond a long are held at its end.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from riskpipe.llm import common

#: Fixed by the contract.
SCALE, EVERY, LABELS, SHIFTED = 256, 100, 10, 7
STRIP = 16
ROWS, QUERIES = 16384, 128     # a tile of a cell: what is held as a matrix at a time
_LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Config:
    positives: int = 5
    negatives: int = 5
    least_percent: int = 80               # where a window ends, in hundredths of the positive's score
    levels: tuple[int, ...] = (95, 90, 85)   # thresholds before that
    block: int = 65536                    # rows of a cell
    chunk: int = 65536                    # anchors of a cell


# -- index and search ---------------------------------------------------------------------------


class Index:
    """Rows ``x`` (whole numbers as doubles), indexed for thresholds of at least ``tau`` times a query's norm."""

    def __init__(self, x: np.ndarray, tau: float):
        d = x.shape[1]
        self.order = np.argsort((x * x).sum(axis=0), kind="stable")
        self.edges = [*range(0, d, STRIP), d]
        self.strips = len(self.edges) - 1
        x = x[:, self.order]
        norms = self._norms(x)
        #: strips left out: the norm up to there, with room for rounding, is below the threshold
        first = np.maximum((norms * (1 + 1e-9) < tau).sum(axis=1) - 1, 0)
        self.at = np.argsort(first, kind="stable")
        self.x, self.norms, self.first = x[self.at], norms[self.at], first[self.at]
        self.listed = np.searchsorted(self.first, np.arange(self.strips), side="right")  # rows of each strip's list

    def _norms(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), self.strips + 1))
        for s in range(self.strips):
            part = x[:, self.edges[s]:self.edges[s + 1]]
            out[:, s + 1] = out[:, s] + (part * part).sum(axis=1)
        return np.sqrt(out)

    def above(self, q: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of all pairs whose inner product is at least ``least`` of the query."""
        q = q[:, self.order]
        qn = self._norms(q)
        low = least - 1e-6 * np.maximum(1, np.abs(least))       # room for the rounding of norms
        low[~np.isfinite(least)] = -np.inf
        part = np.zeros((len(q), len(self.x)))
        a = r = score = None
        for s in reversed(range(self.strips)):
            here = slice(self.edges[s], self.edges[s + 1])
            if a is None:
                n = self.listed[s]
                part[:, :n] += q[:, here] @ self.x[:n, here].T
                left = np.maximum(self.first, s)                # where a row's score is complete from
                alive = part + qn[:, left] * self.norms[np.arange(len(left)), left] >= low[:, None]
                alive &= self.first < self.strips               # no strip of it reaches the threshold
                if s == 0 or alive.mean() < 1 / 8:
                    a, r = np.nonzero(alive)
                    score = part[a, r]
            else:
                more = self.first[r] <= s
                score[more] += np.einsum("ij,ij->i", q[a[more], here], self.x[r[more], here])
                left = np.maximum(self.first[r], s)
                alive = score + qn[a, left] * self.norms[r, left] >= low[a]
                a, r, score = a[alive], r[alive], score[alive]
        for f in range(1, self.strips):
            rest = np.flatnonzero(self.first[r] == f)
            score[rest] += np.einsum("ij,ij->i", q[a[rest], :self.edges[f]], self.x[r[rest], :self.edges[f]])
        good = score >= least[a]
        return a[good], self.at[r[good]], score[good]


def pairs_above(x: np.ndarray, q: np.ndarray, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, row, score) of all pairs whose inner product reaches ``least`` of the query, tile by tile.

    ``x`` and ``q`` are whole numbers (longs); scores are exact."""
    if not len(x) or not len(q):
        return
    reach = max(int(abs(x.max())), int(abs(x.min())), 1) * max(int(abs(q.max())), int(abs(q.min())), 1) * x.shape[1]
    if reach >= 1 << 52:
        for i in range(len(q)):      # numbers that doubles do not hold: Python's own, row by row
            s = np.clip(x.astype(object) @ q[i].astype(object), -_LONG, _LONG).astype(np.int64)
            r = np.flatnonzero(s >= least[i])
            yield np.full(len(r), i), r, s[r]
        return
    x, q = x.astype(np.float64), q.astype(np.float64)
    norm = np.maximum(np.sqrt((q * q).sum(axis=1)), 1e-300)
    tau = least / norm
    by = np.argsort(-tau, kind="stable")         # queries of like thresholds share an index
    for i in range(0, len(q), QUERIES):
        some = by[i:i + QUERIES]
        for j in range(0, len(x), ROWS):
            a, r, score = Index(x[j:j + ROWS], tau[some].min()).above(q[some], least[some].astype(np.float64))
            yield some[a], r + j, np.rint(score).astype(np.int64)


def best(group: np.ndarray, score: np.ndarray, ids: np.ndarray, none: np.ndarray, most: int) -> np.ndarray:
    """Positions of the ``most`` best of each group: highest score, then smallest id, then without one."""
    order = np.lexsort((ids, none, -score, group))
    g = group[order]
    start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
    rank = np.arange(len(g)) - np.repeat(start, np.diff(np.r_[start, len(g)]))
    return order[rank < most]


class _Side:
    """One side of a cell as arrays; vectors by dimension."""

    def __init__(self, table: pa.Table):
        column = lambda name, missing=0: table[name].combine_chunks().fill_null(missing).to_numpy(zero_copy_only=False)
        self.row, self.label, self.ids = column("row"), column("label"), column("vec_id")
        self.none = table["vec_id"].combine_chunks().is_null().to_numpy(zero_copy_only=False)
        x = table["x"].combine_chunks()
        offsets = x.offsets.to_numpy()
        self.size, self._start, self._flat = np.diff(offsets), offsets[:-1] - offsets[0], x.flatten().to_numpy()

    def vectors(self, rows: np.ndarray) -> np.ndarray:
        return self._flat[self._start[rows][:, None] + np.arange(self.size[rows[0]] if len(rows) else 0)]


def _positives(most: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        x, q = _Side(rows), _Side(anchors)
        least = anchors["least"].combine_chunks().cast(pa.float64()).fill_null(-np.inf).to_numpy(zero_copy_only=False)
        found = []
        for d, label in {*zip(q.size.tolist(), q.label.tolist(), strict=True)}:
            mine, theirs = np.flatnonzero((q.size == d) & (q.label == label)), np.flatnonzero((x.size == d) & (x.label == label))
            for a, r, s in pairs_above(x.vectors(theirs), q.vectors(mine), least[mine]):
                a, r = mine[a], theirs[r]
                other = q.row[a] != x.row[r]
                a, r, s = a[other], r[other], s[other]
                keep = best(a, s, x.ids[r], x.none[r], most)
                found.append((a[keep], r[keep], s[keep]))
        a, r, s = (np.concatenate(c).astype(np.int64) if found else np.zeros(0, np.int64) for c in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 3
        keep = best(a, s, x.ids[r], x.none[r], most)
        a, r, s = a[keep], r[keep], s[keep]
        return pa.table({"row": pa.array(q.row[a], pa.int64()), "vec_id": pa.array(x.ids[r], pa.int64(), mask=x.none[r]), "score": pa.array(s, pa.int64())})
    return run


def _negatives(most: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        x, q = _Side(rows), _Side(anchors)
        windows = anchors["windows"].to_pylist()
        slots = max(map(len, windows), default=0)
        low, high = np.full((len(windows), slots), _LONG), np.full((len(windows), slots), -_LONG)
        name = np.zeros((len(windows), slots), np.int32)
        for i, ws in enumerate(windows):
            for k, w in enumerate(ws):
                name[i, k], low[i, k], high[i, k] = w["slot"], w["low"], w["high"]
        found = []
        for d in np.unique(q.size):
            mine, theirs = np.flatnonzero(q.size == d), np.flatnonzero(x.size == d)
            for a, r, s in pairs_above(x.vectors(theirs), q.vectors(mine), low[mine].min(axis=1)):
                a, r = mine[a], theirs[r]
                other = q.label[a] != x.label[r]
                a, r, s = a[other], r[other], s[other]
                for k in range(slots):
                    inside = np.flatnonzero((s >= low[a, k]) & (s <= high[a, k]))
                    keep = inside[best(a[inside], s[inside], x.ids[r[inside]], x.none[r[inside]], most)]
                    found.append((a[keep], np.full(len(keep), k), r[keep], s[keep]))
        a, k, r, s = (np.concatenate(c).astype(np.int64) for c in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 4
        keep = best(a * max(slots, 1) + k, s, x.ids[r], x.none[r], most)
        a, k, r, s = a[keep], k[keep], r[keep], s[keep]
        return pa.table({"row": pa.array(q.row[a], pa.int64()), "slot": pa.array(name[a, k], pa.int32()),
                         "vec_id": pa.array(x.ids[r], pa.int64(), mask=x.none[r]), "score": pa.array(s, pa.int64())})
    return run


# -- the joins ----------------------------------------------------------------------------------


def whole(vectors: DataFrame, label: Column | None = None, vec_id: str = "vec_id", embedding: str = "embedding", label_name: str = "label") -> DataFrame:
    """vec_id, label, x (longs) and row (a key) of the rows that take part, equal ones once."""
    v, i = F.col(f"`{embedding}`").cast("array<double>"), F.col(f"`{vec_id}`").cast("long")
    lab = F.col(f"`{label_name}`").cast("long") if label is None else label
    df = vectors.select(i.alias("vec_id"), lab.alias("label"), v.alias("v")).where("label IS NOT NULL AND size(v) > 0")
    df = df.where(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    df = df.select("vec_id", "label", F.transform("v", lambda c: F.greatest(F.floor(c * float(SCALE)), F.lit(-_LONG))).alias("x")).distinct()
    return df.withColumn("row", F.xxhash64("vec_id", "label", "x"))


def _cells(rows: DataFrame, anchors: DataFrame, blocks: int, chunks: int, run, schema: str) -> DataFrame:
    """``run`` over each cell of a block of rows and a chunk of anchors."""
    rows = rows.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).withColumnRenamed("block", "b")
    anchors = anchors.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("c", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(chunks)).cast("int"))
    anchors = anchors.toDF(*anchors.columns)   # columns of its own, also where both sides are the same table
    return rows.groupBy("b", "c").cogroup(anchors.groupBy("b", "c")).applyInArrow(run, schema)


def _at_percent(score: Column, percent: int) -> Column:
    """The least whole number n with 100 n >= percent * score (score not negative), without overflow."""
    whole_part, rest = F.floor(score / F.lit(100).cast("decimal(3,0)")).cast("long"), F.pmod(score, F.lit(100))
    return whole_part * percent + F.floor((rest * percent + 99) / 100).cast("long")


def _first(found: DataFrame, most: int, *key: str) -> DataFrame:
    by = Window.partitionBy(*key).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(by).cast("int")).where(F.col("rank") <= most)


def hard_negatives(rows: DataFrame, is_anchor: Column, cfg: Config = Config()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows of ``whole`` and those that are anchors."""
    spark = rows.sparkSession
    rows = common.stored(rows, "vectors")
    n, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if(is_anchor)).first()
    blocks = max(-(-n // cfg.block), int(spark.conf.get("spark.sql.shuffle.partitions")))
    chunks = max(-(-n_anchors // cfg.chunk), 1)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    anchors = rows.where(is_anchor).drop("block")
    pair = "row long, vec_id long, score long"

    # the score of the last positive within one block is a threshold that the true positives reach
    trial = _cells(rows.where("block = 0").withColumn("block", F.lit(0)), anchors.withColumn("least", F.lit(None).cast("long")), 1, chunks, _positives(cfg.positives), pair)
    trial = trial.groupBy("row").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") >= cfg.positives).select("row", "least")
    found = _cells(rows, anchors.join(trial, "row", "left"), blocks, chunks, _positives(cfg.positives), pair)
    windows = _first(found, cfg.positives, "row").where("score >= 0").select(
        "row", F.col("rank").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    windows = common.stored(windows, "windows")

    hits, is_open, high = None, windows, F.col("positive_score")
    for percent in (*[p for p in cfg.levels if p > cfg.least_percent], cfg.least_percent):
        low = _at_percent(F.col("positive_score"), percent)
        each = is_open.groupBy("row").agg(F.collect_list(F.struct("slot", low.alias("low"), high.alias("high"))).alias("windows"))
        new = common.stored(_cells(rows, anchors.join(each, "row"), blocks, chunks, _negatives(cfg.negatives), "row long, slot int, vec_id long, score long"), "negatives")
        hits = new if hits is None else hits.union(new)
        full = hits.groupBy("row", "slot").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= cfg.negatives)
        is_open, high = common.stored(windows.join(full, ["row", "slot"], "left_anti"), "open"), low - 1
        if is_open.isEmpty():
            break
    out = _first(hits, cfg.negatives, "row", "slot").join(windows, ["row", "slot"]).join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
    return out.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op11_l2ap_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label, vec_id = F.col("label").cast("long"), F.col("vec_id").cast("long")
    shifted = F.when(vec_id % SHIFTED == 0, (label + 1) % LABELS).otherwise(label)
    return hard_negatives(whole(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), shifted), F.col("vec_id") % EVERY == 0)


#: The same by a plain join of the anchors with all rows.
ORACLE_SQL = f"""
WITH r AS (SELECT row_number() OVER () AS k, * FROM (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % {SHIFTED} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
         list_transform(embedding, lambda c: floor({SCALE} * CAST(c AS DOUBLE))) AS x
  FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)),
s AS (SELECT a.k AS ak, a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id, CAST(list_dot_product(a.x, r.x) AS BIGINT) AS score
      FROM r a JOIN r ON a.k <> r.k AND len(a.x) = len(r.x) WHERE a.vec_id % {EVERY} = 0),
p AS (SELECT ak, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY ak ORDER BY score DESC, vec_id NULLS LAST) AS slot
      FROM s WHERE same QUALIFY slot <= {Config.positives})
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY s.ak, slot ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM s JOIN p ON s.ak = p.ak
WHERE NOT same AND {Config.least_percent} * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= {Config.negatives}"""
