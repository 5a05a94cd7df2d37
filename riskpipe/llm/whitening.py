"""Operator 13: whitening of embeddings from bit-sliced cross-products.

Each component c becomes the whole number floor(64 c) + 1,000,000.  The cross-products of
all pairs of dimensions are exact:

1. one pass gives the number of vectors and each dimension's least and greatest value and sum;
2. in each task the values, less their dimension's least, are cut into bit planes, and a plane
   is packed along the rows, 64 of them to a word.  The AND of two planes has as many ones as
   rows with both bits, so the cross-product of two dimensions is the sum of those counts times
   the planes' weights.  Tasks return sums for each pair of dimensions, which Spark adds;
3. the driver holds d x d whole numbers (d: the dimension), centres them as whole numbers,
   n * sum(xy) - sum(x) sum(y), and only then divides and calls ``eigh``;
4. a last pass over the whitened vectors measures how far their covariance is from the identity.

No step holds more rows than one chunk of ``CHUNK``.

Defined results: vectors that are null or hold a null or a value that is not finite take no
part; rows without an id do, and every repeat of a row counts.  Vectors of another dimension
are a fit of their own.  Whole numbers beyond 2^62 are held there.  ``deviation`` is null where
it does not fit a long.  Components whose eigenvalue is below ``SINGULAR`` of the largest are
not determined in double precision and are left out, so a single vector, or equal ones, give
no rows; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpipe.llm import common

#: Fixed by the contract.
SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 32
CHUNK = 16384
SINGULAR = 1e-11
_HELD = 1 << 62
_HALF = 62   # cross-products travel as two decimals, of this many bits and of the rest
_SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


@dataclass(frozen=True)
class Fit:
    """Estimates for the vectors of one dimension; ``sums`` are exact."""
    n: int
    sums: list[int]
    least: list[int]
    most: list[int]
    vectors: np.ndarray | None = None   # a column for each component, over the root of its eigenvalue
    explained: np.ndarray | None = None
    error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S as whole numbers; Python's where a long does not hold them."""
        reach = self.n * max([1, *map(abs, self.least), *map(abs, self.most)])
        kind = np.int64 if 2 * reach < 1 << 62 else object
        return x.astype(kind) * self.n - np.array(self.sums, dtype=kind)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred.astype(np.float64) / self.n) @ self.vectors

    def deviations(self, centred: np.ndarray) -> list[int | None]:
        most = max([0, *(int(abs(v)) for v in (centred.max(initial=0), centred.min(initial=0)))])
        if most * most * max(centred.shape[1], 1) >= 1 << 63:
            centred = centred.astype(object)
        return [int(v) if v < 1 << 63 else None for v in (centred * centred).sum(axis=1)]


# -- vectors ------------------------------------------------------------------------------------


def whole(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and x (longs) of the vectors that take part."""
    v = F.col(f"`{embedding}`").cast("array<double>")
    df = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), v.alias("v")).where("size(v) > 0")
    df = df.where(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    held = lambda c: F.greatest(F.least(F.floor(c * float(SCALE)), F.lit(_HELD)), F.lit(-_HELD)) + F.lit(OFFSET)
    return df.select("vec_id", F.transform("v", held).alias("x"))


def _by_dimension(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and whole numbers of the batch's vectors, one dimension after the other."""
    lists = batch["x"]
    size = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    start = np.cumsum(size) - size
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        yield rows, flat[start[rows][:, None] + np.arange(d)]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for _, x in _by_dimension(batch):
            for at in range(0, len(x), CHUNK):
                yield x[at:at + CHUNK]


def _range_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[int, list] = {}
    for x in _chunks(batches):
        n, low, high, total = seen.get(x.shape[1], (0, None, None, 0))
        low, high = (x.min(axis=0), x.max(axis=0)) if n == 0 else (np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0)))
        # halves of 31 bits: their sums over a chunk fit a long
        part = (x >> 31).sum(axis=0).astype(object) * (1 << 31) + (x & ((1 << 31) - 1)).sum(axis=0).astype(object)
        seen[x.shape[1]] = [n + len(x), low, high, total + part]
    for d, (n, low, high, total) in seen.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array(low, pa.int64()),
             pa.array(high, pa.int64()), pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))], names=["d", "i", "n", "low", "high", "total"])


# -- bit-sliced cross-products ------------------------------------------------------------------


def planes(x: np.ndarray, bits: list[int]) -> np.ndarray:
    """The bit planes of the columns of ``x`` (not negative, below 2^bits), packed along the rows into 64-bit words."""
    out = np.zeros((sum(bits), -(-len(x) // 64) * 8), np.uint8)
    row = 0
    for i, most in enumerate(bits):
        for b in range(most):
            packed = np.packbits(((x[:, i] >> b) & 1).astype(np.uint8))
            out[row, :len(packed)] = packed
            row += 1
    return out.view(np.uint64)


def cross_products(x: np.ndarray, bits: list[int]) -> np.ndarray:
    """Exact sums over the rows of all products of two columns, by AND and population count of their planes."""
    p = planes(x, bits)
    both = np.zeros((len(p), len(p)), np.int64)
    for k in range(len(p)):
        both[k, k:] = np.bitwise_count(p[k] & p[k:]).sum(axis=1, dtype=np.int64)
    both = both + np.triu(both, 1).T
    kind = np.int64 if 2 * max([0, *bits]) + len(x).bit_length() < 62 else object
    weights = np.zeros((len(bits), len(p)), kind)
    row = 0
    for i, most in enumerate(bits):
        for b in range(most):
            weights[i, row] = 1 << b
            row += 1
    return weights @ both.astype(kind) @ weights.T


def _product_rows(ranges: dict[int, Fit]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for x in _chunks(batches):
            fit = ranges[x.shape[1]]
            bits = [(high - low).bit_length() for low, high in zip(fit.least, fit.most, strict=True)]
            # a difference of two longs fits an unsigned word
            shifted = x.view(np.uint64) - np.array(fit.least, np.int64).view(np.uint64)
            total[x.shape[1]] = total.get(x.shape[1], 0) + cross_products(shifted, bits).astype(object)
        for d, c in total.items():
            i, j = np.triu_indices(d)
            values = [int(v) for v in c[i, j]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * len(i), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                 pa.array([Decimal(v >> _HALF) for v in values], pa.decimal128(38, 0)),
                 pa.array([Decimal(v & ((1 << _HALF) - 1)) for v in values], pa.decimal128(38, 0))], names=["d", "i", "j", "high", "low"])
    return run


def _error_rows(fits: dict[int, Fit]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for x in _chunks(batches):
            w = fits[x.shape[1]].whitened(fits[x.shape[1]].centred(x))
            total[x.shape[1]] = total.get(x.shape[1], 0) + w.T @ w
        for d, c in total.items():
            i, j = np.triu_indices(len(c))
            yield pa.RecordBatch.from_arrays([pa.array([d] * len(i), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(c[i, j])],
                                             names=["d", "i", "j", "total"])
    return run


# -- fit and transform --------------------------------------------------------------------------


def fit(x: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """For each dimension of the vectors ``x`` (from ``whole``) its estimates: d x d numbers reach the driver, no rows."""
    spread = (x.mapInArrow(_range_rows, "d int, i int, n long, low long, high long, total decimal(38,0)").groupBy("d", "i")
              .agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("total").cast("decimal(38,0)").alias("total")))
    by: dict[int, list] = {}
    for r in sorted(spread.collect(), key=lambda r: (r.d, r.i)):
        by.setdefault(r.d, []).append(r)
    ranges = {d: Fit(r[0].n, [int(c.total) for c in r], [c.low for c in r], [c.high for c in r]) for d, r in by.items()}
    if not ranges:
        return {}
    products = (x.mapInArrow(_product_rows(ranges), "d int, i int, j int, high decimal(38,0), low decimal(38,0)").groupBy("d", "i", "j")
                .agg(F.sum("high").cast("decimal(38,0)").alias("high"), F.sum("low").cast("decimal(38,0)").alias("low")))
    centred = {d: np.zeros((d, d), object) for d in ranges}
    for r in products.collect():
        f = ranges[r.d]
        si, sj = (f.sums[k] - f.n * f.least[k] for k in (r.i, r.j))
        centred[r.d][r.i, r.j] = centred[r.d][r.j, r.i] = f.n * ((int(r.high) << _HALF) + int(r.low)) - si * sj
    fits = {}
    for d, f in ranges.items():
        v = (centred[d] / f.n ** 2).astype(np.float64)   # whole numbers until here
        trace = int(np.trace(centred[d])) / f.n ** 2
        e, vec = np.linalg.eigh(v)
        e, vec = e[::-1][:components], vec[:, ::-1][:, :components]
        keep = e > SINGULAR * max(e[0], 0)
        e, vec = e[keep], vec[:, keep]
        # one sign for all: the largest entry is positive
        vec = vec * np.sign(vec[np.abs(vec).argmax(axis=0), np.arange(vec.shape[1])]) if len(e) else vec
        fits[d] = Fit(f.n, f.sums, f.least, f.most, vec / np.sqrt(e), e / trace if len(e) else e)
    errors = x.mapInArrow(_error_rows(fits), "d int, i int, j int, total double").groupBy("d", "i", "j").agg(F.sum("total").alias("total"))
    worst = dict.fromkeys(fits, 0.0)
    for r in errors.collect():
        worst[r.d] = max(worst[r.d], abs(r.total / fits[r.d].n - (r.i == r.j)))
    return {d: Fit(f.n, f.sums, f.least, f.most, f.vectors, f.explained, worst[d]) for d, f in fits.items()}


def _whitened_rows(fits: dict[int, Fit]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _by_dimension(batch):
                f = fits[x.shape[1]]
                ids = batch["vec_id"].take(pa.array(rows))
                for at in range(0, len(x), CHUNK):
                    centred = f.centred(x[at:at + CHUNK])
                    w = f.whitened(centred)
                    m, k = w.shape
                    each = pa.array(np.repeat(np.arange(m), k))
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(at, m).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, f.n)),
                         pa.array(f.deviations(centred), pa.int64()).take(each), pa.array(w.reshape(-1)), pa.array(np.tile(f.explained, m)),
                         pa.array(np.full(m * k, f.error))], names=[c.split()[0] for c in _SCHEMA.split(", ")])
    return run


def whitened(vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """A row for each vector that takes part and each of the first ``components`` of its fit."""
    x = common.stored(whole(vectors, vec_id, embedding), "whole")
    return x.mapInArrow(_whitened_rows(fit(x, components)), _SCHEMA)


def op13_bit_sliced_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
