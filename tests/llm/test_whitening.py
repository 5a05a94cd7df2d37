import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from riskpipe.llm import whitening as W

from .conftest import run


def plain(rows):
    """{dimension: (ids, whole numbers, covariance by exact integers)} of the rows that take part."""
    by = {}
    for r in rows:
        e = r["embedding"]
        if e and all(c is not None and math.isfinite(c) for c in e):
            by.setdefault(len(e), []).append((r["vec_id"], [math.floor(64 * float(c)) + 1_000_000 for c in e]))
    out = {}
    for d, pairs in by.items():
        x = np.array([p[1] for p in pairs], object)
        n, s = len(x), x.sum(axis=0)
        out[d] = [p[0] for p in pairs], x, ((x * n - s).T @ (x * n - s) / n ** 3).astype(float)
    return out


def check(got, rows):
    want = plain(rows)
    seen = 0
    for d, (ids, x, v) in want.items():
        n, s = len(x), x.sum(axis=0)
        deviation = sorted(int(((x[i] * n - s) ** 2).sum()) for i in range(n))
        e = np.linalg.eigvalsh(v)[::-1]
        k = sum(e[:32] > 1e-11 * e[0])
        mine = [r for r in got if r["n"] == n]
        seen += len(mine)
        assert len(mine) == n * k
        by = {}
        for r in mine:
            by.setdefault(r["component"], []).append(r)
            assert abs(r["explained"] - e[r["component"] - 1] / np.trace(v)) < 1e-9 and 0 <= r["identity_error"] < 1e-6
        for c in range(1, k + 1):
            assert sorted(r["deviation"] for r in by[c]) == deviation
            assert sorted((r["vec_id"] is None, r["vec_id"] or 0) for r in by[c]) == sorted((i is None, i or 0) for i in ids)
        unique = [i for i in ids if i is not None and ids.count(i) == 1]
        at = {i: j for j, i in enumerate(ids)}
        w = np.array([[{(r["vec_id"], r["component"]): r["whitened"] for r in mine}[i, c] for c in range(1, k + 1)] for i in unique]) if n < 30 else None
        if w is None:
            table = {(r["vec_id"], r["component"]): r["whitened"] for r in mine}
            w = np.array([[table[i, c] for c in range(1, k + 1)] for i in unique])
        centred = np.array([[float(a) for a in x[at[i]] * n - s] for i in unique]) / n
        # whitened columns are centred @ (eigenvector / root of eigenvalue): the same Gram matrix of distances in the kept space
        vec = np.linalg.eigh(v)[1][:, ::-1][:, :k] / np.sqrt(e[:k])
        expected = centred @ vec
        gaps = np.abs(np.diff(e[:k + 1] if len(e) > k else e[:k])) / e[0]
        for c in range(k):
            if all(g > 1e-6 for g in gaps[max(c - 1, 0):c + 1]):
                assert min(np.abs(w[:, c] - expected[:, c]).max(), np.abs(w[:, c] + expected[:, c]).max()) < 1e-6
    assert seen == len(got)


def test_cross_products_are_exact():
    rng = np.random.default_rng(3)
    for high in (1, 2, 7, 130, 2 ** 20, 2 ** 61):
        for rows in (1, 63, 64, 65, 300):
            x = rng.integers(0, high, (rows, 5), dtype=np.int64)
            got = W.cross_products(x.astype(np.uint64), [int(c).bit_length() for c in x.max(axis=0)])
            y = x.astype(object)
            assert (got == y.T @ y).all()


def test_against_a_plain_version(spark):
    rows = pq.read_table("/root/testdata/sf0.01/embeddings.parquet").to_pylist()
    check(run(spark, "op13_bit_sliced_whitening", "/root/testdata/sf0.01"), rows)


def test_odd_rows_repeats_and_dimensions(spark, tables):
    rows = pq.read_table(f"{tables}/embeddings.parquet").to_pylist()
    check([r for r in run(spark, "op13_bit_sliced_whitening", tables)], rows)


def test_few_equal_and_huge_vectors(spark):
    of = lambda rows: [r.asDict() for r in W.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int")).collect()]
    assert of([(1, [0.5, 2.0], 1)]) == [] and of([(i, [0.5, 2.0], 1) for i in range(5)]) == [] and of([(1, [], 1)]) == []
    rows = [(i, [1e4 * (i % 5), 3.5 * (i % 3), -i / 7], 1) for i in range(20)]
    check(of(rows), [{"vec_id": r[0], "embedding": r[1]} for r in rows])
    held = of([(i, [1e300 * (-1) ** i, float(i)], 1) for i in range(8)])
    assert {r["deviation"] for r in held} == {None} and len(held) == 8


def test_chunks_do_not_matter(spark, monkeypatch):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("*", F.lit(1).alias("n"), F.lit(2).alias("x"))
    a = {(r.vec_id, r.component): r for r in W.whitened(vectors).collect()}
    b = {(r.vec_id, r.component): r for r in W.whitened(vectors.repartition(5)).collect()}
    assert a.keys() == b.keys() and all(abs(a[k].whitened - b[k].whitened) < 1e-9 and a[k].deviation == b[k].deviation for k in a)


@pytest.mark.parametrize("components", [1, 3])
def test_number_of_components(spark, components):
    out = W.whitened(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet"), components)
    assert out.agg(F.max("component")).first()[0] == components
