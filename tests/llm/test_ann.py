import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from riskpipe.llm import ann as A

from .conftest import run


def usable(rows):
    """(id, vector) that take part, repeats once."""
    out = {}
    for r in rows:
        e = r["embedding"]
        if r["vec_id"] is None or e is None or len(e) != 64 or any(x is None or not math.isfinite(x) for x in e) or not any(e):
            continue
        out.setdefault((r["vec_id"], tuple(e)), None)
    return [i for i, _ in out], np.array([e for _, e in out], float)


def nearest(ids, x, i, k=20):
    s = (x * x[i]).sum(axis=1)
    order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
    return [(ids[j], s[j]) for j in order]


def compare(got, ids, x):
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append(r)
    hits = total = 0
    for i, q in enumerate(ids):
        if q % 20:
            assert q not in by
            continue
        mine, want = sorted(by[q], key=lambda r: r["rank"]), nearest(ids, x, i)
        assert [r["rank"] for r in mine] == list(range(1, len(want) + 1))
        assert [(-r["score"], r["vec_id"]) for r in mine] == sorted((-r["score"], r["vec_id"]) for r in mine)
        at = {v: j for j, v in enumerate(ids)}
        for r in mine:
            assert r["vec_id"] != q and abs(r["score"] - x[at[r["vec_id"]]] @ x[i]) < 1e-12 * max(1, abs(r["score"]))
        hits += len({r["vec_id"] for r in mine} & {v for v, _ in want})
        total += len(want)
    return hits / total


def test_recall_with_odd_rows(spark, tables):
    ids, x = usable(pq.read_table(f"{tables}/embeddings.parquet").to_pylist())
    assert compare(run(spark, "op6_cross_polytope", tables), ids, x) > 0.95


def test_recall_on_more_vectors(spark):
    ids, x = usable(pq.read_table("/root/testdata/sf0.1/embeddings.parquet").to_pylist())
    assert compare(run(spark, "op6_cross_polytope", "/root/testdata/sf0.1"), ids, x) > 0.93


def test_few_vectors_and_small_blocks_are_exact(spark):
    rng = np.random.default_rng(0)
    rows = [{"vec_id": i, "embedding": rng.normal(size=64).tolist()} for i in range(0, 75, 5)]
    df = A.usable(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    x = np.array([np.float32(r["embedding"]) for r in rows], float)
    got = [r.asDict() for r in A.search(df, F.col("vec_id") % 20 == 0, cfg=A.Config(tables=1, probes=1, block=4)).collect()]
    assert compare(got, [r["vec_id"] for r in rows], x) == 1.0


def test_each_dimension_is_searched(spark):
    """Rows of a rarer dimension are queries and candidates of their own."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8 if i % 3 else 5).tolist()) for i in range(0, 300, 5)] + [(1000, [2.0])]
    got = A.search(A.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), F.col("vec_id") % 20 == 0, cfg=A.Config(block=16)).collect()
    for dim in (8, 5):
        mine = [(i, v) for i, v in rows if len(v) == dim]
        ids = [i for i, _ in mine]
        assert compare([r.asDict() for r in got if r.query_id in ids], ids, np.array([v for _, v in mine])) > 0.95
    assert not [r for r in got if r.query_id == 1000]
    assert A.search(A.usable(spark.createDataFrame([], "vec_id long, embedding array<double>")), F.col("vec_id") % 20 == 0).collect() == []


def test_several_functions_probe_likely_keys():
    h = A.Hashes(64, A.Config(functions=2, axes=16, probes=8, tables=2))
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 64))
    for t in range(2):
        assert (h.probe(h.lifted(x, None), t)[:, 0] == h.index(h.lifted(x, np.linalg.norm(x, axis=1)), t)).all()


def test_hadamard_is_orthonormal():
    m = A.hadamard(np.eye(16))
    assert np.allclose(m @ m.T, np.eye(16))


@pytest.mark.parametrize("n", [1, 2])
def test_alone(spark, n):
    df = A.usable(spark.createDataFrame([(20 * i, [1.0, 0.0]) for i in range(n)], "vec_id long, embedding array<double>"))
    got = A.search(df, F.col("vec_id") % 20 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in sorted(got)] == ([] if n == 1 else [(0, 1, 20, 1.0), (20, 1, 0, 1.0)])
