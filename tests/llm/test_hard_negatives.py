import math
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from riskpipe.llm import hard_negatives as H

from .conftest import run

COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def plain(rows, every=100, least=80):
    """The same by brute force, in whole numbers."""
    seen = {}
    for r in rows:
        e, i, label = r["embedding"], r["vec_id"], r["label"]
        if label is None or not e or any(c is None or not math.isfinite(c) for c in e):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        seen[i, label, tuple(math.floor(256 * float(c)) for c in e)] = None
    keys = list(seen)
    nothing = lambda i: (i is None, i or 0)
    out = Counter()
    for a in keys:
        if a[0] is None or a[0] % every:
            continue
        scored = [(sum(x * y for x, y in zip(a[2], k[2], strict=True)), k) for k in keys if k != a and len(k[2]) == len(a[2])]
        positives = sorted(((s, k[0]) for s, k in scored if k[1] == a[1]), key=lambda p: (-p[0], nothing(p[1])))[:5]
        for p, i in positives:
            negatives = sorted(((s, k[0]) for s, k in scored if k[1] != a[1] and least * p <= 100 * s <= 100 * p), key=lambda n: (-n[0], nothing(n[1])))[:5]
            out.update((a[0], i, rank, j, p, s) for rank, (s, j) in enumerate(negatives, 1))
    return out


def counted(rows):
    return Counter(tuple(r[c] for c in COLUMNS) for r in rows)


@pytest.mark.parametrize("least", [-np.inf, -5.0, 0.0, 40.0, 150.0, 1e4])
def test_pairs_above_are_all_pairs(least):
    rng = np.random.default_rng(5)
    for d in (1, 5, 16, 40, 64):
        x = (rng.normal(size=(300, d)) * rng.exponential(size=(300, 1)) * 10 * rng.exponential(size=d)).astype(np.int64)
        q = x[rng.integers(0, 300, 20)] + rng.integers(-2, 3, (20, d))
        low = np.full(20, least) + (rng.integers(0, 50, 20) if np.isfinite(least) else 0)
        got = {(int(a[i]), int(r[i])): int(s[i]) for a, r, s in H.pairs_above(x, q, low) for i in range(len(a))}
        want = q @ x.T
        assert got == {(i, j): int(want[i, j]) for i in range(20) for j in range(300) if want[i, j] >= low[i]}


def test_strips_are_left_out_of_the_index():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(500, 64)) * 30
    index = H.Index(x, 0.6 * np.linalg.norm(x, axis=1).mean())
    assert index.listed[0] < index.listed[1] <= 500


def test_numbers_beyond_doubles():
    x = np.array([[1 << 40, 3], [-(1 << 40), 1], [(1 << 40) + 1, 0]])
    q = np.array([[1 << 20, 1]])
    got = [(int(r[i]), int(s[i])) for a, r, s in H.pairs_above(x, q, np.array([0.0])) for i in range(len(a))]
    assert got == [(0, (1 << 60) + 3), (2, (1 << 60) + (1 << 20))]


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_against_brute_force(spark, folder):
    top = f"/root/testdata/{folder}"
    assert counted(run(spark, "op11_l2ap_negatives", top)) == plain(pq.read_table(f"{top}/embeddings.parquet").to_pylist())


def test_odd_rows_ties_and_repeats(spark, tables):
    want = plain(pq.read_table(f"{tables}/embeddings.parquet").to_pylist())
    assert want and counted(run(spark, "op11_l2ap_negatives", tables)) == want


def test_small_cells_many_anchors_and_one_level(spark):
    rng = np.random.default_rng(8)
    rows = [{"vec_id": i, "embedding": [float(c) for c in rng.normal(size=6 if i % 9 else 3) * (0.01 if i % 4 else 2)], "label": int(rng.integers(0, 3)), "row": 1, "b": 2} for i in range(300)]
    rows += [{"vec_id": 300 + i, "embedding": [0.0] * 6, "label": i % 2, "row": 1, "b": 2} for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, row int, b int")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("long")
    want = plain(rows, every=3)
    for cfg in (H.Config(block=50, chunk=7), H.Config(levels=())):
        assert counted(r.asDict() for r in H.hard_negatives(H.whole(df, label), F.col("vec_id") % 3 == 0, cfg).collect()) == want
