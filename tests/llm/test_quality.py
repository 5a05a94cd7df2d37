import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq

from riskpipe.llm import quality as Q

from .conftest import ODD, run


def test_rows_and_fold(spark, tables, docs):
    got = run(spark, "op9_nbsvm_quality", tables)
    assert Counter(r["doc_id"] for r in got) == Counter(d["doc_id"] for d in docs)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    truth = {x["doc_id"]: x["quality"] for x in pq.read_table(f"{sf}/labels.parquet").to_pylist()}
    held = [(truth[r["doc_id"]], r["score"], r["predicted"]) for r in run(spark, "op9_nbsvm_quality", sf) if r["held_out"] and r["doc_id"] in truth]
    pos, neg = [s for y, s, _ in held if y], [s for y, s, _ in held if not y]
    assert np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg]) > 0.98
    assert np.mean([y == p for y, _, p in held]) > 0.96


def test_features_are_indicators_of_each_text():
    texts = [(t or "").encode() for t in ODD]
    at, ends = Q.features(texts)
    for i, (a, b) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
        alone, _ = Q.features([texts[i]])
        assert at[a:b].tolist() == alone.tolist() and len(set(alone.tolist())) == len(alone)
        assert texts[i] or not len(alone)


def test_descent_reaches_the_dual_optimum():
    rng = np.random.default_rng(3)
    ratio = rng.normal(size=30)
    rows = [np.sort(rng.choice(30, 8, replace=False)) for _ in range(120)]
    y = np.where([ratio[r].sum() + rng.normal() > 0 for r in rows], 1.0, -1.0)
    w = Q.descend(rows, y, ratio, c=0.5, epochs=2000)
    x = np.zeros((120, 31))
    for i, r in enumerate(rows):
        x[i, r], x[i, 30] = ratio[r], 1
    loss = lambda v: 0.5 * v @ v + 0.5 * np.maximum(0, 1 - y * (x @ v)).sum()
    best = loss(w)
    for _ in range(300):
        assert loss(w + rng.normal(scale=0.02, size=31)) >= best - 1e-3
