import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st

from riskpipe.llm import labelled as L
from riskpipe.llm import toxicity as T
from riskpipe.llm import wordhash

from .conftest import LOWER, ODD, SF, run, words


def maximal_by_definition(x):
    """Segments of positive sum that no proper part beats and that lie in no larger such segment."""
    sums = np.concatenate([[0], np.cumsum(x)])
    good = []
    for i in range(len(x)):
        for j in range(i + 1, len(x) + 1):
            # every proper prefix and suffix has a positive sum
            if all(sums[k] > sums[i] for k in range(i + 1, j + 1)) and all(sums[j] > sums[k] for k in range(i, j)):
                good.append((i, j))
    return sorted((i, j) for i, j in good if not any(a <= i and j <= b and (a, b) != (i, j) for a, b in good))


@settings(max_examples=500, deadline=None)
@given(st.lists(st.integers(-5, 5), max_size=14))
def test_maximal_segments(xs):
    x = np.array(xs, float)
    got = T.maximal_segments(x)
    assert sorted((a, b) for a, b, _ in got) == maximal_by_definition(x)
    assert all(abs(s - x[a:b].sum()) < 1e-9 for a, b, s in got)


def test_rows_and_fold(spark, tables, docs):
    got = run(spark, "op3_toxic_segments", tables)
    assert Counter(r["doc_id"] for r in got) == Counter(d["doc_id"] for d in docs)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
        assert r["n_passages"] == len([p for p in r["passages"].split(",") if p])


def test_held_out_accuracy_and_no_leak(spark, tmp_path):
    sf = "/root/testdata/sf0.1"
    labels = pq.read_table(f"{sf}/labels.parquet").to_pylist()
    truth = {x["doc_id"]: x["toxic"] for x in labels}
    got = {r["doc_id"]: r for r in run(spark, "op3_toxic_segments", sf)}
    held = [(truth[d], r["score"], r["predicted"]) for d, r in got.items() if r["held_out"] and d in truth]
    pos, neg = [s for y, s, _ in held if y], [s for y, s, _ in held if not y]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc > 0.93 and np.mean([y == p for y, _, p in held]) > 0.95
    share = {y: np.mean([got[d]["n_passages"] > 0 for d, r in got.items() if r["held_out"] and truth.get(d) == y]) for y in (0, 1)}
    assert share[0] < 0.1 and share[1] > 0.9  # passages are not chance: few clean texts hold one
    # labels of the held-out fold, languages and sources change no score
    import shutil
    shutil.copy(f"{SF}/documents.parquet", tmp_path / "documents.parquet")
    table = pq.read_table(f"{SF}/labels.parquet").to_pylist()
    base = None
    for flip in (0, 1):
        pq.write_table(pa.Table.from_pylist([x | {"toxic": 1 - x["toxic"]} if flip and zlib.crc32(str(x["doc_id"]).encode()) % 4 == 2 else x for x in table]), tmp_path / "labels.parquet")
        scores = sorted((r["doc_id"], r["score"]) for r in run(spark, "op3_toxic_segments", str(tmp_path)))
        assert base in (None, scores)
        base = scores


def test_word_hashes():
    texts = [(t or "").encode() for t in ODD]
    w = wordhash.words(texts)
    plain = [x.encode().decode().translate(LOWER) for t in ODD for x in words(t)]
    assert [bytes(w.data[a:b]).decode() for a, b in zip(w.start, w.end, strict=True)] == plain
    assert w.doc.tolist() == [i for i, t in enumerate(ODD) for _ in words(t)] and len(set(w.hash.tolist())) == len(set(plain))
    assert len(set(zip(w.hash.tolist(), plain, strict=True))) == len(set(plain))
    four = dict.fromkeys(zip(w.prefix(4).tolist(), [x.encode()[:4] for x in plain], strict=True))
    assert len(four) == len({x.encode()[:4] for x in plain})


def test_platt_and_rate():
    rng = np.random.default_rng(0)
    x = rng.normal(size=4000)
    y = (rng.random(4000) < L.sigmoid(2 * x - 1)).astype(int)
    a, b = L.platt(x, y)
    assert abs(a - 2) < 0.2 and abs(b + 1) < 0.2
    assert L.platt(x, np.zeros(4000, int))[0] == 0 and L.platt(-x, y)[0] == 0
    counts, values = np.array([70, 30]), np.array([-1.0, 1.0])
    lam = T.extreme_rate(counts, values * 1.5)
    assert abs((0.7 * np.exp(-1.5 * lam) + 0.3 * np.exp(1.5 * lam)) - 1) < 1e-6
    lam = T.extreme_rate(np.array([99, 1]), values)  # a root above 1
    assert lam > 4 and abs(0.99 * np.exp(-lam) + 0.01 * np.exp(lam) - 1) < 1e-6
    assert T.extreme_rate(counts, -np.abs(values)) == 1.0 and T.extreme_rate(np.array([30, 70]), values) == 1e-3


def test_p_value():
    model = T.Model(np.zeros(1), np.zeros(1), lam=2.0, k=0.5)
    for total, n in ((0.0, 100), (3.0, 100), (8.0, 100), (8.0, 100_000)):
        assert abs(model.p_value(total, n) - (1 - np.exp(-0.5 * n * np.exp(-2 * total)))) < 1e-12


def test_every_occurrence_counts(spark):
    """Two equal toxic passages far apart in a long text are both found; a stuttered word is not a passage."""
    rng = np.random.default_rng(5)
    clean = lambda n: " ".join(f"c{int(x)}" for x in rng.integers(0, 300, n))
    bad = [f"bad{i}" for i in range(12)]
    train = [(i, f"{clean(60)} {' '.join(rng.permutation(bad))} {clean(60)}" if i % 4 == 0 else clean(132), int(i % 4 == 0)) for i in range(200)]
    model = T.fit(spark.createDataFrame(train, "doc_id long, text string, label int"))
    passage, first, between = " ".join(bad), clean(400), clean(3000)
    texts = [f"{first} {passage} {between} {passage} {clean(400)}", f"{first} {passage} {between}", f"{first} {'bad0 ' * 12} {between}"]
    got = {r.doc_id: r for r in T.scored(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    inside = lambda r, at: any(int(a) <= at + 2 and at + 10 <= int(b) for a, b in (p.split(":") for p in r.passages.split(",") if p))
    assert inside(got[0], 400) and inside(got[0], 3412) and got[0].n_passages == 2
    assert got[1].n_passages == 1 and inside(got[1], 400) and got[2].n_passages == 0
