import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskpipe.llm import ngram_join as J

from .conftest import LOWER, run, words


def shingles(text):
    w = [x.translate(LOWER) for x in words(text)]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def plain(rows):
    """(doc_id, n_shingles, component_id) of each row, by all pairs that share a shingle."""
    sets = [shingles(r["text"]) for r in rows]
    lists = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            lists[x].append(i)
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, s in enumerate(sets):
        for j, both in Counter(j for x in s for j in lists[x] if j > i).items():
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                up[root(i)] = root(j)
    label = {}
    for i, r in enumerate(rows):
        if r["doc_id"] is not None:
            label[root(i)] = min(label.get(root(i), r["doc_id"]), r["doc_id"])
    return Counter((r["doc_id"], len(s), label.get(root(i))) for i, (r, s) in enumerate(zip(rows, sets, strict=True)))


def got(spark, rows):
    df = spark.createDataFrame([(r["doc_id"], r["text"], 1, "x") for r in rows], "doc_id long, text string, rep int, head string")
    return Counter(map(tuple, J.jaccard_join(df).collect()))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", None])
def test_against_all_pairs(spark, tables, folder):
    import pyarrow.parquet as pq
    top = folder or tables
    rows = pq.read_table(f"{top}/documents.parquet").to_pylist()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in run(spark, "op12_divide_skip_join", top)) == plain(rows)


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
    return " ".join(w)


def test_chains_groups_and_common_passages(spark, monkeypatch):
    """Copies further and further from the first, groups under and over the limit, a passage in everything; blocks of a few rows."""
    monkeypatch.setattr(J, "BLOCK", 7)
    rng = random.Random(4)
    text = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    passage = text(60)
    rows = []
    for size in (3, 30, 200):
        base = text(size)
        for k in range(25):
            rows.append(edited(rng, base, k % 5))
    chain = text(150)
    for _ in range(30):
        chain = edited(rng, chain, 2)
        rows.append(chain)
    rows += [f"{text(20)} {passage} {text(20)}" for _ in range(40)] + [passage] * 6 + [edited(rng, passage, 1) for _ in range(10)]
    rows += [" ".join(["same"] * n) for n in (1, 3, 5, 9, 50)] + ["", None, " \n"]
    rng.shuffle(rows)
    rows = [{"doc_id": i if i % 11 else None, "text": t} for i, t in enumerate(rows)]
    rows += [dict(rows[5]), {"doc_id": 7, "text": rows[20]["text"]}, {"doc_id": None, "text": "all alone without an id here"}]
    want = plain(rows)
    assert len({c for _, _, c in want}) < len(rows) - 40
    assert got(spark, rows) == want


@pytest.mark.parametrize("long", [1, 4, 10 ** 6])
def test_divide_skip_finds_what_a_scan_finds(monkeypatch, long):
    monkeypatch.setattr(J, "LONG", long)
    monkeypatch.setattr(J, "MU", 0.01)
    rng = np.random.default_rng(2)
    base = [np.unique(rng.integers(0, 400, n).astype(np.uint64)) for n in (0, 1, 4, 5, 60, 60, 61)]
    sets = [np.setdiff1d(np.union1d(b, rng.integers(0, 400, k).astype(np.uint64)), rng.choice(b, min(len(b), k)) if len(b) else b) for b in base for k in (0, 1, 2, 4, 8) for _ in range(8)]
    lists = J.Lists(sets)
    for q in sets:
        want = [j for j, s in enumerate(sets) if len(q) and len(s) and 100 * len(np.intersect1d(q, s)) >= 80 * len(np.union1d(q, s))]
        assert lists.search(q).tolist() == want


def test_linked_prefixes_share_enough():
    """The bounds of the prefix filter on random linked sets."""
    rng = np.random.default_rng(9)
    for _ in range(2000):
        n = int(rng.integers(1, 200))
        both = rng.choice(10 ** 6, 2 * n + 40, replace=False)
        extra = int(rng.integers(0, n // 4 + 2))
        a, b = both[:n], both[int(rng.integers(0, n // 5 + 1)):n + extra]
        if not len(b) or 100 * len(np.intersect1d(a, b)) < 80 * len(np.union1d(a, b)):
            continue
        prefix = lambda s: set(np.sort(s)[:J.prefix_size(len(s))].tolist())
        least = J.common_least(J.required(len(a)))
        assert len(prefix(a) & prefix(b)) >= least and 1 <= J.prefix_size(n) <= n
