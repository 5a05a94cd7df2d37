import math
import zlib
from collections import Counter

import numpy as np
import pytest

from riskpipe.llm import pitman_yor as P

from .conftest import LOWER, run, words


@pytest.fixture(scope="module")
def rows(spark, tables):
    return run(spark, "op8_pitman_yor", tables)


def tokens(text):
    return [*words((text or "").translate(LOWER)), None]


def test_base_columns(rows, docs):
    train = [d for d in docs if zlib.crc32(str(d["doc_id"]).encode()) % 7 != 2]
    c = Counter(t for d in train for t in tokens(d["text"]))
    n, v = sum(c.values()), len(c)
    want = sorted((d["doc_id"], len(tokens(d["text"])), sum(c[t] > 0 for t in tokens(d["text"])),
                   sum(math.log10((c[t] + 1) / (n + v + 1)) for t in tokens(d["text"]))) for d in docs)
    got = sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"]) for r in rows)
    assert [x[:3] for x in got] == [x[:3] for x in want]
    assert np.allclose([x[3] for x in got], [x[3] for x in want], rtol=1e-9)
    for r in rows:
        assert r["train_tokens"] == n and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
        assert math.isfinite(r["score"]) and r["score"] < 0 and math.isclose(r["perplexity"], 10 ** (-r["score"] / r["n_tokens"]))


def test_better_than_the_base_on_unseen_texts(rows):
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_reruns_agree(spark, tables, rows):
    key = lambda r: (r["doc_id"], r["score"])
    assert sorted(map(key, run(spark, "op8_pitman_yor", tables))) == sorted(map(key, rows))


def plain_scores(texts, train, state, sweeps=P.SWEEPS, burn=P.BURN_IN):
    """The same sampler with dictionaries, one customer restaurant after the other."""
    toks = [P.tokens([t.encode()]) for t in texts]
    pairs = Counter()
    for (tok, ctx, _), on in zip(toks, train, strict=True):
        if on:
            pairs.update(zip(tok.tolist(), ctx.tolist(), strict=True))
    customers = Counter()
    for (_, u), n in pairs.items():
        customers[u] += n
    v = len({w for w, _ in pairs})
    base, d, s = 1 / (v + 1), state.discount, P.STRENGTH
    one = lambda c, a, dd, key, i: float(P.seat(np.array([float(c)]), np.array([a]), dd, np.array([key], np.uint64), i)[0])
    key = lambda w, u: P.pair_hash(np.array([w], np.uint64), np.array([u]))[0]
    mean = Counter()
    prev = None
    for i in range(sweeps + 1):
        t = {}
        for (w, u), c in pairs.items():
            t[w, u] = min(c, 1) if i == 0 else one(c, (s[0] + d[0] * prev[0][u]) * prev[1](w), d[0], key(w, u), i)
        tables, m = Counter(), Counter()
        for (w, u), x in t.items():
            tables[u] += x
            m[w] += x
        k = {w: (1 if i == 0 else one(x, (s[1] + d[1] * prev[2]) * base, d[1], P.wordhash.mix(np.array([w], np.uint64) + np.uint64(3))[0], i)) for w, x in m.items()}
        total, shared = sum(m.values()), sum(k.values())
        parent = lambda w, m=m, k=k, total=total, shared=shared: (m[w] - d[1] * k.get(w, 0) + (s[1] + d[1] * shared) * base) / (s[1] + total)
        if i > burn:
            for tok, ctx, _ in toks:
                for w, u in zip(tok.tolist(), ctx.tolist(), strict=True):
                    if (w, u) not in mean or mean[w, u][0] < i:
                        p = (pairs[w, u] - d[0] * t.get((w, u), 0) + (s[0] + d[0] * tables[u]) * parent(w)) / (s[0] + customers[u])
                        mean[w, u] = (i, (mean[w, u][1] if (w, u) in mean else 0) + p / (sweeps - burn))
        prev = (tables, parent, shared)
    return [sum(math.log10(mean[w, u][1]) for w, u in zip(tok.tolist(), ctx.tolist(), strict=True)) for tok, ctx, _ in toks]


@pytest.mark.parametrize("spread", [False, True])
def test_equals_plain_sampler(spark, spread, monkeypatch):
    """Also where nearly every word and pair is so frequent that it is spread over shards."""
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.5, 30) % 40) for _ in range(80)] + ["the " * 200, "", "new words only"]
    train = [i % 7 != 2 for i in range(len(texts))]
    monkeypatch.setattr(P, "HOT", 40 if spread else 4)
    monkeypatch.setattr(P, "BLOCK_BYTES", 600)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    from pyspark.sql import functions as F
    hot = P.frequent(df, 4)
    assert not spread or len(hot.words) > 5
    shards = P.sharded(df, F.col("doc_id") % 7 == 2, 4, hot)
    state = P.fit(shards, hot)
    got = {r.doc_id: r.score for r in P.scores(shards, state).collect()}
    want = plain_scores(texts, train, state)
    assert np.allclose([got[i] for i in range(len(texts))], want, rtol=1e-6)


def test_probabilities_of_a_context_sum_to_one(spark):
    from pyspark.sql import functions as F
    texts = ["a b a c", "b a b", "c c c a"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    hot = P.Hot(np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    shards = P.sharded(df, F.lit(False), 1, hot)
    state = P.fit(shards, hot)
    sh = P.Shard(shards.where("pairs IS NOT NULL").collect()[0].pairs, state)
    t, m, p = list(sh.chain(P.SWEEPS))[-1]
    d = state.discount[0]
    for u in np.unique(sh.ctx):
        seen = sh.ctx == u
        tables = state.sweeps[-1].tables[u]
        total = (sh.count - d * t)[seen].sum() + (P.STRENGTH[0] + d * tables) * (p.sum() + (P.STRENGTH[1] + state.discount[1] * state.sweeps[-1].shared) * state.base / (P.STRENGTH[1] + state.sweeps[-1].customers))
        assert abs(total / (P.STRENGTH[0] + state.customers[u]) - 1) < 1e-9


def test_seating_has_the_right_mean():
    """Tables of one dish, against the exact recursion, below and above the size from which groups are seated."""
    def exact(c, a, d):
        p = np.zeros(c + 2)
        p[1] = 1
        for n in range(1, c):
            t = np.arange(c + 2)
            new = np.where(t <= n, a / (a + n - d * np.minimum(t, n)), 0)
            p = p * (1 - new) + np.concatenate([[0], (p * new)[:-1]])
        return (p * np.arange(c + 2)).sum()
    rng = np.random.default_rng(0)
    for c, a in ((5, 0.7), (50, 2.0), (800, 3.0)):
        key = rng.integers(0, 2 ** 63, 6000, dtype=np.uint64)
        t = P.seat(np.full(6000, float(c)), np.full(6000, a), 0.6, key, 1)
        assert abs(t.mean() / exact(c, a, 0.6) - 1) < 0.03 and t.min() >= 1 and t.max() <= c


def test_spread_keys(spark):
    for n in (1, 7, 64):
        keys = P.spread_keys(spark, n)
        assert len(set(keys)) == n


def test_every_previous_word_has_a_restaurant_of_its_own(spark):
    """Also words that agree in the first 16 bits of their mixed hash, of which there are 65,536 only."""
    from pyspark.sql import functions as F
    names = [f"w{i}" for i in range(100_000)]
    tok, ctx, _ = P.tokens([" ".join(names).encode()])
    assert len(np.unique(ctx)) == len(names) + 1
    first = {}
    u, v = next((first[c], i) for i, c in enumerate((P.wordhash.mix(tok[:-1]) >> np.uint64(48)).tolist()) if first.setdefault(c, i) != i)
    texts = [f"{names[u]} x"] * 30 + [f"{names[v]} y"] * 20 + [f"{names[u]} y"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    hot = P.frequent(df, 3)
    shards = P.sharded(df, F.col("doc_id") == 50, 3, hot)
    state = P.fit(shards, hot)
    assert state.customers[tok[u]] == 30 and state.customers[tok[v]] == 20
    got = {r.doc_id: r.score for r in P.scores(shards, state).collect()}
    assert got[50] < got[0] - 1 and got[50] < got[30] - 1


def test_hashing_takes_little_memory_beside_a_block(monkeypatch):
    """A block's texts are hashed a few at a time, with the same tokens."""
    import tracemalloc

    rng = np.random.default_rng(9)
    texts = [b" ".join(b"w%d" % x for x in rng.integers(0, 9999, rng.integers(0, 800))) for _ in range(1500)] + [b"", b"one"]
    P.tokens(texts[:2])
    tracemalloc.start()
    got = P.tokens(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * sum(map(len, texts))
    monkeypatch.setattr(P, "HASHED_BYTES", 1 << 30)
    assert all((x == y).all() for x, y in zip(got, P.tokens(texts), strict=True))
