import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from riskpipe.llm import near_dups as N

from .conftest import LOWER, ODD, run, words


def shingles(text):
    w = (text or "").translate(LOWER)
    w = words(w)
    if len(w) < 3:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + 3]) for i in range(len(w) - 2))


def components(rows):
    """doc_id -> least doc_id reachable, by comparing all pairs that share a shingle."""
    sets = {}
    for r in rows:
        sets.setdefault(r["doc_id"], shingles(r["text"]))
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    where = {}
    for d, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(d)
    both = Counter((a, b) for ds in where.values() for i, b in enumerate(ds) for a in ds[:i])
    for (a, b), n in both.items():
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return sets, {d: root(d) for d in sets}


def check(rows, got):
    sets, comp = components(rows)
    assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in rows)
    for r in got:
        assert r["n_shingles"] == len(sets[r["doc_id"]]) and r["component_id"] == comp[r["doc_id"]], r["doc_id"]
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_query_equals_all_pairs(spark, tables, docs):
    check(docs, run(spark, "op10_fast_sketch_dedup", tables))


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
    return " ".join(w)


@pytest.mark.parametrize("block", [8, 2048])
def test_chains_stars_and_neighbours(spark, monkeypatch, block):
    """Groups in which most members are not linked to each other: chains, copies of a base edited apart, two close groups."""
    monkeypatch.setattr(N, "BLOCK", block)
    rng = random.Random(4)
    base = lambda n: " ".join(f"b{rng.randrange(10 ** 6)}" for _ in range(n))
    texts = []
    chain = base(120)
    for _ in range(25):
        texts.append(chain)
        chain = edited(rng, chain, 2)
    hub = base(150)
    texts += [edited(rng, hub, 3) for _ in range(60)] + [hub]
    texts += [edited(rng, hub, 9) for _ in range(20)]
    texts += [base(40)] * 30 + [base(100) for _ in range(40)]
    rng.shuffle(texts)
    rows = [{"doc_id": 10 * i + 3, "text": t} for i, t in enumerate(texts)]
    got = N.near_duplicates(spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id long, text string"))
    check(rows, [r.asDict() for r in got.collect()])


def test_sets_and_sketches():
    texts = [(t or "") for t in ODD] + ["A b C", "a B c d", "a b c a b c"]
    values, ends = N.shingle_sets([t.encode() for t in texts])
    parts = np.split(values, ends[:-1])
    assert [len(p) for p in parts] == [len(shingles(t)) for t in texts]
    s = N.sketches(values, ends)
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    for t, row in zip(texts, s, strict=True):
        assert (row == none).all() if not shingles(t) else (row != none).all()


def test_fine_bits_do_not_depend_on_the_slices():
    values, ends = N.shingle_sets([(t or "").encode() for t in ODD] * 3)
    assert (N.fine_bits(values, ends, 4) == N.fine_bits(values, ends, 1000)).all()


def test_sketches_estimate_similarity():
    """Unbiased and concentrated like independent coordinates, for small and large sets."""
    rng = np.random.default_rng(5)
    for size in (6, 60, 2000):
        off = []
        for _ in range(60):
            a = rng.integers(0, 2 ** 63, size, dtype=np.uint64)
            b = np.concatenate([a[:size - size // 6], rng.integers(0, 2 ** 63, size // 6, dtype=np.uint64)])
            a, b = np.unique(a), np.unique(b)
            x, y = N.sketches(np.concatenate([a, b]), np.array([len(a), len(a) + len(b)]))
            j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            off.append((x == y).mean() - j)
        assert abs(np.mean(off)) < 0.02 and np.std(off) < 1.5 * np.sqrt(0.72 * 0.28 / N.T)


def test_linked_is_exact_at_the_border():
    a = np.arange(100, dtype=np.uint64)
    assert N.linked(a, a[:85]) and not N.linked(a, a[:84]) and not N.linked(a, a[:0])


def test_rows_without_an_id(spark):
    t = "a b c d e f g"
    df = spark.createDataFrame([(None, t), (7, t), (None, "x y z w"), (None, "x y z w"), (4, "other words here")], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.component_id or 0, r.kept) for r in N.near_duplicates(df).collect())
    assert got == [(False, 4, 4, True), (False, 7, 7, True), (True, 0, 0, True), (True, 0, 0, True), (True, 0, 7, False)]


def test_near_copies_without_ids_and_ids_of_several_texts(spark):
    """Rows without an id are linked by their texts; an id that two texts share names both."""
    base = " ".join(f"w{i}" for i in range(60))
    near = [base.replace("w59", x) for x in ("x", "y", "z")]
    df = spark.createDataFrame([(7, base), (None, near[0]), (None, near[1]), (5, "all other words are here"), (5, near[2]), (9, "all other words are here")], "doc_id long, text string")
    got = Counter((r.doc_id, r.component_id, r.kept) for r in N.near_duplicates(df).collect())
    assert got == Counter({(7, 5, False): 1, (None, 5, False): 2, (5, 5, True): 2, (9, 5, False): 1})
    kept = Counter((r.doc_id, r.text) for r in N.one_of_each(df).collect())
    assert kept == Counter([(5, near[2]), (5, "all other words are here")])
    df = df.where("doc_id IS NULL").unionAll(df.where("doc_id IS NULL"))
    assert N.one_of_each(df).count() == 1


def test_stage_leaves_one_of_equal_rows(spark):
    row = (3, "a b c d e", "x", 1.5)
    rows = [row] * 5 + [(None, "f g h i", "y", None)] * 4 + [(4, "", "z", 0.0)] * 2 + [(None, "", "z", 0.0)] * 2
    out = N.one_of_each(spark.createDataFrame(rows, "doc_id int, text string, key string, least double"))
    assert out.dtypes == [("doc_id", "int"), ("text", "string"), ("key", "string"), ("least", "double")]
    assert Counter(map(tuple, out.collect())) == Counter([row, (None, "f g h i", "y", None), (4, "", "z", 0.0), (None, "", "z", 0.0), (None, "", "z", 0.0)])


def test_stage(spark, tables, docs):
    df = spark.read.parquet(f"{tables}/documents.parquet")
    out = N.one_of_each(df)
    _, comp = components(docs)
    assert out.dtypes == df.dtypes
    assert Counter(r.doc_id for r in out.collect()) == Counter({d["doc_id"] for d in docs if comp[d["doc_id"]] == d["doc_id"]})


def test_a_left_over_class_has_few_partners_over_all_its_buckets(spark):
    """It meets others in each of five buckets; a round takes ``most`` of all of them, the last round every one."""
    row = lambda rep, comp, shared: (rep, comp, b"\0" * N.FINE, [b if b in shared else 1000 * (rep + 1) + b for b in range(N.BANDS)])
    rows = [row(j, 0, {j % 5}) for j in range(40)] + [row(99, 99, range(5))]
    members = spark.createDataFrame([(b, b, rep) for rep, *_, bands in rows for b in range(5) if bands[b] == b], "key long, band int, rep long")
    bits = spark.createDataFrame([(rep, bits, bands) for rep, _, bits, bands in rows], "rep long, bits binary, bands array<long>")
    labels = spark.createDataFrame([(rep, comp) for rep, comp, *_ in rows], "rep long, comp long")
    for most, n in ((4, 4), (1 << 30, 40)):
        got = N.open_pairs(members, bits, labels, most).collect()
        assert len(got) == n and {r.b for r in got} == {99}
        assert any(r.more for r in got) == (n < 40)


def test_links_are_read_once(spark, monkeypatch):
    """Rounds after the first go over pairs of components: a clique of 30 costs its links once, not in every rouN."""
    rows, stored = {}, N.common.stored

    def counted(df, name):
        out = stored(df, name)
        rows.setdefault(name, []).append(out.count())
        return out
    monkeypatch.setattr(N.common, "stored", counted)
    clique = [(i, j) for j in range(30) for i in range(j)]
    links = spark.createDataFrame([*clique, (29, 40), (40, 41), (50, 51)], "a long, b long")
    labels = spark.createDataFrame([(i, i) for i in range(52)], "rep long, comp long")
    got = N.components(links, labels)
    assert {r.rep: r.comp for r in got.collect()} == {i: 0 if i < 30 or i in (40, 41) else 50 if i == 51 else i for i in range(52)}
    assert rows["edges"][0] == len(clique) + 3 and sum(rows["edges"][1:]) <= 1
    rows.clear()
    N.components(links, got)
    assert rows == {"edges": [0], "moves": [0]}


def test_texts_are_hashed_a_few_at_a_time(monkeypatch):
    """Hashing takes some 40 bytes of memory for each byte of text, which a Python worker keeps for all later stages."""
    words = np.random.default_rng(5).integers(0, 5000, (1200, 300))
    texts = [" ".join(f"w{x}" for x in row) for row in words] + [None, "", "one two"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts), pa.array(range(len(texts)))], names=["doc_id", "text", "text_key"])
    whole, sizes = N.shingle_sets, []
    values, ends = whole([(t or "").encode() for t in texts])

    def counted(some):
        sizes.append(sum(map(len, some)))
        return whole(some)

    monkeypatch.setattr(N, "shingle_sets", counted)
    out = pa.Table.from_batches(list(N._sketch_rows(iter([batch]))))
    assert max(sizes) <= (1 << 18) + 3000 and sum(sizes) == sum(len(t or "") for t in texts)
    assert out["doc_id"].to_pylist() == list(range(len(texts))) and out["n"].to_pylist() == np.diff(ends, prepend=0).tolist()
    sizes.clear()
    rows = pa.RecordBatch.from_arrays([batch["doc_id"], batch["text"]], names=["rep", "text"])
    sets = pa.Table.from_batches(list(N._set_rows(iter([rows]))))
    assert max(sizes) <= (1 << 18) + 3000
    assert b"".join(sets["shingles"].to_pylist()) == values.astype("<u8").tobytes()
