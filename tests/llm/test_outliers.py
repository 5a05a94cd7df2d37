from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from riskpipe.llm import outliers as O

from .conftest import run, words


def base(text):
    w = words(text)
    t = text or ""
    lines = [x for x in t.split("\n") if words(x)]
    win = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if win[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}


@pytest.fixture(scope="module")
def rows(spark, tables):
    return run(spark, "op1_mcd_quality", tables)


def test_base_columns(rows, docs):
    want = Counter((d["doc_id"], *base(d["text"]).values()) for d in docs)
    assert Counter((r["doc_id"], *(r[c] for c in O.BASE)) for r in rows) == want
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_clean_documents_stay_and_junk_goes(rows, tables, spark):
    labels = {x["doc_id"]: x["quality"] for x in pq.read_table("/root/testdata/sf0.1/labels.parquet").to_pylist()}
    got = run(spark, "op1_mcd_quality", "/root/testdata/sf0.1")
    clean = [r["kept"] for r in got if labels.get(r["doc_id"]) == 1 and not r["base_failed"]]
    junk = [r["kept"] for r in got if labels.get(r["doc_id"]) == 0]
    assert np.mean(clean) > 0.995 and np.mean(junk) < 0.05


def test_estimate_finds_the_centre_among_outliers(spark):
    """Against a plain MCD by concentration steps from the same start."""
    rng = np.random.default_rng(1)
    good = rng.multivariate_normal(np.full(O.P, 900), np.diag(np.arange(1, O.P + 1) * 900.0) + 300, 900)
    bad = rng.normal(4000, 50, (200, O.P))
    x = np.rint(np.vstack([good, bad])).astype(int)
    df = spark.createDataFrame([(0, "a", None, *map(int, r)) for r in x], "g_level int, g_lang string, g_source string, " + ", ".join(f"{c} long" for c in O.XS))
    p = O.fit(df).collect()
    assert len(p) == 1
    m = np.array([p[0][f"m_{i}"] for i in range(O.P)])
    assert np.abs(m - good.mean(axis=0)).max() < 6
    low = np.array([[p[0][f"l_{i}_{j}"] if j <= i else 0 for j in range(O.P)] for i in range(O.P)])
    cov = low @ low.T - np.diag([(f * O.GRID) ** 2 for f in O.FEATURES.values()])
    assert np.abs(cov / np.cov(good.T) - 1)[np.diag_indices(O.P)].max() < 0.35
    d2 = O.with_distance(df, O.fit(df)).select(*O.XS, "d2").toPandas()
    z = np.linalg.solve(low, (d2[O.XS].to_numpy() - m).T)
    assert np.allclose((z ** 2).sum(axis=0), d2["d2"])


def test_chi_square_constants():
    assert abs(O.chi2_cdf(14.067, 7) - 0.95) < 1e-4 and abs(O.chi2_quantile(0.975, 7) - 16.013) < 1e-3


def test_stage_keeps_all_columns(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    kept = O.keep_good(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    assert kept.exceptAll(docs).isEmpty() and kept.where(F.col("text").isNull()).isEmpty()


@pytest.mark.parametrize("min_group", [1, 60])
def test_pools_of_small_groups_against_sql(spark, min_group):
    """Groups of their own, pools of a language and the pool of all, each step by step as the SQL has them."""
    import duckdb
    top, cfg = "/root/testdata/sf0.01", O.McdConfig(min_group=min_group)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{top}/documents.parquet'")
    want = {r[0]: r[1:] for r in con.execute(f"SELECT doc_id, kept, distance2 FROM ({O._oracle(cfg)})").fetchall()}
    out = O.judge(spark.read.parquet(f"{top}/documents.parquet"), ["doc_id"], cfg)
    got = {r.doc_id: (r.kept, r.distance2) for r in out.select("row.doc_id", "kept", "distance2").collect()}
    assert got.keys() == want.keys()
    for d, (kept, distance) in want.items():
        assert got[d][0] == kept and (got[d][1] is None) == (distance is None) and abs((got[d][1] or 0) - (distance or 0)) < 1e-3


def test_same_verdict_as_a_group_of_its_own(spark):
    """A language whose sources are all small is judged as one group would be."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang = 'en'")
    one = O.judge(docs.withColumn("source", F.lit("x")), ["doc_id"])
    many = O.judge(docs.withColumn("source", F.concat(F.lit("s"), F.col("doc_id"))), ["doc_id"])
    key = lambda df: sorted((r.doc_id, r.kept) for r in df.select("row.doc_id", "kept").collect())
    assert key(one) == key(many)
