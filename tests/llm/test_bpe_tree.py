import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskpipe.llm import bpe_tree as B

from .conftest import run


@pytest.fixture(scope="module")
def enc():
    return B.encoder(*B.public_ranks())


@pytest.fixture()
def small(monkeypatch):
    for name, value in (("LEAF", 16), ("LONG", 48), ("WINDOW", 4), ("PAIRS", 1)):
        monkeypatch.setattr(B, name, value)


def test_query_equals_library(spark, tables, docs, enc):
    got = sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in run(spark, "op4_tree_bpe", tables))
    want = []
    for d in docs:
        ids = enc._lib.encode_ordinary(d["text"] or "")
        want.append((d["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((d["text"] or "").encode()).hexdigest()))
    assert got == sorted(want)


PIECES = [" ", "  ", "\n", "'", "'s", "'re", "'r", "e", "a", "B", "é", "1", "23", "!", "...", "-", "中", "\t", "　", "’", "ab", " the", " ", "\U0001f600"]


def test_tree_equals_library_on_joined_pieces(enc, small):
    rng = random.Random(1)
    for _ in range(1500):
        pool = rng.sample(PIECES, rng.choice([1, 2, 3, 8, len(PIECES)]))
        text = "".join(rng.choice(pool) for _ in range(rng.choice([20, 60, 200])))
        ids = enc.encode(text)
        assert ids.tolist() == enc._lib.encode_ordinary(text), repr(text)
        assert enc.decode(ids) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=120))
def test_tree_equals_library_on_any_text(text):
    enc = B.encoder(*B.public_ranks())
    kept = B.LEAF, B.LONG, B.WINDOW
    B.LEAF, B.LONG, B.WINDOW = 8, 24, 2
    try:
        assert enc.encode(text).tolist() == enc._lib.encode_ordinary(text)
    finally:
        B.LEAF, B.LONG, B.WINDOW = kept


@pytest.mark.parametrize("text", ["a" * 70_000, "ab" * 40_000, "x y " * 10 + "q" * 30_000 + "1" * 30_000, " " * 50_000 + "a", "中文" * 20_000, "'" * 40_000 + "re", "\n \n" * 20_000])
def test_long_runs(enc, text):
    assert enc.encode(text).tolist() == enc._lib.encode_ordinary(text)


def test_join_is_associative(enc, small):
    rng = random.Random(2)
    for _ in range(200):
        a, b, c = ("".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 30))) for _ in range(3))
        e = enc._leaf
        left = enc.join(a + b, enc.join(a, e(a), b, e(b)), c, e(c))
        right = enc.join(a, e(a), b + c, enc.join(b, e(b), c, e(c)))
        assert left.tolist() == right.tolist() == enc._lib.encode_ordinary(a + b + c)


def test_stage(spark, tables, enc):
    docs = spark.read.parquet(f"{tables}/documents.parquet").withColumnRenamed("size", "token_ids")
    out = B.encoded(docs)
    assert [c for c in out.columns if c not in ("token_ids", "n_tokens")] == [c for c in docs.columns if c not in ("token_ids", "n_tokens")]
    for r in out.collect():
        ids = np.frombuffer(r.token_ids, "<u4")
        assert len(ids) == r.n_tokens and enc.decode(ids) == (r.text or "").encode()
