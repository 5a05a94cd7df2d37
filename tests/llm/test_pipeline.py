from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline as C
from riskpipe.llm import bpe_tree, common, pii

from .test_mixing import targets
from .test_near_dups import components


@pytest.fixture(scope="module")
def stages(spark, tables):
    """Rows before and after each stage, each read from what the one before wrote."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    out = [docs]
    for name, stage in C.STAGES:
        docs = common.stored(stage(spark, docs, tables), f"test-{name}")
        out.append(docs)
    return out


def test_names_and_columns(stages):
    assert [n for n, _ in C.STAGES] == ["quality", "near_dups", "pii", "mix", "tokens"]
    for d in stages[1:-1]:
        assert d.dtypes == stages[0].dtypes


def test_each_stage_against_a_plain_version(stages):
    rows = [[r.asDict() for r in d.collect()] for d in stages]
    ids = lambda x: Counter(r["doc_id"] for r in x)
    # quality: only rows of the input, none without words
    assert not ids(rows[1]) - ids(rows[0]) and all(len(r["text"].split()) >= 20 for r in rows[1])
    # near duplicates: one of each group
    _, comp = components(rows[1])
    assert set(ids(rows[2])) == {d for d, c in comp.items() if d == c}
    # personal data: no span is left that was there
    after = {r["doc_id"]: r for r in rows[3]}
    for r in rows[2]:
        new = after[r["doc_id"]]
        assert new["text"] == pii.redact(r["text"], pii.find(r["text"])) and new["n_chars"] == len(new["text"])
    # mix: words of each source near its target
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows[3]:
        n = len(r["text"].split())
        sizes[r["source"]] += n
        largest[r["source"]] = max(largest[r["source"]], n)
    for r in rows[4]:
        taken[r["source"]] += len(r["text"].split())
    for s, t in targets(sizes).items():
        assert abs(taken[s] - t) <= largest[s]
    # tokens
    enc = bpe_tree.encoder(*bpe_tree.public_ranks())
    assert ids(rows[5]) == ids(rows[4])
    for r in rows[5]:
        assert enc.decode(np.frombuffer(r["token_ids"], "<u4")) == r["text"].encode() and r["n_tokens"] * 4 == len(r["token_ids"])


def test_run_is_all_stages(spark, tables, stages):
    key = lambda d: Counter((r.doc_id, r.n_tokens) for r in d.select("doc_id", "n_tokens").collect())
    assert key(C.run(spark, tables)) == key(stages[-1])


def test_empty_table(spark, empty_tables):
    out = C.run(spark, empty_tables)
    assert out.isEmpty() and "token_ids" in out.columns
