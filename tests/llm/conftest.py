"""Small tables with awkward rows, empty tables, and plain versions of what the contracts fix."""

import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

LONG = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
ODD = [None, "", " \t\n ", "one", "two words", "a b c", "x" * 20_000, LONG, "한국어 café é J̌ İ ﬁ",
       "same text here again\nsame text here again\n\nother", "same text here again\nsame text here again\n\nother",
       "rep " * 60, "1 2 3 4 5 6 7 8 " * 9, "mail a.b@c.de, +49 (30) 123-4567 and 10.0.0.1 or 4111 1111 1111 1111",
       "'s don't WE'RE \x1c\x85 \U0001f600 ###$$$"]


def words(text):
    return WORD.findall(text or "")


@pytest.fixture(scope="session")
def tables(tmp_path_factory):
    """documents of sf0.001 and the odd ones; labels and embeddings with nulls and repeats; columns with clashing names."""
    top = tmp_path_factory.mktemp("tables")
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    n = len(docs)
    odd = [{"doc_id": n + i, "text": t, "lang": [None, "en", ""][i % 3], "source": [None, "src0", "new"][i % 3], "n_chars": None if t is None else len(t)}
           for i, t in enumerate(ODD)]
    rows = docs + odd + [dict(docs[3])]                     # a repeated row
    for i, r in enumerate(rows):
        r |= {"size": i, "k": "x", "row": i, "w": None, "h": 1, "n_tokens": -1, "key": 2, "rep": 3}
    pq.write_table(pa.Table.from_pylist(rows), top / "documents.parquet")
    labels = pq.read_table(f"{SF}/labels.parquet").to_pylist()
    labels += [{"doc_id": None, "quality": 1, "toxic": 0}, {"doc_id": 5, "quality": None, "toxic": None}, {"doc_id": 10 ** 9, "quality": 1, "toxic": 1}, dict(labels[0])]
    pq.write_table(pa.Table.from_pylist(labels), top / "labels.parquet")
    vec = pq.read_table(f"{SF}/embeddings.parquet").to_pylist()
    dim = len(vec[0]["embedding"])
    bad = [None, [0.0] * dim, [float("nan")] * dim, [None] * dim, [float("inf")] + [0.0] * (dim - 1), [1.0, 2.0]]
    vec += [{"vec_id": 1000 + i, "embedding": e, "label": 0} for i, e in enumerate(bad)]
    vec += [{"vec_id": 2000 + i, "embedding": vec[7]["embedding"], "label": 0} for i in range(45)]   # ties
    vec += [dict(vec[20]), {"vec_id": 3000, "embedding": [40 * x for x in vec[9]["embedding"]], "label": 1}, {"vec_id": None, "embedding": vec[9]["embedding"], "label": 1}]
    pq.write_table(pa.Table.from_pylist(vec), top / "embeddings.parquet")
    return str(top)


@pytest.fixture(scope="session")
def empty_tables(tmp_path_factory):
    top = tmp_path_factory.mktemp("empty")
    for t in ("documents", "labels", "embeddings"):
        pq.write_table(pq.read_table(f"{SF}/{t}.parquet").slice(0, 0), top / f"{t}.parquet")
    return str(top)


@pytest.fixture(scope="session")
def docs(tables):
    return pq.read_table(f"{tables}/documents.parquet").to_pylist()


def run(spark, name, folder):
    from riskpipe.llm.queries import QUERIES
    return [r.asDict() for r in QUERIES[name](spark, folder).collect()]
