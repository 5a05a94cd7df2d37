import zlib

import numpy as np
import pytest

from riskpipe.llm import token_files as T
from riskpipe.session import scratch_path

from .conftest import ODD, run


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(T.public_vocabulary())
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids


def test_query_equals_library(spark, tables, docs, library):
    got = sorted(run(spark, "op2_token_files", tables), key=lambda r: r["start"])
    ids = {(d["doc_id"], d["text"]): [*library(d["text"]), 2] for d in docs}
    want, at = [], 0
    for d in sorted(docs, key=lambda d: d["doc_id"]):
        x = ids[d["doc_id"], d["text"]]
        want.append({"doc_id": d["doc_id"], "start": at, "n_tokens": len(x), "ids_crc32": zlib.crc32(np.array(x, "<u4").tobytes())})
        at += len(x)
    assert got == want


def test_words_apart_are_words_together(library):
    enc = T.WordEncoder(T.public_vocabulary())
    texts = [t for t in ODD if t] + ["İ Å Å, e,, -. ... x\x01y", "Kelvin K Σας Σ", "̈́ ̈a ä", "WORD word, Word. word!? 12 1a2,"]
    for cache in (10 ** 6, 5):
        T.CACHE, kept = cache, T.CACHE
        try:
            for _ in range(2):
                assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode([t.encode() for t in texts])] == [library(t) for t in texts]
        finally:
            T.CACHE = kept


def test_null_ids_and_random_access(spark, library):
    folder = scratch_path(spark, "token-test")
    rows = [(None, "b"), (3, "x y"), (-5, None), (3, "x"), (2 ** 62, "last")]
    index = T.write(spark.createDataFrame(rows, "doc_id long, text string"), folder, T.public_vocabulary(), parts=3)
    got = sorted(T.read(spark, folder, index).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, -5, 3, 3, 2 ** 62]
    parts = [T.Part(folder, r.asDict()) for r in index.orderBy("part").collect()]
    texts = [p[i].tolist() for p in parts for i in range(len(p))]
    assert texts[0] == [*library("b"), 2] and texts[1] == [2] and texts[-1] == [*library("last"), 2]
    assert sorted(texts[2:4]) == sorted([[*library("x y"), 2], [*library("x"), 2]])
    assert [int(p.offsets[0]) for p in parts] == np.cumsum([0, *[len(p.ids) for p in parts]])[:-1].tolist()


def test_special_tokens_in_a_text_are_as_the_library_has_them(library):
    encoder = T.WordEncoder(T.public_vocabulary())
    texts = ["a <|endoftext|> b", "a<|endoftext|>b.", "<|startoftext|><|endoftext|>", "<|ENDOFTEXT|> Words", "x <|endoftext|", "Upper <|endoftext|>, Words! <|endoftext|>.", "|endoftext|>"]
    got = encoder.encode([t.encode() for t in texts])
    assert [np.frombuffer(g, encoder.dtype).tolist() for g in got] == [library(t) for t in texts]
