"""Operator 4: byte-level BPE encoding and decoding by monoid tree reduction.

A text is halved until its parts are short, the parts are encoded, and neighbours
are joined up the tree.  The join is the monoid's product: it keeps the tokens of
both sides except in a window around the boundary, which it encodes again, and
grows the window until nothing outside can change.

Two facts decide when that is so.

* The splitting pattern never lets a piece cross a *cut*: a place between a
  character that is not white space and one of another class (letter, number,
  white space, other), except an apostrophe before a letter.  No alternative of
  the pattern spans such a place, and none looks behind, so the pieces before a
  cut depend on the text up to its second character only and matching starts
  afresh at it.  Tokens before the last cut of the left side and after the first
  cut of the right side therefore stand.
* Inside one piece, a sequence of tokens is the encoding of its bytes exactly
  when each pair of neighbours is the encoding of their joined bytes.  If the
  window's first token goes with the one before it and its last with the one
  after it, the whole sequence is the encoding.  This is used where one piece is
  so long that no cut is near.

Decoding concatenates bytes up the same kind of tree.

Defined results: a null text is an empty one; it has no tokens.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskpipe.llm import common

LEAF = 4096          # characters of a leaf of the tree, and tokens of a leaf of the decoding tree
WINDOW = 64          # characters looked at for a cut on either side, at first
LONG = 4 * LEAF      # a window beyond this is joined token by token if it is one piece
PAIRS = 8            # tokens on either side of a boundary inside a piece, at first


class TreeEncoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        import tiktoken

        self._lib = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._pattern = regex.compile(pattern)
        self._lengths = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
        for token, i in ranks.items():
            self._lengths[i] = len(token)
        classes = r"\p{L}\p{N}", r"\s"
        # a cut lies before the end of a match of this
        self._cut = regex.compile(r"(?:\p{L}(?=[^\p{L}])|\p{N}(?=[^\p{N}])|[^%s%s'](?=[%s%s])|'(?=[\p{N}\s]))" % (*classes, *classes))

    # -- leaves -------------------------------------------------------------------------------

    def _leaf(self, text: str) -> np.ndarray:
        return np.asarray(self._lib.encode_to_numpy(text, disallowed_special=()), dtype=np.uint32)

    def _piece(self, data: bytes) -> list[int]:
        return self._lib._encode_single_piece(data)

    # -- the tree -----------------------------------------------------------------------------

    def encode(self, text: str) -> np.ndarray:
        if len(text) <= LEAF:
            return self._leaf(text)
        half = len(text) // 2
        left, right = text[:half], text[half:]
        return self.join(left, self.encode(left), right, self.encode(right))

    def join(self, left: str, a: np.ndarray, right: str, b: np.ndarray) -> np.ndarray:
        """Tokens of ``left + right`` from those of each."""
        p, q = self._last_cut(left), self._first_cut(right)
        tail, head = left[p:], right[:q]
        i = len(a) - self._tokens_of(a[::-1], len(tail.encode()))
        j = self._tokens_of(b, len(head.encode()))
        if len(tail) + len(head) > LONG and all(self._is_piece(x) for x in (tail, head, tail + head)):
            middle = self._join_in_piece(a[i:], b[:j])
        else:
            middle = self._leaf(tail + head)
        return np.concatenate([a[:i], middle, b[j:]])

    def _last_cut(self, text: str) -> int:
        size = WINDOW
        while True:
            start = max(0, len(text) - size)
            found = None
            for found in self._cut.finditer(text, start):  # noqa: B007
                pass
            if found:
                return found.end()
            if not start:
                return 0
            size *= 4

    def _first_cut(self, text: str) -> int:
        found = self._cut.search(text)
        return found.end() if found else len(text)

    def _tokens_of(self, ids: np.ndarray, size: int) -> int:
        """How many tokens from the start of ``ids`` have ``size`` bytes together."""
        if not size:
            return 0
        n, ends = WINDOW, None
        while ends is None or ends[-1] < size:
            ends = np.cumsum(self._lengths[ids[:n]])
            if ends[-1] < size and n >= len(ids):
                raise AssertionError("a cut is not between tokens")
            n *= 4
        k = int(np.searchsorted(ends, size))
        assert ends[k] == size, "a cut is not between tokens"
        return k + 1

    def _is_piece(self, text: str) -> bool:
        m = self._pattern.match(text)
        return bool(m) and m.end() == len(text)

    def _join_in_piece(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        k = PAIRS
        while True:
            i, j = max(0, len(a) - k), min(len(b), k)
            window = self._piece(self._bytes(a[i:]) + self._bytes(b[:j]))
            if (i == 0 or self._go_together(int(a[i - 1]), window[0])) and (j == len(b) or self._go_together(window[-1], int(b[j]))):
                return np.concatenate([a[:i], np.asarray(window, np.uint32), b[j:]])
            k *= 2

    def _go_together(self, x: int, y: int) -> bool:
        return self._piece(self._bytes([x, y])) == [x, y]

    # -- decoding -----------------------------------------------------------------------------

    def _bytes(self, ids) -> bytes:
        return self._lib.decode_bytes([int(x) for x in ids])

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= LEAF:
            return self._lib.decode_bytes(ids.tolist())
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> TreeEncoder:
    """One encoder in each Python worker."""
    return TreeEncoder(read_ranks(path), pattern)


def public_ranks() -> tuple[str, str]:
    import public_tokenizers as public

    return public.path("byte_bpe_50k.tiktoken"), public.PATTERN


def _little(ids: np.ndarray) -> bytes:
    return ids.astype("<u4", copy=False).tobytes()


def op4_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_ranks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for batch in batches:
            sizes, ids_hash, text_hash = [], [], []
            for text in batch["text"]:
                ids = enc.encode(text.as_py() or "")
                sizes.append(len(ids))
                ids_hash.append(hashlib.sha256(_little(ids)).hexdigest())
                text_hash.append(hashlib.sha256(enc.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return common.documents(spark, sf_dir).select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, text: str = "text", name: str = "token_ids") -> DataFrame:
    """``docs`` with a binary column ``name``: the text's token ids as little-endian unsigned 32-bit integers,
    and ``n_tokens``.  A column of ``docs`` with either name is replaced."""
    path, pattern = public_ranks()
    keep = [c for c in docs.columns if c not in (name, "n_tokens")]
    at = keep.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for batch in batches:
            ids = [enc.encode(t.as_py() or "") for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([_little(x) for x in ids], pa.binary()), pa.array([len(x) for x in ids], pa.int64())],
                names=[*keep, name, "n_tokens"])

    df = docs.select(*[F.col(f"`{c}`") for c in keep])
    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.BinaryType()), T.StructField("n_tokens", T.LongType())]))
