"""Words of many texts at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose bits all depend on all bits (the splitmix64 finaliser)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BASE = 0x2545F4914F6CDD1D  # odd, so it has an inverse
_powers: dict[bool, np.ndarray] = {}


def _power(n: int, inverse: bool = False) -> np.ndarray:
    have = _powers.get(inverse)
    if have is None or len(have) < n:
        base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
        full = np.full(max(n, 1 << 16), base, _U)
        full[0] = 1
        have = np.multiply.accumulate(full)
        if n <= 1 << 22:  # what longer texts need is not kept
            _powers[inverse] = have
    return have[:n]


@dataclass
class Words:
    """``hash``, ``start`` and ``end`` (bytes in ``data``) and ``doc`` of every word of the texts, in order."""
    data: np.ndarray
    sums: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    n_docs: int

    def prefix(self, size: int | None = None) -> np.ndarray:
        """Hash of the first ``size`` bytes of each word (of all, by default)."""
        end = self.end if size is None else np.minimum(self.start + size, self.end)
        h = (self.sums[end] - self.sums[self.start]) * _power(len(self.sums), inverse=True)[self.start]
        return mix(h + (end - self.start).astype(_U))

    @property
    def hash(self) -> np.ndarray:
        return self.prefix()

    def per_doc(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n_docs)


def words(texts: list[bytes], lower: bool = True) -> Words:
    """The words (see ``common.WORD``) of the texts, A-Z in lower case unless told otherwise."""
    joined = b"\n".join(texts)
    data = np.frombuffer(joined.lower() if lower else joined, np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    starts = np.cumsum(sizes) - sizes
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTE[data] * _power(len(data)), out=sums[1:])
    blank = np.ones(len(data) + 2, bool)
    blank[1:-1] = _BLANK[data]
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    start, end = edges[::2], edges[1::2]
    doc = np.searchsorted(starts, start, side="right") - 1
    return Words(data, sums, start, end, doc.astype(np.int64), len(texts))


def chunks(batch: pa.RecordBatch, text: str = "text", limit: int = 1 << 21) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of a batch with the UTF-8 of their texts (a null text: empty), about ``limit`` bytes each.

    Texts are taken out of the batch slice by slice, so there is no second copy of the batch."""
    column = batch[text].cast(pa.binary())
    start = size = 0
    for i, n in enumerate(pc.binary_length(column).to_pylist()):
        size += n or 0
        if size >= limit or i + 1 == len(column):
            yield batch.slice(start, i + 1 - start), [x.as_py() or b"" for x in column.slice(start, i + 1 - start)]
            start, size = i + 1, 0
