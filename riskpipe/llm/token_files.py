"""Operator 2: token ids in flat binary files with 64-bit document offsets.

Format of a data set (a folder; all integers little-endian):

* ``part-*.ids``  the ids of some consecutive documents, unsigned 16-bit integers if the
  vocabulary fits and 32-bit ones otherwise, nothing between the documents;
* ``part-*.off``  n + 1 unsigned 64-bit integers: where each of its n documents starts, and
  the end, counted in ids from the start of the *data set*;
* ``part-*.doc``  the ids of its documents, signed 64-bit integers (0 where null: those come first);
* ``index``       a Parquet table with a row per part: its files, id width, counts and base.

Documents are dealt to parts by ranges of their id, so parts in order hold them in
ascending order.  A part is written by one task from its own rows; its base, the ids
in all earlier parts, is a prefix sum over one number per part, the only thing that
reaches the driver.  A task that runs again writes under another name, and the index
names the files of the task that counted, so lost executors leave no trace in a
result.  Readers map the files into memory where the store is a file system.

Encoding splits a text at ASCII white space, which the tokenizer drops and never
merges or composes across, and keeps the ids of words it has met, so the library
encodes a word once per worker (as long as ``CACHE`` words are remembered).

Defined results: a null text is an empty one, its ids are the end id alone; documents
without an id come first; documents that share an id stand in order of a hash of their text.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from riskpipe.llm import common
from riskpipe.session import scratch_path

#: Fixed by the contract.
END_ID = 2
#: Words whose ids a worker remembers; beyond that it starts anew.
CACHE = 1_400_000
#: Stands between words that are encoded in one call; its ids are then looked for.
_MARK = b"\x01"
_ENDINGS = b".,;:!?"


class WordEncoder:
    """Ids of whole texts, by the library, word by word."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_file(path)
        #: Such a token in a text is one id, as the library has it, but only as it is written.
        self._special = [t.content.lower().encode() for t in self._tok.get_added_tokens_decoder().values()]
        self._known: dict[bytes, bytes] = {}
        self.dtype = np.dtype("<u2" if self._tok.get_vocab_size() <= 1 << 16 else "<u4")

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as bytes of ``dtype``."""
        split = [self._words(t) for t in texts]
        new = set().union(*split).difference(self._known)
        if new:
            if len(self._known) + len(new) > CACHE:
                self._known = {}
                new = set().union(*split)
            self._learn(new)
        known = self._known
        return [b"".join([known[w] for w in ws]) for ws in split]

    def _words(self, text: bytes) -> list[bytes]:
        """Words between ASCII white space, in lower case as the tokenizer will make them anyway.

        Lower case comes after composition there, so not where an ASCII letter may compose:
        with U+0300 to U+036F, which start with the bytes CC and CD; nor where a special token may stand."""
        low = text.lower()
        return (text if b"\xcc" in text or b"\xcd" in text or any(t in low for t in self._special) else low).split()

    def _learn(self, words: set[bytes]) -> None:
        """Encode new words.  The tokenizer splits marks from letters, so a word and the mark after it are learned apart."""
        known, apart, rest = self._known, [], set()
        for w in words:
            core = w.rstrip(_ENDINGS)
            if core is not w and core.isalpha():
                tail = w[len(core):]
                apart.append((w, core, tail))
                rest.update((core, tail))
            else:
                rest.add(w)
        self._encode([w for w in rest if w not in known])
        for w, core, tail in apart:
            known[w] = known[core] + known[tail]

    def _encode(self, words: list[bytes]) -> None:
        """Many words in one call of the library, with marks between them; words that hold the mark, alone."""
        known, dtype = self._known, self.dtype
        batch = self._tok.encode_batch_fast
        mark = batch([_MARK.decode()], add_special_tokens=False)[0].ids
        assert len(mark) == 1
        odd = [w for w in words if _MARK in w]
        words = [w for w in words if _MARK not in w]
        groups = [words[k:k + 256] for k in range(0, len(words), 256)]
        for k in range(0, len(groups), 64):
            part = groups[k:k + 64]
            for group, e in zip(part, batch([b" \x01 ".join(g).decode() for g in part], add_special_tokens=False), strict=True):
                ids = np.array(e.ids, dtype)
                cuts = np.flatnonzero(ids == mark[0])
                assert len(cuts) == len(group) - 1
                starts, ends = [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)]
                data, size = ids.tobytes(), dtype.itemsize
                known.update((w, data[a * size:b * size]) for w, a, b in zip(group, starts, ends, strict=True))
        for w in odd:
            known[w] = np.array(batch([w.decode()], add_special_tokens=False)[0].ids, dtype).tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder in each Python worker."""
    return WordEncoder(path)


def public_vocabulary() -> str:
    import public_tokenizers as public

    return public.path("word_bpe_49k.json")


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _uri(path: str) -> str:
    """``file:/x``, as Hadoop writes it, as ``file:///x``."""
    return re.sub(r"^file:/(?!/)", "file:///", path)


def _chunks(batch: pa.RecordBatch, limit: int = 1 << 22) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of a batch whose texts have about ``limit`` bytes together."""
    texts = [x.as_py() or b"" for x in batch["text"].cast(pa.binary())]
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit or i + 1 == len(texts):
            yield batch.slice(start, i + 1 - start), texts[start:i + 1]
            start, size = i + 1, 0


_PARTS = "part int, name string, width int, docs long, null_ids long, tokens long"


_COLUMNS = [tuple(c.split()) for c in _PARTS.split(", ")]
_KINDS = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}


def write(docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID, parts: int | None = None) -> DataFrame:
    """Write ``docs`` (doc_id, text) as a data set under ``folder``; returns its index table.

    ``parts``: number of files, the session's shuffle partitions by default."""
    spark = docs.sparkSession
    folder = _uri(folder)
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex[:12]}"
        enc = encoder(vocabulary)
        end = np.array([end_id], enc.dtype).tobytes()
        fs, path = _store(folder)
        lengths, doc_ids, nulls = [], [], 0
        stream = None
        for batch in batches:
            for rows, texts in _chunks(batch):
                ids = enc.encode(texts)
                if stream is None:
                    fs.create_dir(path, recursive=True)
                    stream = fs.open_output_stream(f"{path}/{name}.ids")
                stream.write(b"".join([x + end for x in ids]))
                doc_ids.append(rows["doc_id"].fill_null(0).to_numpy().astype("<i8"))
                nulls += rows["doc_id"].null_count
                lengths.append(np.fromiter((len(x) for x in ids), np.int64, len(ids)) // enc.dtype.itemsize + 1)
        if stream is None:
            return
        stream.close()
        ends = np.cumsum(np.concatenate(lengths))
        with fs.open_output_stream(f"{path}/{name}.len") as f:  # offsets within the part; the base comes later
            f.write(np.concatenate([[0], ends]).astype("<u8").tobytes())
        with fs.open_output_stream(f"{path}/{name}.doc") as f:
            f.write(np.concatenate(doc_ids).tobytes())
        row = {"part": part, "name": name, "width": enc.dtype.itemsize, "docs": len(ends), "null_ids": nulls, "tokens": int(ends[-1])}
        yield pa.RecordBatch.from_arrays([pa.array([row[c]], _KINDS[kind]) for c, kind in _COLUMNS], names=[c for c, _ in _COLUMNS])

    # the hash only tells documents with the same id apart, should there be very many of them
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
               .repartitionByRange(n, "doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text"))
    written = common.stored(ordered.mapInArrow(write_part, _PARTS), "token-parts")
    # bases: prefix sums over one row per part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    index = written.select("*", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))

    def write_offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                local = np.frombuffer(_whole(fs, f"{path}/{row['name']}.len"), "<u8")
                temporary = f"{path}/.{row['name']}-{uuid.uuid4().hex[:8]}"
                with fs.open_output_stream(temporary) as f:
                    f.write((local + np.uint64(row["base"])).astype("<u8").tobytes())
                fs.move(temporary, f"{path}/{row['name']}.off")  # the same bytes whichever task is last
            yield batch

    spread = index.repartitionByRange(n, "part")
    done = spread.mapInArrow(write_offsets, spread.schema)
    done.write.mode("overwrite").parquet(f"{folder}/index")
    common.discard(written)
    return spark.read.schema(spread.schema).parquet(f"{folder}/index")


def _whole(fs: pafs.FileSystem, path: str):
    """A file's bytes: mapped where the store is a local or mounted file system, else read."""
    if isinstance(fs, pafs.LocalFileSystem):
        return pa.memory_map(path).read_buffer() if os.path.getsize(path) else b""
    with fs.open_input_file(path) as f:
        return f.read_buffer()


class Part:
    """One part of a data set, its documents by place."""

    def __init__(self, folder: str, row: dict):
        fs, path = _store(_uri(folder))
        load = lambda kind, dtype: np.frombuffer(_whole(fs, f"{path}/{row['name']}.{kind}"), dtype)
        self.offsets, self.ids, self.doc_ids = load("off", "<u8"), load("ids", f"<u{row['width']}"), load("doc", "<i8")
        self.null_ids = row["null_ids"]

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def __getitem__(self, i: int) -> np.ndarray:
        first = self.offsets[0]
        return self.ids[self.offsets[i] - first:self.offsets[i + 1] - first]


def read(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document of a data set, from its files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                part = Part(folder, row)
                crc = [zlib.crc32(part[i].astype("<u4").tobytes()) for i in range(len(part))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.doc_ids, mask=np.arange(len(part)) < part.null_ids), pa.array(part.offsets[:-1].astype(np.int64)),
                     pa.array(np.diff(part.offsets).astype(np.int64)), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = index.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "part")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    return read(spark, folder, write(common.documents(spark, sf_dir), folder, public_vocabulary()))
