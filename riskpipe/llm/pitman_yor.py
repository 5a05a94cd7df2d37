"""Operator 8: language-model scores from a hierarchical Pitman-Yor model.

Tokens are a text's words and one end.  The restaurant of a context (the whole previous
token, by its 64-bit hash) seats the tokens that follow it; its new
tables send customers to one restaurant that all contexts share, whose new tables come
from a uniform base over the known words and one unknown.  With counts c, tables t,
discount d, strength s and the parent's probability P of the token,

    P(token | context) = (c - d t + (s + d T) P) / (s + C).

Seating is sampled by Gibbs sweeps.  Given the tables of the others, the number of tables
of one token in one context has the distribution that seating its customers one after the
other gives, with a new table in proportion to a = (s + d T) P.  A sweep draws all of them
anew from the totals of the sweep before (blocked sampling), and those of the shared
restaurant from the new tables.  Draws are hashes of context, token, sweep and customer, so
a task that runs again seats alike, and no seating is stored: a pass repeats the sweeps
before it from their totals.  Beyond ``EXACT`` customers of a token in a context, customers
are seated in groups of a sixteenth of those present, new tables in expectation with a
random remainder.  Scores use the mean of the predictive probabilities of the sweeps after
``BURN_IN``.

Layout.  The corpus is packed once, by blocks of documents, into tokens per shard; all
occurrences of a word fall into one shard, where its counts are complete.  Words so frequent
that they would weigh on a shard are spread by context, and pairs that frequent by block;
the totals of those (at most a few per shard) are summed on the driver and sent to every task.
The customers and tables of the contexts grow with the vocabulary and stay in tables: after a
sweep each shard sends one sum for each of its contexts to the range of hashes that the context
falls into, which adds them up and answers each shard, and the next pass joins the answers to
the shards.  A frequent context is so at most one number a shard.
A document's score is the sum of what the shards found for it, gathered by block.

Defined results: a null or empty text is the end alone; documents without an id belong to the
training texts; rows are scored each for itself.  Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpipe.llm import common, labelled, wordhash

STRENGTH = (1.0, 1.0)     # of the context restaurants and of the shared one
SWEEPS, BURN_IN = 3, 1
EXACT = 64
BLOCK_BYTES, BLOCK_DOCS = 1 << 22, 1 << 14
HASHED_BYTES = 1 << 18    # of a block's texts that are hashed at once
HOT = 4                   # a word or pair is spread from 1/HOT of a shard's share on

_U = np.uint64
END, BEGIN = _U(0x8F1BBCDCCA62C1D6), _U(0xFFFFFFFFFFFFFFFF)  # BEGIN: the context of a first token, last in order


def _u(x: int) -> np.uint64:
    return _U(x & 0xFFFFFFFFFFFFFFFF)


def _pack(*arrays) -> bytes:
    data = pickle.dumps(arrays, protocol=5)
    return len(data).to_bytes(8, "little") + pa.Codec("zstd").compress(data, asbytes=True)


def _unpack(data: bytes) -> tuple:
    return pickle.loads(pa.Codec("zstd").decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), asbytes=True))


def _small(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))


def _planes(x: np.ndarray) -> np.ndarray:
    """Sorted hashes as the bytes of their differences, by place: high places are mostly 0."""
    return np.ascontiguousarray(np.diff(x, prepend=_U(0)).view(np.uint8).reshape(-1, 8).T)


def _sorted(planes: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(planes.reshape(8, -1).T).view(_U).ravel(), dtype=_U)


def _raw(x: np.ndarray) -> bytes:
    """Numbers with the letter of their type before them; whole ones as small as they can be."""
    whole = np.rint(x).astype(np.int64)
    x = _small(whole) if (whole == x).all() else x.astype(np.float64)
    return x.dtype.char.encode() + x.tobytes()


def _numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, chr(data[0]), offset=1).astype(np.float64)


# -- blocks and shards ------------------------------------------------------------------------


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the texts and the number per text, made for about ``HASHED_BYTES`` at a time: hashing takes
    some 40 bytes of memory for each byte of text, which a worker keeps afterwards."""
    found, start, size = [], 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= HASHED_BYTES or i + 1 == len(texts):
            w = wordhash.words(texts[start:i + 1])
            found.append((w.hash, w.per_doc()))
            start, size = i + 1, 0
    return np.concatenate([h for h, _ in found]), np.concatenate([n for _, n in found])


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes (words, then END), the token before (BEGIN at the start), and the number per text."""
    hashes, per = _word_hashes(texts)
    n = per + 1
    last = np.cumsum(n) - 1
    tok = np.empty(int(n.sum()), _U)
    tok[np.arange(len(hashes)) + np.repeat(np.arange(len(per)), per)] = hashes
    tok[last] = END
    ctx = np.empty(len(tok), _U)
    ctx[1:] = tok[:-1]
    ctx[np.concatenate([[0], last[:-1] + 1])] = BEGIN
    return tok, ctx, n


def pair_hash(tok: np.ndarray, ctx: np.ndarray) -> np.ndarray:
    return wordhash.mix(tok + wordhash.mix(ctx.astype(_U) + _U(17)))


@dataclass
class Block:
    """Distinct tokens, and contexts (BEGIN after them); pairs (token, context) in their order, by their places there;
    entries (pair, text) with the times the text has the pair."""
    words: np.ndarray
    contexts: np.ndarray
    word: np.ndarray
    ctx: np.ndarray
    entry_pair: np.ndarray
    entry_doc: np.ndarray
    times: np.ndarray
    n: np.ndarray


def block(texts: list[bytes]) -> Block:
    tok, ctx, n = tokens(texts)
    words, at = np.unique(tok, return_inverse=True)
    before = np.concatenate([[len(words)], at[:-1]])
    before[ctx == BEGIN] = len(words)
    doc = np.repeat(np.arange(len(texts), dtype=np.int64), n)
    doc_bits, ctx_bits = len(texts).bit_length(), len(words).bit_length()
    key = np.sort((at.astype(np.int64) << (ctx_bits + doc_bits)) | (before << doc_bits) | doc)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    entry = key[first]
    pair = entry >> doc_bits
    new = np.concatenate([[True], pair[1:] != pair[:-1]])
    pairs = pair[new]
    return Block(words, np.concatenate([words, [BEGIN]]), pairs >> ctx_bits, pairs & ((1 << ctx_bits) - 1), np.cumsum(new) - 1,
                 entry & ((1 << doc_bits) - 1), np.diff(np.concatenate([first, [len(key)]])), n)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, list[bytes]]]:
    """Numbered blocks of one task: a rerun of the task makes the same."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for at in range(0, len(batch), BLOCK_DOCS):
            for rows, texts in wordhash.chunks(batch.slice(at, BLOCK_DOCS), limit=BLOCK_BYTES):
                yield number, rows, texts
                number += 1


@dataclass
class Hot:
    """Sorted hashes of the tokens and pairs that are spread over shards."""
    words: np.ndarray
    pairs: np.ndarray


def _is_in(x: np.ndarray, of: np.ndarray) -> np.ndarray:
    if not len(of):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(of, x), len(of) - 1)
    return of[at] == x


def frequent(docs: DataFrame, shards: int) -> Hot:
    """Tokens and pairs with more than about 1/HOT of a shard's share: at most HOT * shards of each reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, texts in _blocks(batches):
            b = block(texts)
            times = np.bincount(b.entry_pair, weights=b.times).astype(np.int64)
            by_word = np.bincount(b.word, weights=times).astype(np.int64)
            least = max(2, times.sum() // (2 * HOT * shards))
            w, p = np.flatnonzero(by_word >= least), np.flatnonzero(times >= least)
            kind = np.concatenate([np.zeros(1), np.ones(len(w)), np.full(len(p), 2)]).astype(np.int32)
            value = np.concatenate([np.zeros(1, _U), b.words[w], pair_hash(b.words[b.word[p]], b.contexts[b.ctx[p]])])
            count = np.concatenate([[times.sum()], by_word[w], times[p]])
            yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(value.view(np.int64)), pa.array(count.astype(np.int64))], names=["kind", "value", "n"])

    found = docs.select("doc_id", "text").mapInArrow(run, "kind int, value long, n long").groupBy("kind", "value").agg(F.sum("n").alias("n"))
    found = common.stored(found, "frequent")
    total = found.where("kind = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).collect()[0][0]
    got = found.where(f"kind > 0 AND n * {HOT * shards} >= {total}").toArrow()
    kind, value = got["kind"].to_numpy(), got["value"].to_numpy().view(_U)
    return Hot(np.sort(value[kind == 1]), np.sort(value[kind == 2]))


def spread_keys(spark: SparkSession, n: int) -> list[int]:
    """n integers of which each falls into another of n partitions."""
    rows = spark.range(n * 20 + 100).select(F.col("id").cast("int").alias("k"), F.pmod(F.hash(F.col("id").cast("int")), F.lit(n)).alias("p"))
    found = {r["p"]: r["k"] for r in rows.groupBy("p").agg(F.min("k").alias("k")).collect()}
    spare = iter(range(n * 20 + 100, n * 21 + 200))
    return [found[p] if p in found else next(spare) for p in range(n)]


_SHARD = "shard int, block long, pairs binary, entries binary, docs binary"


def sharded(docs: DataFrame, held_out, shards: int, hot: Hot) -> DataFrame:
    """One row per shard (pairs, entries), and one per block (docs), stored."""
    keys = np.array(spread_keys(docs.sparkSession, shards))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows, texts in _blocks(batches):
            b = block(texts)
            train = ~rows["held_out"].to_numpy(zero_copy_only=False)
            words = b.words[b.word]
            pairs = pair_hash(words, b.contexts[b.ctx])
            counts = np.bincount(b.entry_pair, weights=b.times * train[b.entry_doc], minlength=len(pairs)).astype(np.int64)
            entries = np.bincount(b.entry_pair, minlength=len(pairs))
            shard_hash = wordhash.mix(words + _U(5))
            spread = _is_in(words, hot.words)
            shard_hash[spread] = wordhash.mix(pairs[spread] + _U(5))
            spread = _is_in(pairs, hot.pairs)
            shard_hash[spread] = wordhash.mix(pairs[spread] + _u(number * 0x9E3779B97F4A7C15 + 5))
            to = (shard_hash % _U(shards)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            bounds = np.searchsorted(to[order], np.arange(shards + 1))
            starts = np.cumsum(entries) - entries
            out_key, out_blob = [], []
            for s in np.flatnonzero(np.diff(bounds)):
                p = order[bounds[s]:bounds[s + 1]]
                e = np.repeat(starts[p] - (np.cumsum(entries[p]) - entries[p]), entries[p]) + np.arange(int(entries[p].sum()))
                u, per = np.unique(b.word[p], return_counts=True)
                c, ctx = np.unique(b.ctx[p], return_inverse=True)
                out_key.append(int(keys[s]))
                out_blob.append(_pack(_planes(b.words[u]), _small(per), _planes(b.contexts[c]), _small(ctx), _small(counts[p]), _small(entries[p]),
                                      b.entry_doc[e].astype(np.uint16), _small(b.times[e])))
            ids = rows["doc_id"]
            about = _pack(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), ~train, b.n)
            none = pa.nulls(len(out_key), pa.binary())
            yield _shard_rows(out_key, [number] * len(out_key), out_blob, none, none)
            yield _shard_rows([int(keys[number % shards])], [number], pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), [about])

    def merge(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        order = np.argsort(table["block"].to_numpy(), kind="stable")
        of_shard = [(table["block"][int(i)].as_py(), _unpack(x)) for i in order if (x := table["pairs"][int(i)].as_py()) is not None]
        out = [(table["block"][int(i)].as_py(), x) for i in order if (x := table["docs"][int(i)].as_py()) is not None]
        rows = _shard_rows([shard] * len(out), [b for b, _ in out], *[pa.nulls(len(out), pa.binary())] * 2, [x for _, x in out])
        if not of_shard:
            return pa.Table.from_batches([rows])
        word = np.concatenate([np.repeat(_sorted(x[0]), x[1]) for _, x in of_shard])
        count = np.concatenate([x[4].astype(np.int64) for _, x in of_shard])
        words, at = np.unique(word, return_inverse=True)
        contexts, ctx = np.unique(np.concatenate([_sorted(x[2])[x[3]] for _, x in of_shard]), return_inverse=True)
        bits = len(contexts).bit_length()
        pairs, gid = np.unique((at.astype(np.int64) << bits) | ctx, return_inverse=True)
        per = np.bincount(pairs >> bits, minlength=len(words))
        merged = _pack(shard, _planes(words), _small(per), _planes(contexts), _small(pairs & ((1 << bits) - 1)),
                       _small(np.bincount(gid, weights=count).astype(np.int64)))
        entries, done = [], 0
        for number, x in of_shard:
            g = gid[done:done + len(x[3])]
            done += len(x[3])
            entries.append((number, _small(np.diff(g, prepend=0)), x[5], x[6], x[7]))
        one = _shard_rows([shard], [-1], [merged], [_pack(entries)], pa.nulls(1, pa.binary()))
        return pa.Table.from_batches([one, rows])

    df = docs.select("doc_id", "text", held_out.alias("held_out")).mapInArrow(pack, _SHARD)
    return common.stored(df.groupBy("shard").applyInArrow(merge, _SHARD), "shards")


def _shard_rows(shard, number, pairs, entries, about) -> pa.RecordBatch:
    binary = lambda x: x if isinstance(x, pa.Array) else pa.array(x, pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(number, pa.int64()), binary(pairs), binary(entries), binary(about)],
                                      names=["shard", "block", "pairs", "entries", "docs"])


# -- seating ----------------------------------------------------------------------------------


def _uniform(key: np.ndarray, sweep: int, step: int) -> np.ndarray:
    return (wordhash.mix(key ^ _u((sweep << 40) + step * 0x9E3779B97F4A7C15 + 1)) >> _U(11)) * (1 / (1 << 53))


def seat(c: np.ndarray, a: np.ndarray, d: float, key: np.ndarray, sweep: int) -> np.ndarray:
    """Tables of c customers that all eat the same, seated one after the other; a: weight of a new table."""
    t = np.minimum(c, 1).astype(np.float64)
    at = np.flatnonzero(c > 1)
    n = 1
    while len(at):
        group = 1 if n < EXACT else n // 16
        full = c[at] - n
        size = np.minimum(full, group)
        share = a[at] / (a[at] + n + (size - 1) / 2 - d * t[at])
        t[at] += np.floor(size * share + _uniform(key[at], sweep, n)) if group > 1 else _uniform(key[at], sweep, n) < share
        n += group
        at = at[c[at] > n]
    return np.minimum(t, c)


@dataclass
class ByContext:
    """A number for each context, in a table: what each shard was told about its contexts, by ranges of their hashes."""
    table: DataFrame
    shards: DataFrame

    def __getstate__(self):
        return {}  # a task gets the numbers of its shard joined

    def of(self, shard: int) -> np.ndarray:
        rows = self.table.where(f"shard = {shard}").select("k", "x").collect()
        return np.concatenate([_numbers(bytes(r.x)) for r in sorted(rows)])

    def __getitem__(self, context) -> float:
        def run(sh: Shard, _) -> pa.Table:
            return pa.table({"x": sh.told[0][sh.contexts == _u(int(context))]})

        row = _joined(self.shards, State(), [self], run, "x double").first()
        return row.x if row else 0.0


@dataclass
class Sweep:
    """Totals of one sweep: tables by context; customers and tables of the shared restaurant; customers of spread tokens."""
    tables: ByContext
    customers: float
    shared: float
    spread: np.ndarray


@dataclass
class State:
    hot: Hot = field(default_factory=lambda: Hot(np.zeros(0, _U), np.zeros(0, _U)))
    customers: ByContext | None = None        # by context
    n: int = 0
    v: int = 0
    discount: tuple[float, float] = (0.5, 0.5)
    word_counts: np.ndarray = field(default_factory=lambda: np.zeros(0))       # of spread tokens
    pair_counts: np.ndarray = field(default_factory=lambda: np.zeros(0))       # of spread pairs
    sweeps: list[Sweep] = field(default_factory=list)
    keys: list[int] = field(default_factory=list)                              # of the ranges of context hashes

    @property
    def told(self) -> list[ByContext]:
        """What shards are told about their contexts: customers, then tables by sweep."""
        return [self.customers, *(x.tables for x in self.sweeps)] if self.customers else []

    @property
    def base(self) -> float:
        return 1 / (self.v + 1)


class Shard:
    """The pairs of one shard, and what a state makes of them."""

    def __init__(self, data: bytes, state: State, told: list[np.ndarray] | None = None):
        self.number, words, per, contexts, at, count = _unpack(data)
        self.s = state
        self.words, self.contexts = _sorted(words), _sorted(contexts)
        self.told = [x.of(self.number) for x in state.told] if told is None else told
        self.at = at.astype(np.int64)
        self.ctx = self.contexts[self.at]
        self.local = count.astype(np.float64)
        self.word = np.repeat(np.arange(len(per)), per.astype(np.int64))
        self.pair = pair_hash(self.words[self.word], self.ctx)
        self.hot_word = _is_in(self.words, state.hot.words)
        self.hot_pair = _is_in(self.pair, state.hot.pairs)
        self.count = self.local.copy()
        if len(state.pair_counts):
            self.count[self.hot_pair] = state.pair_counts[np.searchsorted(state.hot.pairs, self.pair[self.hot_pair])]
        self.word_count = np.bincount(self.word, weights=self.local, minlength=len(self.words))
        if len(state.word_counts):
            self.word_count[self.hot_word] = state.word_counts[np.searchsorted(state.hot.words, self.words[self.hot_word])]

    def tables(self, sweep: int) -> np.ndarray:
        """Tables of each pair's context."""
        return self.told[1 + sweep][self.at]

    def own(self) -> np.ndarray:
        """Pairs that this shard answers for: spread pairs belong to the shard that their hash gives, as a share each."""
        return np.where(self.hot_pair & (self.count > 0), self.local / np.maximum(self.count, 1), 1.0)

    def parent(self, sweep: int, m: np.ndarray) -> np.ndarray:
        """The shared restaurant's probability of each token, from its customers m, in a finished sweep."""
        s, x = self.s, self.s.sweeps[sweep]
        d = s.discount[1]
        return (m - d * self._shared(sweep, m) + (STRENGTH[1] + d * x.shared) * s.base) / (STRENGTH[1] + x.customers)

    def _shared(self, sweep: int, m: np.ndarray) -> np.ndarray:
        """Tables of each token in the shared restaurant."""
        s = self.s
        if sweep == 0:
            return np.minimum(m, 1)
        a = (STRENGTH[1] + s.discount[1] * s.sweeps[sweep - 1].shared) * s.base
        return seat(np.rint(m), np.full(len(m), a), s.discount[1], wordhash.mix(self.words + _U(3)), sweep)

    def customers(self, sweep: int, t: np.ndarray) -> np.ndarray:
        """Customers that the contexts send to the shared restaurant for each token."""
        m = np.bincount(self.word, weights=t * self.own(), minlength=len(self.words))
        done = self.s.sweeps[sweep].spread if sweep < len(self.s.sweeps) else None
        if done is not None and len(done):
            m[self.hot_word] = done[np.searchsorted(self.s.hot.words, self.words[self.hot_word])]
        return m

    def chain(self, upto: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
        """Tables by pair, customers and probabilities by token of sweeps 0 to ``upto``; the last has no probabilities
        if its totals are not known yet."""
        s, d = self.s, self.s.discount[0]
        t = np.minimum(self.count, 1)
        for i in range(upto + 1):
            if i:
                a = (STRENGTH[0] + d * self.tables(i - 1)) * p[self.word]  # noqa: F821
                t = seat(self.count, a, d, self.pair, i)
            m = self.customers(i, t)
            p = self.parent(i, m) if i < len(s.sweeps) else None
            yield t, m, p


_TOTAL = "kind int, value long, x double"
_SHARED, _SPREAD, _COUNTS, _PAIRS = range(4)
_SENT = "key int, k int, shard int, contexts binary, x binary, sums binary"
_TOLD = "k int, shard int, x binary, sums binary"


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    cols = list(zip(*rows, strict=True)) or [[]] * (schema.count(",") + 1)
    return pa.table({(f := c.split())[0]: pa.array(x, kinds[f[1]]) for c, x in zip(schema.split(", "), cols, strict=True)})


def _joined(shards: DataFrame, state: State, told: list[ByContext], run, schema: str, entries: bool = False) -> DataFrame:
    """``run(Shard, entries)`` of every shard, with what it was told about its contexts."""
    shared = shards.sparkSession.sparkContext.broadcast(state)
    none = F.lit(None).cast("binary").alias("entries")
    parts = shards.where("pairs IS NOT NULL").select("shard", F.lit(-1).alias("number"), F.lit(0).alias("k"), F.col("pairs").alias("data"), F.col("entries") if entries else none)
    for i, x in enumerate(told):
        parts = parts.unionByName(x.table.where("shard IS NOT NULL").select("shard", F.lit(i).alias("number"), "k", F.col("x").alias("data"), none))

    def task(table: pa.Table) -> pa.Table:
        number, data = table["number"].to_numpy(), table["data"]
        order = np.lexsort([table["k"].to_numpy(), number])
        got = [np.concatenate([_numbers(data[int(j)].as_py()) for j in order if number[j] == i]) for i in range(len(told))]
        first = int(order[0])
        return run(Shard(data[first].as_py(), shared.value, got), table["entries"][first].as_py())

    return parts.groupBy("shard").applyInArrow(task, schema)


def _exchanged(shards: DataFrame, state: State, run) -> tuple[ByContext, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """``run(Shard)`` gives a number for each context of the shard and (kind, x) arrays bounded by the spread lists:
    the sums over shards of the former in a table, of the latter here."""
    spark, keys = shards.sparkSession, state.keys
    starts = np.array([-(-k * (1 << 64) // len(keys)) for k in range(len(keys))], _U)  # of the ranges of hashes

    def send(sh: Shard, _) -> pa.Table:
        by_context, sums = run(sh)
        bounds = np.append(np.searchsorted(sh.contexts, starts), len(sh.contexts))
        rows = [(keys[k], k, sh.number, _planes(sh.contexts[bounds[k]:bounds[k + 1]]).tobytes(), _raw(by_context[bounds[k]:bounds[k + 1]]), None)
                for k in np.flatnonzero(np.diff(bounds)).tolist()]
        found = [(kind, at := np.flatnonzero(x), x[at]) for kind, x in sums]
        return _table(_SENT, [*rows, (keys[sh.number % len(keys)], None, None, None, None, _pack(*found))])

    def answer(table: pa.Table) -> pa.Table:
        sums = [(None, None, None, x.as_py()) for x in table["sums"] if x.is_valid]
        sent = [r for r in zip(*[table[c].to_pylist() for c in ("k", "shard", "contexts", "x")], strict=True) if r[0] is not None]
        if not sent:
            return _table(_TOLD, sums)
        contexts = [_sorted(np.frombuffer(c, np.uint8)) for _, _, c, _ in sent]
        _, at = np.unique(np.concatenate(contexts), return_inverse=True)
        # whole numbers, or shares that add up to such; the order of the rows does not show
        total = np.rint(np.bincount(at, weights=np.concatenate([_numbers(x) for *_, x in sent])))[at]
        ends = np.cumsum([len(c) for c in contexts])
        return _table(_TOLD, [*sums, *((k, shard, _raw(total[e - len(c):e]), None) for (k, shard, _, _), c, e in zip(sent, contexts, ends, strict=True))])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch["sums"]:
                for kind, value, x in _unpack(data.as_py()):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(value), kind, np.int32)), pa.array(value.astype(np.int64)), pa.array(x.astype(np.float64))], names=["kind", "value", "x"])

    table = common.stored(_joined(shards, state, state.told, send, _SENT).groupBy("key").applyInArrow(answer, _TOLD), "contexts")
    got = table.where("sums IS NOT NULL").select("sums").mapInArrow(unpack, _TOTAL).groupBy("kind", "value").agg(F.sum("x").alias("x")).toArrow()
    spark._jvm.System.gc()  # so that Spark deletes the shuffled files of this pass
    kind, value, x = (got[c].to_numpy() for c in ("kind", "value", "x"))
    return ByContext(table, shards), {k: (value[kind == k], np.round(x[kind == k], 6)) for k in range(4)}


def _dense(got: tuple[np.ndarray, np.ndarray], size: int) -> np.ndarray:
    out = np.zeros(size)
    out[got[0]] = got[1]
    return out


def count(shards: DataFrame, hot: Hot) -> State:
    """Counts, sizes and discounts (from the numbers of pairs and tokens met once and twice)."""
    spark = shards.sparkSession
    state = State(hot, keys=spread_keys(spark, int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def local(sh: Shard):
        cold = ~sh.hot_word
        w = np.bincount(sh.word, weights=sh.local, minlength=len(sh.words))
        cp = sh.local[~sh.hot_pair]
        pairs_of = np.bincount(sh.word, weights=sh.local > 0, minlength=len(sh.words))[cold]
        return np.bincount(sh.at, weights=sh.local, minlength=len(sh.contexts)), [
            (_COUNTS, np.array([sh.local.sum(), (w[cold] > 0).sum(), (cp == 1).sum(), (cp == 2).sum(), 0, 0], float)),
            (_SHARED, np.array([(pairs_of == 1).sum(), (pairs_of == 2).sum()], float)),
            (_SPREAD, np.bincount(np.searchsorted(hot.words, sh.words[sh.hot_word]), weights=w[sh.hot_word], minlength=len(hot.words))),
            (_PAIRS, np.bincount(np.searchsorted(hot.pairs, sh.pair[sh.hot_pair]), weights=sh.local[sh.hot_pair], minlength=len(hot.pairs)))]

    state.customers, got = _exchanged(shards, state, local)
    counts, once = _dense(got[_COUNTS], 6), _dense(got[_SHARED], 2)
    state.word_counts, state.pair_counts = _dense(got[_SPREAD], len(hot.words)), _dense(got[_PAIRS], len(hot.pairs))
    state.n = int(counts[0])
    state.v = int(counts[1] + (state.word_counts > 0).sum())
    rate = lambda n1, n2: float(np.clip(n1 / (n1 + 2 * n2), 0.1, 0.95)) if n1 + n2 else 0.5
    state.discount = rate(counts[2], counts[3]), rate(*once)
    return state


def sweep(shards: DataFrame, state: State) -> Sweep:
    """The totals of the next sweep."""
    i = len(state.sweeps)
    hot = state.hot

    def tables(sh: Shard):
        *_, (t, m, _) = sh.chain(i)
        cold = ~sh.hot_word
        return np.bincount(sh.at, weights=t * sh.own(), minlength=len(sh.contexts)), [
            (_SHARED, np.array([m[cold].sum(), sh._shared(i, m)[cold].sum()])),
            (_SPREAD, np.bincount(np.searchsorted(hot.words, sh.words[sh.hot_word]), weights=m[sh.hot_word], minlength=len(hot.words)))]

    by_context, got = _exchanged(shards, state, tables)
    spread = _dense(got[_SPREAD], len(hot.words))
    cold = _dense(got[_SHARED], 2)
    a = (STRENGTH[1] + state.discount[1] * state.sweeps[i - 1].shared) * state.base if i else 0.0
    own = seat(np.rint(spread), np.full(len(spread), a), state.discount[1], wordhash.mix(hot.words + _U(3)), i) if i else np.minimum(spread, 1)
    return Sweep(by_context, float(cold[0] + spread.sum()), float(cold[1] + own.sum()), spread)


def fit(shards: DataFrame, hot: Hot, sweeps: int = SWEEPS) -> State:
    state = count(shards, hot)
    for _ in range(sweeps + 1):  # the first is the least seating: a table for each token in each context
        state.sweeps.append(sweep(shards, state))
    return state


# -- scores -----------------------------------------------------------------------------------


def predictive(sh: Shard, burn_in: int = BURN_IN) -> np.ndarray:
    """Mean over the sweeps after ``burn_in`` of each pair's probability."""
    s, d = sh.s, sh.s.discount[0]
    total, used = np.zeros(len(sh.ctx)), 0
    for i, (t, _, p) in enumerate(sh.chain(len(s.sweeps) - 1)):
        if i > burn_in or len(s.sweeps) <= burn_in + 1:
            total += (sh.count - d * t + (STRENGTH[0] + d * sh.tables(i)) * p[sh.word]) / (STRENGTH[0] + sh.told[0][sh.at])
            used += 1
    return total / used


_RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


_PARTS = "block long, part binary, docs binary"


def scores(shards: DataFrame, state: State) -> DataFrame:
    """One row per document of the shards' blocks."""
    shared = shards.sparkSession.sparkContext.broadcast(state)

    def partial(sh: Shard, entries: bytes) -> pa.Table:
        model, base = np.log10(predictive(sh)), np.log10(sh.word_count + 1)[sh.word]
        known = (sh.word_count > 0)[sh.word]
        out = []
        for number, step, per, doc, times in _unpack(entries)[0]:
            g = np.repeat(np.cumsum(step.astype(np.int64)), per)
            doc = doc.astype(np.int64)
            sums = [np.bincount(doc, weights=x[g] * times) for x in (known, base, model)]
            at = np.flatnonzero(np.bincount(doc))
            out.append((number, _pack(at.astype(np.uint16), _small(sums[0][at].astype(np.int64)), sums[1][at], sums[2][at]), None))
        return _table(_PARTS, out)

    def gather(table: pa.Table) -> pa.Table:
        s = shared.value
        ids, null, held, n = next(_unpack(x.as_py()) for x in table["docs"] if x.is_valid)
        sums = np.zeros((3, len(ids)))
        parts = sorted(x.as_py() for x in table["part"] if x.is_valid)  # one order, so a rerun adds alike
        for data in parts:
            at, *found = _unpack(data)
            for row, x in zip(sums, found, strict=True):
                row[at] += x
        base = sums[1] - n * np.log10(s.n + s.v + 1)
        return pa.table([pa.array(ids, pa.int64(), mask=null), pa.array(held), pa.array(n, pa.int64()), pa.array(np.rint(sums[0]).astype(np.int64)),
                         pa.array(np.full(len(ids), s.n, np.int64)), pa.array(base), pa.array(sums[2])], names=[c.split()[0] for c in _RESULT.split(", ")])

    parts = _joined(shards, state, state.told, partial, _PARTS, entries=True)
    docs = shards.where("docs IS NOT NULL").select("block", F.lit(None).cast("binary").alias("part"), "docs")
    return parts.unionByName(docs).groupBy("block").applyInArrow(gather, _RESULT)


def op8_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = frequent(docs, n)
    shards = sharded(docs, labelled.crc(F.col("doc_id")) % 7 == 2, n, hot)
    out = scores(shards, fit(shards, hot))
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
