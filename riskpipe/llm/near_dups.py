"""Operator 10: near-duplicate documents by fast similarity sketches.

A document's set is its distinct 3-word shingles.  Its sketch has ``T`` coordinates,
filled in rounds: in each of the first T rounds every shingle is hashed to a bin and a
value, a bin keeps the least (round, value), and the rounds end when all bins are filled;
T further rounds would each fill one given bin, so none ever stays empty.  Coordinates of
two sketches agree with probability the Jaccard similarity, concentrated as if they were
independent.  Sets of at least 0.85 similarity share one of ``BANDS`` bands of ``ROWS``
coordinates except with probability 4e-7.

Links are confirmed on the full sets.  What must not happen is that a group of thousands
of near copies meets pair by pair, so candidates come in rounds:

1. texts with equal sets are one class, by the set's digest (partial aggregation);
2. each class is compared with one partner, of the smallest members of its buckets (a
   bucket is a band's value that two classes share) the one it meets most often;
3. links are joined into components (least label, with pointer jumping), each link read once:
   later rounds go over the pairs of components that the new links join;
4. in buckets that still hold several components, every class outside the bucket's
   largest component is compared with its nearest partners in other components, nearest by
   a finer sketch: first ``PARTNERS[0]`` of them, then more, at last all whose sketch does not
   rule a link out (a wrong exclusion has probability about 1e-6).  Buckets of one component
   are done: what is linked needs no more links.

Step 4 ends when a round left no partner out, so no link between different texts that
share a bucket is lost.  Large buckets are cut into blocks of ``BLOCK`` classes, so a task
compares a block with the few classes left over, whatever the bucket's size.  All tables
between the steps are written to the shared scratch folder; the driver sees counts only.

Defined results: a document without words has an empty set and is its own component.  Rows that
share an id but not the text are documents of their own, equal rows get equal results.  Rows
without an id take part like others and get the smallest id of their component, or none, and
are kept if there is none.  Texts are read whole whatever their length.  The stage
(``one_of_each``) leaves one row of each component, of several with the smallest id too; rows
without words and id all stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskpipe.llm import common, wordhash

#: Fixed by the contract.
SHINGLE, LINK_PERCENT = 3, 85
BANDS, ROWS = 25, 5
T = BANDS * ROWS
FINE = 1024  # coordinates, of a byte each, of the sketch that rules pairs out
PARTNERS = (4, 32, 1 << 30)
BLOCK = 2048
HASHED_BYTES = 1 << 18  # of texts that are hashed at once: it takes some 40 bytes a byte, which a worker keeps afterwards
SIGMAS = 4.75  # how far below the link a sketch may estimate and still be compared
FEW = 1_000_000  # rows of keys (24 bytes each) that are still broadcast to the texts; more are joined by a shuffle


# -- sets and sketches --------------------------------------------------------------------------


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of the texts, sorted, text after text, and the end of each text's."""
    w = wordhash.words(texts)
    h, n = w.hash, w.per_doc()
    joined = np.zeros(max(len(h) - size + 1, 0), np.uint64)
    for k in range(size):
        joined = wordhash.mix(joined * np.uint64(3) + h[k:len(h) - size + 1 + k]) if len(joined) else joined
    same = w.doc[:len(joined)] == w.doc[size - 1:] if len(joined) else np.zeros(0, bool)
    doc, value = w.doc[:len(joined)][same], joined[same]
    short = np.flatnonzero((n > 0) & (n < size))
    if len(short):
        first = np.cumsum(n) - n
        whole = []
        for d in short:
            x = np.full(1, np.uint64(n[d]))
            for y in h[first[d]:first[d] + n[d]]:
                x = wordhash.mix(x * np.uint64(3) + y)
            whole.append(x[0])
        doc, value = np.concatenate([doc, short]), np.concatenate([value, np.array(whole, np.uint64)])
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return value[new], np.cumsum(np.bincount(doc[new], minlength=len(texts)))


def sketches(values: np.ndarray, ends: np.ndarray, t: int = T) -> np.ndarray:
    """The fast similarity sketch of each set, one row a set; rows of empty sets are all ones."""
    n = len(ends)
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full((n, t), none)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(n), np.diff(ends, prepend=0))
    for i in range(2 * t):
        if not len(values):
            break
        h = wordhash.mix(values ^ wordhash.mix(np.full(1, np.uint64(i + 1)))[0])
        bins = (h % np.uint64(t)).astype(np.int64) if i < t else i - t
        np.minimum.at(flat, owner * t + bins, np.uint64(i) << np.uint64(56) | h >> np.uint64(8))
        open_ = (out == none).any(axis=1)[owner]
        if not open_.all():
            values, owner = values[open_], owner[open_]
    return out


def fine_bits(values: np.ndarray, ends: np.ndarray, at_once: int = 256) -> np.ndarray:
    """A byte of each coordinate of the fine sketches, made for a few sets at a time: they are large beside short texts."""
    starts = np.concatenate([[0], ends[:-1]])
    out = np.empty((len(ends), FINE), np.uint8)
    for i in range(0, len(ends), at_once):
        e = ends[i:i + at_once]
        out[i:i + at_once] = wordhash.mix(sketches(values[starts[i]:e[-1]], e - starts[i], FINE)) >> np.uint64(56)
    return out


def linked(a: np.ndarray, b: np.ndarray, percent: int = LINK_PERCENT) -> bool:
    """Whether two sorted sets have a Jaccard similarity of at least ``percent`` hundredths."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    both = int((a[at] == b).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in wordhash.chunks(batch, limit=HASHED_BYTES):
            values, ends = shingle_sets(texts)
            rows_of = sketches(values, ends)
            starts = np.concatenate([[0], ends[:-1]])
            digest = [hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() for a, b in zip(starts, ends, strict=True)]
            bands = np.zeros((len(texts), BANDS), np.uint64)
            for r in range(ROWS):
                bands = wordhash.mix(bands * np.uint64(3) + rows_of[:, r::ROWS])
            bands = wordhash.mix(bands + np.arange(BANDS, dtype=np.uint64))
            yield pa.RecordBatch.from_arrays(
                [rows["doc_id"], rows["text_key"], pa.array(np.diff(ends, prepend=0), pa.int64()), pa.array(digest, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * BANDS), pa.array(bands.view(np.int64).reshape(-1)))],
                names=["doc_id", "text_key", "n", "digest", "bands"])


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in wordhash.chunks(batch, limit=HASHED_BYTES):
            values, ends = shingle_sets(texts)
            bits = fine_bits(values, ends)
            yield pa.RecordBatch.from_arrays(
                [rows["rep"], pa.array([x.astype("<u8").tobytes() for x in np.split(values, ends[:-1])], pa.binary()),
                 pa.array([b.tobytes() for b in bits], pa.binary())], names=["rep", "shingles", "bits"])


def _confirm_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = [linked(np.frombuffer(x.as_py(), "<u8"), np.frombuffer(y.as_py(), "<u8")) for x, y in zip(batch["set_a"], batch["set_b"], strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


# -- links and components -----------------------------------------------------------------------


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are linked.

    The set of b joins first, then rows meet that of a: a class that many are compared with is the
    hot key of an inner join, which Spark splits."""
    b = sets.withColumnsRenamed({"rep": "b", "shingles": "set_b"})
    a = sets.withColumnsRenamed({"rep": "a", "shingles": "set_a"})
    return common.stored(pairs.join(b, "b").join(a, "a").select("a", "b", "set_a", "set_b").mapInArrow(_confirm_rows, "a long, b long"), "links")


def components(links: DataFrame, labels: DataFrame) -> DataFrame:
    """``labels`` (rep, comp) brought to the least comp that each rep reaches over ``links`` (a, b) as well.

    The links are read once, for the pairs of components that they join; what follows goes over these pairs, of which
    each round leaves fewer.  So links within a component, of earlier calls too, cost nothing any more."""
    ends = links.join(labels.toDF("a", "from"), "a").join(labels.toDF("b", "to"), "b").select("from", "to")
    while True:
        edges = ends.where("`from` != `to`").select(F.least("from", "to").alias("low"), F.greatest("from", "to").alias("high")).distinct()
        edges = common.stored(edges, "edges")
        # each component takes the least label that it meets
        moved = common.stored(edges.groupBy(F.col("high").alias("comp")).agg(F.min("low").alias("to")), "moves")
        if moved.isEmpty():
            return labels
        while True:  # where labels point at labels that move as well
            on = moved.select(F.col("comp").alias("to"), F.col("to").alias("next"))
            jumped = moved.join(on, "to", "left").select("comp", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("jumped"))
            jumped = common.stored(jumped, "moves")
            moved = jumped.select("comp", "to")
            if jumped.where("jumped").isEmpty():
                break
        labels = common.stored(labels.join(moved, "comp", "left").select("rep", F.coalesce("to", "comp").alias("comp")), "labels")
        low, high = moved.toDF("low", "low_to"), moved.toDF("high", "high_to")
        ends = edges.join(low, "low", "left").join(high, "high", "left").select(F.coalesce("low_to", "low").alias("from"), F.coalesce("high_to", "high").alias("to"))


def _partners(most: int):
    """For the rows of one block of a bucket: pairs of a left-over class with its ``most`` nearest in other components."""
    least = np.ceil(FINE * (LINK_PERCENT / 100 - SIGMAS * np.sqrt(LINK_PERCENT / 100 * (1 - LINK_PERCENT / 100) / FINE)))

    def run(group: pa.Table) -> pa.Table:
        rep, comp = group["rep"].to_numpy(), group["comp"].to_numpy()
        left = np.flatnonzero(group["left"].to_numpy(zero_copy_only=False))
        here = np.flatnonzero(group["here"].to_numpy(zero_copy_only=False))
        bits = np.frombuffer(b"".join(group["bits"].to_pylist()), np.uint8).reshape(-1, FINE)
        bands = group["bands"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)[:, :group["band"][0].as_py()]
        out_left, out_other, out_agree, more = [], [], [], []
        theirs = bits[here]
        for i in left:
            agree = (theirs == bits[i]).sum(axis=1)
            at = np.flatnonzero((agree >= least) & (comp[here] != comp[i]))
            # a pair is a matter of the first band it shares
            at = at[~(bands[here[at]] == bands[i]).any(axis=1)]
            if len(at) > most:
                at = at[np.argsort(-agree[at], kind="stable")]
            chosen = rep[here[at[:most]]]
            out_left.append(np.full(len(chosen), rep[i]))
            out_other.append(chosen)
            out_agree.append(agree[at[:most]])
            more.append(np.full(len(chosen), len(at) > most))
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        return pa.table({"left": pa.array(join(out_left, np.int64), pa.int64()), "other": pa.array(join(out_other, np.int64), pa.int64()),
                         "agree": pa.array(join(out_agree, np.int64), pa.int64()), "more": pa.array(join(more, bool), pa.bool_())})

    return run


def open_pairs(members: DataFrame, bits: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """Candidate pairs (a, b, more) of buckets that hold several components: ``most`` for a left-over class, however
    many buckets and blocks it lies in."""
    rows = members.join(labels, "rep")
    per = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    top = per.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    rows = rows.join(top.select("key", F.col("top.comp").alias("main"), F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "key").join(bits, "rep")
    rows = rows.withColumn("left", F.col("comp") != F.col("main")).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("block", F.explode(F.when(F.col("left"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("own"))))
    rows = rows.select("key", "band", "block", "rep", "comp", "bits", "bands", "left", (F.col("block") == F.col("own")).alias("here"))
    found = rows.groupBy("key", "block").applyInArrow(_partners(most), "left long, other long, agree long, more boolean")
    if most < PARTNERS[-1]:
        found = found.groupBy("left", "other").agg(F.max("agree").alias("agree"), F.max("more").alias("more"))
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy("left").orderBy(F.desc("agree"), "other"))).where(F.col("rank") <= most + 1)
        # the one beyond the last says that there are more, and is no candidate yet
        found = found.withColumn("more", F.col("more") | F.max(F.col("rank") > most).over(Window.partitionBy("left"))).where(F.col("rank") <= most)
    pair = found.select(F.least("left", "other").alias("a"), F.greatest("left", "other").alias("b"), "more")
    return pair.groupBy("a", "b").agg(F.max("more").alias("more"))


def _to_texts(keys: DataFrame) -> DataFrame:
    """``keys``, a stored table of a few numbers a row, for a join with the texts: broadcast after a check of its size."""
    return F.broadcast(keys) if keys.limit(FEW + 1).count() <= FEW else keys


def _judged(docs: DataFrame) -> DataFrame:
    """doc_id, text_key (a hash of the text), n, component_id and ``stays`` (whether the row is one of its component's
    least) of every row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    own = common.stored(docs.mapInArrow(_sketch_rows, "doc_id long, text_key long, n long, digest binary, bands array<long>"), "sketches")
    # a class for each set, numbered; its least row stands for it
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    classes = own.where("n > 0").groupBy("digest").agg(F.min(row).alias("row"), F.any_value("bands").alias("bands"))
    classes = common.stored(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    reps = classes.select("rep", "bands")
    keys = reps.select("rep", F.posexplode("bands").alias("band", "key"))
    shared = keys.groupBy("key").agg(F.min("rep").alias("least"), F.count(F.lit(1)).alias("size")).where("size > 1")
    members = common.stored(keys.join(shared, "key").select("key", "band", "rep", "least"), "members")
    involved = common.stored(members.select("rep").distinct(), "involved")
    rows = common.stored(involved.join(classes.select("rep", F.col("row.doc_id").alias("_id"), F.col("row.text_key").alias("_key")), "rep"), "rows")
    texts = docs.join(_to_texts(rows), docs["doc_id"].eqNullSafe(F.col("_id")) & (docs["text_key"] == F.col("_key")))
    sets = common.stored(texts.groupBy("rep").agg(F.min("text").alias("text")).mapInArrow(_set_rows, "rep long, shingles binary, bits binary"), "sets")
    bits, sets = common.stored(sets.select("rep", "bits").join(reps, "rep"), "bits"), sets.select("rep", "shingles")
    # the first round: one partner each
    met = members.where("least < rep").groupBy("rep", "least").agg(F.count(F.lit(1)).alias("n"))
    first = met.groupBy("rep").agg(F.max(F.struct("n", -F.col("least"))).alias("best")).select((-F.col("best.col2")).alias("a"), F.col("rep").alias("b"))
    tested = common.stored(first, "tested")
    labels = components(confirmed(tested, sets), involved.select("rep", F.col("rep").alias("comp")))
    for most in PARTNERS:
        found = common.stored(open_pairs(members, bits, labels, most), "candidates")
        more = not found.where("more").isEmpty()
        pairs = found.select("a", "b").join(tested, ["a", "b"], "left_anti")
        pairs = common.stored(pairs, "pairs")
        if not pairs.isEmpty():
            tested = tested.union(pairs)
            labels = components(confirmed(pairs, sets), labels)
        if not more:
            break
    known = classes.select("rep", "digest", "row").join(labels, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    named = known.groupBy("comp").agg(F.min("row").alias("least"))
    known = known.join(named, "comp").select("digest", "least")
    out = own.select("doc_id", "text_key", "n", "digest").join(known, "digest", "left")
    stays = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_key") == F.col("least.text_key"))
    return out.select("doc_id", "text_key", "n", F.when(F.col("n") > 0, F.col("least.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
                      ((F.col("n") == 0) | stays).alias("stays"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text)."""
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return _judged(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def op10_fast_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.documents(spark, sf_dir))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` of each component, with all its columns (of rows alike in id and text any one)."""
    judged = _judged(docs.select("doc_id", "text"))
    per = judged.groupBy("doc_id", "text_key").agg(F.any_value("stays").alias("stays"), F.count(F.lit(1)).alias("n_rows"), F.max("n").alias("n"))
    per = per.where("NOT stays OR (n_rows > 1 AND (n > 0 OR doc_id IS NOT NULL))")
    per = common.stored(per.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "stays"), "not-as-they-are")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("key"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    out = rows.join(_to_texts(per), same, "left_anti").select("row")
    repeated = per.where("stays")
    if not repeated.isEmpty():
        out = out.unionAll(rows.join(repeated, same, "left_semi").groupBy("id", "key").agg(F.any_value("row").alias("row")).select("row"))
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns])


#: The same result by plain joins: all pairs that share a shingle, and their closure.
ORACLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \\t-\\r]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < {SHINGLE} THEN w ELSE w[i:i + {SHINGLE - 1}] END AS x
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 2}, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= {LINK_PERCENT} * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT DISTINCT doc_id, doc_id AS x FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.x),
m AS (SELECT doc_id, min(x) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM d JOIN m USING (doc_id) LEFT JOIN n USING (doc_id)"""
