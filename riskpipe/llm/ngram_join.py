"""Operator 12: documents whose word 5-gram sets have a Jaccard similarity of at least 0.8.

The join is exact.  Two linked sets share at least 0.8 of the larger one's shingles, so finding
them is a T-occurrence problem: which documents stand in T or more of the inverted lists of a
query's shingles?  It is solved by DivideSkip: the long lists are set aside, the short ones merged by
counting, and only documents that reached T less the number of long lists are looked up in these by
binary search (``search``).

On the way there nothing is paired within a group:

1. texts with equal sets are one class (partial aggregation by the set's digest);
2. only the ``n - ceil(0.8 n) + l(n)`` shingles with the least hashes of a set, its prefix, are counted
   over all documents.  Linked sets share at least l of the smaller one's prefix, so a class with
   fewer prefix shingles that any other class has goes.  Of the rest a class needs its
   rarest prefix shingles only: all but l - 1 of those it shares (keys);
3. every key is represented by the least class that has it (head), and each class is listed once under each
   of its heads.  Two linked classes share a key and so a head;
4. first each head alone is the query for its list; links make components;
5. then, where a list holds several components, all its classes outside the largest one are
   queries for the whole list.  Lists are cut into blocks of ``BLOCK`` classes, queries go to each
   block, and a task returns links that its components need only.

What is compared in step 5 is each class outside its list's largest component with the list, which
is all that an exact join can leave to do.  Tables between the steps lie in the shared scratch
folder; the driver sees counts.

Defined results: a document without words has an empty set and is its own component; rows that
share an id but not the text are documents of their own, equal rows get equal results; rows
without an id take part and get the smallest id of their component, or none if it has none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from riskpipe.llm import common, wordhash
from riskpipe.llm.near_dups import components, shingle_sets

#: Fixed by the contract.
SHINGLE, LINK_PERCENT = 5, 80
BLOCK = 1024
MU = 1.0          # DivideSkip's weight of a look-up; many documents are merged or looked up at once
LONG = 64         # shorter lists are always merged


# -- prefixes -----------------------------------------------------------------------------------


def common_least(n):
    """l(n): how many prefix shingles a linked set of n shingles or more must share (numbers or arrays)."""
    return -(-n // 5)


def required(n, percent: int = LINK_PERCENT):
    """Least overlap of a set of n shingles with a linked one."""
    return -(-percent * n // 100)


def prefix_size(n, percent: int = LINK_PERCENT):
    return n - required(n, percent) + common_least(n)


def _class_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: size, digest and prefix of its set.  Prefix shingles are the first half of their hash:
    equal halves of different shingles only add candidates."""
    for batch in batches:
        for rows, texts in wordhash.chunks(batch):
            values, ends = shingle_sets(texts, SHINGLE)
            starts, n = np.concatenate([[0], ends[:-1]]), np.diff(ends, prepend=0)
            digest = [hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() for a, b in zip(starts, ends, strict=True)]
            size = prefix_size(n)
            at = np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(size.sum())
            prefix = (values[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)
            yield pa.RecordBatch.from_arrays(
                [rows["doc_id"], rows["text_key"], pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(prefix))],
                names=["doc_id", "text_key", "n", "digest", "prefix"])


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in wordhash.chunks(batch):
            values, ends = shingle_sets(texts, SHINGLE)
            yield pa.RecordBatch.from_arrays([rows["rep"], pa.array([x.astype("<u8").tobytes() for x in np.split(values, ends[:-1])], pa.binary())],
                                             names=["rep", "shingles"])


# -- T-occurrence search ------------------------------------------------------------------------


class Lists:
    """Inverted lists of the shingles of some sets (sorted arrays): positions of the sets, ascending."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.fromiter(map(len, sets), np.int64, len(sets))
        values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), self.size)
        order = np.argsort(values, kind="stable")       # owners of a value stay in order
        values, self.owner = values[order], owner[order]
        self.start = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)
        self.values = values[self.start]
        self.length = np.diff(np.r_[self.start, len(values)])

    def of(self, shingles: np.ndarray) -> np.ndarray:
        """The numbers of the lists of those ``shingles`` that have one."""
        at = np.searchsorted(self.values, shingles)
        at[at == len(self.values)] = 0
        return at[self.values[at] == shingles] if len(self.values) else at[:0]

    def search(self, shingles: np.ndarray, percent: int = LINK_PERCENT) -> np.ndarray:
        """Positions of the sets linked with ``shingles``, by DivideSkip."""
        n = len(shingles)
        t = required(n, percent)                        # of the query's shingles, whatever the partner's size
        lists = self.of(shingles)
        if n == 0 or len(lists) < t:
            return np.zeros(0, np.int64)
        lists = lists[np.argsort(self.length[lists], kind="stable")]
        most = int(self.length[lists[-1]])
        long = min(t - 1, int((self.length[lists] >= LONG).sum()), int(t / (MU * np.log2(max(most, 2)) + 1)))
        short = lists[:len(lists) - long]
        lengths = self.length[short]
        at = np.repeat(self.start[short] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        count = np.bincount(self.owner[at], minlength=len(self.size))
        left = long
        found = np.flatnonzero(count >= t - left)
        found = found[(100 * self.size[found] >= percent * n) & (percent * self.size[found] <= 100 * n)]
        count = count[found]
        for k in lists[len(lists) - long:]:
            if not len(found):
                return found
            own = self.owner[self.start[k]:self.start[k] + self.length[k]]
            place = np.searchsorted(own, found)
            place[place == len(own)] = 0
            count += own[place] == found
            left -= 1
            reach = count >= t - left
            if not reach.all():
                found, count = found[reach], count[reach]
        return found[100 * count >= percent * (n + self.size[found] - count)]


class _Roots:
    """Components of the rows of one task."""

    def __init__(self, of: np.ndarray):
        self.up = {int(c): int(c) for c in of}

    def root(self, c: int) -> int:
        while self.up[c] != c:
            self.up[c] = self.up[self.up[c]]
            c = self.up[c]
        return c

    def join(self, a: int, b: int) -> bool:
        """Whether the two were apart."""
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _linked(group: pa.Table) -> pa.Table:
    """Links (a, b) from the queries of one block to its rows; one of those that join the same components."""
    rep, comp = group["rep"].to_numpy(), group["comp"].to_numpy()
    here = np.flatnonzero(group["here"].to_numpy(zero_copy_only=False))
    asks = np.flatnonzero(group["asks"].to_numpy(zero_copy_only=False))
    sets = [np.frombuffer(x.as_py(), "<u8") for x in group["shingles"]]
    lists, roots = Lists([sets[i] for i in here]), _Roots(comp)
    out = []
    for i in asks:
        for j in here[lists.search(sets[i])]:
            if roots.join(int(comp[i]), int(comp[j])):
                out.append((min(rep[i], rep[j]), max(rep[i], rep[j])))
    a, b = zip(*out, strict=True) if out else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _search_in_blocks(rows: DataFrame) -> DataFrame:
    """Links from the rows (head, rep, comp, asks, blocks, shingles) that ask to all rows of their head, block by block."""
    rows = rows.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("block", F.explode(F.when(F.col("asks"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("own"))))
    rows = rows.select("head", "block", "rep", "comp", "asks", (F.col("block") == F.col("own")).alias("here"), "shingles")
    return rows.groupBy("head", "block").applyInArrow(_linked, "a long, b long")


def _blocks(size: str):
    return F.ceil(F.col(size) / BLOCK).cast("int").alias("blocks")


# -- the join -----------------------------------------------------------------------------------


def heads(classes: DataFrame) -> DataFrame:
    """(head, rep): each class (rep, n, prefix) under the least class of each of its keys, where that has others."""
    entries = classes.select("rep", "n", F.explode("prefix").alias("key"))
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    entries = entries.join(shared, "key")
    # the classes that share enough, and their rarest entries
    by = Window.partitionBy("rep")
    need = F.ceil(F.ceil(F.col("n") * LINK_PERCENT / 100) / 5)
    entries = entries.select("rep", "key", F.count(F.lit(1)).over(by).alias("c"), need.alias("t"), F.row_number().over(by.orderBy("df", "key")).alias("at"))
    keys = common.stored(entries.where("at <= c - t + 1").select("key", "rep").distinct(), "keys")
    least = keys.groupBy("key").agg(F.min("rep").alias("head"), F.count(F.lit(1)).alias("size")).where("size > 1").select("key", "head")
    return common.stored(keys.join(least, "key").select("head", "rep").distinct(), "heads")


def jaccard_join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    own = common.stored(docs.mapInArrow(_class_rows, "doc_id long, text_key long, n long, digest binary, prefix array<int>"), "prefixes")
    # a class for each set; one of its rows stands for it
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    classes = own.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("label"), F.min(row).alias("row"), F.any_value("n").alias("n"), F.any_value("prefix").alias("prefix"))
    classes = common.stored(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    members = heads(classes)
    involved = members.select("rep").distinct().join(classes.select("rep", "n", "row"), "rep").select(
        "rep", "n", F.col("row.doc_id").alias("_id"), F.col("row.text_key").alias("_key"))
    texts = docs.join(involved, docs["doc_id"].eqNullSafe(F.col("_id")) & (docs["text_key"] == F.col("_key")))
    sets = common.stored(texts.groupBy("rep").agg(F.min("text").alias("text")).mapInArrow(_set_rows, "rep long, shingles binary"), "sets")
    sizes = classes.select("rep", "n")

    # each head asks its list, of those that its size allows
    of_head = sizes.toDF("head", "head_n")
    pairs = members.join(sizes, "rep").join(of_head, "head").where(f"100 * n >= {LINK_PERCENT} * head_n AND {LINK_PERCENT} * n <= 100 * head_n").select("head", "rep")
    counted = pairs.groupBy("head").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("head", _blocks("size"))
    rows = pairs.join(counted, "head").withColumns({"comp": F.col("rep"), "asks": F.col("rep") == F.col("head")}).join(sets, "rep")
    links = common.stored(_search_in_blocks(rows), "links")
    labels = components(links, common.stored(members.select("rep").distinct().select("rep", F.col("rep").alias("comp")), "labels"))

    # where components are left, all but the largest ask
    rows = members.join(labels, "rep")
    per = rows.groupBy("head", "comp").agg(F.count(F.lit(1)).alias("n"))
    top = per.groupBy("head").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    rows = rows.join(top.select("head", F.col("top.comp").alias("main"), _blocks("size")), "head")
    rows = rows.withColumn("asks", F.col("comp") != F.col("main")).drop("main").join(sets, "rep")
    more = common.stored(_search_in_blocks(rows), "links")
    labels = components(links.union(more), labels)

    known = classes.select("rep", "digest", "label").join(labels, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    named = known.groupBy("comp").agg(F.min("label").alias("component_id"))
    known = known.join(named, "comp").select("digest", "component_id")
    out = own.select("doc_id", "n", "digest").join(known, "digest", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def op12_divide_skip_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(common.documents(spark, sf_dir))


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
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id
FROM d JOIN m USING (doc_id) LEFT JOIN n USING (doc_id)"""
