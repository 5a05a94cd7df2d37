"""Operator 7: mixing sources to target weights by Pareto order sampling (native).

A source's target is its share of all words, limited to ``MAX_COPIES`` times its
size, the excess shared again by weight.  Within a source a document's expected
copies are ``min(3, c * w)``, where ``w`` is the bit length of its size (long
documents are a little likelier) and ``c`` makes the expected words meet the
target.  The whole part is allocated with certainty.  For the rest, the inclusion
probability ``p``, documents are ranked by random odds over inclusion odds and
the sample is the prefix of that ranking whose words come nearest to what the
target still lacks: a fixed size, counted in words.

All of it is DataFrame code and nothing is ranked as a whole: the sums per source
and size class (at most 64 classes a source), and then per source and bin of the
ranking key, are partial sums made in every task; running sums over those small
tables give the targets, the factor ``c``, and the bin in which the prefix ends.
Only the documents of that one bin (about one in ``BINS`` of a source) are sorted.
Random numbers are hashes of the document's id and text, and every sum is of whole numbers,
so reruns agree.

Rows that repeat (alike in source, id and text) are numbered, and the number goes into the hash, so a
block of equal rows, rows without an id included, spreads over the whole ranking and
meets its share of the target.  Only the rows of such blocks are written once more and
numbered by their place: the number in the file, after those of the files before it.

Defined results: a null text has size 0 and is taken 0 times; documents without a
source are a source, the last; a null id counts as an empty one in the hash.  Of rows that repeat, which one is
taken oftener is left open; how many are is not.  Long texts are only measured and hashed.  Extra columns of any name
go through ``mixed`` as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from riskpipe.llm import common

#: Fixed by the contract: weights by the source's place, and the most copies of a document.
WEIGHTS, MAX_COPIES = (1, 2, 3), 3
_ALIKE = ("source", "id", "digest")
BINS = 16384
SEED = "mix"

#: Uniform in (0, 1): 52 bits of a hash of the id, the text's hash and the number among equal rows.
_UNIFORM = ("(CAST(conv(substr(md5(concat('{seed}:', coalesce(CAST(id AS STRING), ''), ':', digest, ':', CAST({number} AS STRING))), 1, 13), 16, 10) AS BIGINT)"
            " + 0.5D) / 4503599627370496D")
#: Random odds over inclusion odds, q, as q / (1 + q).
_KEY = "u * (1 - p) / (u * (1 - p) + (1 - u) * p)"


@dataclass
class Mix:
    """Tables of a plan: ``classes`` has a row for each source and size class, ``cuts`` a row for each source,
    ``repeats`` one for each (source, id, digest) that several rows share (None: there are none)."""
    classes: DataFrame
    cuts: DataFrame
    repeats: DataFrame | None
    seed: str


def _sized(docs: DataFrame, carry: list[str], doc_id: str, text: str, source: str) -> DataFrame:
    """Columns row (a struct of the carried ones), source, id, digest, size and w."""
    return (docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{source}`").alias("source"),
                        F.col(f"`{doc_id}`").alias("id"), F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("digest"),
                        F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(common.WORD)), F.lit(0)).cast("long").alias("size"))
            .selectExpr("row", "source", "id", "digest", "size", "CASE WHEN size > 0 THEN length(bin(size)) ELSE 0 END AS w"))


def _repeats(sized: DataFrame) -> DataFrame | None:
    """The (source, id, digest) of several rows."""
    found = common.stored(sized.groupBy(*_ALIKE).count().where("count > 1").select(*_ALIKE), "mix-repeats")
    return None if found.isEmpty() else found


def _drawn(sized: DataFrame, repeats: DataFrame | None, seed: str) -> DataFrame:
    """``sized`` with the random number u."""
    cols = ["row", "source", "id", "size", "w"]
    u = lambda number: f"{_UNIFORM.format(seed=seed, number=number)} AS u"
    if repeats is None:
        return sized.selectExpr(*cols, u("0"))
    r = repeats.select(*[F.col(c).alias(f"_{c}") for c in _ALIKE])
    alike = _same(_ALIKE)
    once = sized.join(r, alike, "left_anti").selectExpr(*cols, u("0"))
    again = common.stored(sized.join(r, alike, "left_semi"), "mix-again")
    again = again.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    per = common.stored(again.groupBy(*_ALIKE, "file").agg(F.count(F.lit(1)).alias("n")), "mix-again-files")
    before = Window.partitionBy(*_ALIKE).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*[F.col(c).alias(f"_{c}") for c in (*_ALIKE, "file")], F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    here = F.row_number().over(Window.partitionBy(*_ALIKE, "file").orderBy("at"))
    numbered = again.withColumn("here", here).join(per, _same((*_ALIKE, "file")))
    return once.unionByName(numbered.selectExpr(*cols, u("(before + here - 1)")))


def _same(cols) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return out


def targets(classes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size, target.  ``classes``: source, w, words.

    With the sources in order of size over weight, a source is at its limit as long as the level
    that all later ones could share is above its own; the first level that is not is the final one, and the
    largest of those that are not (to limit a source that need not be leaves the others less).
    """
    n = len(weights)
    pick = "CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % {} {} END".format(
        n, " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(weights)))
    per = classes.groupBy("source").agg(F.sum("words").alias("source_size"))
    per = per.selectExpr("source", "source_size", f"{pick} AS weight")
    before = "OVER (ORDER BY CAST(source_size AS DOUBLE) / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    per = per.selectExpr(
        "source", "source_size", "weight",
        f"sum(source_size) OVER () - {MAX_COPIES} * coalesce(sum(source_size) {before}, 0) AS words_left",
        f"sum(weight) OVER () - coalesce(sum(weight) {before}, 0) AS weight_left")
    per = per.selectExpr("*", f"CASE WHEN words_left * weight <= {MAX_COPIES} * source_size * weight_left THEN words_left / CAST(weight_left AS DOUBLE) END AS level")
    return per.selectExpr("source", "source_size", f"least({MAX_COPIES} * source_size, max(level) OVER () * weight) AS target")


def plan(docs: DataFrame, *, seed: str = SEED, doc_id: str = "doc_id", text: str = "text", source: str = "source",
         weights: tuple[int, ...] = WEIGHTS) -> tuple[Mix, DataFrame]:
    """The mix of ``docs``, and the table (row = doc_id, source, id, size, w, u) that it was made from."""
    sized = common.stored(_sized(docs, [doc_id], doc_id, text, source), "mix-sizes")
    repeats = _repeats(sized)
    sizes = _drawn(sized, repeats, seed)
    classes = sizes.groupBy("source", "w").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs"))
    classes = common.stored(classes, "mix-classes")
    per = targets(classes, weights).select(F.col("source").alias("_source"), "source_size", "target")
    # c: the first, from the largest class down, that leaves its class within the most copies; the largest such
    down = "OVER (PARTITION BY source ORDER BY w DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    factors = (classes.join(per, F.col("source").eqNullSafe(F.col("_source")))
               .selectExpr("source", "w", "words", "source_size", "target",
                           f"target - {MAX_COPIES} * coalesce(sum(words) {down}, 0) AS lacking",
                           f"sum(w * words) OVER (PARTITION BY source) - coalesce(sum(w * words) {down}, 0) AS weighted")
               .selectExpr("*", f"CASE WHEN weighted > 0 AND lacking * w <= {MAX_COPIES} * CAST(weighted AS DOUBLE) THEN lacking / weighted END AS c")
               .selectExpr("*", f"least({MAX_COPIES}, coalesce(max(c) OVER (PARTITION BY source), {MAX_COPIES}) * w) AS expected")
               .selectExpr("source", "w", "source_size", "target", "expected", "CAST(floor(expected) AS BIGINT) AS whole",
                           "expected - floor(expected) AS p",
                           "target - sum(CAST(floor(expected) AS BIGINT) * words) OVER (PARTITION BY source) AS rest"))
    factors = common.stored(factors, "mix-factors")
    # the prefix of the ranking: first by bins, then within the bin where it ends
    ranked = _with_class(sizes, factors).where("p > 0").selectExpr("source", "id", "size", "rest", f"{_KEY} AS k", f"CAST(floor({_KEY} * {BINS}) AS INT) AS bin")
    ranked = common.stored(ranked, "mix-ranks")
    bins = ranked.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.greatest(F.first("rest"), F.lit(0.0)).alias("rest"))
    below = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("below", F.coalesce(F.sum("words").over(below), F.lit(0)))
    ends = bins.where("below <= rest AND rest < below + words").selectExpr("source AS _source", "bin AS end", "below")
    ends = common.stored(ends, "mix-ends")
    edge = (ranked.join(ends, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bin") == F.col("end")))
            .selectExpr("source", "end", "rest", "k", "id", "size",
                        "below + sum(size) OVER (PARTITION BY source ORDER BY k, id, size ROWS UNBOUNDED PRECEDING) - size / 2.0D AS middle"))
    last = edge.where("middle <= rest").groupBy("source").agg(F.max(F.struct("k", "id", "size")).alias("cut")).selectExpr("source AS _s", "cut")
    cuts = ends.join(last, F.col("_source").eqNullSafe(F.col("_s")), "left").selectExpr("_source AS source", "end", "cut")
    return Mix(factors, common.stored(cuts, "mix-cuts"), repeats, seed), sizes


def _with_class(sizes: DataFrame, factors: DataFrame) -> DataFrame:
    f = factors.withColumnsRenamed({"source": "_source", "w": "_w"})
    return sizes.join(f, F.col("source").eqNullSafe(F.col("_source")) & (F.col("w") == F.col("_w"))).drop("_source", "_w")


def apply(sizes: DataFrame, mix: Mix) -> DataFrame:
    """row, size, source_size, target, expected and copies of every row of ``sizes``.

    Without a bin in which the prefix ends, the whole ranking is taken."""
    cuts = mix.cuts.withColumnRenamed("source", "_source")
    df = _with_class(sizes, mix.classes).join(cuts, F.col("source").eqNullSafe(F.col("_source")), "left")
    df = df.selectExpr("row", "source", "id", "size", "source_size", "target", "expected", "whole", "p", "end", "cut", f"{_KEY} AS k")
    return df.selectExpr(
        "row", "source", "size", "source_size", "target", "expected",
        f"""whole + CASE WHEN p > 0 AND (end IS NULL OR floor(k * {BINS}) < end
                          OR (floor(k * {BINS}) = end AND cut IS NOT NULL AND struct(k, id, size) <= cut)) THEN 1 ELSE 0 END AS copies""")


def op7_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix, sizes = plan(common.documents(spark, sf_dir))
    return apply(sizes, mix).selectExpr("row.doc_id AS doc_id", "size", "source_size", "target", "copies * size AS taken", "copies", "expected")


def mixed(docs: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns."""
    cols = docs.columns
    mix, _ = plan(docs, **kw)
    sized = _sized(docs, cols, kw.get("doc_id", "doc_id"), kw.get("text", "text"), kw.get("source", "source"))
    out = apply(_drawn(sized, mix.repeats, mix.seed), mix).where("copies > 0")
    return out.select(F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("_"), "row").select(
        *[F.col("row")[c].alias(c) for c in cols])


def _oracle() -> str:
    """The same mix with plain windows, for DuckDB."""
    up = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    m = MAX_COPIES
    return f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+')) AS BIGINT) AS size,
                  (CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, '')) || ':' ||
                   (row_number() OVER (PARTITION BY source, doc_id, md5(coalesce(text, ''))) - 1)), 1, 13) AS BIGINT) + CAST(0.5 AS DOUBLE)) / CAST(4503599627370496 AS DOUBLE) AS u
           FROM documents),
z AS (SELECT *, CASE WHEN size > 0 THEN length(bin(size)) ELSE 0 END AS w FROM d),
k AS (SELECT source, w, CAST(sum(size) AS BIGINT) AS words FROM z GROUP BY ALL),
s AS (SELECT source, CAST(sum(words) AS BIGINT) AS source_size, 1 + (row_number() OVER (ORDER BY source IS NULL, source COLLATE C) - 1) % 3 AS weight FROM k GROUP BY source),
l AS (SELECT *, sum(source_size) OVER () - {m} * coalesce(sum(source_size) OVER o, 0) AS words_left, sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS weight_left
      FROM s WINDOW o AS (ORDER BY CAST(source_size AS DOUBLE) / weight, source IS NULL, source COLLATE C {up})),
v AS (SELECT *, CASE WHEN words_left * weight <= {m} * source_size * weight_left THEN CAST(words_left AS DOUBLE) / CAST(weight_left AS DOUBLE) END AS level FROM l),
t AS (SELECT source, source_size, least(CAST({m} * source_size AS DOUBLE), max(level) OVER () * weight) AS target FROM v),
f AS (SELECT k.source, w, words, source_size, target, target - {m} * coalesce(sum(words) OVER o, 0) AS lacking,
             sum(w * words) OVER (PARTITION BY k.source) - coalesce(sum(w * words) OVER o, 0) AS weighted
      FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source WINDOW o AS (PARTITION BY k.source ORDER BY w DESC {up})),
c AS (SELECT *, CASE WHEN weighted > 0 AND lacking * w <= {m} * CAST(weighted AS DOUBLE) THEN lacking / CAST(weighted AS DOUBLE) END AS c FROM f),
e AS (SELECT *, least(CAST({m} AS DOUBLE), coalesce(max(c) OVER (PARTITION BY source), CAST({m} AS DOUBLE)) * w) AS expected FROM c),
g AS (SELECT *, expected - floor(expected) AS p, CAST(floor(expected) AS BIGINT) AS whole,
             target - sum(CAST(floor(expected) AS BIGINT) * words) OVER (PARTITION BY source) AS rest FROM e),
r AS (SELECT z.*, source_size, target, expected, whole, p, rest, u * (1 - p) / (u * (1 - p) + (1 - u) * p) AS k
      FROM z JOIN g ON z.source IS NOT DISTINCT FROM g.source AND z.w = g.w),
q AS (SELECT *, CASE WHEN p > 0 AND sum(CASE WHEN p > 0 THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY p <= 0, k, doc_id, size ROWS UNBOUNDED PRECEDING)
                          - size / CAST(2 AS DOUBLE) <= rest THEN 1 ELSE 0 END AS extra FROM r)
SELECT doc_id, size, source_size, target, CAST((whole + extra) * size AS BIGINT) AS taken, CAST(whole + extra AS BIGINT) AS copies, expected FROM q"""


ORACLE_SQL = _oracle()
