"""Operator 1: quality rules with robust multivariate outliers (native).

Each document becomes a vector of transformed statistics.  Within every
(language, source) group a minimum-covariance-determinant estimate of centre and
scatter is fitted by concentration steps, and documents whose Mahalanobis
distance from it is too large are rejected.

Everything is DataFrame code.  A text is read once; its statistics go to a small
table in the shared scratch folder, and each concentration step is

* a join of that table with one row of parameters per group (ordinary join: the
  number of groups has no bound that we know, so Spark decides by size),
* a histogram of the distances per group, whose bins hold counts, sums and sums of products
  (at most a few thousand bins each, so a group that holds a third of all rows is summed
  up in every task and never gathered),
* running sums over the bins, read off at the one below which ``support`` of the group lies.

The statistics are held as whole numbers of ``1/GRID``, so all sums are exact
and a rerun gives the same rows whatever the order of the tasks.

Defined results.  A null or empty text has no words and fails the base rule.
Null languages and sources are groups like any other.  Groups with fewer than
``min_group`` documents that pass the base rule are pooled in steps: the small groups of a
language are estimated together, and where these are still too few, those of all
such languages; if even that is too little, the base rule alone decides.  Repeated rows are judged each for itself, texts
are read whole whatever their length, and only the columns used are taken, so others may have any name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from riskpipe.llm import common

#: Fixed by the contract.
MIN_WORDS, WINDOW, REPEAT_PERCENT = 20, 8, 30
SYMBOLS = "#*$%&|<>"

#: Whole numbers per unit of a statistic.
GRID = 1024
#: Name and least standard deviation of each statistic.  Many are 0 for nearly every clean
#: document, where an estimated scatter would be singular; below the floor a difference is not odd.
FEATURES = {"f_symbols": 0.05, "f_upper": 0.08, "f_marks": 0.08, "f_length": 0.10, "f_lines": 0.25, "f_repeat": 0.25, "f_stutter": 0.12}
P = len(FEATURES)
DECILES = 2.563  # standard deviations between the first and the last decile of a normal distribution
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class McdConfig:
    support: float = 0.75       # share of a group that the determinant is minimised over
    steps: int = 4              # concentration steps, then one reweighting step
    reweight: float = 0.975     # chi-square quantile of the reweighting step
    tail: float = 1e-3          # share of clean documents that the cutoff gives up, were they normal
    min_group: int = 20 * P
    bins: int = 64              # histogram bins per doubling of the distance


# -- chi-square constants (driver arithmetic on the configuration, no data) -----------------


def chi2_cdf(x: float, k: int) -> float:
    """Regularised lower incomplete gamma function by its series."""
    if x <= 0:
        return 0.0
    a, half = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-17:
        n += 1
        term *= half / n
        total += term
    return min(1.0, total * math.exp(-half + a * math.log(half) - math.lgamma(a)))


def chi2_quantile(p: float, k: int) -> float:
    lo, hi = 0.0, 400.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, k) < p else (lo, mid)
    return (lo + hi) / 2


# -- statistics of a text -------------------------------------------------------------------


def _without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _joined(hashes: Column, step: int) -> Column:
    """Hash of each element with the one ``step`` places on; the last ``step`` have no partner and go."""
    return F.slice(F.zip_with(hashes, F.slice(hashes, step + 1, F.greatest(F.size(hashes) - step, F.lit(0))), lambda a, b: F.xxhash64(a, b)),
                   1, F.greatest(F.size(hashes) - step, F.lit(0)))


def with_repeats(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words of the hash array ``h`` that lie in a window of 8 found twice or more.

    Window hashes are made by doubling: pairs, fours, eights.  Where two are equal, sorting
    (hash, position) puts equal windows side by side; the positions found are then swept from
    left to right, counting each covered word once.  Other texts skip the sort.
    """
    assert WINDOW == 8
    df = df.withColumn("h2", _joined(F.col("h"), 1)).drop("h")
    df = df.withColumn("h4", _joined(F.col("h2"), 2)).drop("h2")
    df = df.withColumn("h8", _joined(F.col("h4"), 4)).drop("h4")
    df = df.withColumn("pairs", F.when(F.size(F.array_distinct("h8")) < F.size("h8"), F.sort_array(
        F.transform("h8", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("h8")
    pairs = F.col("pairs")
    df = df.withColumn("twice", F.sort_array(F.filter(
        F.transform(pairs, lambda x, i: F.when((x["h"] == F.get(pairs, i - 1)["h"]) | (x["h"] == F.get(pairs, i + 1)["h"]), x["i"])),
        lambda p: p.isNotNull()))).drop("pairs")
    swept = F.aggregate(
        "twice", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, p: F.struct((acc["n"] + p + WINDOW - F.greatest(acc["end"], p)).alias("n"), (p + WINDOW).alias("end")))
    return df.withColumn("n_repeat_words", F.coalesce(swept["n"], F.lit(0))).drop("twice")


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` (with any columns) as columns ``row`` (all of them), the base columns and ``base_failed``,
    and the statistics of the vector as whole numbers of 1/GRID."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), t.alias("t"))
    df = df.select("row", "t", F.transform(common.words(F.col("t")), lambda x: F.xxhash64(x)).alias("h"),
                   F.filter(F.split("t", "\n", -1), lambda x: x.rlike(common.WORD)).alias("lines"))
    df = df.select(
        "row",
        F.size("h").alias("n_words"),
        F.char_length(_without(F.col("t"), common.BLANKS)).alias("word_chars"),
        (F.octet_length("t") - F.octet_length(_without(F.col("t"), SYMBOLS))).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.size("lines").alias("n_lines"),
        "h",
        (F.octet_length("t") - F.octet_length(_without(F.col("t"), "!?.,;:"))).alias("n_marks"),
        F.regexp_count(F.col("t"), F.lit(r"\p{Lu}")).alias("n_upper"),
        F.size(F.filter("h", lambda x, i: F.get(F.col("h"), i - 1) == x)).alias("n_stutter"))
    df = with_repeats(df)
    chars, nw = F.greatest(F.col("word_chars"), F.lit(1)), F.greatest(F.col("n_words"), F.lit(1))
    share = lambda a, b: F.sqrt(F.least(F.col(a) / b, F.lit(1.0)))
    vector = {
        "f_symbols": share("n_symbols", chars),
        "f_upper": share("n_upper", chars),
        "f_marks": share("n_marks", chars),
        "f_length": F.log(chars / nw),
        "f_lines": share("n_dup_lines", F.greatest(F.col("n_lines"), F.lit(1))),
        "f_repeat": share("n_repeat_words", nw),
        "f_stutter": share("n_stutter", nw),
    }
    return df.select(
        "row", *[F.col(c).cast("long").alias(c) for c in BASE],
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
        *[F.floor(c * GRID + 0.5).cast("long").alias(k) for k, c in vector.items()])


# -- estimates ------------------------------------------------------------------------------

KEY = ["g_level", "g_lang", "g_source"]   # level 0: a group of its own, 1: of a language, 2: of all
XS = list(FEATURES)


def _real(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def _cholesky_sql(scale: float) -> list[str]:
    out = [f"s_{i} / n AS m_{i}" for i in range(P)]
    for i in range(P):
        for j in range(i + 1):
            floor = f" + {_real((FEATURES[XS[i]] * GRID) ** 2)}" if i == j else ""
            out.append(f"(s_{i}_{j} - CAST(s_{i} AS DOUBLE) * s_{j} / n) / n * {_real(scale)}{floor} AS c_{i}_{j}")
    for j in range(P):
        for i in range(j, P):
            rest = "".join(f" - l_{i}_{k} * l_{j}_{k}" for k in range(j))
            out.append(f"sqrt(c_{j}_{j}{rest}) AS l_{j}_{j}" if i == j else f"(c_{i}_{j}{rest}) / l_{j}_{j} AS l_{i}_{j}")
    return out


def _distance_sql() -> list[str]:
    z = [f"({x} - m_{i}" + "".join(f" - l_{i}_{k} * z_{k}" for k in range(i)) + f") / l_{i}_{i} AS z_{i}" for i, x in enumerate(XS)]
    return [*z, " + ".join(f"z_{i} * z_{i}" for i in range(P)) + " AS d2"]


def _sums_sql() -> list[str]:
    return [f"sum({x}) AS s_{i}" for i, x in enumerate(XS)] + [f"sum({XS[i]} * {XS[j]}) AS s_{i}_{j}" for i in range(P) for j in range(i + 1)]


def _cholesky(est: DataFrame, scale: float) -> DataFrame:
    """From columns n, s_i, s_i_j (sums over a group) the columns m_i and l_i_j of scale * covariance plus floors.

    Each expression may use the ones before it (lateral aliases)."""
    out = _cholesky_sql(scale)
    return est.selectExpr(*KEY, *out).select(*KEY, *_PARAMS)


_PARAMS = [f"m_{i}" for i in range(P)] + [f"l_{i}_{j}" for i in range(P) for j in range(i + 1)]


def _start(rows: DataFrame) -> DataFrame:
    """Medians and scaled inter-decile ranges: exact percentiles of whole numbers of a small range."""
    agg = rows.groupBy(*KEY).agg(*[F.percentile(x, F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))).alias(f"q_{i}") for i, x in enumerate(XS)])
    cols = {f"m_{i}": F.col(f"q_{i}")[1] for i in range(P)}
    for i, x in enumerate(XS):
        spread = (F.col(f"q_{i}")[2] - F.col(f"q_{i}")[0]) / DECILES
        for j in range(i + 1):
            cols[f"l_{i}_{j}"] = F.sqrt(spread * spread + (FEATURES[x] * GRID) ** 2) if i == j else F.lit(0.0)
    return agg.select(*KEY, *[cols[k].alias(k) for k in _PARAMS])


def _on_key() -> Column:
    """Null-safe equality of the group columns with their underscored twins."""
    return F.expr(" AND ".join(f"{k} <=> _{k}" for k in KEY))


def with_distance(rows: DataFrame, params: DataFrame) -> DataFrame:
    """Adds ``d2``, the squared Mahalanobis distance; null where the group has no estimate."""
    p = params.select(*[F.col(k).alias(f"_{k}") for k in KEY], *_PARAMS)
    df = rows.join(p, _on_key(), "left")
    return df.selectExpr(*[f"`{c}`" for c in rows.columns], *_distance_sql()).select(*rows.columns, "d2")


def _closest(rows: DataFrame, share: float, bins: int) -> DataFrame:
    """n, s_i and s_i_j of each group's rows up to the distance below which ``share`` of it lies (whole histogram bins)."""
    rows = rows.withColumn("bin", F.floor(F.log2(1 + F.col("d2")) * bins).cast("int"))
    sums = ["count(1) AS n", *_sums_sql()]
    names = [x.split(" AS ")[1] for x in sums]
    by = Window.partitionBy(*KEY)
    so_far = by.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    cells = rows.groupBy(*KEY, "bin").agg(*map(F.expr, sums))
    cells = cells.select(*KEY, F.col("n").alias("here"), F.sum("n").over(by).alias("total"), *[F.sum(c).over(so_far).alias(c) for c in names])
    return cells.where((F.col("n") >= F.col("total") * share) & (F.col("n") - F.col("here") < F.col("total") * share)).select(*KEY, *names)


def fit(rows: DataFrame, cfg: McdConfig = McdConfig()) -> DataFrame:
    """MCD estimate of each group of ``rows`` (columns KEY and the statistics): means and Cholesky factors."""
    params = common.stored(_start(rows), "mcd")
    inside = chi2_cdf(chi2_quantile(cfg.support, P), P + 2)
    for _ in range(cfg.steps):
        params = common.stored(_cholesky(_closest(with_distance(rows, params), cfg.support, cfg.bins), cfg.support / inside), "mcd")
    limit = chi2_quantile(cfg.reweight, P)
    core = with_distance(rows, params).where(F.col("d2") <= limit).groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), *map(F.expr, _sums_sql()))
    return common.stored(_cholesky(core, cfg.reweight / chi2_cdf(limit, P + 2)), "mcd")


def judge(docs: DataFrame, carry: list[str], cfg: McdConfig = McdConfig(), lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per row of ``docs``: ``row`` (a struct of the ``carry`` columns), the base columns,
    ``base_failed``, ``distance2`` and ``kept``."""
    need = list(dict.fromkeys([*carry, lang, source, "text"]))
    df = with_statistics(docs.select(*[F.col(f"`{c}`") for c in need]))
    df = df.select(F.struct(*[F.col("row")[c].alias(c) for c in carry]).alias("row"),
                   F.col("row")[lang].alias("lang"), F.col("row")[source].alias("source"), *BASE, "base_failed", *XS)
    df = common.stored(df, "statistics")
    # a row for each (language, source): its group and the documents in it
    groups = df.where(~F.col("base_failed")).groupBy("lang", "source").agg(F.count(F.lit(1)).alias("size"))
    groups = groups.selectExpr("lang AS _l", "source AS _s", "size", f"size >= {cfg.min_group} AS own")
    pool = F.sum("size").over(Window.partitionBy("own", "_l"))
    groups = groups.withColumn("g_level", F.when(F.col("own"), 0).when(pool >= cfg.min_group, 1).otherwise(2))
    groups = groups.selectExpr("*", "CASE WHEN g_level < 2 THEN _l END AS g_lang", "CASE WHEN g_level = 0 THEN _s END AS g_source")
    groups = common.stored(groups.withColumn("members", F.sum("size").over(Window.partitionBy(*KEY))), "groups")
    df = (df.join(groups, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")), "left")
          .withColumn("g_level", F.coalesce("g_level", F.lit(2))).drop("_l", "_s", "size", "own"))
    clean = df.where(~F.col("base_failed") & (F.col("members") >= cfg.min_group)).select(*KEY, *XS)
    params = fit(common.stored(clean, "vectors"), cfg)
    limit = chi2_quantile(1 - cfg.tail, P)
    out = with_distance(df, params)
    return out.select("row", *BASE, "base_failed", F.col("d2").alias("distance2"),
                      (~F.col("base_failed") & (F.col("d2").isNull() | (F.col("d2") <= limit))).alias("kept"))


# -- the query and the pipeline stage --------------------------------------------------------


def op1_mcd_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(common.documents(spark, sf_dir), ["doc_id"])
    return out.select(F.col("row.doc_id").alias("doc_id"), *BASE, "base_failed", "kept", F.round("distance2", 4).alias("distance2"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    cols = docs.columns
    out = judge(docs, cols).where("kept")
    return out.select(*[F.col("row")[c].alias(c) for c in cols])


def _nested(source: str, columns: list[str]) -> str:
    """Each column in a query of its own over the one before, so that none is worked out twice."""
    for c in columns:
        source = f"SELECT *, {c} FROM ({source})"
    return source


def _oracle(cfg: McdConfig = McdConfig()) -> str:
    """The same estimate with every step as a query, for DuckDB."""
    key = ", ".join(KEY)
    same = " AND ".join(f"r.{k} IS NOT DISTINCT FROM p.{k}" for k in KEY)
    share = lambda a, b: f"CAST(floor(sqrt(least({a} / CAST({b} AS DOUBLE), 1)) * {GRID} + CAST(0.5 AS DOUBLE)) AS BIGINT)"
    count = lambda chars: f"length(t) - length(regexp_replace(t, '[{chars}]', '', 'g'))"
    chars, words, lines = "greatest(word_chars, 1)", "greatest(n_words, 1)", "greatest(n_lines, 1)"
    steps = []

    def distances(k: int, rows: str) -> str:
        return _nested(f"SELECT r.*, p.* EXCLUDE ({key}) FROM {rows} r JOIN p{k} p ON {same}", _distance_sql())

    inside = chi2_cdf(chi2_quantile(cfg.support, P), P + 2)
    for k in range(cfg.steps):
        steps.append(f"""
x{k} AS (SELECT {key}, {', '.join(XS)}, floor(log2(1 + d2) * {cfg.bins}) AS bin FROM ({distances(k, 'clean')})),
h{k} AS (SELECT {key}, bin, count(*) AS c FROM x{k} GROUP BY ALL),
w{k} AS (SELECT *, coalesce(sum(c) OVER (PARTITION BY {key} ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below, sum(c) OVER (PARTITION BY {key}) AS total FROM h{k}),
t{k} AS (SELECT {key}, max(bin) AS lim FROM w{k} WHERE below < total * {_real(cfg.support)} GROUP BY ALL),
s{k} AS (SELECT {', '.join('r.' + c for c in KEY)}, count(*) AS n, {', '.join(_sums_sql())} FROM x{k} r JOIN t{k} p ON {same} WHERE bin <= lim GROUP BY ALL),
p{k + 1} AS MATERIALIZED (SELECT {key}, {', '.join(_PARAMS)} FROM ({_nested(f'SELECT * FROM s{k}', _cholesky_sql(cfg.support / inside))}))""")
    k, limit = cfg.steps, chi2_quantile(cfg.reweight, P)
    last = f"""
sr AS (SELECT {key}, count(*) AS n, {', '.join(_sums_sql())} FROM ({distances(k, 'clean')}) WHERE d2 <= {_real(limit)} GROUP BY {key}),
p{k + 1} AS MATERIALIZED (SELECT {key}, {', '.join(_PARAMS)} FROM ({_nested('SELECT * FROM sr', _cholesky_sql(cfg.reweight / chi2_cdf(limit, P + 2)))}))"""
    spread = [f"quantile_cont({x}, CAST({q} AS DOUBLE)) AS q_{i}_{j}" for i, x in enumerate(XS) for j, q in enumerate((0.1, 0.5, 0.9))]
    start = [f"q_{i}_1 AS m_{i}" for i in range(P)] + [
        f"sqrt((q_{i}_2 - q_{i}_0) / {_real(DECILES)} * ((q_{i}_2 - q_{i}_0) / {_real(DECILES)}) + {_real((FEATURES[x] * GRID) ** 2)}) AS l_{i}_{j}" if i == j else f"CAST(0 AS DOUBLE) AS l_{i}_{j}"
        for i, x in enumerate(XS) for j in range(i + 1)]
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS ls FROM documents),
win AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i:i + {WINDOW - 1}]) AS c FROM (SELECT rid, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d)),
rep AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + {WINDOW})) AS j FROM win WHERE c > 1) GROUP BY rid),
stu AS (SELECT rid, count_if(w[i] = w[i - 1]) AS n FROM (SELECT rid, w, unnest(range(2, len(w) + 1)) AS i FROM d) GROUP BY rid),
b AS MATERIALIZED (SELECT d.rid, doc_id, lang, source, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars, {count(SYMBOLS)} AS n_symbols,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines, len(ls) AS n_lines, coalesce(rep.n, 0) AS n_repeat_words, {count('!?.,;:')} AS n_marks,
             len(regexp_extract_all(t, '\\p{{Lu}}')) AS n_upper, coalesce(stu.n, 0) AS n_stutter
      FROM d LEFT JOIN rep ON d.rid = rep.rid LEFT JOIN stu ON d.rid = stu.rid),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed,
             {share('n_symbols', chars)} AS f_symbols, {share('n_upper', chars)} AS f_upper, {share('n_marks', chars)} AS f_marks,
             CAST(floor(ln({chars} / CAST({words} AS DOUBLE)) * {GRID} + CAST(0.5 AS DOUBLE)) AS BIGINT) AS f_length,
             {share('n_dup_lines', lines)} AS f_lines, {share('n_repeat_words', words)} AS f_repeat, {share('n_stutter', words)} AS f_stutter FROM b),
z AS (SELECT *, CASE WHEN own THEN 0 WHEN sum(size) OVER (PARTITION BY own, lang) >= {cfg.min_group} THEN 1 ELSE 2 END AS g_level
      FROM (SELECT lang, source, count(*) AS size, count(*) >= {cfg.min_group} AS own FROM f WHERE NOT base_failed GROUP BY ALL)),
g AS MATERIALIZED (SELECT f.*, coalesce(z.g_level, 2) AS g_level, CASE WHEN z.g_level < 2 THEN f.lang END AS g_lang, CASE WHEN z.g_level = 0 THEN f.source END AS g_source
      FROM f LEFT JOIN z ON f.lang IS NOT DISTINCT FROM z.lang AND f.source IS NOT DISTINCT FROM z.source),
clean AS MATERIALIZED (SELECT * FROM (SELECT {key}, {', '.join(XS)}, count(*) OVER (PARTITION BY {key}) AS members FROM g WHERE NOT base_failed) WHERE members >= {cfg.min_group}),
q AS (SELECT {key}, {', '.join(spread)} FROM clean GROUP BY ALL),
p0 AS MATERIALIZED (SELECT {key}, {', '.join(start)} FROM q),{','.join(steps)},{last}
SELECT doc_id, {', '.join(BASE)}, base_failed, NOT base_failed AND (d2 IS NULL OR d2 <= {_real(chi2_quantile(1 - cfg.tail, P))}) AS kept, round(d2, 4) AS distance2
FROM ({_nested(f'SELECT r.*, p.* EXCLUDE ({key}) FROM g r LEFT JOIN p{k + 1} p ON {same}', _distance_sql())})"""


ORACLE_SQL = _oracle()
