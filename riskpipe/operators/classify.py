"""Sensitive-column classification.

The vendor classifier is closed, so the rules here are our own: a column's
*name* and a profile of its *values* decide a semantic category and a privacy
category.  The value profile of every column of a table is computed in **one**
aggregate pass (null count, match counts);
each map task pre-aggregates, so the pass costs one scan whatever the size.
The wide profile row is unpivoted to one row per column and classified with
column expressions; nothing is collected.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from riskpipe.sources.csv_ingest import utc_now
from pyspark.sql import types as T


@dataclass(frozen=True)
class ClassificationProfile:
    """Options of a classification run (G1)."""
    minimum_object_age_for_classification_days: int = 0
    maximum_classification_validity_days: int = 30
    auto_tag: bool = True
    value_match_threshold: float = 0.8


# fixed values: name rules (regex on the lower-cased column name → semantic, privacy)
NAME_RULES = [
    (r"(^|_)(policy_number|account_number|ssn|passport)($|_)", "IDENTIFIER", "IDENTIFIER"),
    (r"(^|_)(email)($|_)", "EMAIL", "IDENTIFIER"),
    (r"(^|_)(phone)($|_)", "PHONE_NUMBER", "IDENTIFIER"),
    (r"(^|_)(name|first_name|last_name)$", "NAME", "IDENTIFIER"),
    (r"(^|_)age$", "AGE", "QUASI_IDENTIFIER"),
    (r"(^|_)(sex|gender)($|_)", "GENDER", "QUASI_IDENTIFIER"),
    (r"(^|_)occupation($|_)", "OCCUPATION", "QUASI_IDENTIFIER"),
    (r"(^|_)education", "EDUCATION", "QUASI_IDENTIFIER"),
    (r"(^|_)state($|_)", "US_STATE_OR_PROVINCE", "QUASI_IDENTIFIER"),
    (r"(amount|premium|deductable|deductible|salary|income)", "FINANCIAL_AMOUNT", "SENSITIVE"),
]
# fixed values: US state names (value rule by set membership)
US_STATES = ["Alabama", "Alaska", "Arizona", "Arkansas", "California", "Colorado", "Connecticut", "Delaware",
             "Florida", "Georgia", "Hawaii", "Idaho", "Illinois", "Indiana", "Iowa", "Kansas", "Kentucky",
             "Louisiana", "Maine", "Maryland", "Massachusetts", "Michigan", "Minnesota", "Mississippi",
             "Missouri", "Montana", "Nebraska", "Nevada", "New Hampshire", "New Jersey", "New Mexico",
             "New York", "North Carolina", "North Dakota", "Ohio", "Oklahoma", "Oregon", "Pennsylvania",
             "Rhode Island", "South Carolina", "South Dakota", "Tennessee", "Texas", "Utah", "Vermont",
             "Virginia", "Washington", "West Virginia", "Wisconsin", "Wyoming"]
# fixed values: value rules (regex, or a set of values, on trimmed text → semantic, privacy)
VALUE_RULES = [
    (r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$", "EMAIL", "IDENTIFIER"),
    (r"^\+?[0-9][0-9 ().-]{8,}[0-9]$", "PHONE_NUMBER", "IDENTIFIER"),
    (r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$", "NATIONAL_IDENTIFIER", "IDENTIFIER"),
    (US_STATES, "US_STATE_OR_PROVINCE", "QUASI_IDENTIFIER"),
    (["M", "F", "Male", "Female", "MALE", "FEMALE"], "GENDER", "QUASI_IDENTIFIER"),
]


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


# Necessary conditions checked before each regex (AND short-circuits, so most
# values never reach the regex engine; the match result is unchanged).
REGEX_GUARDS = {
    "EMAIL": "instr({x}, '@') > 0",
    "PHONE_NUMBER": "length({x}) BETWEEN 10 AND 25",
    "NATIONAL_IDENTIFIER": "length({x}) = 11",
}


def _match_sql(text: str, rule, semantic: str | None = None) -> str:
    """Set rules are a hash lookup (IN); regex rules use RLIKE behind a cheap guard."""
    if isinstance(rule, list):
        return f"{text} IN ({', '.join(_sql_str(v) for v in rule)})"
    guard = REGEX_GUARDS.get(semantic)
    match = f"{text} RLIKE {_sql_str(rule)}"
    return f"({guard.format(x=text)} AND {match})" if guard else match


def _profile_aggs(df: DataFrame) -> list[Column]:
    """All per-column profile aggregates as SQL expressions (one parse each, one pass)."""
    exprs = ["count(1) AS __rows"]
    for i, f in enumerate(df.schema.fields):
        c = "`" + f.name.replace("`", "``") + "`"
        exprs.append(f"count({c}) AS n{i}")
        for j, (rule, semantic, _) in enumerate(VALUE_RULES):
            if isinstance(f.dataType, T.StringType):
                exprs.append(f"count_if({_match_sql(f'trim({c})', rule, semantic)}) AS v{i}_{j}")
            else:
                exprs.append(f"CAST(0 AS BIGINT) AS v{i}_{j}")
    return [F.expr(e) for e in exprs]


def profile(df: DataFrame) -> DataFrame:
    """One row per column: (column, data_type, rows, non_null, matches)."""
    wide = df.agg(*_profile_aggs(df))
    per_col = []
    for i, f in enumerate(df.schema.fields):
        per_col.append(F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"n{i}").cast("long").alias("non_null"),
            F.array(*[F.col(f"v{i}_{j}").cast("long") for j in range(len(VALUE_RULES))]).alias("matches")))
    return wide.select(F.col("__rows").cast("long").alias("rows"), F.inline(F.array(*per_col)))


def _name_rule(col: Column, idx: int) -> Column:
    """Semantic (idx 1) or privacy (idx 2) category from the first matching name rule."""
    out = F.lit(None).cast("string")
    for rx, sem, priv in reversed(NAME_RULES):
        out = F.when(F.lower(col).rlike(rx), F.lit(sem if idx == 1 else priv)).otherwise(out)
    return out


def classify(df: DataFrame, table: str, profile_opts: ClassificationProfile = ClassificationProfile(),
             classified_at: Column | None = None) -> DataFrame:
    """G1: (table_name, column_name, semantic_category, privacy_category, confidence,
    null_rate, classified_at), one row per column, one scan of ``df``."""
    p = profile(df)
    thr = profile_opts.value_match_threshold
    rate = [F.when(F.col("non_null") > 0, F.col("matches")[j] / F.col("non_null")).otherwise(F.lit(0.0))
            for j in range(len(VALUE_RULES))]
    value_sem = F.lit(None).cast("string")
    value_priv = F.lit(None).cast("string")
    for j in reversed(range(len(VALUE_RULES))):
        _, sem, priv = VALUE_RULES[j]
        value_sem = F.when(rate[j] >= thr, F.lit(sem)).otherwise(value_sem)
        value_priv = F.when(rate[j] >= thr, F.lit(priv)).otherwise(value_priv)
    name_sem, name_priv = _name_rule(F.col("column_name"), 1), _name_rule(F.col("column_name"), 2)
    sem = F.coalesce(value_sem, name_sem)
    priv = F.coalesce(value_priv, name_priv)
    conf = (F.when(value_sem.isNotNull() & (value_sem == name_sem), "HIGH")
            .when(value_sem.isNotNull(), "MEDIUM")
            .when(name_sem.isNotNull(), "MEDIUM")
            .otherwise(None))
    at = classified_at if classified_at is not None else utc_now()
    return p.select(
        F.lit(table).alias("table_name"), "column_name", "data_type",
        sem.alias("semantic_category"), priv.alias("privacy_category"), conf.alias("confidence"),
        F.when(F.col("rows") > 0, 1.0 - F.col("non_null") / F.col("rows")).alias("null_rate"),
        at.alias("classified_at"))


def classification_result(results: DataFrame, table: str) -> DataFrame:
    """The stored classification of one table."""
    return results.where(F.col("table_name") == table)


def tags(results: DataFrame, table: str | None = None) -> DataFrame:
    """Tag references (table, column, tag_name, tag_value) of classified columns."""
    r = results if table is None else results.where(F.col("table_name") == table)
    r = r.where(F.col("semantic_category").isNotNull())
    return r.select("table_name", "column_name", F.inline(F.array(
        F.struct(F.lit("SEMANTIC_CATEGORY").alias("tag_name"), F.col("semantic_category").alias("tag_value")),
        F.struct(F.lit("PRIVACY_CATEGORY").alias("tag_name"), F.col("privacy_category").alias("tag_value")))))


def apply_tags_as_metadata(df: DataFrame, tag_rows: list[tuple[str, str, str]]) -> DataFrame:
    """auto_tag: carry (column, tag_name, tag_value) as column metadata of ``df``.

    ``tag_rows`` is the (small, one-per-column) collected tag list."""
    by_col: dict[str, dict] = {}
    for col, name, value in tag_rows:
        by_col.setdefault(col, {})[name.lower()] = value
    return df.select(*[F.col(f"`{c}`").alias(c, metadata={"tags": by_col[c]}) if c in by_col else F.col(f"`{c}`")
                       for c in df.columns])


RESULT_SCHEMA = ("table_name string, column_name string, data_type string, semantic_category string, privacy_category string, "
                 "confidence string, null_rate double, classified_at timestamp_ntz")
TAG_SCHEMA = "table_name string, column_name string, tag_name string, tag_value string"


def _there(spark, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def needs_classification(spark, results_path: str, table: str,
                         profile_opts: ClassificationProfile = ClassificationProfile(),
                         now: _dt.datetime | None = None, object_created: _dt.datetime | None = None) -> bool:
    """Re-classify only when the last result is older than the validity window and
    the object is at least the minimum age (both from the profile)."""
    now = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    if object_created is not None and \
            (now - object_created).days < profile_opts.minimum_object_age_for_classification_days:
        return False
    if not _there(spark, results_path):
        return True
    last = (spark.read.schema(RESULT_SCHEMA).parquet(results_path).where(F.col("table_name") == table)
            .agg(F.max("classified_at")).first()[0])
    if last is None:
        return True
    return (now - last).days >= profile_opts.maximum_classification_validity_days


def tags_path(results_path: str) -> str:
    return f"{results_path.rstrip('/')}_tags"


def classify_and_store(spark, df: DataFrame, table: str, results_path: str,
                       profile_opts: ClassificationProfile = ClassificationProfile(), *, force: bool = False) -> bool:
    """Run G1 if stale (or forced) and append the result; returns whether it ran.

    With ``auto_tag`` the tags of the table's columns are stored too, in place of its earlier ones."""
    if not force and not needs_classification(spark, results_path, table, profile_opts):
        return False
    classify(df, table, profile_opts).write.mode("append").parquet(results_path)
    if profile_opts.auto_tag:
        newest = classification_result(spark.read.schema(RESULT_SCHEMA).parquet(results_path), table)
        last = newest.agg(F.max("classified_at").alias("_at"))   # one row
        (tags(newest.join(F.broadcast(last), F.col("classified_at") == F.col("_at")))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("table_name").parquet(tags_path(results_path)))
    return True


def stored_tags(spark, results_path: str) -> DataFrame:
    """The tags as stored."""
    if not _there(spark, tags_path(results_path)):
        return spark.createDataFrame([], TAG_SCHEMA)
    return spark.read.schema(TAG_SCHEMA).parquet(tags_path(results_path)).select("table_name", "column_name", "tag_name", "tag_value")


@dataclass
class SchemaProfile:
    """A classification profile set on a schema: its options hold for every table, one scan each."""
    results_path: str
    options: ClassificationProfile = ClassificationProfile()
    active: bool = True

    def unset(self) -> None:
        """Tables are no longer classified; what is stored stays."""
        self.active = False

    def run(self, spark, tables: dict[str, DataFrame], *, force: bool = False) -> list[str]:
        """Classify the tables that need it; returns their names."""
        if not self.active:
            return []
        return [name for name, df in tables.items() if classify_and_store(spark, df, name, self.results_path, self.options, force=force)]
