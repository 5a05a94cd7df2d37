"""Corpus preparation as a pipeline of training-data operators.

``STAGES`` lists the stages in order; each takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's docs.

1. quality     documents that the quality rules reject go
2. near_dups   one document of each group of near copies stays
3. pii         personal data in the texts gives way to the name of its kind
4. mix         each source is brought to its target, documents repeated or left out
5. tokens      the texts' byte-level BPE ids are added

All but the last return the columns of their input, whatever they are.  An empty table
passes through every stage as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskpipe.llm import bpe_tree, common, mixing, near_dups, outliers, pii


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return outliers.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.ship(spark)
    return near_dups.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.ship(spark)
    return pii.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.ship(spark)
    return bpe_tree.encoded(docs)


STAGES = [("quality", quality), ("near_dups", near_duplicates), ("pii", personal_data), ("mix", mix), ("tokens", tokens)]

#: Sketches and tokenizers are beyond SQL; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = common.documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = common.stored(docs, f"stage-{name}")
    return docs
