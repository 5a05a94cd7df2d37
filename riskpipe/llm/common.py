"""Helpers shared by the operators: reading, shared scratch tables, word patterns."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpipe.session import scratch_path

#: Fixed by the contract: the characters that end a word, and the word pattern.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` would, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(), "riskpipe.zip")  # the driver serves it; executors fetch it from there
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(top)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text: Column) -> Column:
    """The words of a text; of a null text, none."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh table in the shared scratch folder and read back.

    This cuts the lineage: what follows is recomputed from the files, which every
    executor can reach, and not from the input.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by ``stored`` that nothing reads any more."""
    path = getattr(df, "_stored_path", None)
    if path is None:
        return
    spark = df.sparkSession
    jvm, sc = spark._jvm, spark.sparkContext
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
