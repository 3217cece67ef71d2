"""What the operators of this folder share: reading tables and counting words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from badgeflow.session import ship_package, work_dir

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Executors that lack this package, which the operators' Python workers
    import, get it first."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame, written to the cluster's shared folder and read back.

    Cuts the lineage: what follows survives a lost executor without repeating
    what came before, and a frame that is used twice is computed once.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def let(value: Column, body) -> Column:
    """``body(value)`` with value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]
