"""The endpoint's NDJSON files, the landing table, and its change feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.staging import with_feed_metadata
from ..schemas import LANDING_SCHEMA, RAW_COLUMNS

ACCEPTED, REJECTED = "accepted", "rejected"
LANDED = LANDING_SCHEMA.rstrip() + ", ingest_date date"


def read_events(
    spark: SparkSession, path: str, streaming: bool = True, max_files: int | None = None
) -> DataFrame:
    """Lines (``value``) of the NDJSON files under ``path``."""
    if not streaming:
        return spark.read.text(path)
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Accepted landing rows."""
    landed = spark.read.schema(LANDED).parquet(path)
    return landed.filter(F.col("status") == ACCEPTED).select(*RAW_COLUMNS, "raw_json", "ingest_date")


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    landed = spark.read.schema(LANDED).parquet(path)
    return landed.filter(F.col("status") == REJECTED).select(
        "raw_json", "reject_reasons", "ingestion_time"
    )


def changes(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Change feed: accepted rows landed since the consumer's checkpoint."""
    reader = spark.readStream.schema(LANDED)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.parquet(path).filter(F.col("status") == ACCEPTED)
    return with_feed_metadata(rows.select(*RAW_COLUMNS))
