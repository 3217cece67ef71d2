"""NDJSON lines to the landing table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.transform import pipe_transform
from ..schemas import INGEST_LOG_SCHEMA
from ..sources.landing import ACCEPTED, LANDED, REJECTED
from .consume import log_once

INGEST_BATCH_LOG_SCHEMA = INGEST_LOG_SCHEMA.rstrip() + ", _batch_id long"


def land_raw(
    events: DataFrame,
    path: str,
    checkpoint: str,
    ingestion_time=None,
    name: str | None = None,
    **transform,
) -> StreamingQuery:
    """Transform lines and append them to the landing table, all that is there.

    Accepted rows and rejected lines go to two partitions of one table in one
    pass. Spark's file sink commits each micro-batch once: readers of the table
    see only committed files.
    """
    rows = pipe_transform(events, ingestion_time, **transform)
    bad = F.size("reject_reasons") > 0
    landing = rows.withColumns(
        {
            "status": F.when(bad, REJECTED).otherwise(ACCEPTED),
            "ingest_date": F.to_date("ingestion_time"),
        }
    )
    writer = (
        landing.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("status", "ingest_date")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if name:
        writer = writer.queryName(name)
    return writer.start(path)


def ingest_log_rows(landed: DataFrame, channel: str, pipe: str) -> DataFrame:
    """A log row for each arrival time of some landed rows (a micro-batch has one)."""
    bad = F.col("status") == REJECTED
    return landed.groupBy(F.col("ingestion_time").alias("server_timestamp")).agg(
        F.count(F.lit(1)).alias("rows_parsed"),
        F.count_if(~bad).alias("rows_inserted"),
        F.count_if(bad).alias("rows_error_count"),
        F.coalesce(F.sum(F.when(~bad, F.octet_length("raw_json"))), F.lit(0)).cast("long").alias("bytes_inserted"),
        F.max(F.when(bad, F.col("reject_reasons")[0])).alias("last_error_message"),
    ).select(
        F.lit(channel).alias("channel_name"), F.lit(pipe).alias("pipe_name"), "server_timestamp",
        "rows_parsed", "rows_inserted", "rows_error_count", "bytes_inserted", "last_error_message",
    )


def log_landed(spark: SparkSession, path: str, log: str, checkpoint: str, channel: str, pipe: str) -> None:
    """Log what landed since the last run, whatever its arrival times.

    The landing table is read by a stream of its own, so its checkpoint says what has
    been logged: a clock that was set back, or one time for several deliveries, hides no
    row, and each run reads the new files only.
    """
    query = (
        spark.readStream.schema(LANDED)
        .parquet(path)
        .writeStream.foreachBatch(
            lambda batch, batch_id: log_once(
                ingest_log_rows(batch, channel, pipe), log, batch_id, INGEST_BATCH_LOG_SCHEMA
            )
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
