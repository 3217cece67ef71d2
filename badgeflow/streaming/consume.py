"""Change feed to staging, once per landed row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators.staging import raw_to_staging
from ..sources.landing import changes

STAGE_LOG_SCHEMA = "rows_read long, rows_staged long, staged_at timestamp_ntz, _batch_id long"


def write_batch(rows: DataFrame, path: str, batch_id: int, *by: str) -> None:
    """Replace the partition of this batch: a replayed batch adds nothing.

    ``by`` divides it further, for rows that are the same in a replay.
    """
    (
        rows.withColumn("_batch_id", F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("_batch_id", *by)
        .parquet(path)
    )


def log_once(rows: DataFrame, path: str, batch_id: int, schema: str) -> None:
    """Append a batch's few log rows as one file, unless the log at ``path`` holds them.

    Batches come in order and only the last one can be replayed, so the newest batch in
    the log tells; the log needs no folder per batch and may be compacted at any time.
    """
    spark = rows.sparkSession
    spark.createDataFrame([], schema).write.mode("append").parquet(path)  # so that a first run finds a log
    newest = spark.read.schema(schema).parquet(path).agg(F.max("_batch_id")).first()[0]
    if newest is None or newest < batch_id:
        entry = rows.withColumn("_batch_id", F.lit(batch_id).cast("long"))
        entry.coalesce(1).write.mode("append").parquet(path)


def stage_batch(batch: DataFrame, batch_id: int, staged: str, log: str, staging_time=None) -> None:
    """Deduplicate one micro-batch into its staging partition and log it."""
    read, written = Observation(), Observation()
    counted = batch.observe(read, F.count(F.lit(1)).alias("rows_read"))
    rows = raw_to_staging(counted, staging_time)
    write_batch(
        rows.observe(written, F.count(F.lit(1)).alias("rows"), F.max("staging_time").alias("at")), staged, batch_id
    )
    # Logged after the rows are in place, with the same replay rule.
    seen = (read.get["rows_read"], written.get["rows"], written.get["at"])
    entry = batch.sparkSession.createDataFrame([seen], "rows_read long, rows_staged long, staged_at timestamp_ntz")
    log_once(entry, log, batch_id, STAGE_LOG_SCHEMA)


def stage_changes(
    spark: SparkSession,
    raw: str,
    staged: str,
    log: str,
    checkpoint: str,
    max_files: int | None = None,
    staging_time=None,
) -> None:
    """Consume everything landed since the last run.

    The offset moves when a batch is done; a crash before that replays the batch
    under the same id.
    """
    query = (
        changes(spark, raw, max_files)
        .writeStream.foreachBatch(
            lambda batch, batch_id: stage_batch(batch, batch_id, staged, log, staging_time)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
