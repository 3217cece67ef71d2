"""The hourly volume report kept up to date by a stream.

Distinct counts do not add up, but bitmaps do: badges and zones get dense numbers once,
and an hour keeps, beside its sums, one bitmap for each 32,768 numbers that occur in it.
State grows with hours and with badges, not with scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.numbers import ratio
from ..functions.times import trunc_hour
from ..operators.dimensions import dense_key, max_key
from .consume import write_batch

MEASURED = ("badge_id", "zone_id")
NUMBERS_SCHEMA = "kind string, id string, number long"
STATE_SCHEMA = """
    ingestion_hour timestamp_ntz, kind string, bucket long, members binary,
    event_count long, signal_sum decimal(38,2), signal_count long,
    weak_signal_count long, entry_count long, exit_count long, _batch_id long
"""
SUMS = ("event_count", "signal_sum", "signal_count", "weak_signal_count", "entry_count", "exit_count")


def numbers_of(rows: DataFrame, known: DataFrame) -> DataFrame:
    """(kind, id, number) of the ids that ``known`` lacks, numbered on from there."""
    ids = rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("id")) for c in MEASURED])).alias("x"))
    fresh = (
        ids.select("x.*")
        .filter("id IS NOT NULL")
        .distinct()
        .join(known.select("kind", "id"), ["kind", "id"], "left_anti")
    )
    named = fresh.withColumn("_name", F.concat_ws(" ", "kind", "id"))
    return dense_key(named, "_name", "number", max_key(known, "number")).select("kind", "id", "number")


def hourly_state(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """What adds up over batches: per clock hour a row of sums (kind is NULL), and a row
    with a bitmap for each kind and each 32,768 numbers."""
    timed = rows.withColumn("ingestion_hour", trunc_hour("ingestion_time"))
    sums = timed.groupBy("ingestion_hour").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.sum("signal_strength").cast("decimal(38,2)").alias("signal_sum"),
        F.count("signal_strength").alias("signal_count"),
        F.count_if(F.col("signal_quality") == "WEAK").alias("weak_signal_count"),
        F.count_if(F.col("direction") == "ENTRY").alias("entry_count"),
        F.count_if(F.col("direction") == "EXIT").alias("exit_count"),
    )
    # An id is one row an hour before it meets its number.
    seen = (
        timed.select(
            "ingestion_hour",
            F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("id")) for c in MEASURED])).alias("x"),
        )
        .select("ingestion_hour", "x.*")
        .distinct()
    )
    bits = (
        seen.join(numbers, ["kind", "id"])
        .groupBy("ingestion_hour", "kind", F.bitmap_bucket_number("number").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("members"))
    )
    return sums.unionByName(bits, allowMissingColumns=True)


def add_batch(rows: DataFrame, batch_id: int, path: str) -> None:
    """Number the ids that are new, then write the batch's state; a replay of the batch
    finds its ids numbered and replaces its partition."""
    spark = rows.sparkSession
    rows = rows.select("ingestion_time", *MEASURED, "signal_strength", "signal_quality", "direction")
    spark.createDataFrame([], NUMBERS_SCHEMA).write.mode("append").parquet(f"{path}/numbers")
    numbers = spark.read.schema(NUMBERS_SCHEMA).parquet(f"{path}/numbers")
    numbers_of(rows, numbers).write.mode("append").parquet(f"{path}/numbers")
    numbers = spark.read.schema(NUMBERS_SCHEMA).parquet(f"{path}/numbers")
    write_batch(hourly_state(rows, numbers), f"{path}/state", batch_id)


def write_rollup(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Add the state of every micro-batch of landing rows to the tables under ``path``.

    Nothing is held in the stream: a late row adds to its hour whenever it comes, and
    open hours are there as far as they go. A replayed batch replaces its partition.
    """
    return (
        rows.writeStream.foreachBatch(lambda batch, batch_id: add_batch(batch, batch_id, path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_state(spark, path: str) -> DataFrame:
    return spark.read.schema(STATE_SCHEMA).parquet(f"{path}/state")


def merged_state(state: DataFrame) -> DataFrame:
    """State of many batches as that of one: sums added, bitmaps united."""
    return state.groupBy("ingestion_hour", "kind", "bucket").agg(
        F.bitmap_or_agg("members").alias("members"), *[F.sum(c).alias(c) for c in SUMS]
    )


def hourly_report(state: DataFrame) -> DataFrame:
    """One row per clock hour with exact distinct counts, from the stored state."""
    merged = merged_state(state)
    count = lambda kind: F.coalesce(
        F.sum(F.when(F.col("kind") == kind, F.bitmap_count("members"))), F.lit(0)
    ).cast("long")
    hours = merged.groupBy("ingestion_hour").agg(
        *[F.sum(c).alias(c) for c in SUMS], count("badge_id").alias("unique_badges"), count("zone_id").alias("unique_zones")
    )
    return hours.select(
        "ingestion_hour",
        "event_count",
        "unique_badges",
        "unique_zones",
        F.round(ratio(F.col("signal_sum"), F.col("signal_count")), 2).alias("avg_signal_strength"),
        "weak_signal_count",
        "entry_count",
        "exit_count",
    )
