"""Landing to staging: change rows, latest copy per badge and time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.times import as_time, now
from ..schemas import RAW_COLUMNS

DEDUP_KEY = ("badge_id", "event_timestamp")
# Copies with equal ingestion_time are settled by their content, so that a
# retried task picks the same one.
TIE_BREAK = ("reader_id", "zone_id", "user_id", "signal_strength", "direction")


def with_feed_metadata(rows: DataFrame, action: str = "INSERT", is_update=False) -> DataFrame:
    """Change-feed columns; an append-only table has inserts only.

    An update is a DELETE of the old row and an INSERT of the new one, both marked.
    """
    return rows.select(
        "*",
        F.lit(action).alias("_action"),
        F.lit(is_update).alias("_is_update"),
        F.xxhash64(*rows.columns).alias("_row_id"),
    )


def inserts_only(changes: DataFrame) -> DataFrame:
    if "_action" not in changes.columns:
        return changes
    return changes.filter(F.col("_action") == "INSERT")


def dedup_latest(rows: DataFrame, keys=DEDUP_KEY, newest: str = "ingestion_time") -> DataFrame:
    """Keep the newest copy per key.

    The ``= 1`` filter lets Spark drop all but one copy per key and partition
    before the shuffle, so a key with very many copies stays cheap. Rows are sorted by the
    last key first: times differ in the eight bytes that a sort compares at once, badge
    ids of one site do not.
    """
    ties = [F.col(c).asc_nulls_last() for c in TIE_BREAK if c in rows.columns]
    newest_first = Window.partitionBy(*reversed(keys)).orderBy(F.col(newest).desc_nulls_last(), *ties)
    return (
        rows.withColumn("_copy", F.row_number().over(newest_first))
        .filter(F.col("_copy") == 1)
        .drop("_copy")
    )


def raw_to_staging(changes: DataFrame, staging_time=None) -> DataFrame:
    """Filter to inserts, drop older copies, project, stamp the staging time."""
    stamp = now() if staging_time is None else as_time(staging_time)
    return dedup_latest(inserts_only(changes).select(*RAW_COLUMNS)).withColumn(
        "staging_time", stamp
    )


def pending_count(raw: DataFrame, stage_log: DataFrame) -> DataFrame:
    """Landing rows not yet consumed: rows landed minus rows read so far."""
    return _pending(raw.agg(F.count(F.lit(1)).alias("landed")), stage_log)


def pending_of_logs(ingest_log: DataFrame, stage_log: DataFrame) -> DataFrame:
    """The same from what the landing runs noted: the landing table is not read."""
    return _pending(ingest_log.agg(F.coalesce(F.sum("rows_inserted"), F.lit(0)).alias("landed")), stage_log)


def _pending(landed: DataFrame, stage_log: DataFrame) -> DataFrame:
    read = stage_log.agg(F.coalesce(F.sum("rows_read"), F.lit(0))).scalar()
    return landed.select(
        F.lit("Stream Pending Records").alias("check_type"),
        (F.col("landed") - read).cast("long").alias("pending_count"),
    )


def pending_status(raw: DataFrame, stage_log: DataFrame) -> DataFrame:
    """Does the change feed hold unread rows?"""
    return feed_status(pending_count(raw, stage_log))


def feed_status(pending: DataFrame) -> DataFrame:
    """The answer from a pending count."""
    return pending.select(
        F.lit("raw_badge_events_stream").alias("stream_name"),
        (F.col("pending_count") > 0).alias("has_data"),
    )


def has_pending(raw: DataFrame, stage_log: DataFrame) -> bool:
    return pending_status(raw, stage_log).first()["has_data"]
