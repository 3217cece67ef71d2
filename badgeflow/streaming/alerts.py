"""Alerts raised while scans arrive: repeated keys, and users with too many events an hour.

A key is counted in the state of a streaming aggregate, by the clock hour of its scans; an
hour's keys are dropped when no scan of it is waited for any more, so state holds the last
hours and not all scans. What is reported depends on the scans and not on how they are cut
into batches.

State is larger than memory in a large batch: ``spark.sql.streaming.stateStore.providerClass``
is set to RocksDB by ``state_settings``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.times import instant, trunc_hour
from ..operators.quality import BUSY_EVENTS_PER_HOUR
from ..operators.staging import DEDUP_KEY
from .consume import write_batch

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
REPEATED, BUSY = "DUPLICATE_EVENTS", "ABNORMAL_ACTIVITY"
# Hours that ended longer than this before the newest scan are not looked at any more.
LATENESS = "1 hour"
_KEY = ["alert", "subject", "at"]
LOG_SCHEMA = "alert string, subject string, at timestamp_ntz, _batch_id long, alert_date date"


def state_settings(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _alerts(scans: DataFrame, rules: list[tuple[str, Column, Column, int]], lateness: str) -> DataFrame:
    """rules: (alert, subject, time, limit). One stream for all of them.

    A key above its limit comes in every batch that adds to it; ``write_alerts`` takes it
    once. The scans of a key lie in one hour, so the hour adds no groups. They are combined
    in each task first: a user with a third of all scans is a few rows from each task.
    """
    keys = F.array(*[F.struct(F.lit(name).alias("alert"), subject.alias("subject"), at.alias("at")) for name, subject, at, _ in rules])
    over = F.lit(False)
    for name, _, _, limit in rules:
        over = over | ((F.col("alert") == name) & (F.col("n") > limit))
    counted = (
        scans.withColumn("_ts", instant("event_timestamp"))
        .withWatermark("_ts", lateness)
        .select(F.window("_ts", "1 hour").alias("hour"), F.explode(keys).alias("key"))
        .filter("key.subject IS NOT NULL AND key.at IS NOT NULL")
        .groupBy("hour", *[F.col(f"key.{c}").alias(c) for c in _KEY])
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.filter(over).select(*_KEY)


def _repeated() -> tuple[str, Column, Column, int]:
    badge, at = DEDUP_KEY
    return REPEATED, F.col(badge), F.col(at), 1


def _busy(more_than: int) -> tuple[str, Column, Column, int]:
    return BUSY, F.col("user_id"), trunc_hour("event_timestamp"), more_than


def repeated_keys(scans: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """An alert for each (badge, time) that comes again, once."""
    return _alerts(scans, [_repeated()], lateness)


def busy_users(scans: DataFrame, more_than: int = BUSY_EVENTS_PER_HOUR, lateness: str = LATENESS) -> DataFrame:
    """An alert for each user and clock hour with more than so many scans, once, when the
    limit is passed."""
    return _alerts(scans, [_busy(more_than)], lateness)


def scan_alerts(scans: DataFrame, more_than: int = BUSY_EVENTS_PER_HOUR, lateness: str = LATENESS) -> DataFrame:
    """Both kinds, from one reading of the scans."""
    return _alerts(scans, [_repeated(), _busy(more_than)], lateness)


def _write_new(batch: DataFrame, path: str, batch_id: int) -> None:
    """Write the alerts of a batch that no earlier batch has in the log at ``path``.

    Only the days of the log that the batch reports on are read.
    """
    dated = batch.withColumn("alert_date", F.to_date("at"))
    if batch_id == 0:
        write_batch(dated, path, batch_id, "alert_date")
        return
    dated.persist()  # the state is brought up to date once
    first, last = dated.agg(F.min("alert_date"), F.max("alert_date")).first()
    if first is not None:
        log = batch.sparkSession.read.schema(LOG_SCHEMA).parquet(path)
        told = log.filter((F.col("_batch_id") < batch_id) & F.col("alert_date").between(F.lit(first), F.lit(last)))
        write_batch(dated.join(told.select(*_KEY), _KEY, "left_anti"), path, batch_id, "alert_date")
    dated.unpersist()


def write_alerts(alerts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the alerts of every micro-batch to the log at ``path``, each alert once."""
    return (
        alerts.writeStream.foreachBatch(lambda batch, batch_id: _write_new(batch, path, batch_id))
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
