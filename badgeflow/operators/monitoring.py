"""Monitoring views over the layers and over the operational logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import gib, mean, percent, ratio
from ..functions.times import ago, as_time, seconds_between, trunc_hour, trunc_minute
from .transform import UNKNOWN_SIGNAL

# Fixed values of the views.
STALE_AFTER, WARNING_AFTER = 300, 120
CREDITS_PER_GB = 0.01
SUCCEEDED, FAILED, SKIPPED = "SUCCEEDED", "FAILED", "SKIPPED"


def _n() -> Column:
    return F.count(F.lit(1))


def since(df: DataFrame, ts: str, as_of, day_column: str | None = None, **units: int) -> DataFrame:
    """Rows of the last hours or days, pruned by the date partition if there is one."""
    start = ago(as_time(as_of), **units)
    recent = df.filter(F.col(ts) >= start)
    if day_column and day_column in df.columns:
        recent = recent.filter(F.col(day_column) >= F.to_date(start))
    return recent


# -- layers ----------------------------------------------------------------------


def ingestion_metrics(raw: DataFrame, as_of, exclude_unknown: bool = False) -> DataFrame:
    """Hourly volume, signal and occupancy over 24 hours."""
    signal = F.col("signal_strength")
    if exclude_unknown:
        signal = F.when(signal != UNKNOWN_SIGNAL, signal)
    hourly = (
        since(raw, "ingestion_time", as_of, "ingest_date", days=1)
        .groupBy(trunc_hour("ingestion_time").alias("ingestion_hour"))
        .agg(
            _n().alias("event_count"),
            F.countDistinct("badge_id").alias("unique_badges"),
            F.countDistinct("zone_id").alias("unique_zones"),
            F.round(mean(signal), 2).alias("avg_signal_strength"),
            F.count_if(F.col("signal_quality") == "WEAK").alias("weak_signal_count"),
            F.count_if(F.col("direction") == "ENTRY").alias("entry_count"),
            F.count_if(F.col("direction") == "EXIT").alias("exit_count"),
        )
    )
    return hourly.select(
        "*",
        (F.col("event_count") / F.lit(3600.0)).alias("events_per_second"),
        percent(F.col("weak_signal_count"), F.col("event_count")).alias("weak_signal_pct"),
        (F.col("entry_count") - F.col("exit_count")).alias("net_occupancy_change"),
    ).orderBy(F.col("ingestion_hour").desc())


def pipeline_latency(layers: dict[str, tuple[DataFrame, str, str | None]], as_of) -> DataFrame:
    """Health per layer: ``{name: (rows, update time, date partition)}`` in order.

    A layer without updates in the last hour has no age and counts as HEALTHY.
    """
    at = as_time(as_of)
    frames = [
        since(df, ts, at, day, hours=1)
        .agg(F.max(ts).alias("last_update"), _n().alias("row_count"))
        .select(F.lit(i).alias("_order"), F.lit(name).alias("layer"), "last_update", "row_count")
        for i, (name, (df, ts, day)) in enumerate(layers.items())
    ]
    rows = frames[0]
    for frame in frames[1:]:
        rows = rows.unionByName(frame)
    return _health(rows, at)


def write_marks(rows: DataFrame, layer: str, ts: str) -> DataFrame:
    """(layer, written_at, n, mark_date): how many rows each write brought to a layer.

    A run writes its rows at one time, so a mark is a row a run, whatever it wrote.
    """
    return rows.groupBy(F.col(ts).alias("written_at")).agg(_n().alias("n")).select(
        F.lit(layer).alias("layer"), "written_at", "n", F.to_date("written_at").alias("mark_date")
    )


def latency_of_marks(marks: DataFrame, layers: tuple[str, ...], as_of) -> DataFrame:
    """``pipeline_latency`` of these layers, in order, from what their runs noted: no
    layer is read, and of the marks the last hour's days."""
    at = as_time(as_of)
    recent = (
        since(marks, "written_at", at, "mark_date", hours=1)
        .groupBy("layer")
        .agg(F.max("written_at").alias("last_update"), F.sum("n").alias("n"))
    )
    named = F.array(*[F.struct(F.lit(i).alias("_order"), F.lit(name).alias("layer")) for i, name in enumerate(layers)])
    rows = marks.sparkSession.range(1).select(F.inline(named)).join(F.broadcast(recent), "layer", "left")  # a row a layer
    return _health(rows.select("_order", "layer", "last_update", F.coalesce("n", F.lit(0)).alias("row_count")), at)


def _health(rows: DataFrame, at: Column) -> DataFrame:
    return (
        rows.withColumn("seconds_since_update", seconds_between("last_update", at))
        .withColumn(
            "health_status",
            F.when(F.col("seconds_since_update") > STALE_AFTER, "STALE")
            .when(F.col("seconds_since_update") > WARNING_AFTER, "WARNING")
            .otherwise("HEALTHY"),
        )
        .orderBy("_order")
        .drop("_order")
    )


def data_freshness(tables: dict[str, tuple[DataFrame, str]], as_of) -> DataFrame:
    """Newest event and write per table: ``{name: (rows, write time)}``."""
    at = as_time(as_of)
    rows = None
    for name, (df, written) in tables.items():
        one = df.agg(
            F.max("event_timestamp").alias("last_event_timestamp"),
            F.max(written).alias("last_ingestion_timestamp"),
            _n().alias("total_rows"),
            F.count_if(F.col(written) >= ago(at, hours=1)).alias("rows_last_hour"),
        ).select(
            F.lit(name).alias("table_name"),
            "*",
            seconds_between("last_event_timestamp", at).alias("event_age_seconds"),
            seconds_between("last_ingestion_timestamp", at).alias("ingestion_age_seconds"),
        )
        rows = one if rows is None else rows.unionByName(one)
    return rows


# -- ingest log ------------------------------------------------------------------


def channel_status(ingest_log: DataFrame, as_of) -> DataFrame:
    """Channel health over the last hour."""
    at = as_time(as_of)
    return (
        since(ingest_log, "server_timestamp", at, "log_date", hours=1)
        .groupBy("channel_name", "pipe_name")
        .agg(
            F.max("server_timestamp").alias("last_ingestion_time"),
            F.sum("rows_inserted").alias("total_rows_inserted"),
            gib(F.sum("bytes_inserted")).alias("total_gb_inserted"),
            F.countDistinct(trunc_minute("server_timestamp")).alias("active_minutes_last_hour"),
            F.round(mean(F.col("rows_inserted")), 6).alias("avg_rows_per_insert"),
            F.max("rows_inserted").alias("max_rows_per_insert"),
        )
        .withColumn(
            "seconds_since_last_ingestion", seconds_between("last_ingestion_time", at)
        )
    )


def streaming_costs(ingest_log: DataFrame, as_of) -> DataFrame:
    """Daily volume and estimated credits over 30 days."""
    return (
        since(ingest_log, "server_timestamp", as_of, "log_date", days=30)
        .groupBy(F.to_date("server_timestamp").alias("ingestion_date"))
        .agg(
            gib(F.sum("bytes_inserted")).alias("gb_ingested_uncompressed"),
            F.sum("rows_inserted").alias("rows_ingested"),
        )
        .select(
            "*",
            (F.col("gb_ingested_uncompressed") * F.lit(CREDITS_PER_GB)).alias("estimated_credits"),
            F.round(ratio(F.col("rows_ingested"), F.col("gb_ingested_uncompressed")), 0).alias(
                "rows_per_gb"
            ),
        )
        .orderBy(F.col("ingestion_date").desc())
    )


def streaming_cost_total(ingest_log: DataFrame, as_of) -> DataFrame:
    """Credits over 30 days; bytes are summed exactly, priced once."""
    return since(ingest_log, "server_timestamp", as_of, "log_date", days=30).agg(
        (gib(F.sum("bytes_inserted")) * F.lit(CREDITS_PER_GB)).alias("total_credits_last_30_days")
    )


def ingest_error_rate(ingest_log: DataFrame, as_of) -> DataFrame:
    """Parsed, inserted and rejected lines per channel over 24 hours."""
    return (
        since(ingest_log, "server_timestamp", as_of, "log_date", days=1)
        .groupBy("channel_name")
        .agg(
            F.sum("rows_parsed").alias("rows_parsed"),
            F.sum("rows_inserted").alias("rows_inserted"),
            F.sum("rows_error_count").alias("rows_error_count"),
            F.max_by(
                "last_error_message",
                F.when(F.col("last_error_message").isNotNull(), F.col("server_timestamp")),
            ).alias("last_error_message"),
        )
        .withColumn("error_pct", percent(F.col("rows_error_count"), F.col("rows_parsed"), 4))
        .withColumn("within_target", F.coalesce(F.col("error_pct") < 0.1, F.lit(True)))
    )


def pipe_volume(ingest_log: DataFrame, as_of) -> DataFrame:
    """Volume per pipe over seven days."""
    return (
        since(ingest_log, "server_timestamp", as_of, "log_date", days=7)
        .groupBy("pipe_name")
        .agg(
            gib(F.sum("bytes_inserted")).alias("gb_ingested"),
            F.sum("rows_inserted").alias("total_rows"),
        )
    )


# -- run log -----------------------------------------------------------------------


def task_history(
    run_log: DataFrame, as_of, hours: int = 24, limit: int | None = None
) -> DataFrame:
    """The runs of the last hours, newest first, with duration and mapped status."""
    state = F.col("state")
    rows = (
        since(run_log, "scheduled_time", as_of, "log_date", hours=hours)
        .select(
            F.col("name").alias("task_name"),
            "state",
            "scheduled_time",
            "completed_time",
            seconds_between("scheduled_time", "completed_time").alias("duration_seconds"),
            "error_code",
            "error_message",
            F.when(state == SUCCEEDED, "SUCCESS")
            .when(state.isin(FAILED, SKIPPED), state)
            .otherwise("UNKNOWN")
            .alias("execution_status"),
        )
        .orderBy(F.col("scheduled_time").desc(), "task_name")
    )
    return rows if limit is None else rows.limit(limit)


def task_durations(run_log: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """Runs and mean seconds per task, successful runs only."""
    return (
        task_history(run_log, as_of, hours)
        .filter(F.col("execution_status") == "SUCCESS")
        .groupBy("task_name")
        .agg(
            _n().alias("executions"),
            F.round(mean(F.col("duration_seconds")), 6).alias("avg_duration"),
        )
    )


def task_success_rate(run_log: DataFrame, as_of) -> DataFrame:
    succeeded = F.count_if(F.col("state") == SUCCEEDED)
    return (
        since(run_log, "scheduled_time", as_of, "log_date", days=1)
        .groupBy("name")
        .agg(
            _n().alias("total_runs"),
            succeeded.alias("successful"),
            F.count_if(F.col("state") == FAILED).alias("failed"),
            percent(succeeded, _n()).alias("success_pct"),
        )
    )


def task_failures(run_log: DataFrame) -> DataFrame:
    return (
        run_log.filter(F.col("state") == FAILED)
        .select("name", "error_code", "error_message", "scheduled_time")
        .orderBy(F.col("scheduled_time").desc(), "name")
    )


# -- scan and metering logs ----------------------------------------------------------


def partition_efficiency(
    scan_log: DataFrame, as_of, tables=("RAW_BADGE_EVENTS", "FCT_ACCESS_EVENTS")
) -> DataFrame:
    """Share of partitions read per table over a day, graded."""
    # Kept in hundredths as an exact decimal, so the mean does not depend on order.
    scanned = percent(F.col("partitions_scanned"), F.col("partitions_total")).cast("decimal(9,2)")
    stats = (
        since(scan_log, "start_time", as_of, days=1)
        .filter(F.col("table_name").isin(*tables) & (F.col("partitions_total") > 0))
        .select("table_name", scanned.alias("scan_pct"), "bytes_scanned")
    )
    average = mean(F.col("scan_pct"))
    return stats.groupBy("table_name").agg(
        _n().alias("query_count"),
        F.round(average, 2).alias("avg_scan_ratio_pct"),
        F.min("scan_pct").cast("double").alias("best_scan_ratio_pct"),
        F.max("scan_pct").cast("double").alias("worst_scan_ratio_pct"),
        F.round(ratio(gib(F.sum("bytes_scanned")), _n()), 2).alias("avg_gb_scanned"),
        F.when(average < 20, "EXCELLENT")
        .when(average < 50, "GOOD")
        .when(average < 80, "FAIR")
        .otherwise("POOR")
        .alias("pruning_efficiency"),
    )


def credit_usage(metering_log: DataFrame, as_of, warehouse: str, hours: int = 2) -> DataFrame:
    credits = F.col("credits_used")
    return (
        since(metering_log, "start_time", as_of, hours=hours)
        .filter(F.col("warehouse_name") == warehouse)
        .groupBy("warehouse_name")
        .agg(
            F.sum(credits).cast("double").alias("total_credits"),
            _n().alias("execution_count"),
            F.round(mean(credits), 4).alias("avg_credits_per_run"),
        )
    )
