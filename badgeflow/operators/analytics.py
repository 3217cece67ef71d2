"""Validation reports and access analytics on the star schema.

Joins to a dimension come after the counts wherever the report allows: a zone or
user holding most events is then one row at the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numbers import mean, median_of_counts, percent, ratio, value_counts
from ..functions.times import as_time, seconds_between
from .dimensions import UNKNOWN, users_current
from .staging import pending_count
from .transform import UNKNOWN_SIGNAL


def _n() -> Column:
    return F.count(F.lit(1))


def _union(frames: list[DataFrame]) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def _day(as_of) -> Column:
    return F.to_date(as_time(as_of))


# -- row counts over the layers ------------------------------------------------


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows per layer, largest first."""
    counts = [
        df.agg(_n().alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        for name, df in layers.items()
    ]
    return _union(counts).orderBy(F.col("row_count").desc(), "layer")


def layer_count_diff(layers: dict[str, DataFrame]) -> DataFrame:
    """Each layer's count and the previous layer's surplus over it, by layer name."""
    previous = F.lag("row_count").over(Window.orderBy("layer"))  # one row per layer
    return layer_counts(layers).select(
        "layer",
        F.col("row_count").alias("cnt"),
        (previous - F.col("row_count")).alias("difference"),
    )


# -- dimensions ------------------------------------------------------------------


def dim_user_summary(users: DataFrame) -> DataFrame:
    return users_current(users).agg(
        F.lit("DIM_USERS").alias("dimension_name"),
        _n().alias("total_users"),
        F.count_if(F.col("user_name") == UNKNOWN).alias("auto_created_users"),
        F.count_if(F.col("user_name") != UNKNOWN).alias("seed_users"),
    )


def auto_created_users(users: DataFrame, sample: int = 5) -> DataFrame:
    """A sample report of members that were created from events."""
    return (
        users_current(users)
        .filter(F.col("user_name") == UNKNOWN)
        .select(
            F.lit("Sample Auto-Created Users").alias("check_type"),
            "user_id",
            "user_name",
            "clearance_level",
            "created_timestamp",
        )
        .orderBy("user_id")
        .limit(sample)
    )


# -- fact reports ----------------------------------------------------------------


def fact_date_range(facts: DataFrame) -> DataFrame:
    return facts.agg(
        F.lit("FCT_ACCESS_EVENTS").alias("table_name"),
        _n().alias("total_events"),
        F.min("event_date").alias("earliest_date"),
        F.max("event_date").alias("latest_date"),
        F.min("event_timestamp").alias("earliest_timestamp"),
        F.max("event_timestamp").alias("latest_timestamp"),
    )


def events_by_date(facts: DataFrame, dates: int = 10, approximate: bool = False) -> DataFrame:
    """Events, distinct badges and zones of the latest dates.

    The oldest of those dates is found first, so only their partitions are read.
    """
    latest = facts.select("event_date").distinct().orderBy(F.col("event_date").desc()).limit(dates)
    oldest = latest.agg(F.min("event_date")).scalar()
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    return (
        facts.filter(F.col("event_date") >= oldest)
        .groupBy("event_date")
        .agg(
            _n().alias("event_count"),
            distinct("badge_id").alias("unique_badges"),
            distinct("zone_key").alias("unique_zones"),
        )
        .orderBy(F.col("event_date").desc())
    )


def direction_distribution(facts: DataFrame) -> DataFrame:
    counts = facts.groupBy("direction").agg(_n().alias("event_count"))
    total = counts.agg(F.sum("event_count")).scalar()
    return counts.select(
        "direction", "event_count", percent(F.col("event_count"), total).alias("percentage")
    ).orderBy(F.col("event_count").desc(), "direction")


def signal_quality_distribution(facts: DataFrame, exclude_unknown: bool = False) -> DataFrame:
    """Events and mean signal per class; the unknown marker counts unless excluded."""
    signal = F.col("signal_strength")
    if exclude_unknown:
        signal = F.when(signal != UNKNOWN_SIGNAL, signal)
    return (
        facts.groupBy("signal_quality")
        .agg(_n().alias("event_count"), F.round(mean(signal), 2).alias("avg_signal_strength"))
        .orderBy(F.col("event_count").desc(), "signal_quality")
    )


def flag_shares(facts: DataFrame) -> DataFrame:
    """After-hours, weekend and restricted events and their share, in one scan."""
    flags = {
        "After-Hours Events": "is_after_hours",
        "Weekend Events": "is_weekend",
        "Restricted Access Events": "is_restricted_access",
    }
    totals = facts.agg(
        _n().alias("total"), *[F.count_if(F.col(f)).alias(f) for f in flags.values()]
    )
    return totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(label).alias("category"),
                        F.col(flag).alias("event_count"),
                        F.coalesce(percent(F.col(flag), F.col("total")), F.lit(0.0)).alias(
                            "percentage"
                        ),
                    )
                    for label, flag in flags.items()
                ]
            )
        )
    )


def top_zones(facts: DataFrame, zones: DataFrame, k: int = 5) -> DataFrame:
    counts = facts.groupBy("zone_key").agg(_n().alias("n"))
    return (
        counts.join(zones.select("zone_key", "zone_name", "zone_type"), "zone_key")
        .groupBy("zone_name", "zone_type")
        .agg(F.sum("n").alias("access_count"))
        .orderBy(F.col("access_count").desc(), "zone_name", "zone_type")
        .limit(k)
    )


def top_badges(facts: DataFrame, users: DataFrame, k: int = 5) -> DataFrame:
    counts = facts.groupBy("badge_id", "user_key").agg(_n().alias("n"))
    return (
        counts.join(users.select("user_key", "user_name", "user_type"), "user_key")
        .groupBy("badge_id", "user_name", "user_type")
        .agg(F.sum("n").alias("access_count"))
        .orderBy(F.col("access_count").desc(), "badge_id", "user_name", "user_type")
        .limit(k)
    )


def fact_completeness(facts: DataFrame) -> DataFrame:
    nulls = {
        "null_badge_id": "badge_id",
        "null_user_key": "user_key",
        "null_zone_key": "zone_key",
        "null_timestamp": "event_timestamp",
        "null_direction": "direction",
    }
    return facts.agg(
        F.lit("Completeness Check").alias("check_type"),
        _n().alias("total_records"),
        *[F.count_if(F.col(c).isNull()).alias(name) for name, c in nulls.items()],
    )


def latency_counts(facts: DataFrame) -> DataFrame:
    """(v, n): how often each number of seconds from landing to fact occurs.

    Counts add up: those of every load, stored, give the latencies of the whole fact.
    """
    latency = facts.filter(F.col("fact_load_time").isNotNull()).select(
        seconds_between("ingestion_time", "fact_load_time").alias("latency")
    )
    return value_counts(latency, "latency")


def ingestion_latency(facts: DataFrame) -> DataFrame:
    """Min, max, mean and exact median seconds from landing to fact."""
    return latency_report(latency_counts(facts))


def latency_report(counts: DataFrame) -> DataFrame:
    """The same from ``latency_counts``, or from the stored ones of all loads."""
    return counts.agg(
        F.lit("Ingestion Latency").alias("metric"),
        F.min("v").alias("min_latency_sec"),
        F.max("v").alias("max_latency_sec"),
        F.round(ratio(F.sum(F.col("v") * F.col("n")), F.sum("n")), 6).alias("avg_latency_sec"),
    ).withColumn("median_latency_sec", median_of_counts(counts).scalar())


def pipeline_verdict(
    layers: dict[str, DataFrame],
    raw: DataFrame,
    stage_log: DataFrame,
    run_log: DataFrame,
    facts: DataFrame,
    max_latency_sec: int = 120,
) -> DataFrame:
    """One row: do the layers agree, is nothing pending, did all runs succeed?"""
    counts = layer_counts(layers).agg(
        (F.min("row_count") == F.max("row_count")).alias("counts_match")
    )
    failed = run_log.agg(F.count_if(F.col("state") == "FAILED")).scalar()
    slowest = facts.agg(F.max(seconds_between("ingestion_time", "fact_load_time"))).scalar()
    pending = pending_count(raw, stage_log).select("pending_count").scalar()
    checks = {
        "stream_empty": pending == 0,
        "no_failed_tasks": failed == 0,
        "latency_ok": slowest < max_latency_sec,
    }
    healthy = F.col("counts_match")
    for name in checks:
        healthy = healthy & F.col(name)
    return counts.withColumns(checks).withColumn("pipeline_ok", healthy)


# -- access analytics ------------------------------------------------------------


def events_in_range(facts: DataFrame, first_day, last_day) -> DataFrame:
    """Facts of a date range; reads only those partitions."""
    return facts.filter(F.col("event_date").between(F.lit(first_day), F.lit(last_day)))


def user_access_history(
    facts: DataFrame, users: DataFrame, zones: DataFrame, badge_id, as_of, days: int = 7
) -> DataFrame:
    """One badge's events of the last days with user and zone names."""
    badge = badge_id if isinstance(badge_id, Column) else F.lit(badge_id)
    return (
        facts.filter((F.col("badge_id") == badge) & (F.col("event_date") >= F.date_sub(_day(as_of), days)))
        .join(users.select("user_key", "user_name"), "user_key")
        .join(zones.select("zone_key", "zone_name"), "zone_key")
    )


def zone_entries(facts: DataFrame, day) -> DataFrame:
    return (
        facts.filter((F.col("event_date") == _day(day)) & (F.col("direction") == "ENTRY"))
        .groupBy("zone_key")
        .agg(_n().alias("entry_count"))
    )


def after_hours_alerts(facts: DataFrame, day) -> DataFrame:
    return facts.filter(
        F.col("is_after_hours")
        & F.col("is_restricted_access")
        & (F.col("event_date") == _day(day))
    )


def after_hours_restricted(
    facts: DataFrame, users: DataFrame, zones: DataFrame, day
) -> DataFrame:
    return (
        after_hours_alerts(facts, day)
        .join(users_current(users).select("user_key", "user_name"), "user_key")
        .join(zones.select("zone_key", "zone_name"), "zone_key")
        .select("user_name", "zone_name", "event_timestamp", "signal_quality")
        .orderBy(F.col("event_timestamp").desc())
    )


def daily_zone_access(facts: DataFrame, zones: DataFrame, as_of, days: int = 7) -> DataFrame:
    daily = (
        facts.filter(F.col("event_date") >= F.date_sub(_day(as_of), days))
        .groupBy("zone_key", "event_date")
        .agg(
            _n().alias("n"),
            F.count_if(F.col("direction") == "ENTRY").alias("n_in"),
            F.count_if(F.col("direction") == "EXIT").alias("n_out"),
        )
    )
    return (
        daily.join(zones.select("zone_key", "zone_name"), "zone_key")
        .groupBy("zone_name", "event_date")
        .agg(
            F.sum("n").alias("access_count"),
            F.sum("n_in").alias("entries"),
            F.sum("n_out").alias("exits"),
        )
        .orderBy("event_date", F.col("access_count").desc())
    )


def recent_events(rows: DataFrame, by: str, k: int = 10, ties: tuple[str, ...] = ()) -> DataFrame:
    """The k newest rows; ``ties`` make the choice repeatable."""
    return rows.orderBy(F.col(by).desc(), *ties).limit(k)
