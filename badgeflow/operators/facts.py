"""Fact load: calendar columns, dimension keys, no double counting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, Window, functions as F

from ..functions.times import as_time, now
from ..schemas import FACT_COLUMNS
from .dimensions import users_current
from .joins import salted_join
from .staging import DEDUP_KEY, dedup_latest

# Fixed values of the calendar.
DAY_STARTS_AT = 6
DAY_ENDS_AT = 22
SUNDAY, SATURDAY = 0, 6

PART_BITS = 17
# Ranges of the fact that a load names; days in excess are merged where they lie closest.
RANGES = 32


def calendar(ts: Column) -> dict[str, Column]:
    """Date, hour, day of week (0 = Sunday), after-hours and weekend flags."""
    hour = F.hour(ts)
    weekday = F.dayofweek(ts) - 1
    return {
        "event_date": F.to_date(ts),
        "event_hour": hour,
        "event_day_of_week": weekday,
        "is_after_hours": (hour < DAY_STARTS_AT) | (hour >= DAY_ENDS_AT),
        "is_weekend": weekday.isin(SUNDAY, SATURDAY),
    }


def with_calendar(events: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    return events.withColumns(calendar(F.col(ts)))


def not_loaded(staged: DataFrame, facts: DataFrame) -> DataFrame:
    """Staged rows whose (badge, time) is not in the fact yet.

    The caller prunes ``facts`` to the times it loads (``touching``).
    """
    return staged.join(facts.select(*DEDUP_KEY), list(DEDUP_KEY), "left_anti")


def time_spans(staged: DataFrame, ranges: int = RANGES) -> list[tuple]:
    """At most ``ranges`` (first, last) event times that hold a batch, in order.

    One per calendar day; of more days those with the least time between them share
    a range. So bad clocks cost a wider read, and never more than this many rows here.
    """
    return spans_of_days(days_between(staged), ranges)


def days_between(events: DataFrame) -> DataFrame:
    """(day, first, last): the days of event times, with the first and last of each."""
    return events.groupBy(F.to_date("event_timestamp").alias("day")).agg(
        F.min("event_timestamp").alias("first"), F.max("event_timestamp").alias("last")
    )


def days_of(profile: DataFrame) -> DataFrame:
    """The same from a ``profile``."""
    return profile.groupBy("day").agg(F.min("first").alias("first"), F.max("last").alias("last"))


def spans_of_days(days: DataFrame, ranges: int = RANGES) -> list[tuple]:
    """The same from (day, first, last)."""
    days = days.filter("day IS NOT NULL")
    in_order = Window.orderBy("day")  # one row per calendar day
    gaps = days.withColumn("before", F.lag("last").over(in_order)).withColumn(
        "gap", F.timestamp_diff("SECOND", F.col("before"), F.col("first"))
    )
    widest = gaps.orderBy(F.col("gap").desc_nulls_first(), "day").limit(ranges)
    end = days.agg(F.max("last")).scalar()
    cuts = widest.select(F.col("first").alias("since"), "before", end.alias("end")).orderBy("since").collect()
    ends = [cut.before for cut in cuts[1:]] + [cut.end for cut in cuts[:1]]
    return [(cut.since, until) for cut, until in zip(cuts, ends)]


def profile(batch: DataFrame, zones: DataFrame) -> DataFrame:
    """(day, user_id, placed, first, last, n): what a load must know of its batch, in one
    pass. ``placed`` rows have a known zone and can load now."""
    known = zones.select("zone_id", F.lit(True).alias("placed")).distinct()
    return (
        batch.join(known, "zone_id", "left")
        .groupBy(
            F.to_date("event_timestamp").alias("day"),
            "user_id",
            F.coalesce("placed", F.lit(False)).alias("placed"),
        )
        .agg(
            F.min("event_timestamp").alias("first"),
            F.max("event_timestamp").alias("last"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def touching(facts: DataFrame, spans: list[tuple]) -> DataFrame:
    """The part of the fact that a batch with these spans can overlap.

    Dates prune partitions. The Parquet reader does not compare zone-less times with the
    ranges of a row group, but it does compare the hour: spans within a day so skip the
    files and row groups of other hours, as rows are sorted by time. A batch of the last
    minute reads an hour of the fact, not all of today.
    """
    times, hours = F.lit(False), F.lit(False)
    for first, last in spans:
        times = times | F.col("event_timestamp").between(as_time(first), as_time(last))
        one_day = first.date() == last.date()
        hours = hours | (F.col("event_hour").between(first.hour, last.hour) if one_day else F.lit(True))
    return facts.filter(dates_within(F.col("event_date"), spans)).filter(times).filter(hours)


def dates_within(day: Column, spans: list[tuple]) -> Column:
    within = F.lit(False)
    for first, last in spans:
        within = within | day.between(F.lit(first.date()), F.lit(last.date()))
    return within


def keys_of(events: DataFrame) -> DataFrame:
    """The natural keys of events, each once."""
    return events.select(*DEDUP_KEY).distinct()


def fact_load(
    staged: DataFrame,
    users: DataFrame,
    zones: DataFrame,
    facts: DataFrame | None = None,
    load_time=None,
    hot_users: DataFrame | None = None,
) -> DataFrame:
    """New fact rows for staged events, without surrogate key.

    Staging may hold copies from different batches, so it is deduplicated by the
    fact's natural key; the anti-join on that key reuses the same shuffle. Events
    of unknown zones stay out until the zone exists.
    """
    fresh = dedup_latest(staged)
    if facts is not None:
        fresh = not_loaded(fresh, facts)
    members = users_current(users).select("user_id", "user_key")
    places = zones.select(
        "zone_id", "zone_key", F.col("is_restricted").alias("is_restricted_access")
    )
    # Zones first: the few zones are usually broadcast, and a hot user's
    # partition is then the last shuffle before the write.
    placed = fresh.join(places, "zone_id")
    if hot_users is None:
        keyed = placed.join(members, "user_id")
    else:
        keyed = salted_join(placed, members, "user_id", hot_users, DEDUP_KEY)
    stamp = now() if load_time is None else as_time(load_time)
    return with_calendar(keyed).withColumn("fact_load_time", stamp).select(*FACT_COLUMNS)


def unplaced(staged: DataFrame, zones: DataFrame) -> DataFrame:
    """Staged rows whose zone is not known yet; they load once it is.

    Only these few are deduplicated. An older copy kept here because the newest
    one had a known zone never loads: its key is in the fact by then.
    """
    return dedup_latest(staged.join(zones.select("zone_id"), "zone_id", "left_anti"))


def with_event_key(facts: DataFrame, first_key: int = 1) -> DataFrame:
    """Unique keys from ``first_key`` on; gaps are allowed.

    Keys number the rows of a partition, so they belong after the last shuffle: a
    task that runs again then renumbers only its own, uncommitted file. The row number
    stands above the partition's, so a load uses up 131,072 keys for each row of its
    largest task, and bigint lasts for tens of millions of loads of a million rows a task.
    """
    spark_id = F.monotonically_increasing_id()  # the partition above 33 bits of row number
    part, row = F.shiftright(spark_id, 33), spark_id.bitwiseAND(F.lit((1 << 33) - 1))
    too_many = F.raise_error(F.lit("a load writes with at most 131072 tasks")).cast("long")
    key = F.lit(first_key) + F.shiftleft(row, PART_BITS) + part
    return facts.withColumn("event_key", F.when(part < 1 << PART_BITS, key).otherwise(too_many))


def facts_writer(facts: DataFrame, first_key: int = 1, written: Observation | None = None) -> DataFrameWriter:
    """Rows laid out for the date-partitioned fact table, with keys from ``first_key``.

    REBALANCE sizes the files by volume: a date holding most rows is split over
    many tasks and small dates share one. ``written`` receives ``rows`` and the
    highest ``key``.
    """
    laid_out = facts.hint("rebalance", "event_date").sortWithinPartitions(
        "event_date", "event_timestamp"
    )
    keyed = with_event_key(laid_out, first_key)
    if written is not None:
        keyed = keyed.observe(
            written,
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.max("event_key"), F.lit(0)).alias("key"),
        )
    return keyed.write.partitionBy("event_date")


def write_facts(
    facts: DataFrame,
    path: str,
    first_key: int = 1,
    mode: str = "append",
    written: Observation | None = None,
) -> None:
    """Append to the fact table."""
    facts_writer(facts, first_key, written).mode(mode).parquet(path)


# Bits of each of the two coordinates of the curve.
CURVE_BITS = 16


def curve(badge: Column, ts: Column) -> Column:
    """Place of (badge, time of day) on a space-filling curve: the bits of a hash of the
    badge and of the second of the day in turn, the highest first.

    Rows near each other on the curve are near in both, so a file that holds a stretch of
    it has a short range of times and few badges' hashes.
    """
    second = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts).cast("int")
    steps = F.floor(second.cast("double") * ((1 << CURVE_BITS) / 86400.0)).cast("long")
    return _spread(_badge_hash(badge)) * 2 + _spread(steps)


def _badge_hash(badge: Column) -> Column:
    return F.pmod(F.xxhash64(badge), F.lit(1 << CURVE_BITS))


def _spread(x: Column) -> Column:
    """The bits of a 16-bit number with a zero before each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return x


def compact(facts: DataFrame, target: str, rows_per_file: int = 1_000_000, by_badge: bool = False) -> None:
    """Rewrite the fact by date and time order to a new path (never in place).

    Range partitions cut a large date by time, so no task takes a whole date; their
    number follows the row count, which Parquet answers from its footers. ``by_badge``
    lays the rows of a date along a curve of badge and time instead, with a Bloom filter
    of the badges in each row group: one badge's history then reads few of them, and a
    span of time is still a part of the date only.
    """
    parts = max(1, -(-facts.count() // rows_per_file))
    if by_badge:
        rows = facts.withColumn("_at", curve(F.col("badge_id"), F.col("event_timestamp")))
        order = ("event_date", "_at")
    else:
        rows, order = facts, ("event_date", "event_timestamp")
    laid_out = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("_at")
    writer = laid_out.write.mode("errorifexists").partitionBy("event_date")
    if by_badge:
        writer = writer.option("parquet.bloom.filter.enabled#badge_id", "true").option(
            "parquet.bloom.filter.adaptive.enabled", "true"
        )
    writer.parquet(target)
