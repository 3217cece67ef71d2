from datetime import datetime, timedelta
from decimal import Decimal

from badgeflow.operators import staging
from badgeflow.schemas import RAW_SCHEMA

T0 = datetime(2024, 1, 5, 10)


def raw(spark, rows):
    """rows: (badge, minute, reader, seconds until ingestion)"""
    return spark.createDataFrame(
        [
            (b, "U", "Z", r, T0 + timedelta(minutes=m), Decimal("-50.00"), "STRONG", "ENTRY",
             T0 + timedelta(minutes=m, seconds=s), "{}")
            for b, m, r, s in rows
        ],
        RAW_SCHEMA,
    )


def test_newest_copy_wins(spark):
    rows = raw(spark, [("B1", 0, "R1", 1), ("B1", 0, "R2", 9), ("B1", 1, "R1", 1)])
    kept = {(r.event_timestamp, r.reader_id) for r in staging.raw_to_staging(rows, T0).collect()}
    assert kept == {(T0, "R2"), (T0 + timedelta(minutes=1), "R1")}


def test_ties_do_not_depend_on_order(spark):
    rows = [("B1", 0, f"R{i}", 5) for i in range(20)]
    for given in (rows, rows[::-1]):
        kept = staging.dedup_latest(raw(spark, given).repartition(7)).collect()
        assert [r.reader_id for r in kept] == ["R0"]


def test_one_event_with_very_many_copies(spark):
    """A third of all rows are copies of one event; most go before the shuffle."""
    many = spark.range(30000).selectExpr(
        "if(id % 3 = 0, 'HOT', concat('B', id)) badge_id", "'U' user_id", "'Z' zone_id",
        "concat('R', id) reader_id", "timestamp_ntz'2024-01-05 10:00:00' event_timestamp",
        "cast(-50 as decimal(5,2)) signal_strength", "'STRONG' signal_quality",
        "'ENTRY' direction", "timestamp_ntz'2024-01-05 10:00:05' ingestion_time",
    ).repartition(6)
    kept = staging.dedup_latest(many)
    assert kept.count() == 20001
    plan = kept._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_feed_metadata_and_filter(spark):
    feed = staging.with_feed_metadata(raw(spark, [("B1", 0, "R1", 1)]))
    row = feed.first()
    assert (row._action, row._is_update) == ("INSERT", False)
    deleted = feed.withColumn("_action", staging.F.lit("DELETE"))
    assert staging.inserts_only(feed.unionByName(deleted)).count() == 1
    assert staging.raw_to_staging(deleted, T0).count() == 0


def test_pending_counts_copies_too(spark):
    rows = raw(spark, [("B1", 0, "R1", 1), ("B1", 0, "R2", 9), ("B2", 0, "R1", 1)])
    log = spark.createDataFrame([(2,)], "rows_read long")
    assert staging.pending_count(rows, log).first().pending_count == 1
    assert staging.has_pending(rows, log)
    assert not staging.has_pending(rows, log.unionAll(spark.createDataFrame([(1,)], "rows_read long")))
    assert staging.has_pending(rows, log.limit(0))


def test_copies_are_sorted_by_time_first(spark):
    """Badge ids share their first bytes, which are all that a sort compares at once."""
    rows = spark.createDataFrame([], "badge_id string, event_timestamp timestamp_ntz, ingestion_time timestamp_ntz")
    plan = staging.dedup_latest(rows)._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Sort [" in line]
    assert sorts and all("Sort [event_timestamp" in line for line in sorts)
