from datetime import datetime, timedelta

import pytest

from badgeflow.functions.numbers import median_of_longs
from badgeflow.functions.times import seconds_between, trunc_hour, trunc_minute
from badgeflow.operators import analytics, monitoring

NOW = datetime(2024, 1, 5, 10)


@pytest.mark.parametrize("age, health", [(120, "HEALTHY"), (121, "WARNING"), (300, "WARNING"), (301, "STALE")])
def test_health_limits(spark, age, health):
    rows = spark.createDataFrame([(NOW - timedelta(seconds=age),)], "t timestamp_ntz")
    got = monitoring.pipeline_latency({"RAW": (rows, "t", None)}, NOW).first()
    assert (got.seconds_since_update, got.health_status) == (age, health)


def test_silent_layer_counts_as_healthy(spark):
    rows = spark.createDataFrame([(NOW - timedelta(hours=3),)], "t timestamp_ntz")
    got = monitoring.pipeline_latency({"RAW": (rows, "t", None)}, NOW).first()
    assert (got.row_count, got.last_update, got.health_status) == (0, None, "HEALTHY")


def test_second_boundaries_and_truncation_ignore_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame(
        [(datetime(2024, 3, 10, 2, 30, 0, 900000), datetime(2024, 3, 10, 2, 30, 1, 100000))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    try:
        # 02:30 does not exist on that day in New York.
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = df.select(seconds_between("a", "b"), trunc_hour("a"), trunc_minute("b")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(row) == (1, datetime(2024, 3, 10, 2), datetime(2024, 3, 10, 2, 30))


@pytest.mark.parametrize(
    "values, median",
    [([5], 5.0), ([1, 2], 1.5), ([1, 9000], 4500.5), ([3, 1, 2], 2.0), ([7] * 10 + [1, 100000], 7.0), ([-10, -20, 3600, 3599], 1794.5), ([], None)],
)
def test_exact_median(spark, values, median):
    df = spark.createDataFrame([(v,) for v in values], "x long")
    assert median_of_longs(df, "x").first().median == median


def test_median_matches_brute_force(spark):
    import random
    import statistics

    rng = random.Random(7)
    for n in (100, 101):
        values = [rng.choice([0, 5000, rng.randrange(100000)]) for _ in range(n)]
        df = spark.createDataFrame([(v,) for v in values], "x long").repartition(5)
        assert median_of_longs(df, "x").first().median == statistics.median(values)


def test_task_status_mapping(spark):
    log = spark.createDataFrame(
        [("t", s, NOW, NOW + timedelta(seconds=5), None, None) for s in ("SUCCEEDED", "FAILED", "SKIPPED", "EXECUTING")],
        "name string, state string, scheduled_time timestamp_ntz, completed_time timestamp_ntz, error_code string, error_message string",
    )
    got = {r.state: (r.execution_status, r.duration_seconds) for r in monitoring.task_history(log, NOW).collect()}
    assert got == {
        "SUCCEEDED": ("SUCCESS", 5), "FAILED": ("FAILED", 5), "SKIPPED": ("SKIPPED", 5), "EXECUTING": ("UNKNOWN", 5),
    }
    assert monitoring.task_failures(log).count() == 1


def test_empty_fact_has_no_shares(spark):
    empty = spark.createDataFrame([], "is_after_hours boolean, is_weekend boolean, is_restricted_access boolean")
    assert {(r.event_count, r.percentage) for r in analytics.flag_shares(empty).collect()} == {(0, 0.0)}


def test_unknown_signal_marker_can_be_left_out(spark):
    rows = spark.createDataFrame([("STRONG", -50), ("STRONG", -999)], "signal_quality string, signal_strength int")
    assert analytics.signal_quality_distribution(rows).first().avg_signal_strength == -524.5
    assert analytics.signal_quality_distribution(rows, exclude_unknown=True).first().avg_signal_strength == -50.0


def test_verdict(spark):
    rows = spark.range(3)
    facts = rows.selectExpr("timestamp_ntz'2024-01-05 10:00:00' ingestion_time", "timestamp_ntz'2024-01-05 10:01:59' fact_load_time")
    runs = spark.createDataFrame([("SUCCEEDED",)], "state string")
    read = spark.createDataFrame([(3,)], "rows_read long")
    layers = {"a": rows, "b": rows}
    good = analytics.pipeline_verdict(layers, rows, read, runs, facts).first()
    assert good.pipeline_ok
    bad = analytics.pipeline_verdict({"a": rows, "b": rows.limit(2)}, rows, read.limit(0), runs, facts).first()
    assert (bad.counts_match, bad.stream_empty, bad.pipeline_ok) == (False, False, False)
