from datetime import datetime, timedelta

import pytest

from pyspark.sql import functions as F

from badgeflow.operators import validation

NOW = datetime(2024, 3, 1, 12, 0, 0)
SCHEMA = (
    "badge_id string, user_id string, zone_id string, reader_id string, "
    "event_timestamp timestamp_ntz, signal_strength double, direction string"
)


def event(**changes):
    row = {
        "badge_id": "B1",
        "user_id": "U1",
        "zone_id": "Z1",
        "reader_id": "R1",
        "event_timestamp": NOW - timedelta(minutes=5),
        "signal_strength": -45.5,
        "direction": "ENTRY",
    }
    return tuple((row | changes).values())


def check(spark, strict=False, **changes):
    df = spark.createDataFrame([event(**changes)], SCHEMA)
    return validation.validate_events(df, NOW, strict).first()


def test_clean_event(spark):
    row = check(spark)
    assert (row.errors, row.warnings, row.is_valid) == ([], [], True)


@pytest.mark.parametrize("blank", ["", "   ", "\t\n", None])
def test_blank_ids(spark, blank):
    row = check(spark, user_id=blank)
    assert row.errors == ["user_id is required and cannot be empty"]


def test_missing_time(spark):
    assert check(spark, event_timestamp=None).errors == ["event_timestamp is required"]


def test_future(spark):
    row = check(spark, event_timestamp=NOW + timedelta(seconds=1))
    assert row.errors == ["Event timestamp 2024-03-01 12:00:01 is in the future"]


def test_exactly_now_is_fine(spark):
    assert check(spark, event_timestamp=NOW).is_valid


def test_old_event_warns_twice(spark):
    row = check(spark, event_timestamp=NOW - timedelta(days=30, microseconds=500000))
    assert row.warnings == [
        "Event timestamp 2024-01-31 11:59:59.500000 is more than 30 days old",
        "Event is 720.0 hours old",
    ]
    assert row.is_valid


def test_one_hour_is_the_limit(spark):
    assert check(spark, event_timestamp=NOW - timedelta(hours=1)).warnings == []
    late = check(spark, event_timestamp=NOW - timedelta(hours=1, seconds=1))
    assert late.warnings == ["Event is 1.0 hours old"]


@pytest.mark.parametrize(
    "signal, errors, warnings",
    [
        (0.0, [], []),
        (0.5, ["Signal strength 0.5 dBm cannot be positive"], []),
        (-80.0, [], []),
        (-80.5, [], ["Weak signal strength: -80.5 dBm"]),
        (-100.0, [], ["Weak signal strength: -100.0 dBm"]),
        (
            -100.5,
            ["Signal strength -100.5 dBm is too weak (< -100 dBm)"],
            ["Weak signal strength: -100.5 dBm"],
        ),
        (None, [], []),
    ],
)
def test_signal(spark, signal, errors, warnings):
    row = check(spark, signal_strength=signal)
    assert (row.errors, row.warnings) == (errors, warnings)


def test_id_length(spark):
    assert check(spark, badge_id="B" * 50).errors == []
    assert check(spark, badge_id="B" * 51).errors == ["badge_id exceeds maximum length of 50"]


@pytest.mark.parametrize("direction, ok", [("ENTRY", True), ("EXIT", True), (None, True), ("entry", False)])
def test_direction(spark, direction, ok):
    assert check(spark, direction=direction).is_valid is ok


def test_strict_mode_fails_on_warnings(spark):
    assert check(spark, signal_strength=-85.0).is_valid
    assert not check(spark, strict=True, signal_strength=-85.0).is_valid


def test_split_lists_errors_before_warnings(spark):
    df = spark.createDataFrame([event(), event(signal_strength=-120.0)], SCHEMA)
    accepted, rejected = validation.split_valid(validation.validate_events(df, NOW))
    assert accepted.count() == 1
    assert rejected.first().reasons == [
        "Signal strength -120.0 dBm is too weak (< -100 dBm)",
        "Weak signal strength: -120.0 dBm",
    ]


def test_totals(spark):
    df = spark.createDataFrame(
        [event(), event(event_timestamp=NOW - timedelta(minutes=4)), event(badge_id="")], SCHEMA
    )
    row = validation.ingest_totals(validation.validate_events(df, NOW)).first()
    assert (row.events_sent, row.events_rejected, row.duration_seconds) == (2, 1, 60.0)
    assert row.events_per_second == round(2 / 60, 6)


@pytest.mark.parametrize(
    "seconds, text", [(4500, "1.2"), (4140, "1.1"), (8100, "2.2"), (6300, "1.8"), (4860, "1.4"), (3601, "1.0"), (13500, "3.8"), (36900, "10.2")]
)
def test_hours_round_as_a_double_does(spark, seconds, text):
    assert f"{seconds / 3600:.1f}" == text
    tenths = spark.range(1).select(validation.tenths_of_hours(F.lit(seconds * 1_000_000))).first()[0]
    assert f"{tenths // 10}.{tenths % 10}" == text


def test_hours_agree_for_every_minute(spark):
    micros = spark.range(0, 40_000).select((F.col("id") * 60_000_000).alias("m"))
    rows = micros.select("m", validation.tenths_of_hours(F.col("m")).alias("t")).collect()
    assert all(f"{r.t // 10}.{r.t % 10}" == f"{r.m / 1e6 / 3600:.1f}" for r in rows)


@pytest.mark.parametrize("number", [0.0, 0.0005, -0.0005, 0.00025, 1e-5, -2.5e-7, 0.001, -80.25, 5.0, 123.0])
def test_small_numbers_as_text(spark, number):
    assert spark.range(1).select(validation.number_text(F.lit(number))).first()[0] == str(number)
