import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from badgeflow.operators import transform

GOOD = {
    "badge_id": "B1",
    "user_id": "U1",
    "zone_id": "Z1",
    "reader_id": "R1",
    "event_timestamp": "2024-01-05T10:00:00.123456",
    "signal_strength": -45.5,
    "direction": "entry",
}


def run(spark, *payloads, **options):
    lines = [(p if isinstance(p, str) or p is None else json.dumps(p),) for p in payloads]
    rows = transform.pipe_transform(
        spark.createDataFrame(lines, "value string"), "2024-02-01 00:00:00", **options
    )
    return rows


def one(spark, payload, **options):
    return run(spark, payload, **options).first()


def test_accepted_row(spark):
    row = one(spark, GOOD)
    assert row.reject_reasons == []
    assert row.event_timestamp == datetime(2024, 1, 5, 10, 0, 0, 123456)
    assert row.signal_strength == Decimal("-46.00")
    assert row.signal_quality == "STRONG"
    assert row.direction == "ENTRY"
    assert json.loads(row.raw_json) == GOOD


@pytest.mark.parametrize(
    "signal, stored, quality",
    [
        (-80, "-80.00", "MEDIUM"),
        (-80.4, "-80.00", "MEDIUM"),
        (-80.5, "-81.00", "WEAK"),
        (-60, "-60.00", "STRONG"),
        (-60.5, "-61.00", "MEDIUM"),
        (-59.6, "-60.00", "STRONG"),
        (None, "-999.00", "STRONG"),
        ("-70", "-70.00", "MEDIUM"),
    ],
)
def test_signal_is_rounded_then_classified(spark, signal, stored, quality):
    row = one(spark, GOOD | {"signal_strength": signal})
    assert (str(row.signal_strength), row.signal_quality) == (stored, quality)


def test_fraction_is_kept_on_request(spark):
    row = one(spark, GOOD | {"signal_strength": -80.4}, signal_scale=2)
    assert (row.signal_strength, row.signal_quality) == (Decimal("-80.40"), "WEAK")


def test_trim_is_optional(spark):
    padded = GOOD | {"direction": " exit "}
    assert one(spark, padded).direction == " EXIT "
    assert one(spark, padded, trim_direction=True).direction == "EXIT"


@pytest.mark.parametrize(
    "change, reason",
    [
        ({"event_timestamp": "soon"}, "event_timestamp is not a time"),
        ({"event_timestamp": None}, "event_timestamp is missing"),
        ({"badge_id": None}, "badge_id is missing"),
        ({"zone_id": "Z" * 51}, "zone_id is longer than 50"),
        ({"direction": "D" * 11}, "direction is longer than 10"),
        ({"signal_strength": "n/a"}, "signal_strength is not a number"),
        ({"signal_strength": -1000}, "signal_strength is out of range"),
    ],
)
def test_rejects_keep_their_reason(spark, change, reason):
    assert one(spark, GOOD | change).reject_reasons == [reason]


def test_sample_without_user_is_rejected(spark):
    payload = {k: v for k, v in GOOD.items() if k != "user_id"} | {"event_type": "ENTRY"}
    assert one(spark, payload).reject_reasons == ["user_id is missing"]


@pytest.mark.parametrize("line", ["nope", '{"badge_id":"B1","us', "[1, 2]", None])
def test_lines_that_are_no_object(spark, line):
    assert one(spark, line).reject_reasons == ["line is not a JSON object"]


def test_split_keeps_every_line(spark):
    rows = run(spark, GOOD, "nope", GOOD | {"badge_id": None})
    accepted, rejected = transform.split_rejects(rows)
    assert (accepted.count(), rejected.count()) == (1, 2)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025-10-31T14:23:45.123Z", "2025-10-31 14:23:45.123000"),
        ("2025-10-31T14:23:45.123456+02:00", "2025-10-31 12:23:45.123000"),
        ("2025-10-31T23:00:00-0530", "2025-11-01 04:30:00.000000"),
        ("2025-10-31 14:23:45.999999", "2025-10-31 14:23:45.999000"),
        ("2025-10-31", "2025-10-31 00:00:00.000000"),
        ("yesterday", None),
        ("12:30:00", None),
        ("12:30:00Z", None),
        ("", None),
    ],
)
def test_normalize_event_time(spark, text, expected):
    row = spark.createDataFrame([(text,)], "t string").select(
        transform.normalize_event_time(F.col("t")).alias("n")
    ).first()
    want = expected and datetime.strptime(expected, "%Y-%m-%d %H:%M:%S.%f")
    assert row.n == (want or None)


def test_each_line_is_parsed_once(spark):
    rows = run(spark, GOOD)
    plan = transform.split_rejects(rows)[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_strict_times_and_offsets(spark):
    def landed(time, **options):
        text = json.dumps({"badge_id": "B", "user_id": "U", "zone_id": "Z", "reader_id": "R", "event_timestamp": time})
        df = spark.createDataFrame([(text,)], "value string")
        return transform.pipe_transform(df, "2024-02-01 00:00:00", **options).first()

    assert landed("soon").reject_reasons == ["event_timestamp is not a time"]
    with pytest.raises(Exception, match="not a time: soon"):
        landed("soon", strict_time=True)
    assert landed(None, strict_time=True).reject_reasons == ["event_timestamp is missing"]
    late = "2024-01-05T23:30:00.1239+02:00"
    assert str(landed(late).event_timestamp) == "2024-01-05 23:30:00.123900"
    assert str(landed(late, apply_offset=True, strict_time=True).event_timestamp) == "2024-01-05 21:30:00.123000"
