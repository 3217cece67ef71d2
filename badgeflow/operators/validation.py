"""Event rules as column expressions: errors, warnings, verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import Rule, messages, with_computed
from ..functions.times import ago, as_time, time_text
from ..schemas import ID_FIELDS

# Fixed values of the rules.
MAX_AGE_DAYS = 30
STALE_AFTER_SECONDS = 3600
STRONGEST, WEAKEST, WEAK_BELOW = 0, -100, -80
MAX_ID_LENGTH = 50
DIRECTION_PATTERN = "^(ENTRY|EXIT)$"

WHITESPACE = " \t\n\r\f\v"

Rules = list[Rule]


def required_rules() -> tuple[Rules, Rules]:
    blank = {c: F.coalesce(F.trim(c, F.lit(WHITESPACE)), F.lit("")) == "" for c in ID_FIELDS}
    errors = [(blank[c], f"{c} is required and cannot be empty") for c in ID_FIELDS]
    errors.append((F.col("event_timestamp").isNull(), "event_timestamp is required"))
    return errors, []


def tenths_of_hours(micros: Column) -> Column:
    """Hours as a double, rounded to tenths by its exact binary value, ties to even.

    Away from ties, odd multiples of 180 seconds, whole microseconds decide. At a tie the
    double nearest n / 20 may lie above or below it: ``rest`` is by how much, times 20,
    without rounding, as times 4 and times 16 are exact.
    """
    n = micros / F.lit(180e6)
    rest = n / F.lit(20.0) * F.lit(4.0) - (n - n / F.lit(20.0) * F.lit(16.0))
    down = F.when((rest < 0) | ((rest == 0) & (n % F.lit(4.0) == F.lit(1.0))), 1).otherwise(0)
    tie = F.when(micros % 360_000_000 == 180_000_000, down).otherwise(0)
    return F.floor((micros + 180_000_000) / 360_000_000) - tie


def number_text(number: Column) -> Column:
    """A double as text: positional from 0.0001 on, below that with a two-digit exponent."""
    text = number.cast("string")
    digits = F.regexp_replace(F.substring_index(F.abs(number).cast("string"), "E", 1), r"\.0$", "")
    sign = F.when(number < 0, "-").otherwise("")
    tiny = F.abs(number) < 1e-4
    exponent = F.lpad(F.substring_index(text, "E-", -1), 2, "0")
    return (
        F.when((number == 0) | (F.abs(number) >= 1e-3), text)
        .when(tiny, F.concat(sign, digits, F.lit("e-"), exponent))
        .otherwise(F.concat(sign, F.lit("0.000"), F.replace(digits, F.lit("."), F.lit(""))))
    )


def timestamp_rules(as_of: Column) -> tuple[Rules, Rules]:
    ts = F.col("event_timestamp")
    text = time_text(ts)
    age = F.timestamp_diff("MICROSECOND", ts, as_of)
    tenths = tenths_of_hours(age)
    hours = (tenths / F.lit(10.0)).cast("decimal(18,1)").cast("string")
    errors = [
        (ts > as_of, F.concat(F.lit("Event timestamp "), text, F.lit(" is in the future")))
    ]
    warnings = [
        (
            ts < ago(as_of, days=MAX_AGE_DAYS),
            F.concat(
                F.lit("Event timestamp "), text, F.lit(f" is more than {MAX_AGE_DAYS} days old")
            ),
        ),
        (
            age > STALE_AFTER_SECONDS * 1_000_000,
            F.concat(F.lit("Event is "), hours, F.lit(" hours old")),
        ),
    ]
    return errors, warnings


def signal_rules() -> tuple[Rules, Rules]:
    signal = F.col("signal_strength").cast("double")
    text = signal.cast("string")  # only positive signals can be tiny
    errors = [
        (
            signal > STRONGEST,
            F.concat(F.lit("Signal strength "), number_text(signal), F.lit(" dBm cannot be positive")),
        ),
        (
            signal < WEAKEST,
            F.concat(F.lit("Signal strength "), text, F.lit(" dBm is too weak (< -100 dBm)")),
        ),
    ]
    warnings = [
        (signal < WEAK_BELOW, F.concat(F.lit("Weak signal strength: "), text, F.lit(" dBm")))
    ]
    return errors, warnings


def id_rules() -> tuple[Rules, Rules]:
    return [
        (F.length(c) > MAX_ID_LENGTH, f"{c} exceeds maximum length of {MAX_ID_LENGTH}")
        for c in ID_FIELDS
    ], []


def direction_rules() -> tuple[Rules, Rules]:
    return [(~F.col("direction").rlike(DIRECTION_PATTERN), "direction must be ENTRY or EXIT")], []


def _check(events: DataFrame, groups: list[tuple[Rules, Rules]], strict: bool) -> DataFrame:
    errors = [rule for group in groups for rule in group[0]]
    warnings = [rule for group in groups for rule in group[1]]
    checked = with_computed(
        events, {"errors": messages(errors), "warnings": messages(warnings)}
    )
    valid = F.size("errors") == 0
    if strict:
        valid = valid & (F.size("warnings") == 0)
    return checked.withColumn("is_valid", valid)


def validate_required(events: DataFrame) -> DataFrame:
    return _check(events, [required_rules()], strict=False)


def validate_timestamp(events: DataFrame, as_of) -> DataFrame:
    return _check(events, [timestamp_rules(as_time(as_of))], strict=False)


def validate_signal(events: DataFrame) -> DataFrame:
    return _check(events, [signal_rules()], strict=False)


def validate_ids(events: DataFrame) -> DataFrame:
    return _check(events, [id_rules()], strict=False)


def validate_direction(events: DataFrame) -> DataFrame:
    return _check(events, [direction_rules()], strict=False)


def validate_events(events: DataFrame, as_of, strict: bool = False) -> DataFrame:
    """All rules; in strict mode a warning also fails the event."""
    groups = [
        required_rules(),
        timestamp_rules(as_time(as_of)),
        signal_rules(),
        id_rules(),
        direction_rules(),
    ]
    return _check(events, groups, strict)


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted events, rejected events with ``reasons``: errors, then warnings)."""
    accepted = checked.filter("is_valid").drop("errors", "warnings", "is_valid")
    rejected = (
        checked.filter(~F.col("is_valid"))
        .withColumn("reasons", F.concat("errors", "warnings"))
        .drop("errors", "warnings", "is_valid")
    )
    return accepted, rejected


def ingest_totals(checked: DataFrame) -> DataFrame:
    """Events sent and rejected, seconds spanned, average rate."""
    sent = F.count_if(F.col("is_valid"))
    rejected = F.count_if(~F.col("is_valid"))
    span = (
        F.timestamp_diff("MICROSECOND", F.min("event_timestamp"), F.max("event_timestamp"))
        / F.lit(1e6)
    )
    totals = checked.agg(
        sent.alias("events_sent"), rejected.alias("events_rejected"), span.alias("duration_seconds")
    )
    return totals.withColumn(
        "events_per_second",
        F.round(
            F.when(
                F.col("duration_seconds") > 0,
                F.col("events_sent").cast("double") / F.col("duration_seconds"),
            ).otherwise(F.lit(0.0)),
            6,
        ),
    )
