"""In-flight transform: JSON lines to landing rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import Rule, messages, with_computed
from ..functions.times import as_time, now, utc_clock
from ..schemas import EVENT_FIELDS, ID_FIELDS, RAW_COLUMNS, SIGNAL_TYPE

# Fixed values of the landing contract.
UNKNOWN_SIGNAL = -999
WEAK_BELOW = -80
MEDIUM_BELOW = -60
MAX_ID_LENGTH = 50
MAX_DIRECTION_LENGTH = 10

_BAD_LINE = "_bad_line"
_PAYLOAD = ", ".join(f"{c} string" for c in EVENT_FIELDS) + f", {_BAD_LINE} string"


def signal_quality(strength: Column) -> Column:
    """WEAK / MEDIUM / STRONG; an unknown (NULL) signal counts as STRONG."""
    return (
        F.when(strength < WEAK_BELOW, "WEAK")
        .when(strength < MEDIUM_BELOW, "MEDIUM")
        .otherwise("STRONG")
    )


def normalize_event_time(text: Column) -> Column:
    """ISO 8601 text to a zone-less UTC time cut to milliseconds.

    An offset is applied, a missing one means UTC, bad text gives NULL.
    """
    clean = F.trim(text)
    zoned = clean.rlike(r"[T ][0-9]{1,2}:.*([zZ]|[+-][0-9]{2}:?[0-9]{2})$")
    in_utc = F.concat(clean, F.when(clean.contains(":"), "Z").otherwise("T00:00:00Z"))
    # A bare time of day would be read as today's.
    dated = clean.rlike("^[0-9]{4}(-|$)")
    instant = F.when(dated, F.when(zoned, clean).otherwise(in_utc)).try_cast("timestamp")
    millis = F.floor(F.unix_micros(instant) / 1000).cast("long")
    return utc_clock(millis * 1000)


def parse_payload(events: DataFrame, value: str = "value") -> DataFrame:
    """JSON text to string fields, original text kept.

    The fields come out of a generator, which later filters cannot be pushed
    through: each line is parsed once however many rules look at its fields.
    """
    parsed = F.from_json(F.col(value), _PAYLOAD, {"columnNameOfCorruptRecord": _BAD_LINE})
    return events.select(F.col(value).alias("raw_json"), F.inline(F.array(parsed)))


def _limits(kept: dict[str, Column]) -> list[Rule]:
    """NOT NULL and length rules of the landing table."""
    rules: list[Rule] = [(kept[c].isNull(), f"{c} is missing") for c in ID_FIELDS]
    rules += [
        (F.length(kept[c]) > MAX_ID_LENGTH, f"{c} is longer than {MAX_ID_LENGTH}")
        for c in ID_FIELDS
    ]
    rules.append(
        (
            F.length(kept["direction"]) > MAX_DIRECTION_LENGTH,
            f"direction is longer than {MAX_DIRECTION_LENGTH}",
        )
    )
    return rules


def pipe_transform(
    events: DataFrame,
    ingestion_time=None,
    signal_scale: int = 0,
    trim_direction: bool = False,
    value: str = "value",
    strict_time: bool = False,
    apply_offset: bool = False,
) -> DataFrame:
    """JSON lines to landing rows plus ``reject_reasons`` (empty when accepted).

    A bad line never fails the job: it is kept with the reasons it was refused. Only
    with ``strict_time`` does text that is no time stop it. ``apply_offset`` is for lines
    straight from devices: their times are taken to UTC and cut to milliseconds, else an
    offset is left out. ``signal_scale=0`` rounds the signal to whole dBm, 2 keeps the
    fraction.
    """
    p = parse_payload(events, value)
    signal = F.col("signal_strength").try_cast(f"decimal(38,{signal_scale})")
    stored = F.coalesce(signal, F.lit(UNKNOWN_SIGNAL)).try_cast(SIGNAL_TYPE)
    direction = F.upper(F.col("direction"))
    if trim_direction:
        direction = F.trim(direction)
    text = F.col("event_timestamp")
    event_time = normalize_event_time(text) if apply_offset else text.try_cast("timestamp_ntz")
    if strict_time:
        refused = F.raise_error(F.concat(F.lit("event_timestamp is not a time: "), text))
        event_time = F.when(text.isNotNull() & event_time.isNull(), refused.cast("timestamp_ntz")).otherwise(event_time)
    bad_line = F.col(_BAD_LINE).isNotNull() | F.col("raw_json").isNull()
    no_time, no_signal = F.col("event_timestamp").isNull(), F.col("signal_strength").isNull()
    reasons = messages(
        [
            (no_time, "event_timestamp is missing"),
            (~no_time & event_time.isNull(), "event_timestamp is not a time"),
            *_limits({c: F.col(c) for c in ID_FIELDS} | {"direction": direction}),
            (~no_signal & signal.isNull(), "signal_strength is not a number"),
            (signal.isNotNull() & stored.isNull(), "signal_strength is out of range"),
        ]
    )
    landing = {
        "_time": event_time,
        "_signal": signal,
        "reject_reasons": F.when(
            bad_line, F.array(F.lit("line is not a JSON object"))
        ).otherwise(reasons),
    }
    return with_computed(p, landing).select(
        *ID_FIELDS,
        F.col("_time").alias("event_timestamp"),
        F.coalesce("_signal", F.lit(UNKNOWN_SIGNAL)).try_cast(SIGNAL_TYPE).alias("signal_strength"),
        signal_quality(F.col("_signal")).alias("signal_quality"),
        direction.alias("direction"),
        (now() if ingestion_time is None else as_time(ingestion_time)).alias("ingestion_time"),
        "raw_json",
        "reject_reasons",
    )


def split_rejects(transformed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted landing rows, rejected lines with reasons)."""
    bad = F.size("reject_reasons") > 0
    accepted = transformed.filter(~bad).select(*RAW_COLUMNS, "raw_json")
    rejected = transformed.filter(bad).select("raw_json", "reject_reasons", "ingestion_time")
    return accepted, rejected


def standardize(scans: DataFrame, signal_scale: int = 0) -> DataFrame:
    """The same projection for scans that are already typed columns."""
    signal = F.col("signal_strength").cast(f"decimal(38,{signal_scale})")
    return scans.select(
        *ID_FIELDS,
        "event_timestamp",
        F.coalesce(signal, F.lit(UNKNOWN_SIGNAL)).cast(SIGNAL_TYPE).alias("signal_strength"),
        signal_quality(signal).alias("signal_quality"),
        F.upper("direction").alias("direction"),
        "ingestion_time",
    )
