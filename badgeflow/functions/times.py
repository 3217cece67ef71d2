"""Time helpers over zone-less timestamps.

Spark's ``date_trunc`` and ``unix_timestamp`` go through the session time zone;
these do not, so results are the same in any session.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trunc_hour(ts: Column | str) -> Column:
    t = _col(ts)
    return F.make_timestamp_ntz(
        F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0)
    )


def trunc_minute(ts: Column | str) -> Column:
    t = _col(ts)
    return F.make_timestamp_ntz(
        F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t), F.lit(0)
    )


def _since_epoch(unit: str, ts: Column | str) -> Column:
    return F.timestamp_diff(unit, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _col(ts))


def instant(ts: Column | str) -> Column:
    """The instant at which a UTC clock shows this zone-less time."""
    return F.timestamp_micros(_since_epoch("MICROSECOND", ts))


def utc_clock(micros: Column) -> Column:
    """Microseconds since 1970 as the zone-less time a UTC clock shows."""
    return F.timestamp_add("MICROSECOND", micros, ntz("1970-01-01 00:00:00"))


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970 on the wall clock."""
    return _since_epoch("SECOND", ts)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Second boundaries crossed from start to end (0.9 s to 1.1 s is 1)."""
    return epoch_seconds(end) - epoch_seconds(start)


def ago(as_of: Column, **units: int) -> Column:
    """``as_of`` minus days, hours or minutes."""
    return as_of - F.make_dt_interval(
        F.lit(units.get("days", 0)),
        F.lit(units.get("hours", 0)),
        F.lit(units.get("minutes", 0)),
        F.lit(0),
    )


def time_text(ts: Column | str, always_micros: bool = False) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` with six digits of microseconds, if any or always."""
    text = _col(ts).cast("string")
    plain = F.concat(text, F.lit(".000000")) if always_micros else text
    # Years may have more than four digits, so only the fraction has a fixed length.
    point = F.instr(text, ".")
    return F.when(point > 0, F.rpad(text, point + 6, F.lit("0"))).otherwise(plain)


def ntz(text: str) -> Column:
    """A zone-less timestamp literal."""
    return F.lit(text).cast("timestamp_ntz")


def as_time(value) -> Column:
    """Accept a Column, datetime or ISO text as a point in time."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp_ntz")


def now() -> Column:
    return F.localtimestamp()
