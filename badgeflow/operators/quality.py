"""Data-quality metrics, expectations, suites and the views over their log.

Row-level metrics are aggregate expressions, so all of a table's are computed in
one pass; metrics that need their own grouping are DataFrame functions. Every
metric is one bigint.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import percent
from ..functions.times import ago, as_time, ntz, seconds_between, trunc_hour
from .staging import DEDUP_KEY
from .transform import UNKNOWN_SIGNAL

# Fixed values of the checks.
SIGNAL_RANGE = (-100, 0)
DIRECTIONS = ("ENTRY", "EXIT")
LAST_PLAUSIBLE_TIME = "2099-12-31 00:00:00"
BUSY_EVENTS_PER_HOUR = 100


# -- row-level metrics: columns -> aggregate expression -----------------------


def null_count(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def blank_count(column: str) -> Column:
    return F.count_if(F.trim(column) == "")


def row_count() -> Column:
    return F.count(F.lit(1))


def invalid_signal_strength(column: str = "signal_strength") -> Column:
    signal = F.col(column)
    return F.count_if(~signal.between(*SIGNAL_RANGE) & (signal != UNKNOWN_SIGNAL))


def future_timestamps(column: str = "event_timestamp") -> Column:
    return F.count_if(F.col(column) > ntz(LAST_PLAUSIBLE_TIME))


def invalid_direction(column: str = "direction") -> Column:
    return F.count_if(F.col(column).isNotNull() & ~F.col(column).isin(*DIRECTIONS))


def freshness(column: str, as_of) -> Column:
    """Seconds since the newest value (the last write: use the write time column)."""
    return seconds_between(F.max(column), as_time(as_of))


def as_metric(df: DataFrame, expression: Column) -> DataFrame:
    return df.agg(expression.cast("long").alias("value"))


# -- metrics with a grouping of their own: DataFrame -> DataFrame[value] ------


def duplicate_events(df: DataFrame, *keys: str) -> DataFrame:
    """Number of keys that occur more than once (not of surplus rows)."""
    repeated = df.groupBy(*(keys or DEDUP_KEY)).agg(F.count(F.lit(1)).alias("n"))
    return repeated.agg(F.count_if(F.col("n") > 1).alias("value"))


def abnormal_user_activity(
    df: DataFrame,
    user: str = "user_id",
    ts: str = "event_timestamp",
    more_than: int = BUSY_EVENTS_PER_HOUR,
) -> DataFrame:
    """Users above the hourly limit in any clock hour of the last hour of data."""
    latest = df.agg(F.max(ts)).scalar()
    busy = (
        df.filter(F.col(ts) >= ago(latest, hours=1))
        .groupBy(user, trunc_hour(ts).alias("hour"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > more_than)
    )
    return busy.agg(F.countDistinct(user).alias("value"))


def orphaned_fact_records(facts: DataFrame, users: DataFrame, zones: DataFrame) -> DataFrame:
    """Facts whose user or zone key is in no dimension; NULL keys do not count.

    Facts are counted per key pair first, so a hot key is one row at the joins.
    """
    pairs = facts.groupBy("user_key", "zone_key").agg(F.count(F.lit(1)).alias("n"))
    known_users = users.select("user_key", F.lit(True).alias("_user")).distinct()
    known_zones = zones.select("zone_key", F.lit(True).alias("_zone")).distinct()
    lost = (F.col("user_key").isNotNull() & F.col("_user").isNull()) | (
        F.col("zone_key").isNotNull() & F.col("_zone").isNull()
    )
    return (
        pairs.join(known_zones, "zone_key", "left")
        .join(known_users, "user_key", "left")
        .agg(F.coalesce(F.sum(F.when(lost, F.col("n"))), F.lit(0)).cast("long").alias("value"))
    )


ROW_METRICS: dict[str, Callable[..., Column]] = {
    "NULL_COUNT": null_count,
    "BLANK_COUNT": blank_count,
    "ROW_COUNT": row_count,
    "INVALID_SIGNAL_STRENGTH": invalid_signal_strength,
    "FUTURE_TIMESTAMPS": future_timestamps,
    "INVALID_DIRECTION": invalid_direction,
    "FRESHNESS": freshness,
}
GROUPED_METRICS: dict[str, Callable[..., DataFrame]] = {
    "DUPLICATE_EVENTS": duplicate_events,
    "ABNORMAL_USER_ACTIVITY": abnormal_user_activity,
}


def register_metric(name: str, metric: Callable, grouped: bool = False) -> None:
    """Add a metric of your own to the suites."""
    (GROUPED_METRICS if grouped else ROW_METRICS)[name] = metric


COMPARATORS: dict[str, Callable[[Column, Column], Column]] = {
    "=": lambda value, limit: value == limit,
    "<>": lambda value, limit: value != limit,
    "<": lambda value, limit: value < limit,
    "<=": lambda value, limit: value <= limit,
    ">": lambda value, limit: value > limit,
    ">=": lambda value, limit: value >= limit,
}

# -- expectations -------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """One metric on one table, with an optional expectation on its value."""

    metric: str
    columns: tuple[str, ...] = ()
    expectation: str | None = None
    op: str | None = None
    threshold: int | None = None

    def __post_init__(self):
        if self.expectation is not None and (self.op not in COMPARATORS or self.threshold is None):
            raise ValueError(f"{self.expectation} cannot be judged: {self.op!r} {self.threshold!r}")


RAW_CHECKS = [
    *[Check("NULL_COUNT", (c,), "no_nulls", "=", 0)
      for c in ("badge_id", "user_id", "zone_id", "event_timestamp")],
    Check("BLANK_COUNT", ("badge_id",), "no_blanks", "=", 0),
    Check("ROW_COUNT", (), "growing", ">=", 1000),
    Check("FRESHNESS", ("ingestion_time",), "fresh_data", "<=", 300),
    Check("DUPLICATE_EVENTS", DEDUP_KEY, "no_duplicates", "=", 0),
    Check("INVALID_SIGNAL_STRENGTH", ("signal_strength",), "valid_signals", "=", 0),
    Check("FUTURE_TIMESTAMPS", ("event_timestamp",), "no_future", "=", 0),
    Check("INVALID_DIRECTION", ("direction",), "valid_directions", "=", 0),
    Check("ABNORMAL_USER_ACTIVITY", ("user_id", "event_timestamp"), "normal_activity", "<", 5),
]
STAGING_CHECKS = [
    Check("ROW_COUNT", (), "data_exists", ">", 0),
    Check("NULL_COUNT", ("signal_quality",), "quality_populated", "=", 0),
]
# One hour, in seconds: the intent of the fact freshness rule.
FACT_CHECKS = [
    Check("ROW_COUNT"),
    Check("NULL_COUNT", ("user_key",), "valid_user_key", "=", 0),
    Check("NULL_COUNT", ("zone_key",), "valid_zone_key", "=", 0),
    Check("FRESHNESS", ("event_timestamp",), "recent_data", "<=", 3600),
]


def measure(df: DataFrame, checks: list[Check], as_of, by: Column | None = None) -> DataFrame:
    """Metric values in long form, each with its expectation.

    Columns: data_metric_name, column_names, value, expectation, op, threshold.
    All row-level checks share one aggregate over ``df``. With ``by`` they are
    measured per group (``slice``); grouped metrics then do not apply.
    """
    rows = [c for c in checks if c.metric in ROW_METRICS]
    exprs = [_row_expression(c, as_of).cast("long").alias(f"m{i}") for i, c in enumerate(rows)]
    keep = [] if by is None else ["slice"]
    grouped = df.groupBy() if by is None else df.groupBy(by.alias("slice"))
    long_form = F.inline(
        F.array(*[F.struct(*_described(c, F.col(f"m{i}"))) for i, c in enumerate(rows)])
    )
    result = grouped.agg(*exprs).select(*keep, long_form)
    if by is None:
        for c in checks:
            if c.metric in GROUPED_METRICS:
                value = GROUPED_METRICS[c.metric](df, *c.columns)
                result = result.unionByName(value.select(*_described(c, F.col("value"))))
    return result


def _row_expression(check: Check, as_of) -> Column:
    if check.metric == "FRESHNESS":
        return freshness(*check.columns, as_of)
    return ROW_METRICS[check.metric](*check.columns)


def _described(check: Check, value: Column) -> list[Column]:
    return [
        F.lit(check.metric).alias("data_metric_name"),
        F.lit(",".join(check.columns)).alias("column_names"),
        value.cast("long").alias("value"),
        F.lit(check.expectation).cast("string").alias("expectation"),
        F.lit(check.op).cast("string").alias("op"),
        F.lit(check.threshold).cast("long").alias("threshold"),
    ]


def evaluate(measures: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """Add ``expectation_violations``: the names of the expectations that failed.

    ``rules`` (data_metric_name, column_names, expectation, op, threshold) replaces
    the expectations the measures carry. What cannot be judged does not pass: a NULL
    value or threshold violates its expectation, and an unknown comparator stops the job.
    """
    if rules is not None:
        bare = measures.drop("expectation", "op", "threshold")
        measures = bare.join(rules, ["data_metric_name", "column_names"], "left")
    op = F.coalesce("op", F.lit("none"))
    holds = F.raise_error(F.concat(F.lit("unknown comparator: "), op)).cast("boolean")
    for name, compare in COMPARATORS.items():
        holds = F.when(op == name, compare(F.col("value"), F.col("threshold"))).otherwise(holds)
    passed = F.when(F.col("expectation").isNull(), True).otherwise(F.coalesce(holds, F.lit(False)))
    broken = F.when(~passed, F.array("expectation"))
    none = F.array().cast("array<string>")
    return measures.withColumn("expectation_violations", F.coalesce(broken, none)).drop(
        "expectation", "op", "threshold"
    )


def run_suite(
    df: DataFrame,
    checks: list[Check],
    as_of,
    database: str,
    schema: str,
    table: str,
    schedule: str = "MANUAL",
) -> DataFrame:
    """Measure and judge one table; rows fit the result log."""
    judged = evaluate(measure(df, checks, as_of))
    return _as_log(judged, as_time(as_of), database, schema, table, schedule)


def run_suite_per_hour(
    df: DataFrame, ts: str, checks: list[Check], database: str, schema: str, table: str
) -> DataFrame:
    """The row-level checks on every clock hour, measured at the hour's end."""
    judged = evaluate(measure(df, checks, None, by=trunc_hour(ts)))
    at = F.col("slice") + F.make_dt_interval(F.lit(0), F.lit(1), F.lit(0), F.lit(0))
    return _as_log(judged, at, database, schema, table, "HOURLY").drop("slice")


def _as_log(
    judged: DataFrame, measured_at: Column, database: str, schema: str, table: str, schedule: str
) -> DataFrame:
    return judged.withColumns(
        {
            "measurement_time": measured_at,
            "table_database": F.lit(database),
            "table_schema": F.lit(schema),
            "table_name": F.lit(table),
            "schedule_type": F.lit(schedule),
            "status": F.lit("COMPLETED"),
        }
    )


def append_results(results: DataFrame, path: str) -> None:
    results.write.mode("append").parquet(path)


# -- views over the result log --------------------------------------------------


def _full_name() -> Column:
    return F.concat_ws(".", "table_database", "table_schema", "table_name")


def dashboard(results: DataFrame, database: str) -> DataFrame:
    return (
        results.filter(F.col("table_database") == database)
        .select(
            "measurement_time",
            "table_database",
            "table_schema",
            "table_name",
            "data_metric_name",
            "column_names",
            F.col("value").alias("measurement_value"),
            "expectation_violations",
            "schedule_type",
            "status",
        )
        .orderBy(F.col("measurement_time").desc())
    )


def _violated() -> Column:
    return F.size("expectation_violations") > 0


def violations(results: DataFrame, database: str) -> DataFrame:
    return (
        results.filter((F.col("table_database") == database) & _violated())
        .select(
            "measurement_time",
            _full_name().alias("full_table_name"),
            "table_name",
            "data_metric_name",
            "column_names",
            F.col("value").alias("measurement_value"),
            F.size("expectation_violations").cast("long").alias("violation_count"),
            "expectation_violations",
        )
        .orderBy(F.col("measurement_time").desc())
    )


def _since(results: DataFrame, database: str, as_of, **units: int) -> DataFrame:
    """Measurements of one database in a window, pruned by ``log_date`` if there is one."""
    start = ago(as_time(as_of), **units)
    rows = results.filter((F.col("table_database") == database) & (F.col("measurement_time") >= start))
    return rows.filter(F.col("log_date") >= F.to_date(start)) if "log_date" in results.columns else rows


def quality_scores(results: DataFrame, database: str, as_of) -> DataFrame:
    """Share of passed checks per table over seven days, worst first."""
    recent = _since(results, database, as_of, days=7)
    passed = F.count_if(~_violated())
    return (
        recent.groupBy(_full_name().alias("full_table_name"))
        .agg(
            F.count(F.lit(1)).alias("total_measurements"),
            passed.alias("passed_checks"),
            percent(passed, F.count(F.lit(1))).alias("quality_score_pct"),
            F.max("measurement_time").alias("last_measured"),
        )
        .orderBy("quality_score_pct", "full_table_name")
    )


def violation_trends(results: DataFrame, database: str, as_of) -> DataFrame:
    """Violations per hour, table and metric over 24 hours."""
    return (
        _since(results, database, as_of, days=1)
        .filter(_violated())
        .groupBy(
            trunc_hour("measurement_time").alias("measurement_hour"),
            "table_name",
            "data_metric_name",
        )
        .agg(F.count(F.lit(1)).alias("violation_count"))
        .orderBy(F.col("measurement_hour").desc(), F.col("violation_count").desc())
    )


def alert_rows(results: DataFrame, database: str, as_of, minutes: int = 5) -> DataFrame:
    """Violations measured in the last minutes, stamped for the alert log."""
    at = as_time(as_of)
    return (
        violations(_since(results, database, at, minutes=minutes), database)
        .select(
            at.alias("alert_time"),
            "table_name",
            "data_metric_name",
            "column_names",
            F.col("measurement_value").alias("value"),
            "expectation_violations",
        )
    )


ALERT_KEY = ("measurement_time", "table_name", "data_metric_name", "column_names")


def append_alerts(results: DataFrame, database: str, path: str, as_of, minutes: int = 5) -> None:
    """Append the alerts of the last minutes that the log at ``path`` does not hold yet.

    A run that is repeated, or whose window overlaps the one before, raises no alert
    twice: an alert is known by its measurement.
    """
    at = as_time(as_of)
    fresh = (
        violations(_since(results, database, at, minutes=minutes), database)
        .select(
            at.alias("alert_time"),
            *ALERT_KEY,
            F.col("measurement_value").alias("value"),
            "expectation_violations",
        )
    )
    spark = results.sparkSession
    empty = spark.createDataFrame([], fresh.schema)
    empty.write.mode("append").parquet(path)  # so that a first run finds a log
    logged = spark.read.schema(fresh.schema).parquet(path)
    # Only measurements of the window can be raised again: the rest of the log is not looked at.
    known = logged.filter(F.col("measurement_time") >= ago(at, minutes=minutes)).select(*ALERT_KEY)
    fresh.join(known, list(ALERT_KEY), "left_anti").write.mode("append").parquet(path)
