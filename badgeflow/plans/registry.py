"""Every query by name: (spark, sf_dir) -> DataFrame.

Operators of the pipeline itself run straight on the given tables; reports run
on the stored layers built from them (``warehouse``).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.times import ago, as_time, ntz, time_text
from ..operators import (
    analytics,
    dimensions,
    facts,
    joins,
    monitoring,
    quality,
    snapshots,
    staging,
    transform,
    validation,
)
from ..schemas import RAW_COLUMNS, ZONE_SCHEMA
from ..session import work_dir
from ..sources import derived, landing
from ..streaming import alerts, consume, ingest, pipeline, rollup
from .warehouse import loaded_facts, staged_rows, warehouse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the reports.
VERSIONED_AT = "2024-01-16 00:00:00"
LOOKED_UP_AT = "2024-01-20 00:00:00"
SPLIT_AT = "2024-01-16 00:00:00"
FIRST_DAY, LAST_DAY = "2024-01-10", "2024-01-19"


def plain(df: DataFrame) -> DataFrame:
    """Result types that read the same in any engine: decimals as double, dates
    as ISO text, string arrays joined."""
    shown: list[Column] = []
    for field in df.schema:
        c = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, T.ArrayType):
            c = F.concat_ws("; ", c)
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        shown.append(c.alias(field.name))
    return df.select(*shown)


def query(name: str) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: plain(build(spark, sf_dir))
        return build

    return add


def _latest(df: DataFrame, column: str) -> Column:
    return df.agg(F.max(column)).scalar()


# -- landing -----------------------------------------------------------------------


def _transformed(spark: SparkSession, d: str, **options) -> DataFrame:
    return transform.pipe_transform(derived.lines(spark, d), "2024-02-01 00:00:00", **options)


@query("pipe_transform")
def _(spark, d):
    return transform.split_rejects(_transformed(spark, d))[0]


@query("pipe_transform_fractional")
def _(spark, d):
    rows = _transformed(spark, d, signal_scale=2, trim_direction=True)
    return transform.split_rejects(rows)[0].drop("raw_json")


@query("pipe_rejects")
def _(spark, d):
    return transform.split_rejects(_transformed(spark, d))[1]


@query("signal_quality_class")
def _(spark, d):
    return derived.scans(spark, d).select(
        "event_id",
        "copy",
        "signal_strength",
        transform.signal_quality(F.col("signal_strength")).alias("signal_quality"),
    )


@query("normalize_event_time")
def _(spark, d):
    """Event times as text with a zone that depends on the event type."""
    zone = (
        F.when(F.col("event_type") == "view", "Z")
        .when(F.col("event_type") == "click", "+02:00")
        .when(F.col("event_type") == "error", "-05:30")
        .otherwise("")
    )
    text = F.when(
        F.col("event_type") == "signup", F.concat(F.lit("at "), F.col("event_id").cast("string"))
    ).otherwise(F.concat(F.translate(time_text("ts"), " ", "T"), zone))
    return derived.table(spark, d, "events").select(
        "event_id", transform.normalize_event_time(text).alias("event_timestamp")
    )


@query("event_calendar")
def _(spark, d):
    return facts.with_calendar(derived.table(spark, d, "events").select("event_id", "ts"), "ts")


@query("ingest_totals")
def _(spark, d):
    return validation.ingest_totals(_checked(spark, d))


# -- validation ----------------------------------------------------------------------


def _field_as_of(scans: DataFrame) -> Column:
    return ago(_latest(scans, "event_timestamp"), days=1)


def _verdicts(checked: DataFrame) -> DataFrame:
    return checked.select("event_id", "errors", "warnings", "is_valid")


def _checked(spark: SparkSession, d: str, strict: bool = False) -> DataFrame:
    scans = derived.field_scans(spark, d)
    return validation.validate_events(scans, _field_as_of(scans), strict)


@query("validate_required")
def _(spark, d):
    return _verdicts(validation.validate_required(derived.field_scans(spark, d)))


@query("validate_timestamp")
def _(spark, d):
    scans = derived.field_scans(spark, d)
    return _verdicts(validation.validate_timestamp(scans, _field_as_of(scans)))


@query("validate_signal")
def _(spark, d):
    return _verdicts(validation.validate_signal(derived.field_scans(spark, d)))


@query("validate_ids")
def _(spark, d):
    return _verdicts(validation.validate_ids(derived.field_scans(spark, d)))


@query("validate_direction")
def _(spark, d):
    return _verdicts(validation.validate_direction(derived.field_scans(spark, d)))


@query("validate_events")
def _(spark, d):
    return _verdicts(_checked(spark, d))


@query("validate_events_strict")
def _(spark, d):
    return _verdicts(_checked(spark, d, strict=True))


@query("split_valid")
def _(spark, d):
    accepted, rejected = validation.split_valid(_checked(spark, d))
    return accepted.select("event_id", F.lit("accepted").alias("verdict"), F.lit("").alias("reasons")).unionByName(
        rejected.select("event_id", F.lit("rejected").alias("verdict"), F.concat_ws("; ", "reasons").alias("reasons"))
    )


# -- change feed and staging -------------------------------------------------------------


@query("cdc_insert_filter")
def _(spark, d):
    """The feed of a table written twice: first all scans, then without purchases and with
    those that were sent again in the place of their first copies."""
    raw = derived.raw_rows(spark, d)
    again = F.col("reader_id") == derived.RESEND_READER
    first = raw.filter(~again)
    stays = first.filter(~F.coalesce(F.col("direction") == "EXIT", F.lit(False)))
    second = raw.filter(again).unionByName(stays.join(raw.filter(again), list(staging.DEDUP_KEY), "left_anti").select(*raw.columns))
    feed = snapshots.net_changes(raw.limit(0), first, staging.DEDUP_KEY).unionByName(
        snapshots.net_changes(first, second, staging.DEDUP_KEY)
    )
    return staging.inserts_only(feed).drop("_row_id")


@query("snapshot_changes")
def _(spark, d):
    """All changes of the user dimension that its dated changes brought."""
    before = derived.users(spark, d)
    changes = derived.dated_changes(spark, d).filter("arrival % 5 = 0")
    after = dimensions.scd2_rebuild(before, changes, VERSIONED_AT)
    shown = ("user_id", "clearance_level", "effective_start_date", "effective_end_date", "is_current")
    return snapshots.net_changes(before.select(*shown), after.select(*shown), ("user_id", "effective_start_date")).drop("_row_id")


@query("dedup_latest")
def _(spark, d):
    return staging.dedup_latest(derived.raw_rows(spark, d))


@query("raw_to_staging")
def _(spark, d):
    return staged_rows(staging.with_feed_metadata(derived.raw_rows(spark, d)))


def _pending(spark: SparkSession, d: str) -> DataFrame:
    """What staging, a day behind, has not read, from the logs of both."""
    wh = warehouse(spark, d)
    return staging.pending_of_logs(wh.log("ingest"), derived.stage_log(wh.raw, ago(wh.mark("arrival"), days=1)))


@query("pending_count")
def _(spark, d):
    return _pending(spark, d)


@query("pending_status")
def _(spark, d):
    return staging.feed_status(_pending(spark, d))


# -- dimensions ---------------------------------------------------------------------------


@query("seed_users")
def _(spark, d):
    """The enrolled users with the seed members added where missing."""
    seeds = dimensions.seed_users(spark, derived.ENROLLED_AT)
    return dimensions.add_missing_members(derived.users(spark, d), seeds, "user_id", "user_key")


@query("seed_zones")
def _(spark, d):
    seeds = dimensions.seed_zones(spark, derived.ENROLLED_AT)
    return dimensions.add_missing_members(derived.zones(spark, d), seeds, "zone_id", "zone_key")


@query("unknown_users")
def _(spark, d):
    staged = staging.dedup_latest(derived.raw_rows(spark, d))
    return dimensions.unknown_users(staged, derived.users(spark, d))


@query("orphaned_users")
def _(spark, d):
    staged = staging.dedup_latest(derived.raw_rows(spark, d))
    return dimensions.orphaned_users(staged, derived.users(spark, d))


@query("dim_users_upsert")
def _(spark, d):
    staged = staging.dedup_latest(derived.raw_rows(spark, d))
    return dimensions.upsert_unknown_users(staged, derived.users(spark, d), VERSIONED_AT)


def _versioned(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.scd2_apply(
        derived.users(spark, d), derived.user_changes(spark, d), VERSIONED_AT
    )


@query("scd2_apply")
def _(spark, d):
    return _versioned(spark, d)


@query("scd2_rebuild")
def _(spark, d):
    """Dated changes that came in three deliveries, in no order of time."""
    history = derived.users(spark, d)
    changes = derived.dated_changes(spark, d)
    log = dimensions.change_points(history)
    for part in (1, 2, 0):
        landed = work_dir(spark, "changes")
        changes.filter(F.col("arrival") % 3 == part).drop("arrival").write.parquet(landed)
        came = spark.read.parquet(landed)
        path = work_dir(spark, "versions")
        dimensions.scd2_rebuild(history, came, VERSIONED_AT, log).write.parquet(path)
        history, log = spark.read.parquet(path), log.unionByName(came)
    return history.select(
        "user_id", "user_name", "clearance_level", "effective_start_date", "effective_end_date", "is_current"
    )


@query("users_current")
def _(spark, d):
    return dimensions.users_current(_versioned(spark, d))


@query("users_point_in_time")
def _(spark, d):
    history = _versioned(spark, d)
    before = dimensions.users_as_of(history, "2024-01-10 00:00:00")
    after = dimensions.users_as_of(history, LOOKED_UP_AT)
    return before.withColumn("looked_up", F.lit("before")).unionByName(
        after.withColumn("looked_up", F.lit("after"))
    ).select("looked_up", "user_id", "user_key", "clearance_level", "is_current")


@query("fact_as_of_users")
def _(spark, d):
    staged = staging.dedup_latest(derived.raw_rows(spark, d))
    hot = joins.heavy_keys(derived.raw_rows(spark, d), "user_id")
    return dimensions.events_with_user_version(staged, _versioned(spark, d), hot).select(
        "badge_id", "event_timestamp", "user_key", "user_name", "clearance_level"
    )


@query("masked_users")
def _(spark, d):
    return dimensions.mask_pii(derived.users(spark, d), role="ANALYST").select(
        "user_key", "user_id", "email", "phone"
    )


# -- facts -----------------------------------------------------------------------------------


def _load_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    staged = staged_rows(derived.raw_rows(spark, d))
    users = dimensions.upsert_unknown_users(staged, derived.users(spark, d), VERSIONED_AT)
    return staged, users, derived.zones(spark, d)


def _hot_users(spark: SparkSession, d: str) -> DataFrame:
    return joins.heavy_keys(derived.raw_rows(spark, d), "user_id")


@query("fact_load")
def _(spark, d):
    staged = staged_rows(derived.raw_rows(spark, d))
    return loaded_facts(
        staged, derived.users(spark, d), derived.zones(spark, d), hot_users=_hot_users(spark, d)
    )


@query("process_badge_events")
def _(spark, d):
    """Unknown members, then facts; users holding very many events are spread."""
    return loaded_facts(*_load_inputs(spark, d), hot_users=_hot_users(spark, d))


def _profiled(spark: SparkSession, d: str, rows: DataFrame, zones: DataFrame) -> tuple[list[tuple], DataFrame]:
    """The spans and hot users of a batch, from one pass over it."""
    path = work_dir(spark, "profile")
    facts.profile(rows, zones).write.parquet(path)
    can_load = spark.read.parquet(path).filter("placed")
    return facts.spans_of_days(facts.days_of(can_load)), joins.heavy_keys(can_load, "user_id")


@query("fact_idempotent_load")
def _(spark, d):
    """A second load over the same staging: only what the first did not have."""
    wh = warehouse(spark, d)
    spans, hot = _profiled(spark, d, wh.staged, wh.zones)
    early = wh.staged.filter(F.col("event_timestamp") < ntz(SPLIT_AT))
    first = loaded_facts(early, wh.users, wh.zones, hot_users=hot)
    known = facts.touching(first, spans)
    return loaded_facts(wh.staged, wh.users, wh.zones, facts=known, hot_users=hot)


@query("late_dimension_replay")
def _(spark, d):
    """Facts that load once their zones, unknown before, have been added."""
    wh = warehouse(spark, d)
    members = derived.late_zones(wh.staged, wh.zones)
    members = dimensions.conform(members, ZONE_SCHEMA)
    grown = dimensions.add_missing_members(wh.zones, members, "zone_id", "zone_key")
    path = work_dir(spark, "waiting")
    facts.unplaced(wh.staged, wh.zones).write.parquet(path)
    waiting = spark.read.parquet(path)
    spans, hot = _profiled(spark, d, waiting, grown)
    known = facts.touching(wh.facts, spans)
    return loaded_facts(waiting, wh.users, grown, facts=known, hot_users=hot)


@query("event_keys")
def _(spark, d):
    """Surrogate keys of the stored fact: one a row, none missing."""
    keys = warehouse(spark, d).facts.groupBy("event_key").agg(F.count(F.lit(1)).alias("n"))
    return keys.agg(
        F.sum("n").alias("facts"),
        F.count("event_key").alias("distinct_keys"),
        F.count_if(F.col("event_key").isNull() | (F.col("event_key") < 1)).alias("bad_keys"),
    )


@query("fact_compact")
def _(spark, d):
    target = work_dir(spark, "compacted")
    facts.compact(warehouse(spark, d).facts, target)
    return spark.read.parquet(target).drop("event_key")


# -- streaming -----------------------------------------------------------------------------------


def _write_lines(rows: DataFrame, path: str) -> None:
    rows.select("value").write.mode("append").text(path)


@query("ingest_stream")
def _(spark, d):
    root = work_dir(spark, "ingest")
    _write_lines(derived.lines(spark, d), f"{root}/lines")
    ingest.land_raw(
        landing.read_events(spark, f"{root}/lines"), f"{root}/raw", f"{root}/checkpoint"
    ).awaitTermination()
    landed = landing.read_landed(spark, f"{root}/raw").drop("ingestion_time", "ingest_date")
    rejects = landing.read_rejects(spark, f"{root}/raw").select(
        "raw_json", F.concat_ws("; ", "reject_reasons").alias("reject_reasons")
    )
    return landed.unionByName(rejects, allowMissingColumns=True)


@query("stream_dedup")
def _(spark, d):
    root = work_dir(spark, "dedup")
    raw = derived.raw_rows(spark, d).withColumns(
        {"status": F.lit(landing.ACCEPTED), "ingest_date": F.to_date("ingestion_time")}
    )
    raw.write.partitionBy("status", "ingest_date").parquet(f"{root}/raw")
    consume.stage_changes(
        spark, f"{root}/raw", f"{root}/stg", f"{root}/log", f"{root}/checkpoint",
        staging_time=LOOKED_UP_AT,
    )
    return spark.read.parquet(f"{root}/stg").drop("_batch_id")


@query("cdc_incremental")
def _(spark, d):
    """Three runs of the change feed: each reads only what landed since."""
    root = work_dir(spark, "cdc")
    raw = derived.raw_rows(spark, d).withColumns(
        {"status": F.lit(landing.ACCEPTED), "ingest_date": F.to_date("ingestion_time")}
    )
    early = F.col("ingestion_time") < ntz(SPLIT_AT)
    for part in (early, ~early, None):
        if part is not None:
            raw.filter(part).write.mode("append").partitionBy("status", "ingest_date").parquet(
                f"{root}/raw"
            )
        consume.stage_changes(
            spark, f"{root}/raw", f"{root}/stg", f"{root}/log", f"{root}/checkpoint"
        )
    return (
        spark.read.schema(consume.STAGE_LOG_SCHEMA)
        .parquet(f"{root}/log")
        .groupBy("_batch_id")
        .agg(F.sum("rows_read").alias("rows_read"))
        .withColumnRenamed("_batch_id", "batch_id")
    )


@query("hourly_rollup")
def _(spark, d):
    """The hourly report from the state that a stream keeps, in several batches."""
    root = work_dir(spark, "rollup")
    raw = derived.raw_rows(spark, d).select(*RAW_COLUMNS)
    early = F.col("ingestion_time") < ntz(SPLIT_AT)
    for part in (~early, early):  # the older half comes late
        raw.filter(part).write.mode("append").parquet(f"{root}/raw")
        stream = spark.readStream.schema(raw.schema).parquet(f"{root}/raw")
        rollup.write_rollup(stream, f"{root}/state", f"{root}/checkpoint").awaitTermination()
    return rollup.hourly_report(rollup.read_state(spark, f"{root}/state"))


@query("stream_alerts")
def _(spark, d):
    """Keys that came again and users with more than two scans an hour, while they arrive."""
    root = work_dir(spark, "alerts")
    raw = derived.raw_rows(spark, d).select(*RAW_COLUMNS)
    early = F.col("ingestion_time") < ntz(SPLIT_AT)
    session = spark.newSession()  # the state store is a setting of this stream's only
    alerts.state_settings(session)
    for part in (early, ~early):
        raw.filter(part).write.mode("append").parquet(f"{root}/raw")
        scans = session.readStream.schema(raw.schema).parquet(f"{root}/raw")
        found = alerts.scan_alerts(scans, more_than=2)
        alerts.write_alerts(found, f"{root}/alerts", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/alerts").drop("_batch_id", "alert_date")


@query("pipeline_end_to_end")
def _(spark, d):
    """Lines in two deliveries through the whole chain, then facts with names."""
    store = pipeline.create(
        spark, work_dir(spark, "pipeline"), derived.users(spark, d), derived.zones(spark, d)
    )
    lines = derived.lines(spark, d)
    early = F.col("received_at") < ntz(SPLIT_AT)
    for part in (early, ~early):
        _write_lines(lines.filter(part), store.path("lines"))
        pipeline.run_once(store, store.path("lines"))
    loaded = store.facts()
    return (
        loaded.join(store.users().select("user_key", "user_id", "user_name"), "user_key")
        .join(store.zones().select("zone_key", "zone_name"), "zone_key")
        .select(
            "badge_id", "event_timestamp", "user_id", "user_name", "zone_name", "event_date",
            "event_hour", "event_day_of_week", "direction", "signal_strength", "signal_quality",
            "is_restricted_access", "is_after_hours", "is_weekend",
        )
    )


# -- data quality ------------------------------------------------------------------------------------


@query("dq_null_count")
def _(spark, d):
    raw = warehouse(spark, d).raw
    return raw.agg(
        *[
            quality.null_count(c).alias(f"null_{c}")
            for c in ("badge_id", "user_id", "zone_id", "event_timestamp", "direction")
        ]
    )


@query("dq_blank_count")
def _(spark, d):
    scans = derived.field_scans(spark, d)
    return scans.agg(
        quality.blank_count("badge_id").alias("blank_badge_id"),
        quality.blank_count("user_id").alias("blank_user_id"),
    )


@query("dq_row_count")
def _(spark, d):
    return quality.as_metric(warehouse(spark, d).raw, quality.row_count())


@query("dq_freshness")
def _(spark, d):
    wh = warehouse(spark, d)
    by_write = quality.as_metric(wh.raw, quality.freshness("ingestion_time", wh.as_of()))
    by_column = quality.as_metric(wh.facts, quality.freshness("event_timestamp", wh.as_of()))
    return by_write.select(F.lit("RAW_BADGE_EVENTS").alias("table_name"), "value").unionByName(
        by_column.select(F.lit("FCT_ACCESS_EVENTS").alias("table_name"), "value")
    )


@query("dq_duplicate_events")
def _(spark, d):
    return quality.duplicate_events(warehouse(spark, d).raw)


@query("dq_invalid_signal")
def _(spark, d):
    return quality.as_metric(warehouse(spark, d).raw, quality.invalid_signal_strength())


@query("dq_future_timestamps")
def _(spark, d):
    return quality.as_metric(warehouse(spark, d).raw, quality.future_timestamps())


@query("dq_invalid_direction")
def _(spark, d):
    return quality.as_metric(warehouse(spark, d).raw, quality.invalid_direction())


@query("dq_abnormal_activity")
def _(spark, d):
    """The standard limit, and a limit of one event to show busy users."""
    raw = warehouse(spark, d).raw
    return (
        quality.abnormal_user_activity(raw)
        .select(F.lit(100).alias("more_than"), "value")
        .unionByName(
            quality.abnormal_user_activity(raw, more_than=1).select(
                F.lit(1).alias("more_than"), "value"
            )
        )
    )


@query("dq_orphaned_facts")
def _(spark, d):
    """The stored facts against the users as they were before unknown members."""
    wh = warehouse(spark, d)
    return quality.orphaned_fact_records(wh.facts, derived.users(spark, d), wh.zones)


def _suite(spark: SparkSession, d: str, layer: str) -> DataFrame:
    wh = warehouse(spark, d)
    rows, checks, schema, table, schedule = {
        "raw": (wh.raw, quality.RAW_CHECKS, "STAGE", "RAW_BADGE_EVENTS", "15 MINUTE"),
        "staging": (wh.staged, quality.STAGING_CHECKS, "TRANSFORM", "STG_BADGE_EVENTS", "ON CHANGE"),
        "fact": (wh.facts, quality.FACT_CHECKS, "ANALYTICS", "FCT_ACCESS_EVENTS", "HOURLY"),
    }[layer]
    return quality.run_suite(rows, checks, wh.as_of(), derived.DATABASE, schema, table, schedule)


_SUITE_COLUMNS = ("table_name", "data_metric_name", "column_names", "value", "expectation_violations")


@query("dq_suite_raw")
def _(spark, d):
    return _suite(spark, d, "raw").select(*_SUITE_COLUMNS, "measurement_time")


@query("dq_suite_staging")
def _(spark, d):
    return _suite(spark, d, "staging").select(*_SUITE_COLUMNS)


@query("dq_suite_fact")
def _(spark, d):
    return _suite(spark, d, "fact").select(*_SUITE_COLUMNS)


@query("dq_expectations")
def _(spark, d):
    """Expectations of every comparator on the hourly metrics of landing."""
    return _dq_log(spark, d)[0].select(
        "measurement_time", "table_name", "data_metric_name", "value", "expectation_violations"
    )


@query("dq_run")
def _(spark, d):
    """The three suites, appended to a result log and read back."""
    path = f"{work_dir(spark, 'dq')}/results"
    for layer in ("raw", "staging", "fact"):
        quality.append_results(_suite(spark, d, layer), path)
    return spark.read.parquet(path).select(*_SUITE_COLUMNS)


def _dq_log(spark: SparkSession, d: str) -> tuple[DataFrame, Column]:
    wh = warehouse(spark, d)
    return wh.log("dq"), wh.mark("measurement")


@query("dq_dashboard")
def _(spark, d):
    return quality.dashboard(_dq_log(spark, d)[0], derived.DATABASE)


@query("dq_violations")
def _(spark, d):
    return quality.violations(_dq_log(spark, d)[0], derived.DATABASE)


@query("dq_quality_scores")
def _(spark, d):
    log, newest = _dq_log(spark, d)
    return quality.quality_scores(log, derived.DATABASE, newest)


@query("dq_violation_trends")
def _(spark, d):
    log, newest = _dq_log(spark, d)
    return quality.violation_trends(log, derived.DATABASE, newest)


@query("dq_alert_log")
def _(spark, d):
    """The alert log after two runs over the newest measurements."""
    (log, newest), path = _dq_log(spark, d), f"{work_dir(spark, 'alerts')}/log"
    for _ in range(2):
        quality.append_alerts(log, derived.DATABASE, path, newest)
    return spark.read.parquet(path).drop("measurement_time")


# -- monitoring ----------------------------------------------------------------------------------------


@query("ingestion_metrics")
def _(spark, d):
    wh = warehouse(spark, d)
    return monitoring.ingestion_metrics(wh.raw, wh.as_of())


@query("pipeline_latency")
def _(spark, d):
    wh = warehouse(spark, d)
    return monitoring.latency_of_marks(wh.write_marks, ("RAW", "STAGING", "ANALYTICS"), wh.as_of())


@query("data_freshness")
def _(spark, d):
    wh = warehouse(spark, d)
    return monitoring.data_freshness(
        {
            "RAW_BADGE_EVENTS": (wh.raw, "ingestion_time"),
            "FCT_ACCESS_EVENTS": (wh.facts, "fact_load_time"),
        },
        wh.as_of(),
    )


def _ingest_log(spark: SparkSession, d: str) -> tuple[DataFrame, Column]:
    wh = warehouse(spark, d)
    return wh.log("ingest"), wh.mark("line")


@query("channel_status")
def _(spark, d):
    return monitoring.channel_status(*_ingest_log(spark, d))


@query("streaming_costs")
def _(spark, d):
    return monitoring.streaming_costs(*_ingest_log(spark, d))


@query("streaming_cost_total")
def _(spark, d):
    return monitoring.streaming_cost_total(*_ingest_log(spark, d))


@query("ingest_error_rate")
def _(spark, d):
    return monitoring.ingest_error_rate(*_ingest_log(spark, d))


@query("pipe_volume")
def _(spark, d):
    return monitoring.pipe_volume(*_ingest_log(spark, d))


def _run_log(spark: SparkSession, d: str) -> tuple[DataFrame, Column]:
    wh = warehouse(spark, d)
    return wh.log("run"), wh.mark("line")


@query("task_history")
def _(spark, d):
    """All runs of three days."""
    return monitoring.task_history(*_run_log(spark, d), hours=72)


@query("task_durations")
def _(spark, d):
    return monitoring.task_durations(*_run_log(spark, d))


@query("task_success_rate")
def _(spark, d):
    return monitoring.task_success_rate(*_run_log(spark, d))


@query("task_failures")
def _(spark, d):
    return monitoring.task_failures(_run_log(spark, d)[0])


@query("partition_efficiency")
def _(spark, d):
    log = derived.scan_log(spark, d)
    return monitoring.partition_efficiency(log, _latest(log, "start_time"))


@query("credit_usage")
def _(spark, d):
    log = derived.metering_log(spark, d)
    return monitoring.credit_usage(log, _latest(log, "start_time"), "ETL_WH")


@query("credit_usage_week")
def _(spark, d):
    log = derived.metering_log(spark, d)
    return monitoring.credit_usage(log, _latest(log, "start_time"), "ETL_WH", hours=7 * 24)


# -- validation reports and analytics ------------------------------------------------------------------


@query("layer_counts")
def _(spark, d):
    return analytics.layer_counts(warehouse(spark, d).layers)


@query("layer_count_diff")
def _(spark, d):
    raw, staged, loaded = warehouse(spark, d).layers.values()
    return analytics.layer_count_diff({"RAW": raw, "STAGING": staged, "ANALYTICS": loaded})


@query("dim_user_summary")
def _(spark, d):
    return analytics.dim_user_summary(warehouse(spark, d).users)


@query("auto_created_users")
def _(spark, d):
    return analytics.auto_created_users(warehouse(spark, d).users)


@query("fact_date_range")
def _(spark, d):
    return analytics.fact_date_range(warehouse(spark, d).facts)


@query("events_by_date")
def _(spark, d):
    return analytics.events_by_date(warehouse(spark, d).facts)


@query("direction_distribution")
def _(spark, d):
    return analytics.direction_distribution(warehouse(spark, d).facts)


@query("signal_quality_distribution")
def _(spark, d):
    return analytics.signal_quality_distribution(warehouse(spark, d).facts)


@query("signal_quality_known")
def _(spark, d):
    return analytics.signal_quality_distribution(warehouse(spark, d).facts, exclude_unknown=True)


@query("flag_shares")
def _(spark, d):
    return analytics.flag_shares(warehouse(spark, d).facts)


@query("top_zones")
def _(spark, d):
    wh = warehouse(spark, d)
    return analytics.top_zones(wh.facts, wh.zones)


@query("top_badges")
def _(spark, d):
    wh = warehouse(spark, d)
    return analytics.top_badges(wh.facts, wh.users)


@query("fact_completeness")
def _(spark, d):
    return analytics.fact_completeness(warehouse(spark, d).facts)


@query("ingestion_latency")
def _(spark, d):
    return analytics.latency_report(warehouse(spark, d).latencies)


@query("pipeline_verdict")
def _(spark, d):
    """With staging up to now, and with staging a day behind."""
    wh = warehouse(spark, d)
    now = wh.raw.agg(F.max("ingestion_time")).first()[0] + timedelta(minutes=5)
    verdicts = [
        analytics.pipeline_verdict(
            wh.layers, wh.raw, derived.stage_log(wh.raw, until), wh.log("run"), wh.facts
        ).withColumn("staged_until", F.lit(name))
        for name, until in (("now", as_time(now)), ("yesterday", as_time(now - timedelta(days=1))))
    ]
    return verdicts[0].unionByName(verdicts[1])


@query("events_in_range")
def _(spark, d):
    return analytics.events_in_range(warehouse(spark, d).facts, FIRST_DAY, LAST_DAY).drop(
        "event_key"
    )


@query("user_access_history")
def _(spark, d):
    """The history of the badge seen last."""
    wh = warehouse(spark, d)
    newest = wh.facts.agg(F.max_by("badge_id", F.struct("event_timestamp", "badge_id"))).scalar()
    return analytics.user_access_history(wh.facts, wh.users, wh.zones, newest, wh.last_event()).drop(
        "event_key"
    )


@query("zone_entries")
def _(spark, d):
    wh = warehouse(spark, d)
    return analytics.zone_entries(wh.facts, wh.last_event())


@query("after_hours_alerts")
def _(spark, d):
    wh = warehouse(spark, d)
    return analytics.after_hours_alerts(wh.facts, wh.last_event()).drop("event_key")


@query("after_hours_restricted")
def _(spark, d):
    wh = warehouse(spark, d)
    return analytics.after_hours_restricted(wh.facts, wh.users, wh.zones, wh.last_event())


@query("daily_zone_access")
def _(spark, d):
    wh = warehouse(spark, d)
    return analytics.daily_zone_access(wh.facts, wh.zones, wh.last_event())


@query("recent_events")
def _(spark, d):
    """Newest ten rows of each layer."""
    wh = warehouse(spark, d)
    shown = ("badge_id", "reader_id", "event_timestamp", "signal_quality")
    newest = [
        analytics.recent_events(rows, by, ties=("badge_id", "event_timestamp", "reader_id")).select(
            F.lit(layer).alias("layer"), *shown
        )
        for layer, rows, by in (
            ("RAW", wh.raw, "ingestion_time"),
            ("STAGING", wh.staged, "staging_time"),
            ("ANALYTICS", wh.facts, "fact_load_time"),
        )
    ]
    return newest[0].unionByName(newest[1]).unionByName(newest[2])
