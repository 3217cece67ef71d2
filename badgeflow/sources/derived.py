"""Badge scans, dimensions and operational logs derived from the given tables.

Every frame here grows with the tables it reads; see FIXTURES.md section 3.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.times import ntz, time_text, trunc_minute
from ..operators import quality
from ..operators.dimensions import conform
from ..operators.transform import standardize
from ..schemas import USER_SCHEMA, ZONE_SCHEMA
from ..session import file_system

PIPE = "BADGE_EVENTS_PIPE"
STAGE_TASK, LOAD_TASK = "raw_to_staging_task", "staging_to_analytics_task"
DATABASE = "BADGES"
ENROLLED_AT = "2024-01-01 00:00:00"
RESEND_READER = "RDR-999"

ORIGINAL, RESENT, FAULTY = 0, 1, 2


_tables: dict[tuple, DataFrame] = {}


def stamp(spark: SparkSession, path: str) -> tuple:
    """What changes when a table does: path, files, bytes and time of change."""
    store, name = file_system(spark, path)
    found, summary = store.getFileStatus(name), store.getContentSummary(name)
    return path, summary.getFileCount(), summary.getLength(), found.getModificationTime()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its files are listed and its schema read once, until it changes."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, stamp(spark, path))
    if key not in _tables:
        _tables[key] = spark.read.parquet(path)
    return _tables[key]


def padded(prefix: str, number: Column, width: int) -> Column:
    """``prefix`` and the zero-padded number; longer numbers are never cut."""
    text = number.cast("string")
    return F.concat(
        F.lit(prefix), F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))
    )


def _seconds(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n.cast("decimal(18,6)"))


def _k() -> Column:
    return F.regexp_extract("props", "([0-9]+)", 1).cast("int")


def _copies(spark: SparkSession, sf_dir: str, faulty_too: bool) -> DataFrame:
    """Events as scans, once per line that reached the endpoint, in one read.

    An event of type error is sent again by the fallback reader; an implausibly
    large value also produced a garbled line.
    """
    again = F.col("event_type") == "error"
    garbled = (F.col("value") >= 100) if faulty_too else F.lit(False)
    sent = (
        F.when(again & garbled, F.lit([ORIGINAL, RESENT, FAULTY]))
        .when(again, F.lit([ORIGINAL, RESENT]))
        .when(garbled, F.lit([ORIGINAL, FAULTY]))
        .otherwise(F.lit([ORIGINAL]))
    )
    k = F.col("k")
    signal = F.when(k % 10 != 0, -(F.col("value").cast("decimal(9,2)") % 110))
    direction = (
        F.when(F.col("event_type") == "view", "entry")
        .when(F.col("event_type") == "purchase", "EXIT")
        .when(F.col("event_type") == "signup", "Entry")
        .when(k % 2 == 0, "LOITER")
    )
    resent = F.col("copy") == RESENT
    return (
        table(spark, sf_dir, "events")
        .select(
            "event_id",
            "ts",
            "user_id",
            "event_type",
            "value",
            _k().alias("k"),
            F.explode(sent).alias("copy"),
        )
        .select(
            "event_id",
            "copy",
            "k",
            padded("BADGE-", F.col("user_id"), 5).alias("badge_id"),
            padded("USR-", F.col("user_id"), 4).alias("user_id"),
            padded("ZONE-", k % 30, 2).alias("zone_id"),
            F.when(resent, RESEND_READER).otherwise(padded("RDR-", k % 25, 3)).alias("reader_id"),
            F.col("ts").alias("event_timestamp"),
            signal.cast("decimal(5,2)").alias("signal_strength"),
            direction.alias("direction"),
            (F.col("ts") + _seconds(k + F.when(resent, 60).otherwise(0))).alias("ingestion_time"),
        )
    )


def scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed badge scans, resent copies included."""
    return _copies(spark, sf_dir, faulty_too=False)


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize(scans(spark, sf_dir))


def field_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scans as devices report them: late uploads, blank and over-long ids,
    positive signals."""
    k = F.col("k")
    return (
        table(spark, sf_dir, "events")
        .withColumn("k", _k())
        .select(
            "event_id",
            padded("BADGE-", F.col("user_id"), 5).alias("badge_id"),
            F.when(k == 7, "  ")
            .when(k != 8, padded("USR-", F.col("user_id"), 4))
            .alias("user_id"),
            padded("ZONE-", k % 30, 2).alias("zone_id"),
            F.when(k == 11, F.rpad(padded("RDR-", k % 25, 3), 60, "X"))
            .otherwise(padded("RDR-", k % 25, 3))
            .alias("reader_id"),
            F.when(k != 13, F.when(F.col("event_type") == "signup", F.col("ts") - F.expr("INTERVAL 20 DAYS"))
                   .otherwise(F.col("ts"))).alias("event_timestamp"),
            F.when(k % 10 != 0, F.col("value").cast("decimal(9,2)") % 110 * F.when(k == 3, 1).otherwise(-1))
            .cast("double")
            .alias("signal_strength"),
            F.when(F.col("event_type") == "view", "ENTRY")
            .when(F.col("event_type") == "purchase", "EXIT")
            .when(F.col("event_type") == "signup", "Entry")
            .alias("direction"),
        )
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NDJSON lines (``value``) with channel, arrival time and planted fault."""
    k = F.col("k")
    rows = _copies(spark, sf_dir, faulty_too=True).withColumn(
        "fault", F.when(F.col("copy") == FAULTY, k % 6)
    )
    fault = F.col("fault")

    def quoted(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{name}":"'), value, F.lit('"'))

    iso_time = F.translate(time_text("event_timestamp", always_micros=True), " ", "T")
    fields = F.concat_ws(
        ",",
        F.when(fault.isNull() | (fault != 1), quoted("badge_id", F.col("badge_id"))),
        F.when(fault == 5, F.lit('"user_id":null')).otherwise(quoted("user_id", F.col("user_id"))),
        quoted("zone_id", F.when(fault == 4, F.rpad("zone_id", 60, "X")).otherwise(F.col("zone_id"))),
        quoted("reader_id", F.col("reader_id")),
        quoted("event_timestamp", F.when(fault == 0, "not-a-time").otherwise(iso_time)),
        F.concat(
            F.lit('"signal_strength":'),
            F.when(fault == 3, '"n/a"').otherwise(
                F.coalesce(F.col("signal_strength").cast("string"), F.lit("null"))
            ),
        ),
        F.when(fault == 5, F.lit('"direction":"SIDEWAYS-LONG"')).otherwise(
            F.coalesce(quoted("direction", F.col("direction")), F.lit('"direction":null'))
        ),
    )
    line = F.concat(F.lit("{"), fields, F.lit("}"))
    return rows.select(
        F.when(fault == 2, F.substring(line, 1, 20)).otherwise(line).alias("value"),
        padded("CH-", k % 4, 1).alias("channel_name"),
        F.col("ingestion_time").alias("received_at"),
        "copy",
        "fault",
        "k",
    )


# -- dimensions ---------------------------------------------------------------------


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in good standing are enrolled; the others are unknown users."""
    balance = F.col("c_acctbal")
    start = ntz(ENROLLED_AT)
    enrolled = (
        table(spark, sf_dir, "customer")
        .filter(balance >= 0)
        .select(
            (F.col("c_custkey") + 1).alias("user_key"),
            padded("USR-", F.col("c_custkey"), 4).alias("user_id"),
            F.col("c_name").alias("user_name"),
            _user_type().alias("user_type"),
            F.col("c_mktsegment").alias("department"),
            _email().alias("email"),
            _phone().alias("phone"),
            F.when(balance >= 7000, "SECRET")
            .when(balance >= 3000, "CONFIDENTIAL")
            .otherwise("PUBLIC")
            .alias("clearance_level"),
            F.lit(True).alias("is_active"),
            start.alias("effective_start_date"),
            F.lit(True).alias("is_current"),
            start.alias("created_timestamp"),
            start.alias("updated_timestamp"),
        )
    )
    return conform(enrolled, USER_SCHEMA)


def _user_type() -> Column:
    balance = F.col("c_acctbal")
    return (
        F.when(balance >= 8000, "EMPLOYEE")
        .when(balance >= 4000, "CONTRACTOR")
        .when(balance >= 1000, "VENDOR")
        .otherwise("VISITOR")
    )


def _email() -> Column:
    return F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com"))


def _phone() -> Column:
    return padded("555-", F.col("c_custkey"), 7)


def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming attributes: clearance now follows the number of orders."""
    orders = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    n = F.col("n")
    return (
        table(spark, sf_dir, "customer")
        .join(orders, "c_custkey")
        .select(
            padded("USR-", F.col("c_custkey"), 4).alias("user_id"),
            F.col("c_name").alias("user_name"),
            _user_type().alias("user_type"),
            F.col("c_mktsegment").alias("department"),
            _email().alias("email"),
            _phone().alias("phone"),
            F.when(n >= 12, "SECRET")
            .when(n >= 9, "CONFIDENTIAL")
            .otherwise("PUBLIC")
            .alias("clearance_level"),
        )
    )


def dated_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a change of its customer's clearance, at the order's time."""
    priority = F.col("o_orderpriority")
    clearance = F.when(priority == "1-URGENT", "SECRET").when(priority == "2-HIGH", "CONFIDENTIAL").otherwise("PUBLIC")
    dated = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_orderkey").alias("arrival"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("changed_at"),
        clearance.alias("clearance_level"),
    )
    return table(spark, sf_dir, "customer").join(dated, "c_custkey").select(
        padded("USR-", F.col("c_custkey"), 4).alias("user_id"),
        "changed_at",
        "arrival",
        F.col("c_name").alias("user_name"),
        _user_type().alias("user_type"),
        F.col("c_mktsegment").alias("department"),
        _email().alias("email"),
        _phone().alias("phone"),
        "clearance_level",
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    n = F.col("n_nationkey")
    start = ntz(ENROLLED_AT)
    placed = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        (n + 1).cast("long").alias("zone_key"),
        padded("ZONE-", n, 2).alias("zone_id"),
        padded("RDR-", n, 3).alias("reader_id"),
        F.col("r_name").alias("building_name"),
        F.col("n_name").alias("zone_name"),
        F.when(n % 5 == 0, "SECURE_AREA").when(n % 5 == 1, "LOBBY").otherwise("OFFICE").alias(
            "zone_type"
        ),
        (n % 4 == 0).alias("is_restricted"),
        F.lit(True).alias("is_monitored"),
        start.alias("created_timestamp"),
        start.alias("updated_timestamp"),
    )
    return conform(placed, ZONE_SCHEMA)


def late_zones(events: DataFrame, known: DataFrame) -> DataFrame:
    """Zones that events name but the dimension lacks, as new members."""
    return (
        events.select("zone_id")
        .distinct()
        .join(known.select("zone_id"), "zone_id", "left_anti")
        .select(
            "zone_id",
            F.lit("LATE BUILDING").alias("building_name"),
            F.concat(F.lit("LATE "), F.col("zone_id")).alias("zone_name"),
            F.lit(False).alias("is_restricted"),
        )
    )


# -- operational logs -----------------------------------------------------------------


def ingest_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per channel and minute with lines."""
    bad = F.col("fault").isNotNull()
    return (
        lines(spark, sf_dir)
        .groupBy("channel_name", trunc_minute("received_at").alias("server_timestamp"))
        .agg(
            F.count(F.lit(1)).alias("rows_parsed"),
            F.count_if(~bad).alias("rows_inserted"),
            F.count_if(bad).alias("rows_error_count"),
            F.coalesce(F.sum(F.when(~bad, F.octet_length("value"))), F.lit(0))
            .cast("long")
            .alias("bytes_inserted"),
            F.max("fault").alias("fault"),
        )
        .select(
            "channel_name",
            F.lit(PIPE).alias("pipe_name"),
            "server_timestamp",
            "rows_parsed",
            "rows_inserted",
            "rows_error_count",
            "bytes_inserted",
            F.concat(F.lit("fault "), F.col("fault").cast("string")).alias("last_error_message"),
        )
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two chained runs per minute with arrivals.

    Staging fails where a minute brought more bad than good lines and is skipped
    where it brought only resent ones; the load follows successful staging.
    """
    bad = F.col("fault").isNotNull()
    minutes = (
        lines(spark, sf_dir)
        .groupBy(trunc_minute("received_at").alias("minute"))
        .agg(
            F.count_if(bad).alias("n_bad"),
            F.count_if(F.col("copy") == RESENT).alias("n_resent"),
            F.count(F.lit(1)).alias("n"),
            F.sum("k").alias("work"),
        )
    )
    stage_state = (
        F.when(F.col("n_bad") * 2 > F.col("n"), "FAILED")
        .when(F.col("n_resent") == F.col("n"), "SKIPPED")
        .otherwise("SUCCEEDED")
    )
    timed = (
        minutes.withColumn("stage_state", stage_state)
        .withColumn("stage_at", F.col("minute") + _seconds(F.lit(60)))
        .withColumn("staged_at", F.col("stage_at") + _seconds(F.col("work") % 90))
        .withColumn("loaded_at", F.col("staged_at") + _seconds(F.col("work") % 60))
    )
    failed = F.col("stage_state") == "FAILED"
    stage = F.struct(
        F.lit(STAGE_TASK).alias("name"),
        F.col("stage_state").alias("state"),
        F.col("stage_at").alias("scheduled_time"),
        F.col("staged_at").alias("completed_time"),
        F.when(failed, "100038").alias("error_code"),
        F.when(failed, F.concat(F.col("n_bad").cast("string"), F.lit(" bad lines"))).alias(
            "error_message"
        ),
    )
    load = F.struct(
        F.lit(LOAD_TASK).alias("name"),
        F.when(F.col("stage_state") == "SUCCEEDED", "SUCCEEDED").otherwise("SKIPPED").alias("state"),
        F.col("staged_at").alias("scheduled_time"),
        F.col("loaded_at").alias("completed_time"),
        F.lit(None).cast("string").alias("error_code"),
        F.lit(None).cast("string").alias("error_message"),
    )
    return timed.select(F.inline(F.array(stage, load)))


def stage_log(raw: DataFrame, before: Column) -> DataFrame:
    """Rows read by staging, one batch per day, up to a point in time."""
    return (
        raw.filter(F.col("ingestion_time") < before)
        .groupBy(F.to_date("ingestion_time").alias("batch_day"))
        .agg(F.count(F.lit(1)).alias("rows_read"))
    )


def scan_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as one query: table by type, partitions by props and value."""
    return (
        table(spark, sf_dir, "events")
        .withColumn("k", _k())
        .select(
            F.when(F.col("event_type") == "view", "RAW_BADGE_EVENTS")
            .when(F.col("event_type").isin("click", "purchase"), "FCT_ACCESS_EVENTS")
            .otherwise("STG_BADGE_EVENTS")
            .alias("table_name"),
            F.concat(F.lit("Q-"), F.col("event_id").cast("string")).alias("query_id"),
            (F.floor("value").cast("long") % (F.col("k") + 1)).alias("partitions_scanned"),
            F.col("k").cast("long").alias("partitions_total"),
            (F.floor("value").cast("long") * 10000000).alias("bytes_scanned"),
            F.col("ts").alias("start_time"),
        )
    )


def metering_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.when(F.col("event_type").isin("view", "click", "purchase"), "ETL_WH")
        .otherwise("BI_WH")
        .alias("warehouse_name"),
        (F.col("value").cast("decimal(9,2)") / 1000).cast("decimal(12,5)").alias("credits_used"),
        F.col("ts").alias("start_time"),
    )


HOURLY_CHECKS = [
    quality.Check("NULL_COUNT", ("direction",), "no_nulls", "=", 0),
    quality.Check("BLANK_COUNT", ("badge_id",), "no_blanks", "=", 0),
    quality.Check("ROW_COUNT", (), "growing", ">=", 10),
    quality.Check("INVALID_SIGNAL_STRENGTH", ("signal_strength",), "valid_signals", "=", 0),
    quality.Check("FUTURE_TIMESTAMPS", ("event_timestamp",), "no_future", "=", 0),
    quality.Check("INVALID_DIRECTION", ("direction",), "valid_directions", "<", 3),
]


def dq_results(raw: DataFrame, staged: DataFrame) -> DataFrame:
    """A result log: the hourly checks over every hour of landing and staging."""
    of_raw = quality.run_suite_per_hour(
        raw, "ingestion_time", HOURLY_CHECKS, DATABASE, "STAGE", "RAW_BADGE_EVENTS"
    )
    of_staging = quality.run_suite_per_hour(
        staged, "ingestion_time", HOURLY_CHECKS, DATABASE, "TRANSFORM", "STG_BADGE_EVENTS"
    )
    return of_raw.unionByName(of_staging)
