from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from badgeflow.operators import dimensions, facts, joins
from badgeflow.schemas import STAGING_SCHEMA, USER_SCHEMA, ZONE_SCHEMA

T0 = datetime(2024, 1, 5, 10)  # a Friday
STAGED = STAGING_SCHEMA.replace(", _batch_id long", "").replace(",\n    staging_time timestamp_ntz", ", staging_time timestamp_ntz")


def staged(spark, *rows):
    """rows: (badge, user, zone, hours after T0)"""
    return spark.createDataFrame(
        [
            (b, u, z, "R", T0 + timedelta(hours=h), Decimal("-50.00"), "STRONG", "ENTRY", T0, T0)
            for b, u, z, h in rows
        ],
        STAGED,
    )


@pytest.fixture(scope="module")
def users(spark):
    rows = spark.createDataFrame([(1, "U1"), (2, "U2")], "user_key long, user_id string")
    return dimensions.conform(rows.withColumn("is_current", F.lit(True)), USER_SCHEMA)


@pytest.fixture(scope="module")
def zones(spark):
    rows = spark.createDataFrame(
        [(1, "Z1", True), (2, "Z2", False)], "zone_key long, zone_id string, is_restricted boolean"
    )
    return dimensions.conform(rows, ZONE_SCHEMA)


@pytest.mark.parametrize(
    "ts, weekday, after_hours, weekend",
    [
        ("2024-01-07 05:59:59", 0, True, True),
        ("2024-01-06 06:00:00", 6, False, True),
        ("2024-01-08 21:59:59", 1, False, False),
        ("2024-01-05 22:00:00", 5, True, False),
    ],
)
def test_calendar(spark, ts, weekday, after_hours, weekend):
    df = spark.sql(f"select timestamp_ntz'{ts}' event_timestamp")
    row = facts.with_calendar(df).first()
    assert (row.event_day_of_week, row.is_after_hours, row.is_weekend) == (weekday, after_hours, weekend)
    assert str(row.event_date) == ts[:10] and row.event_hour == int(ts[11:13])


def test_load_joins_and_flags(spark, users, zones):
    rows = staged(spark, ("B1", "U1", "Z1", 0), ("B2", "U2", "Z2", 1), ("B3", "U1", "Z9", 0), ("B4", "U9", "Z1", 0))
    got = {r.badge_id: r for r in facts.fact_load(rows, users, zones, load_time=T0).collect()}
    assert set(got) == {"B1", "B2"}
    assert got["B1"].is_restricted_access and not got["B2"].is_restricted_access
    assert (got["B1"].user_key, got["B2"].zone_key) == (1, 2)
    assert [r.badge_id for r in facts.unplaced(rows, zones).collect()] == ["B3"]


def test_loading_again_adds_nothing(spark, users, zones):
    rows = staged(spark, ("B1", "U1", "Z1", 0), ("B1", "U1", "Z1", 0), ("B2", "U1", "Z1", 30))
    first = facts.fact_load(rows, users, zones, load_time=T0)
    assert first.count() == 2
    assert facts.fact_load(rows, users, zones, facts=first, load_time=T0).count() == 0


def test_hot_user_is_spread_and_nothing_is_lost(spark, users, zones):
    """Two thirds of the events belong to one user."""
    rows = spark.range(3000).selectExpr(
        "concat('B', id) badge_id", "if(id % 3 < 2, 'U1', 'U2') user_id",
        "if(id % 2 = 0, 'Z1', 'Z2') zone_id", "'R' reader_id",
        "timestamp_ntz'2024-01-05 10:00:00' event_timestamp", "cast(-50 as decimal(5,2)) signal_strength",
        "'STRONG' signal_quality", "'ENTRY' direction", "timestamp_ntz'2024-01-05 10:00:00' ingestion_time",
        "timestamp_ntz'2024-01-05 10:00:00' staging_time",
    )
    hot = joins.heavy_keys(rows, "user_id", share=2)
    assert [r.user_id for r in hot.collect()] == ["U1"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = facts.fact_load(rows, users, zones, load_time=T0)
        salted = facts.fact_load(rows, users, zones, load_time=T0, hot_users=hot)
        assert salted.count() == plain.count() == 3000
        assert salted.exceptAll(plain).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_heavy_keys_are_bounded(spark):
    rows = spark.range(1000).selectExpr("id % 10 as k")
    assert joins.heavy_keys(rows, "k", share=10).count() == 10
    assert joins.heavy_keys(rows, "k", share=9).count() == 0


def test_write_prunes_and_compacts(spark, users, zones, tmp_path):
    rows = staged(spark, *[(f"B{i}", "U1", "Z1", i) for i in range(100)])
    path, target = str(tmp_path / "fct"), str(tmp_path / "compacted")
    facts.write_facts(facts.fact_load(rows, users, zones, load_time=T0), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 100
    assert stored.select("event_key").distinct().count() == 100
    batch = staged(spark, ("B3", "U1", "Z1", 3), ("B5", "U1", "Z1", 5), ("B30", "U1", "Z1", 30))
    spans = facts.time_spans(batch)
    assert [str(first.date()) for first, _ in spans] == ["2024-01-05", "2024-01-06"]
    touched = facts.touching(stored, spans)
    assert {r.badge_id for r in touched.collect()} == {"B3", "B4", "B5", "B30"}
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(event_timestamp" in plan.split("PushedFilters: [")[1]
    facts.compact(stored, target)
    rewritten = spark.read.parquet(target)
    assert rewritten.exceptAll(stored.select(rewritten.columns)).count() == 0
    assert rewritten.count() == 100


def test_keys_continue_after_the_last(spark):
    df = spark.range(10).repartition(3)
    keys = [r.event_key for r in facts.with_event_key(df, 500).collect()]
    assert min(keys) >= 500 and len(set(keys)) == 10
    # A load of small tasks takes few keys, however many loads there are.
    assert max(keys) < 500 + 10 * 2**17


def test_a_date_with_most_rows_is_split_over_files(spark, users, zones, tmp_path):
    rows = spark.range(40000).selectExpr(
        "concat('BADGE-', id) badge_id", "'U1' user_id", "'Z1' zone_id", "concat('R', uuid()) reader_id",
        "timestamp_ntz'2024-01-05 00:00:00' + make_dt_interval(if(id % 10 < 9, 0, 1), 0, 0, id) event_timestamp",
        "cast(-50 as decimal(5,2)) signal_strength", "'STRONG' signal_quality", "'ENTRY' direction",
        "timestamp_ntz'2024-01-05 10:00:00' ingestion_time", "timestamp_ntz'2024-01-05 10:00:00' staging_time",
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        loaded = facts.fact_load(rows, users, zones, load_time=T0)
        loaded.repartition(4).write.parquet(str(tmp_path / "loaded"))
        facts.write_facts(spark.read.parquet(str(tmp_path / "loaded")), str(tmp_path / "fct"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored = spark.read.parquet(str(tmp_path / "fct"))
    files = (
        stored.select("event_date", F.input_file_name().alias("file"))
        .distinct()
        .groupBy("event_date")
        .agg(F.count("file").alias("n"))
        .collect()
    )
    assert stored.count() == stored.select("event_key").distinct().count() == 40000
    assert max(r.n for r in files) > 1


def test_days_without_number_make_few_ranges(spark, users, zones, tmp_path):
    """A batch with bad clocks names few ranges, and none of its own rows is outside."""
    rows = staged(spark, *[(f"B{i}", "U1", "Z1", 24 * 60 * (i * i)) for i in range(90)])
    spans = facts.time_spans(rows, ranges=8)
    assert len(spans) == 8 and spans == sorted(spans)
    loaded = facts.fact_load(rows, users, zones, load_time=T0)
    assert facts.touching(loaded, spans).count() == 90
    assert len(facts.time_spans(rows)) == facts.RANGES
    assert facts.time_spans(rows.limit(0)) == []
    # Of far apart days, what lies between is not read.
    between = facts.touching(loaded, facts.time_spans(rows.filter("badge_id IN ('B0', 'B89')")))
    assert between.count() == 2


def rows_scanned(df):
    """Rows that the scan hands on, after whole row groups were left out."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()


def test_one_badge_reads_a_small_part_of_the_curve(spark, tmp_path):
    """Of 16,000 rows of a day one badge reads few row groups, and so does a span of time."""
    rows = spark.range(16_000).selectExpr(
        "id AS event_key", "concat('BADGE-', id % 400) AS badge_id",
        "timestamp_ntz'2024-01-05 00:00:00' + make_dt_interval(0, 0, 0, CAST(pmod(xxhash64(id), 86400) AS decimal(18,6))) AS event_timestamp",
        "date'2024-01-05' AS event_date",
    ).withColumn("event_hour", F.hour("event_timestamp"))
    paths = {}
    for by_badge in (False, True):
        paths[by_badge] = str(tmp_path / f"fct{by_badge}")
        facts.compact(rows, paths[by_badge], rows_per_file=250, by_badge=by_badge)
    curve, by_time = (spark.read.parquet(paths[k]) for k in (True, False))
    assert sorted(map(str, curve.collect())) == sorted(map(str, by_time.collect()))
    badge, minutes = F.col("badge_id") == "BADGE-7", [(datetime(2024, 1, 5, 10, 5), datetime(2024, 1, 5, 10, 9))]
    assert curve.filter(badge).count() == 40
    assert rows_scanned(by_time.filter(badge)) > 7000 and rows_scanned(curve.filter(badge)) < 4000
    assert facts.touching(curve, minutes).count() == facts.touching(by_time, minutes).count() > 10
    assert rows_scanned(facts.touching(by_time, minutes)) < 1500 and rows_scanned(facts.touching(curve, minutes)) < 5000


def test_curve_alternates_the_bits(spark):
    def spread(x):
        return sum(((x >> i) & 1) << (2 * i) for i in range(16))

    rows = spark.range(300).selectExpr(
        "concat('B', id) AS badge", "timestamp_ntz'2024-01-05 00:00:00' + make_dt_interval(0, 0, 0, CAST(id * 287 AS decimal(18,6))) AS ts"
    ).select(facts.curve(F.col("badge"), F.col("ts")).alias("at"), facts._badge_hash(F.col("badge")).alias("h"), "ts").collect()
    for r in rows:
        second = r.ts.hour * 3600 + r.ts.minute * 60 + r.ts.second
        assert r.at == 2 * spread(r.h) + spread(int(second * 65536 / 86400))
