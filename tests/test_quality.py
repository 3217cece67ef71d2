from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from badgeflow.operators import quality

T0 = datetime(2024, 1, 5, 10)


def value(df):
    return df.first().value


def test_abnormal_activity_counts_clock_hours(spark):
    """101 events in one clock hour are too many; 60 + 60 over two hours are not."""
    rows = [("busy", T0 + timedelta(seconds=i)) for i in range(101)]
    rows += [("limit", T0 + timedelta(seconds=i)) for i in range(100)]
    rows += [("spread", T0 + timedelta(minutes=-30, seconds=i)) for i in range(60)]
    rows += [("spread", T0 + timedelta(minutes=1, seconds=i)) for i in range(60)]
    rows += [("old", T0 - timedelta(hours=5) + timedelta(seconds=i)) for i in range(500)]
    df = spark.createDataFrame(rows, "user_id string, event_timestamp timestamp_ntz")
    assert value(quality.abnormal_user_activity(df)) == 1
    assert value(quality.abnormal_user_activity(df, more_than=99)) == 2


def test_duplicates_are_keys_not_rows(spark):
    df = spark.createDataFrame([("a", T0)] * 3 + [("b", T0)] * 2 + [("c", T0)], "badge_id string, event_timestamp timestamp_ntz")
    assert value(quality.duplicate_events(df)) == 2


@pytest.mark.parametrize("signal, bad", [(-100, 0), (0, 0), (1, 1), (-101, 1), (-999, 0), (None, 0), (-998, 1)])
def test_invalid_signal(spark, signal, bad):
    df = spark.createDataFrame([(signal,)], "signal_strength int")
    assert value(quality.as_metric(df, quality.invalid_signal_strength())) == bad


def test_row_metrics(spark):
    df = spark.createDataFrame(
        [("ENTRY", "x", T0), ("LOITER", " ", datetime(2100, 1, 1)), (None, None, datetime(2099, 12, 31))],
        "direction string, badge_id string, event_timestamp timestamp_ntz",
    )
    got = df.agg(
        quality.null_count("badge_id"), quality.blank_count("badge_id"), quality.row_count(),
        quality.invalid_direction(), quality.future_timestamps(),
        quality.freshness("event_timestamp", datetime(2100, 1, 1, 0, 0, 9)),
    ).first()
    assert tuple(got) == (1, 1, 3, 1, 1, 9)


def test_orphans_ignore_null_keys(spark):
    facts = spark.createDataFrame(
        [(1, 1), (1, 9), (9, 1), (9, 9), (None, 1), (None, 9), (None, None)], "user_key long, zone_key long"
    )
    users = spark.createDataFrame([(1,), (1,)], "user_key long")
    zones = spark.createDataFrame([(1,)], "zone_key long")
    assert value(quality.orphaned_fact_records(facts, users, zones)) == 4


@pytest.mark.parametrize(
    "op, threshold, got, violated",
    [("=", 0, 0, False), ("=", 0, 1, True), ("<", 5, 5, True), ("<", 5, 4, False), ("<=", 300, 300, False),
     ("<=", 300, 301, True), (">=", 1000, 999, True), (">=", 1000, 1000, False), (">", 0, 0, True), (">", 0, 1, False)],
)
def test_expectations(spark, op, threshold, got, violated):
    measures = spark.createDataFrame([("M", "c", got)], "data_metric_name string, column_names string, value long")
    rules = spark.createDataFrame([("M", "c", "rule", op, threshold)],
                                  "data_metric_name string, column_names string, expectation string, op string, threshold long")
    assert quality.evaluate(measures, rules).first().expectation_violations == (["rule"] if violated else [])


def test_metric_without_rule_never_violates(spark):
    df = spark.createDataFrame([(1,)], "user_key long")
    judged = quality.evaluate(quality.measure(df, [quality.Check("ROW_COUNT")], T0)).first()
    assert (judged.value, judged.expectation_violations) == (1, [])


def test_own_metric(spark):
    quality.register_metric("NEGATIVE_COUNT", lambda c: F.count_if(F.col(c) < 0))
    df = spark.createDataFrame([(-1,), (2,)], "x int")
    check = quality.Check("NEGATIVE_COUNT", ("x",), "no_negatives", "=", 0)
    log = quality.run_suite(df, [check], T0, "D", "S", "T")
    assert quality.violations(log, "D").first().expectation_violations == ["no_negatives"]


def test_suite_reads_the_table_once_for_row_metrics(spark, tmp_path):
    spark.range(10).selectExpr("cast(id as string) signal_quality").write.parquet(str(tmp_path / "t"))
    log = quality.run_suite(spark.read.parquet(str(tmp_path / "t")), quality.STAGING_CHECKS, T0, "D", "S", "T")
    assert log._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_views(spark):
    rows = [
        (T0, "D", "S", "T", "A", "", 1, ["x"], "M", "COMPLETED"),
        (T0 - timedelta(minutes=6), "D", "S", "T", "A", "", 1, ["x"], "M", "COMPLETED"),
        (T0 - timedelta(days=8), "D", "S", "T", "A", "", 1, [], "M", "COMPLETED"),
        (T0, "D", "S", "T", "B", "", 0, [], "M", "COMPLETED"),
        (T0, "OTHER", "S", "T", "B", "", 0, ["x"], "M", "COMPLETED"),
    ]
    log = spark.createDataFrame(
        rows,
        "measurement_time timestamp_ntz, table_database string, table_schema string, table_name string, "
        "data_metric_name string, column_names string, value long, expectation_violations array<string>, "
        "schedule_type string, status string",
    )
    assert quality.dashboard(log, "D").count() == 4
    assert quality.violations(log, "D").count() == 2
    score = quality.quality_scores(log, "D", T0).first()
    assert (score.full_table_name, score.total_measurements, score.passed_checks, score.quality_score_pct) == ("D.S.T", 3, 1, 33.33)
    trend = {r.measurement_hour: r.violation_count for r in quality.violation_trends(log, "D", T0).collect()}
    assert trend == {T0: 1, T0 - timedelta(hours=1): 1}
    assert quality.alert_rows(log, "D", T0).count() == 1


def test_what_cannot_be_judged_does_not_pass(spark):
    with pytest.raises(ValueError):
        quality.Check("ROW_COUNT", (), "x", "!!", 0)
    with pytest.raises(ValueError):
        quality.Check("ROW_COUNT", (), "x", "=", None)
    columns = "data_metric_name string, column_names string, value long, expectation string, op string, threshold long"
    rows = [("a", "", None, "null value", "<=", 300), ("b", "", 5, "differs", "<>", 5), ("c", "", 5, None, None, None), ("d", "", 4, "ok", "<>", 5)]
    judged = quality.evaluate(spark.createDataFrame(rows, columns))
    got = {r.data_metric_name: list(r.expectation_violations) for r in judged.collect()}
    assert got == {"a": ["null value"], "b": ["differs"], "c": [], "d": []}
    with pytest.raises(Exception, match="unknown comparator"):
        quality.evaluate(spark.createDataFrame([("e", "", 5, "typo", "=<", 5)], columns)).collect()


def test_alerts_are_appended_once(spark, tmp_path):
    path = str(tmp_path / "alerts")
    empty = spark.createDataFrame([], "ingestion_time timestamp_ntz")
    checks = [quality.Check("FRESHNESS", ("ingestion_time",), "fresh_data", "<=", 300)]
    log = quality.run_suite(empty, checks, T0, "D", "S", "T")
    for minutes in (0, 2, 4):
        quality.append_alerts(log, "D", path, T0 + timedelta(minutes=minutes))
    rows = spark.read.parquet(path).collect()
    assert [(r.table_name, r.value, list(r.expectation_violations)) for r in rows] == [("T", None, ["fresh_data"])]
