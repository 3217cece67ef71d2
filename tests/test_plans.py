"""What the plans must look like to hold at scale."""

import pytest

from badgeflow.operators import analytics, monitoring
from badgeflow.plans.registry import QUERIES
from badgeflow.plans.warehouse import warehouse

# These run whole jobs (streams, rewrites) while the frame is built.
EAGER = {"ingest_stream", "stream_dedup", "cdc_incremental", "pipeline_end_to_end", "fact_compact", "hourly_rollup", "stream_alerts", "dq_run", "dq_alert_log"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in EAGER])
def test_no_pairwise_joins_and_no_python(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert banned not in plan


def test_date_range_prunes_partitions(spark, sf_dir):
    plan = plan_of(analytics.events_in_range(warehouse(spark, sf_dir).facts, "2024-01-10", "2024-01-12"))
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_reports_read_only_their_columns(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    plan = plan_of(analytics.top_zones(wh.facts, wh.zones))
    assert "ReadSchema: struct<zone_key:bigint>" in plan


def test_recent_window_prunes_landing(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    plan = plan_of(monitoring.ingestion_metrics(wh.raw, "2024-01-20 12:00:00"))
    assert "ingest_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(ingestion_time" in plan


def test_zone_counts_are_aggregated_before_the_join(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    plan = plan_of(analytics.top_zones(wh.facts, wh.zones))
    scan = plan.index("ReadSchema: struct<zone_key:bigint>")
    join = plan.index("Join [zone_key")
    assert "partial_count(1)" in plan[join:scan]


def test_log_windows_read_the_days_they_need(spark, sf_dir):
    for name in ("channel_status", "ingest_error_rate", "task_success_rate", "dq_violation_trends"):
        plan = plan_of(QUERIES[name](spark, sf_dir))
        assert any("log_date" in part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:]), name
