"""Alerts of a stream are those of the batch rules, however the scans are cut into batches."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from badgeflow.streaming import alerts

T0 = datetime(2024, 1, 1)
SCANS = "badge_id string, user_id string, event_timestamp timestamp_ntz"


@pytest.fixture
def session(spark):
    own = spark.newSession()
    alerts.state_settings(own)
    own.conf.set("spark.sql.shuffle.partitions", "2")
    return own


def scans(n, start=0):
    """Scans of a few badges and users; every third one comes again a little later."""
    rows = []
    for i in range(start, start + n):
        rows.append((f"B{i % 11}", f"U{i % 2}", T0 + timedelta(seconds=i)))
        if i % 3 == 0 and i >= 20:
            rows.append((f"B{(i - 20) % 11}", f"U{i % 2}", T0 + timedelta(seconds=i - 20)))
    return rows


def run(session, root, name, build, per_batch):
    stream = session.readStream.schema(SCANS).option("maxFilesPerTrigger", per_batch).parquet(f"{root}/raw")
    query = alerts.write_alerts(build(stream), f"{root}/{name}", f"{root}/checkpoint-{name}")
    query.awaitTermination()
    rows = session.read.schema("alert string, subject string, at timestamp_ntz").parquet(f"{root}/{name}").collect()
    return sorted((r.subject, r.at) for r in rows), query


def test_same_alerts_for_any_batching_and_after_a_restart(spark, session, tmp_path):
    rows = scans(90)
    frame = spark.createDataFrame(rows + [(None, None, T0), ("B1", "U1", None)], SCANS)
    again = frame.filter("badge_id IS NOT NULL AND event_timestamp IS NOT NULL").groupBy("badge_id", "event_timestamp").count().filter("count > 1")
    want = sorted((r.badge_id, r.event_timestamp) for r in again.collect())
    assert len(want) > 15
    root = str(tmp_path)
    for part in (rows[:40], rows[40:41], rows[41:] + [(None, None, T0), ("B1", "U1", None)]):
        spark.createDataFrame(part, SCANS).coalesce(1).write.mode("append").parquet(f"{root}/raw")
        run(session, root, "again", alerts.repeated_keys, 1)  # stopped and begun again each time
    assert run(session, root, "again", alerts.repeated_keys, 1)[0] == want
    assert run(session, root, "once", alerts.repeated_keys, 10)[0] == want
    busy = lambda stream: alerts.busy_users(stream, more_than=50)
    users = frame.filter("event_timestamp IS NOT NULL AND user_id IS NOT NULL").groupBy("user_id", F.hour("event_timestamp")).count().filter("count > 50")
    assert run(session, root, "busy", busy, 1)[0] == [(u, T0) for u in sorted(r.user_id for r in users.collect())] != []


def test_state_goes_when_its_time_is_over(spark, session, tmp_path):
    root = str(tmp_path)
    held = []
    for hour in (0, 5, 10):
        rows = [(b, u, at + timedelta(hours=hour)) for b, u, at in scans(40)]
        spark.createDataFrame(rows, SCANS).coalesce(1).write.mode("append").parquet(f"{root}/raw")
        found, query = run(session, root, "again", alerts.repeated_keys, 1)
        held.append(query.lastProgress.stateOperators[0].numRowsTotal)
    assert len(found) == 3 * len({(s, a) for s, a in found if a < T0 + timedelta(hours=1)})
    # The keys of the last five hours, not those of all three deliveries.
    assert held[2] < 3 * held[0]


def test_a_key_over_its_limit_is_told_once(spark, session, tmp_path):
    """Scans that go on after the alert, hours between them, and a batch with nothing new."""
    root, user = str(tmp_path), [("B1", "U1", T0)] * 3
    deliveries = [user, user + [("B2", "U1", T0)], [("B3", "U2", T0 + timedelta(days=1))], [("B3", "U2", T0 + timedelta(days=1))] * 2]
    found = []
    for part in deliveries:
        spark.createDataFrame(part, SCANS).coalesce(1).write.mode("append").parquet(f"{root}/raw")
        found.append(run(session, root, "both", lambda stream: alerts.scan_alerts(stream, more_than=2), 1)[0])
    assert found[0] == found[1] == found[2] == [("B1", T0), ("U1", T0)]
    assert found[3] == sorted(found[0] + [("B3", T0 + timedelta(days=1)), ("U2", T0 + timedelta(days=1))])


def test_state_is_kept_without_python_calls(spark, tmp_path):
    """The state of millions of keys is kept by Spark itself, not by a call a key."""
    spark.createDataFrame(scans(10), SCANS).coalesce(1).write.parquet(f"{tmp_path}/raw")
    stream = spark.readStream.schema(SCANS).parquet(f"{tmp_path}/raw")
    plan = alerts.scan_alerts(stream)._jdf.queryExecution().analyzed().toString()
    assert "Aggregate" in plan and "Python" not in plan and "Pandas" not in plan
