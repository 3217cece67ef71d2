"""The incremental pipeline: same rows in one or many batches, and after crashes."""

import json
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from badgeflow.operators import dimensions
from badgeflow.schemas import USER_SCHEMA, ZONE_SCHEMA
from badgeflow.sources import landing
from badgeflow.streaming import consume, ingest, pipeline

T0 = datetime(2024, 1, 5, 10)


def line(badge, user, zone, minute=0, **extra):
    return json.dumps(
        {
            "badge_id": badge, "user_id": user, "zone_id": zone, "reader_id": "R1",
            "event_timestamp": (T0 + timedelta(minutes=minute)).isoformat(),
            "signal_strength": -50, "direction": "ENTRY",
        }
        | extra
    )


def deliver(store, *lines):
    store.spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode(
        "append"
    ).text(store.path("lines"))


@pytest.fixture
def store(spark, tmp_path):
    users = spark.createDataFrame([(1, "U1", "Ann")], "user_key long, user_id string, user_name string")
    users = dimensions.conform(
        users.withColumns({"is_current": F.lit(True), "effective_start_date": F.lit(T0).cast("timestamp_ntz")}),
        USER_SCHEMA,
    )
    zones = dimensions.conform(
        spark.createDataFrame([(1, "Z1", False)], "zone_key long, zone_id string, is_restricted boolean"), ZONE_SCHEMA
    )
    return pipeline.create(spark, str(tmp_path / "store"), users, zones)


def badges(store):
    return sorted(r.badge_id for r in store.facts().collect())


def test_incremental_runs(store):
    deliver(store, line("B1", "U1", "Z1"), line("B2", "U2", "Z1"), "garbage")
    assert pipeline.run_once(store, store.path("lines")) == 2
    deliver(store, line("B3", "U2", "Z1"), line("B1", "U1", "Z1"))
    assert pipeline.run_once(store, store.path("lines")) == 1
    assert pipeline.run_once(store, store.path("lines")) == 0
    assert badges(store) == ["B1", "B2", "B3"]
    keys = [r.event_key for r in store.facts().collect()]
    assert len(set(keys)) == 3
    users = {r.user_id: r.user_name for r in store.users().collect()}
    assert users == {"U1": "Ann", "U2": "UNKNOWN"}
    log = store.ingest_log().agg(F.sum("rows_parsed"), F.sum("rows_inserted"), F.sum("rows_error_count"), F.max("last_error_message")).first()
    assert tuple(log) == (5, 4, 1, "line is not a JSON object")
    assert {r.state for r in store.run_log().collect()} == {"SUCCEEDED"}
    assert store.stage_log().agg(F.sum("rows_read")).first()[0] == 4


def test_rejects_are_kept(store, spark):
    deliver(store, line("B1", "U1", "Z1"), "garbage", line("B2", None, "Z1"))
    pipeline.ingest(store, store.path("lines"))
    assert store.raw().count() == 1
    reasons = {r.raw_json[:7]: r.reject_reasons for r in landing.read_rejects(spark, store.path("raw")).collect()}
    assert reasons["garbage"] == ["line is not a JSON object"]
    assert ["user_id is missing"] in reasons.values()


def test_one_batch_or_many_give_the_same_facts(spark, store, tmp_path):
    lines = [line(f"B{i % 7}", f"U{i % 3}", "Z1", minute=i % 11) for i in range(60)]
    for i in range(0, 60, 10):
        deliver(store, *lines[i : i + 10])
    pipeline.ingest(store, store.path("lines"), max_files=1)
    pipeline.stage(store, max_files=2)
    pipeline.process_badge_events(store)
    many = {(r.badge_id, r.event_timestamp) for r in store.facts().collect()}
    assert store.facts().count() == len(many)
    expected = {(f"B{i % 7}", T0 + timedelta(minutes=i % 11)) for i in range(60)}
    assert many == expected
    assert store.stage_log().count() > 1


def test_late_zone_loads_once_it_exists(store, spark):
    deliver(store, line("B1", "U1", "Z1"), line("B2", "U1", "Z2"))
    assert pipeline.run_once(store, store.path("lines")) == 1
    assert store.waiting().count() == 1
    pipeline.add_zones(store, spark.createDataFrame([("Z2", "Attic", "B")], "zone_id string, zone_name string, building_name string"))
    pipeline.add_zones(store, spark.createDataFrame([("Z2", "Attic", "B")], "zone_id string, zone_name string, building_name string"))
    assert store.zones().count() == 2
    assert pipeline.run_once(store, store.path("lines")) == 1
    assert pipeline.run_once(store, store.path("lines")) == 0
    assert badges(store) == ["B1", "B2"]


def test_replayed_batch_replaces_its_partition(spark, store, tmp_path):
    deliver(store, line("B1", "U1", "Z1"), line("B1", "U1", "Z1"))
    pipeline.ingest(store, store.path("lines"))
    batch = store.raw()
    for _ in range(2):
        consume.stage_batch(batch, 5, store.path("stg"), store.path("log/stage"), T0)
    assert store.staged().count() == 1
    assert store.stage_log().collect()[0].rows_read == 2


def test_crash_before_the_load_is_logged(store, monkeypatch):
    """Users and facts are written, then the driver dies; the rerun adds only
    what is missing, under new keys."""
    deliver(store, line("B1", "U1", "Z1"), line("B2", "U2", "Z1"))
    pipeline.ingest(store, store.path("lines"))
    pipeline.stage(store)
    keep = pipeline.Store.append

    def die(self, name, rows, schema):
        if name == "log/load":
            raise RuntimeError("lost driver")
        keep(self, name, rows, schema)

    monkeypatch.setattr(pipeline.Store, "append", die)
    with pytest.raises(RuntimeError):
        pipeline.logged(store, "staging_to_analytics_task", lambda: pipeline.process_badge_events(store))
    assert [r.state for r in store.run_log().collect()] == ["FAILED"]
    monkeypatch.undo()
    deliver(store, line("B3", "U3", "Z1"))
    assert pipeline.run_once(store, store.path("lines")) == 1
    assert badges(store) == ["B1", "B2", "B3"]
    assert store.facts().select("event_key").distinct().count() == 3
    users = store.users().collect()
    assert len({u.user_key for u in users}) == len({u.user_id for u in users}) == len(users) == 3


def test_crash_while_staging_replays_the_batch(store, monkeypatch):
    deliver(store, line("B1", "U1", "Z1"), line("B2", "U1", "Z1"))
    pipeline.ingest(store, store.path("lines"))

    def die(*args):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(consume, "log_once", die)
    with pytest.raises(Exception):
        pipeline.stage(store)
    monkeypatch.undo()
    pipeline.stage(store)
    assert store.staged().count() == 2
    assert store.stage_log().agg(F.sum("rows_read")).first()[0] == 2


def test_batch_without_accepted_rows(store):
    deliver(store, "garbage")
    assert pipeline.run_once(store, store.path("lines")) == 0
    deliver(store, line("B1", "U1", "Z1"))
    assert pipeline.run_once(store, store.path("lines")) == 1


def test_streamed_hours_equal_the_batch_report(spark, tmp_path):
    """Files in any order, one a batch: late rows count, and open hours are there."""
    from badgeflow.operators import monitoring
    from badgeflow.schemas import RAW_COLUMNS
    from badgeflow.sources import derived
    from badgeflow.streaming import rollup

    raw = derived.raw_rows(spark, "/root/testdata/sf0.001").filter("ingestion_time < '2024-01-02'")
    for n in (2, 0, 1):
        part = raw.filter(F.hour("ingestion_time") % 3 == n).select(*RAW_COLUMNS)
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "raw"))
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "raw"))
    rollup.write_rollup(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    state = rollup.read_state(spark, str(tmp_path / "out"))
    report = rollup.hourly_report(state)
    got = {r.ingestion_hour: r for r in report.collect()}
    want = monitoring.ingestion_metrics(raw, datetime(2024, 1, 2)).select(*report.columns).collect()
    assert len(got) > 10 and got == {r.ingestion_hour: r for r in want}
    # A batch keeps one row of sums and two bitmaps an hour, however many scans it has.
    assert state.groupBy("_batch_id", "ingestion_hour").count().filter("count <> 3").isEmpty()
    numbers = spark.read.parquet(str(tmp_path / "out" / "numbers"))
    assert numbers.select("number").distinct().count() == numbers.select("kind", "id").distinct().count() == numbers.count()
    assert numbers.agg(F.max("number")).first()[0] == numbers.count()
    merged = rollup.merged_state(state)
    assert {r.ingestion_hour: r for r in rollup.hourly_report(merged).collect()} == got
    # A batch that is replayed changes nothing.
    rollup.add_batch(raw.filter(F.hour("ingestion_time") % 3 == 2), 0, str(tmp_path / "out"))
    again = rollup.hourly_report(rollup.read_state(spark, str(tmp_path / "out")))
    assert {r.ingestion_hour: r for r in again.collect()} == got


def test_ingest_log_survives_a_crash(store, monkeypatch):
    """Rows are landed, then the driver dies before logging: the next run logs them."""
    deliver(store, line("B1", "U1", "Z1"), "garbage")

    def die(*args):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(ingest, "ingest_log_rows", die)
    with pytest.raises(Exception, match="lost driver"):
        pipeline.ingest(store, store.path("lines"))
    assert store.raw().count() == 1 and store.ingest_log().isEmpty()
    monkeypatch.undo()
    deliver(store, line("B2", "U1", "Z1"))
    assert pipeline.run_once(store, store.path("lines")) == 2
    pipeline.ingest(store, store.path("lines"))
    rows = sorted((r.rows_parsed, r.rows_inserted, r.rows_error_count) for r in store.ingest_log().collect())
    assert rows == [(1, 1, 0), (2, 1, 1)]
    assert store.unread() == 0


def test_the_whole_error_text_is_logged(store):
    def fail():
        raise ValueError("x" * 3000)

    with pytest.raises(ValueError):
        pipeline.logged(store, "job", fail)
    assert store.run_log().first().error_message == "x" * 3000


def test_waiting_rows_are_stored_once(store, spark):
    """Rows of unknown zones on 100 days: later runs neither copy them nor read for them."""
    lines = [
        line(f"W{i}", "U1", "Z9", event_timestamp=(T0 - timedelta(days=i)).isoformat()) for i in range(100)
    ]
    deliver(store, *lines)
    assert pipeline.run_once(store, store.path("lines")) == 0
    assert store.waiting().count() == 100
    files = len(store.waiting().inputFiles())
    deliver(store, line("B1", "U1", "Z1"))
    assert pipeline.run_once(store, store.path("lines")) == 1
    loads = store.load_log().count()
    assert pipeline.run_once(store, store.path("lines")) == 0
    # Without input nothing is written, and the rows that wait are where they were.
    assert store.load_log().count() == loads
    assert store.waiting().count() == 100 and len(store.waiting().inputFiles()) == files
    pipeline.add_zones(store, spark.createDataFrame([("Z9", "Roof", "B")], "zone_id string, zone_name string, building_name string"))
    assert pipeline.run_once(store, store.path("lines")) == 100
    assert pipeline.run_once(store, store.path("lines")) == 0
    assert store.waiting().count() == 0 and len(set(badges(store))) == len(badges(store)) == 101
    assert store.facts().select("event_key").distinct().count() == 101


def test_user_versions_are_swapped_in(store, spark, monkeypatch):
    """A crash between writing and pointing leaves the old rows in force."""
    changes = store.users().select("user_id", *dimensions.TRACKED).withColumn("clearance_level", F.lit("SECRET"))
    keep = pipeline.Store.append

    def die(self, name, rows, schema):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(pipeline.Store, "append", die)
    with pytest.raises(RuntimeError):
        pipeline.apply_user_changes(store, changes, T0)
    assert store.users().count() == 1
    monkeypatch.setattr(pipeline.Store, "append", keep)
    pipeline.apply_user_changes(store, changes, T0)
    pipeline.apply_user_changes(store, changes, T0)
    assert {(r.clearance_level, r.is_current) for r in store.users().collect()} == {(None, False), ("SECRET", True)}
    assert store.users().count() == 2
    deliver(store, line("B1", "U1", "Z1"), line("B2", "U2", "Z1"))
    assert pipeline.run_once(store, store.path("lines")) == 2
    current = {r.user_id: r.user_key for r in store.users().collect() if r.is_current}
    assert {r.badge_id: r.user_key for r in store.facts().collect()} == {"B1": current["U1"], "B2": current["U2"]}


def test_compacted_facts_take_their_place(store):
    for i in range(3):
        deliver(store, line(f"B{i}", "U1", "Z1"))
        pipeline.run_once(store, store.path("lines"))
    before, files = sorted(map(str, store.facts().collect())), len(store.facts().inputFiles())
    pipeline.compact_facts(store)
    assert sorted(map(str, store.facts().collect())) == before
    assert len(store.facts().inputFiles()) == 1 < files
    deliver(store, line("B9", "U1", "Z1"), line("B1", "U1", "Z1"))
    assert pipeline.run_once(store, store.path("lines")) == 1
    assert badges(store) == ["B0", "B1", "B2", "B9"]


def test_compacted_logs_go_on(store):
    for i in range(2):
        deliver(store, line(f"B{i}", "U1", "Z1"))
        pipeline.run_once(store, store.path("lines"))
    logs = lambda: [store.ingest_log(), store.load_log(), store.run_log(), store.stage_log()]
    before = [sorted(map(str, log.collect())) for log in logs()]
    pipeline.compact_logs(store)
    assert [sorted(map(str, log.collect())) for log in logs()] == before
    assert [len(log.inputFiles()) for log in logs()] == [1, 1, 1, 1]
    deliver(store, line("B9", "U1", "Z1"))
    assert pipeline.run_once(store, store.path("lines")) == 1
    assert [log.count() for log in logs()] == [3, 3, 6, 3]


def zone(store, *names):
    rows = [(name, name, "B") for name in names]
    pipeline.add_zones(store, store.spark.createDataFrame(rows, "zone_id string, zone_name string, building_name string"))


def test_clock_set_back_between_deliveries(store):
    """Rows whose arrival time is not after the newest logged one are logged and staged."""
    source = store.path("lines")
    for n, at in enumerate((T0, T0 - timedelta(minutes=1), T0)):
        deliver(store, line(f"B{n}", "U1", "Z1"), line(f"C{n}", "U1", "Z1"))
        pipeline.ingest(store, source, ingestion_time=at)
        assert store.ingest_log().agg(F.sum("rows_inserted")).first()[0] == store.raw().count() == 2 * n + 2
        assert store.unread() == 2
        assert pipeline.run_once(store, source) == 2
        assert store.unread() == 0
    assert store.stage_log().agg(F.sum("rows_read")).first()[0] == 6


def test_a_new_zone_reads_its_bucket(store):
    names = [f"X{i}" for i in range(12)]
    for badge in "WV":
        deliver(store, *[line(f"{badge}{i}", "U1", name) for i, name in enumerate(names)])
        pipeline.run_once(store, store.path("lines"))
    assert store.waiting().count() == 24
    first = store.spark.range(1).select(pipeline._bucket(F.lit("X3"))).first()[0]
    files = store.waiting([first]).inputFiles()
    assert 0 < len(files) < len(store.waiting().inputFiles()) and all(f"/zone_bucket={first}/" in f for f in files)
    others = {f for f in store.waiting().inputFiles() if f"/zone_bucket={first}/" not in f}
    zone(store, "X3")
    assert pipeline.process_badge_events(store) == 2
    assert store.waiting().count() == 22 and store.waiting().filter("zone_id = 'X3'").isEmpty()
    # The other buckets were not touched.
    assert others <= set(store.waiting().inputFiles())
    pipeline.compact_waiting(store)
    assert store.waiting().count() == 22
    zone(store, *names)
    assert pipeline.process_badge_events(store) == 22
    assert store.waiting().count() == 0 and len(badges(store)) == 24


def test_crash_after_waiting_rows_are_written(store, monkeypatch):
    """The rerun writes them again; they count once, and load once."""
    deliver(store, line("W1", "U1", "Z9"), line("B1", "U1", "Z1"))
    pipeline.ingest(store, store.path("lines"))
    pipeline.stage(store)
    keep = pipeline.Store.append

    def die(self, name, rows, schema):
        if name == "log/load":
            raise RuntimeError("lost driver")
        keep(self, name, rows, schema)

    monkeypatch.setattr(pipeline.Store, "append", die)
    with pytest.raises(RuntimeError):
        pipeline.process_badge_events(store)
    monkeypatch.undo()
    assert pipeline.process_badge_events(store) == 0  # B1 is there already
    assert store.waiting().count() == 1 and badges(store) == ["B1"]
    assert store.latencies().agg(F.sum("n")).first()[0] == 1
    zone(store, "Z9")
    assert pipeline.process_badge_events(store) == 1
    assert store.waiting().count() == 0 and badges(store) == ["B1", "W1"]
    assert store.latencies().agg(F.sum("n")).first()[0] == 2


def test_delivery_without_repeats_reads_no_facts(store, monkeypatch):
    """The key filters rule out every row; with a repeat, its minutes are read."""
    asked = []
    real = pipeline.facts.fact_load

    def watched(staged, users, zones, loaded, *args, **kwargs):
        asked.append(loaded)
        return real(staged, users, zones, loaded, *args, **kwargs)

    monkeypatch.setattr(pipeline.facts, "fact_load", watched)
    deliver(store, *[line(f"B{i}", "U1", "Z1", minute=i) for i in range(50)])
    assert pipeline.run_once(store, store.path("lines")) == 50
    deliver(store, *[line(f"C{i}", "U1", "Z1", minute=i) for i in range(50)])
    assert pipeline.run_once(store, store.path("lines")) == 50
    assert asked == [None, None]
    deliver(store, line("D1", "U1", "Z1"), line("B7", "U1", "Z1", minute=7), line("C9", "U1", "Z1", minute=9))
    assert pipeline.run_once(store, store.path("lines")) == 1
    assert asked[2].count() == 6  # minutes 7 to 9, two badges each
    pipeline.compact_logs(store)
    deliver(store, line("B3", "U1", "Z1", minute=3))
    assert pipeline.run_once(store, store.path("lines")) == 0
    assert len(badges(store)) == 101


def test_false_positives_are_looked_up(store, monkeypatch):
    """Filters with all bits set rule nothing out, and the rows are right."""
    from badgeflow.operators import key_filter

    monkeypatch.setattr(key_filter, "BLOCK_BITS", 2)
    store = replace(store, key_blocks=1)
    deliver(store, *[line(f"B{i}", "U1", "Z1", minute=i) for i in range(20)])
    assert pipeline.run_once(store, store.path("lines")) == 20
    keys = store.facts().select("badge_id", "event_timestamp")
    others = keys.withColumn("badge_id", F.concat(F.lit("not "), "badge_id"))
    assert key_filter.possibly_loaded(others, store.key_filters(), 1).count() == 20
    with pytest.raises(Exception, match="not made with 2 blocks"):
        key_filter.possibly_loaded(keys, store.key_filters(), 2).count()
    deliver(store, *[line(f"B{i}", "U1", "Z1", minute=i) for i in range(10, 30)])
    assert pipeline.run_once(store, store.path("lines")) == 10
    assert len(badges(store)) == 30


def test_latencies_and_marks_add_up(store, monkeypatch):
    from badgeflow.operators import analytics, monitoring

    for n in range(2):
        deliver(store, *[line(f"B{n}-{i}", "U1", "Z1") for i in range(2 * n + 2)])
        pipeline.run_once(store, store.path("lines"))
    assert analytics.latency_report(store.latencies()).first() == analytics.ingestion_latency(store.facts()).first()
    pipeline.compact_logs(store)
    assert analytics.latency_report(store.latencies()).first() == analytics.ingestion_latency(store.facts()).first()
    rows = {r.layer: r for r in monitoring.latency_of_marks(store.marks(), ("RAW", "STAGING", "ANALYTICS"), F.localtimestamp()).collect()}
    assert {name: r.row_count for name, r in rows.items()} == {"RAW": 6, "STAGING": 6, "ANALYTICS": 6}
    assert all(r.last_update is not None for r in rows.values())


def test_vacuum_deletes_what_nothing_points_to(store):
    deliver(store, line("B1", "U1", "Z1"), line("W1", "U1", "X1"))
    pipeline.run_once(store, store.path("lines"))
    for _ in range(2):
        pipeline.compact_facts(store)
    pipeline.compact_logs(store)
    pipeline.compact_waiting(store)
    tables = lambda: [sorted(map(str, t.collect())) for t in (store.facts(), store.users(), store.waiting(), store.load_log(), store.ingest_log(), store.key_filters(), store.latencies())]
    before = tables()
    gone = pipeline.vacuum(store)
    assert "fct" in gone and any(name.startswith("fct-") for name in gone) and "load" in gone
    assert any(name.startswith("stg_waiting-") for name in gone)
    assert tables() == before and pipeline.vacuum(store) == []
    zone(store, "X1")
    assert pipeline.process_badge_events(store) == 1
