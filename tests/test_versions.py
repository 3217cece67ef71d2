"""Versions from dated changes, as-of joins over many versions, and net changes."""

import itertools
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from badgeflow.operators import dimensions as dims, snapshots
from badgeflow.schemas import USER_SCHEMA

START = datetime(2024, 1, 1)
STAMP = datetime(2025, 1, 1)
CHANGES = "user_id string, changed_at timestamp_ntz, user_name string, user_type string, department string, email string, phone string, clearance_level string"


def day(n):
    return START + timedelta(days=n)


def change(user, n, department, name="Ann"):
    return (user, day(n), name, "EMPLOYEE", department, None, None, "PUBLIC")


def version(key, user, n, department, end=None, name="Ann"):
    kind = "EMPLOYEE" if name != "UNKNOWN" else "UNKNOWN"
    end = None if end is None else day(end)
    return (key, user, name, kind, department, None, None, "PUBLIC", True, day(n), end, end is None, day(n), day(n))


def rows_of(users):
    return sorted((r.user_id, r.effective_start_date, r.effective_end_date, r.department, r.is_current) for r in users.collect())


def brute_force(points):
    """points: (user, time, department). Versions by walking through each user's changes."""
    out = []
    for user, own in itertools.groupby(sorted(points), key=lambda p: p[0]):
        picked = {}
        for _, at, department in own:
            picked[at] = max(picked.get(at, department), department)
        kept = []
        for at in sorted(picked):
            if not kept or kept[-1][1] != picked[at]:
                kept.append((at, picked[at]))
        ends = [at for at, _ in kept[1:]] + [None]
        out += [(user, at, end, department, end is None) for (at, department), end in zip(kept, ends)]
    return sorted(out)


def test_any_order_of_arrival_gives_the_same_versions(spark):
    pick = random.Random(4)
    points = [change(f"U{pick.randrange(4)}", pick.randrange(40), pick.choice("ABC")) for _ in range(60)]
    first = spark.createDataFrame([version(1, "U0", 10, "B"), version(2, "U9", 5, "C")], USER_SCHEMA)
    want = brute_force([(p[0], p[1], p[4]) for p in points] + [("U0", day(10), "B"), ("U9", day(5), "C")])
    for seed in (1, 2):
        random.Random(seed).shuffle(points)
        users, log = first, dims.change_points(first)
        for part in (points[:20], points[20:30], points[30:]):
            came = spark.createDataFrame(part, CHANGES)
            users = spark.createDataFrame(dims.scd2_rebuild(users, came, STAMP, log).collect(), USER_SCHEMA)
            log = log.unionByName(came)
        assert rows_of(users) == want
        assert users.select("user_key").distinct().count() == len(want)


def test_late_change_splits_a_closed_version(spark):
    users = spark.createDataFrame([version(1, "U1", 0, "A", 20), version(2, "U1", 20, "B"), version(7, "U2", 0, "Z")], USER_SCHEMA)
    got = dims.scd2_rebuild(users, spark.createDataFrame([change("U1", 10, "C")], CHANGES), STAMP).collect()
    keys = {(r.user_id, r.effective_start_date): r for r in got}
    assert rows_of(spark.createDataFrame(got, USER_SCHEMA)) == [
        ("U1", day(0), day(10), "A", False), ("U1", day(10), day(20), "C", False), ("U1", day(20), None, "B", True), ("U2", day(0), None, "Z", True)
    ]
    assert [keys["U1", day(n)].user_key for n in (0, 10, 20)] == [1, 8, 2]
    # Only what changed is stamped.
    assert [keys["U1", day(n)].updated_timestamp for n in (0, 10, 20)] == [STAMP, STAMP, day(20)]
    # A change to what was in force anyway merges with its neighbours.
    merged = dims.scd2_rebuild(users, spark.createDataFrame([change("U1", 10, "A"), change("U1", 25, "B")], CHANGES), STAMP)
    assert rows_of(merged) == rows_of(users)


def test_unknown_member_becomes_known(spark):
    """Its key, which facts hold, goes to the version in force when it was added."""
    users = spark.createDataFrame([version(5, "U1", 10, "UNKNOWN", name="UNKNOWN")], USER_SCHEMA)
    came = spark.createDataFrame([change("U1", 3, "A"), change("U1", 12, "B")], CHANGES)
    got = {r.effective_start_date: r.user_key for r in dims.scd2_rebuild(users, came, STAMP).collect()}
    assert got == {day(3): 5, day(12): 6}
    later = spark.createDataFrame([change("U1", 30, "A")], CHANGES)
    assert [(r.user_key, r.department) for r in dims.scd2_rebuild(users, later, STAMP).collect()] == [(5, "A")]


def test_no_changes_and_nulls(spark):
    users = spark.createDataFrame([version(1, "U1", 0, "A")], USER_SCHEMA)
    none = spark.createDataFrame([], CHANGES)
    assert dims.scd2_rebuild(users, none, STAMP).collect() == users.collect()
    odd = spark.createDataFrame([(None, day(1), *change("x", 1, "B")[2:]), ("U1", None, *change("x", 1, "B")[2:])], CHANGES)
    assert rows_of(dims.scd2_rebuild(users, odd, STAMP)) == rows_of(users)
    empty = users.limit(0)
    fresh = dims.scd2_rebuild(empty, spark.createDataFrame([change("U3", 1, "B")], CHANGES), STAMP)
    assert [(r.user_key, r.user_id) for r in fresh.collect()] == [(1, "U3")]


def as_of_by_pairs(events, users):
    """The version in force by comparing every event with every version."""
    return (
        events.alias("e")
        .join(users.alias("u"), "user_id")
        .filter("u.effective_start_date <= e.event_timestamp AND (u.effective_end_date IS NULL OR u.effective_end_date > e.event_timestamp)")
        .select("e.badge_id", "e.event_timestamp", "u.user_key")
    )


@pytest.mark.parametrize("cut", [False, True])
def test_version_in_force_at_the_event(spark, cut):
    pick = random.Random(8)
    users = []
    for user in range(5):
        starts = sorted(pick.sample(range(0, 200), pick.randrange(1, 30)))
        for n, (start, end) in enumerate(zip(starts, starts[1:] + [None])):
            gone = end if end is None or pick.random() < 0.8 else end - pick.randrange(0, end - start + 1)
            users.append((100 * user + n, f"U{user}", START + timedelta(hours=start), None if gone is None else START + timedelta(hours=gone)))
    users = spark.createDataFrame(users, "user_key long, user_id string, effective_start_date timestamp_ntz, effective_end_date timestamp_ntz")
    users = users.withColumns({"user_name": F.lit("n"), "clearance_level": F.lit("c")})
    events = [(f"B{i}", f"U{pick.randrange(6)}", START + timedelta(hours=pick.randrange(-5, 230), minutes=pick.choice((0, 0, 30)))) for i in range(600)]
    events = spark.createDataFrame(events, "badge_id string, user_id string, event_timestamp timestamp_ntz")
    hot = spark.createDataFrame([("U1",), ("U2",)], "user_id string") if cut else None
    got = dims.events_with_user_version(events, users, hot).select("badge_id", "event_timestamp", "user_key")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, as_of_by_pairs(events, users).collect()))


def test_ten_thousand_versions_of_one_user(spark):
    """Rows that the join makes are the events and the versions, not their product."""
    users = spark.range(10_000).selectExpr(
        "id AS user_key", "'U1' AS user_id", "'n' AS user_name", "'c' AS clearance_level",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, id) AS effective_start_date",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, id + 1) AS effective_end_date",
    )
    events = spark.range(20_000).selectExpr(
        "concat('B', id) AS badge_id", "'U1' AS user_id", "timestamp_ntz'2024-01-01 00:00:30' + make_dt_interval(0, 0, id % 10000) AS event_timestamp"
    )
    found = dims.events_with_user_version(events, users)
    wrong = found.filter("user_key <> CAST(substr(badge_id, 2) AS long) % 10000").count()
    assert found.count() == 20_000 and wrong == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" in plan


def feed_of(before, after):
    """Net changes by counting rows."""
    was, now = Counter(before), Counter(after)
    return Counter({("INSERT", row): n for row, n in (now - was).items()} | {("DELETE", row): n for row, n in (was - now).items()})


def test_net_changes_by_counting(spark):
    pick = random.Random(2)
    row = lambda: (pick.choice(["a", "b", "c", None]), pick.choice([1, 2, None]))
    for _ in range(3):
        before, after = [row() for _ in range(30)], [row() for _ in range(30)]
        frames = [spark.createDataFrame(rows, "k string, v long") for rows in (before, after)]
        got = snapshots.net_changes(*frames, key=("k",)).collect()
        assert Counter((r._action, (r.k, r.v)) for r in got) == feed_of(before, after)
        for k in ("a", "b", "c", None):
            own = [r for r in got if r.k == k]
            pairs = min(sum(r._action == "INSERT" for r in own), sum(r._action == "DELETE" for r in own))
            assert [sum(r._action == a and r._is_update for r in own) for a in ("INSERT", "DELETE")] == [pairs, pairs]
    same = spark.createDataFrame([("a", 1)], "k string, v long")
    assert snapshots.net_changes(same, same, ("k",)).isEmpty()


def test_tasks_follow_the_rows(spark, monkeypatch):
    """A task holds so many rows, whatever the session's number of partitions, and the
    versions are those of one task."""
    points = [change(f"U{i % 40}", i // 40, "ABC"[(i // 7) % 3]) for i in range(400)]
    first = spark.createDataFrame([version(i + 1, f"U{i}", 3, "B") for i in range(0, 40, 2)], USER_SCHEMA)
    came = spark.createDataFrame(points, CHANGES)
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    want = sorted(map(str, dims.scd2_rebuild(first, came, STAMP, dims.change_points(first)).collect()))
    monkeypatch.setattr(dims, "ROWS_PER_TASK", 10)
    got = dims.scd2_rebuild(first, came, STAMP, dims.change_points(first))
    assert sorted(map(str, got.collect())) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    parts = -(-(400 + 20 + 20) // 10)
    assert parts > usual and f"hashpartitioning(user_id" in plan
    # All that is sorted by user or ranked by bucket is dealt to as many tasks as the rows need.
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line and ", REPARTITION_BY_NUM" in line:
            assert f", {parts})" in line
    assert plan.count(f", {parts}), REPARTITION_BY_NUM") >= 3
