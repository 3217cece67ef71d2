from datetime import datetime

from pyspark.sql import functions as F

from badgeflow.operators import dimensions as dims
from badgeflow.schemas import USER_SCHEMA

START = datetime(2024, 1, 1)
CHANGE = datetime(2024, 2, 1)
CHANGES = "user_id string, user_name string, user_type string, department string, email string, phone string, clearance_level string"


def users(spark, *rows):
    """rows: (key, id, name, department)"""
    return spark.createDataFrame(
        [
            (k, i, n, "EMPLOYEE", d, None, None, "PUBLIC", True, START, None, True, START, START)
            for k, i, n, d in rows
        ],
        USER_SCHEMA,
    )


def events(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "user_id string")


def test_seeds(spark):
    seeds = dims.seed_users(spark, START).orderBy("user_id").collect()
    assert [s.user_id for s in seeds] == [f"USR-00{i}" for i in range(1, 6)]
    assert all(s.is_active and s.is_current and s.effective_end_date is None for s in seeds)
    zones = {z.zone_id: z for z in dims.seed_zones(spark, START).collect()}
    assert zones["ZONE-SERVER-B1"].floor_number == -1
    assert zones["ZONE-SERVER-B1"].is_restricted and not zones["ZONE-LOBBY-1"].is_restricted
    assert all(z.is_monitored for z in zones.values())


def test_seeding_twice_adds_nothing(spark):
    once = dims.add_missing_members(users(spark, (1, "X", "x", "d")), dims.seed_users(spark), "user_id", "user_key")
    twice = dims.add_missing_members(once, dims.seed_users(spark), "user_id", "user_key")
    assert once.count() == twice.count() == 6
    assert sorted(r.user_key for r in once.collect()) == [1, 2, 3, 4, 5, 6]


def test_dense_key_is_dense_and_repeatable(spark):
    df = spark.range(5000).selectExpr("concat('U', id) user_id")
    a = dims.dense_key(df.repartition(7), "user_id", "k", F.lit(100))
    b = dims.dense_key(df.repartition(3), "user_id", "k", F.lit(100))
    keys = {r.user_id: r.k for r in a.collect()}
    assert sorted(keys.values()) == list(range(101, 5101))
    assert keys == {r.user_id: r.k for r in b.collect()}


def test_unknown_members(spark):
    dim = users(spark, (7, "U1", "Ann", "HR"))
    grown = dims.upsert_unknown_users(events(spark, "U1", "U2", "U2", "U3"), dim, CHANGE)
    added = {r.user_id: r for r in grown.filter("user_name = 'UNKNOWN'").collect()}
    assert set(added) == {"U2", "U3"} and {r.user_key for r in added.values()} == {8, 9}
    assert all(r.clearance_level == "PUBLIC" and r.is_current for r in added.values())
    again = dims.upsert_unknown_users(events(spark, "U1", "U2", "U3"), grown, CHANGE)
    assert again.count() == 3


def test_orphans_are_counted_per_user(spark):
    dim = users(spark, (7, "U1", "Ann", "HR"))
    got = dims.orphaned_users(events(spark, "U1", "U2", "U2"), dim).collect()
    assert [(r.user_id, r.orphaned_records) for r in got] == [("U2", 2)]


def change(i, name, dept):
    return (i, name, "EMPLOYEE", dept, None, None, "PUBLIC")


def test_scd2(spark):
    dim = users(spark, (1, "U1", "Ann", "HR"), (2, "U2", "Bob", None), (3, "U3", "Cy", "IT"))
    incoming = spark.createDataFrame(
        [change("U1", "Ann", "IT"), change("U2", "Bob", None), change("U9", "New", "HR")], CHANGES
    )
    got = dims.scd2_apply(dim, incoming, CHANGE)
    history = {(r.user_id, r.is_current): r for r in got.collect()}
    assert got.count() == 5
    assert history["U1", False].effective_end_date == CHANGE
    assert history["U1", True].department == "IT"
    assert history["U1", True].effective_start_date == CHANGE
    assert history["U1", True].created_timestamp == START
    assert ("U2", False) not in history, "NULL equals NULL"
    assert history["U9", True].user_key > 3
    assert {r.user_key for r in got.collect()} == {1, 2, 3, 4, 5}
    assert dims.scd2_apply(got, incoming, CHANGE).count() == 5, "applying again adds nothing"


def test_point_in_time(spark):
    dim = users(spark, (1, "U1", "Ann", "HR"))
    got = dims.scd2_apply(dim, spark.createDataFrame([change("U1", "Ann", "IT")], CHANGES), CHANGE)
    assert dims.users_as_of(got, datetime(2024, 1, 31)).first().department == "HR"
    assert dims.users_as_of(got, CHANGE).first().department == "IT"
    assert dims.users_as_of(got, datetime(2023, 1, 1)).count() == 0
    scans = spark.createDataFrame(
        [("U1", datetime(2024, 1, 10)), ("U1", datetime(2024, 2, 10))],
        "user_id string, event_timestamp timestamp_ntz",
    )
    versions = dims.events_with_user_version(scans, got).orderBy("event_timestamp").collect()
    assert [r.user_key for r in versions] == [1, 2]


def test_masking(spark):
    dim = users(spark, (1, "U1", "Ann", "HR")).withColumn("email", F.lit("ann@example.com"))
    assert dims.mask_pii(dim, "ANALYST").first().email == "***@***"
    assert dims.mask_pii(dim, "ADMIN").first().email == "ann@example.com"
    both = dims.mask_pii(dim, "ANALYST", columns=("email", "user_name")).first()
    assert both.user_name == "***@***"


def test_two_changes_of_one_user_make_one_version(spark):
    users = dims.conform(
        spark.createDataFrame([(1, "U1", "PUBLIC", True)], "user_key long, user_id string, clearance_level string, is_current boolean"),
        USER_SCHEMA,
    )
    rows = [("U1", level, *[None] * (len(dims.TRACKED) - 1)) for level in ("SECRET", "CONFIDENTIAL")]
    order = ["clearance_level", *[c for c in dims.TRACKED if c != "clearance_level"]]
    changes = spark.createDataFrame(rows, "user_id string, " + ", ".join(f"{c} string" for c in order))
    got = dims.scd2_apply(users, changes, "2024-01-16 00:00:00")
    assert sorted(r.is_current for r in got.collect()) == [False, True]
