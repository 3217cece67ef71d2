"""User and zone dimensions: seeds, unknown members, versions, masking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.times import as_time, now
from ..schemas import SEED_USERS, SEED_ZONES, USER_SCHEMA, ZONE_SCHEMA

# Fixed values for members first seen in an event.
UNKNOWN = "UNKNOWN"
PUBLIC = "PUBLIC"

TRACKED = ("user_name", "user_type", "department", "email", "phone", "clearance_level")


def conform(df: DataFrame, schema: str) -> DataFrame:
    """Select the columns of a DDL schema, NULL where ``df`` lacks one."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in T.StructType.fromDDL(schema)
        ]
    )


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few fixed rows, held in the plan itself."""
    fields = T.StructType.fromDDL(schema).fields
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def dense_key(df: DataFrame, natural_key: str, key: str, start: Column, parts: int | None = None) -> DataFrame:
    """Number rows start+1, start+2, ... by a rule of the data alone.

    Rows are ranked inside 4096 hash buckets of the natural key and each bucket
    is shifted by the sizes of those before it, so no task sees all rows and a
    retried task gives the same numbers. ``parts`` is the number of tasks that rank them.
    """
    bucket = F.substring(F.md5(F.col(natural_key)), 1, 3)
    rows = df.withColumn("_bucket", bucket)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    ranked = Window.partitionBy("_bucket").orderBy(natural_key)
    return (
        _spread(rows, parts, "_bucket").withColumn("_rank", F.row_number().over(ranked))
        .join(F.broadcast(offsets), "_bucket")  # at most 4096 rows
        .withColumn(key, (start + F.col("_before") + F.col("_rank")).cast("long"))
        .drop("_bucket", "_rank", "_before")
    )


# Rows of a dimension or its changes for one task, which sorts them several times.
ROWS_PER_TASK = 250_000


def tasks_for(*frames: DataFrame | None) -> int:
    """Tasks that hold all rows of some frames; stored tables know their number of rows."""
    return -(-sum(df.count() for df in frames if df is not None) // ROWS_PER_TASK)


def _spread(df: DataFrame, parts: int | None, key: str) -> DataFrame:
    """``df`` dealt by ``key`` to at least so many tasks; left as it is without a number.

    Up to the session's own number of partitions adaptive execution may merge them.
    """
    if parts is None:
        return df
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, key) if parts > usual else df.repartition(key)


def max_key(dim: DataFrame, key: str) -> Column:
    return dim.agg(F.coalesce(F.max(key), F.lit(0))).scalar()


# -- seeds ------------------------------------------------------------------


def seed_users(spark: SparkSession, as_of=None) -> DataFrame:
    stamp = now() if as_of is None else as_time(as_of)
    names = "user_id string, user_name string, user_type string, department string, clearance_level string"
    seeds = literal_rows(spark, SEED_USERS, names)
    return conform(with_user_defaults(seeds, stamp), USER_SCHEMA)


def seed_zones(spark: SparkSession, as_of=None) -> DataFrame:
    stamp = now() if as_of is None else as_time(as_of)
    names = (
        "zone_id string, reader_id string, building_name string, floor_number int, "
        "zone_name string, zone_type string, capacity long, requires_clearance string, "
        "is_restricted boolean, reader_location string, reader_type string"
    )
    seeds = literal_rows(spark, SEED_ZONES, names).withColumns(
        {
            "is_monitored": F.lit(True),
            "created_timestamp": stamp,
            "updated_timestamp": stamp,
        }
    )
    return conform(seeds, ZONE_SCHEMA)


def add_missing_members(dim: DataFrame, members: DataFrame, natural_key: str, key: str) -> DataFrame:
    """``dim`` plus the members whose natural key it lacks, newly numbered."""
    missing = members.drop(key).join(dim.select(natural_key), natural_key, "left_anti")
    numbered = dense_key(missing, natural_key, key, max_key(dim, key))
    return dim.unionByName(numbered, allowMissingColumns=True)


def with_user_defaults(users: DataFrame, stamp: Column) -> DataFrame:
    return users.withColumns(
        {
            "is_active": F.lit(True),
            "is_current": F.lit(True),
            "effective_start_date": stamp,
            "effective_end_date": F.lit(None).cast("timestamp_ntz"),
            "created_timestamp": stamp,
            "updated_timestamp": stamp,
        }
    )


# -- members first seen in events -------------------------------------------


def users_current(users: DataFrame) -> DataFrame:
    return users.filter(F.col("is_current"))


def unknown_users(events: DataFrame, users: DataFrame) -> DataFrame:
    """Distinct event users without a current dimension row."""
    return (
        events.select("user_id")
        .distinct()
        .join(users_current(users).select("user_id"), "user_id", "left_anti")
        .select(
            "user_id",
            F.lit(UNKNOWN).alias("user_name"),
            F.lit(UNKNOWN).alias("user_type"),
            F.lit(UNKNOWN).alias("department"),
            F.lit(PUBLIC).alias("clearance_level"),
        )
    )


def new_members(events: DataFrame, users: DataFrame, as_of=None) -> DataFrame:
    """Dimension rows, keys included, for the unknown users of ``events``."""
    stamp = now() if as_of is None else as_time(as_of)
    fresh = with_user_defaults(unknown_users(events, users), stamp)
    return conform(dense_key(fresh, "user_id", "user_key", max_key(users, "user_key")), USER_SCHEMA)


def upsert_unknown_users(events: DataFrame, users: DataFrame, as_of=None) -> DataFrame:
    """Insert-if-missing: the dimension with every event user in it."""
    return users.unionByName(new_members(events, users, as_of))


def orphaned_users(events: DataFrame, users: DataFrame) -> DataFrame:
    """Events per user id that has no current dimension row."""
    return (
        events.groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("orphaned_records"))
        .join(users_current(users).select("user_id"), "user_id", "left_anti")
    )


# -- versions ----------------------------------------------------------------


def scd2_apply(users: DataFrame, changes: DataFrame, as_of, tracked=TRACKED) -> DataFrame:
    """Close changed current rows at ``as_of`` and add their new versions.

    Of several rows of one user_id in ``changes`` the one with the greatest attributes
    counts, so there is one new version at most. Rows equal to the current version
    (NULLs equal) add nothing; unknown ids are inserted.
    """
    stamp = as_time(as_of)
    incoming = (
        changes.groupBy("user_id").agg(F.max(F.struct(*tracked)).alias("_new")).select("user_id", "_new.*")
    )
    now_current = users_current(users).select(
        "user_id", F.struct(*tracked).alias("_now"), F.col("created_timestamp").alias("_created")
    )
    versions = (
        incoming.join(now_current, "user_id", "left")
        .filter(~F.struct(*tracked).eqNullSafe(F.col("_now")))
        .withColumn("_created", F.coalesce("_created", stamp))
        .drop("_now")
    )
    fresh = (
        with_user_defaults(versions, stamp)
        .withColumn("created_timestamp", F.col("_created"))
        .drop("_created")
    )
    added = conform(dense_key(fresh, "user_id", "user_key", max_key(users, "user_key")), USER_SCHEMA)
    closing = F.col("is_current") & F.coalesce("_changed", F.lit(False))
    kept = (
        users.join(versions.select("user_id", F.lit(True).alias("_changed")), "user_id", "left")
        .withColumn("_closing", closing)
        .withColumns(
            {
                "effective_end_date": F.when(F.col("_closing"), stamp).otherwise(
                    F.col("effective_end_date")
                ),
                "updated_timestamp": F.when(F.col("_closing"), stamp).otherwise(
                    F.col("updated_timestamp")
                ),
                "is_current": F.col("is_current") & ~F.col("_closing"),
            }
        )
        .select(*users.columns)
    )
    return kept.unionByName(added)


def valid_at(when: Column) -> Column:
    """Version in force at a time: start <= time < end, or still open."""
    end = F.col("effective_end_date")
    return (F.col("effective_start_date") <= when) & (end.isNull() | (end > when))


def users_as_of(users: DataFrame, when) -> DataFrame:
    return users.filter(valid_at(as_time(when)))


def events_with_user_version(
    events: DataFrame, users: DataFrame, hot_users: DataFrame | None = None
) -> DataFrame:
    """Each event with the user version in force at its event time.

    Events and version starts are put in one order per user, and each event takes the
    last version before it: one sorted pass, whatever the number of versions. Users with
    very many events (``hot_users``) are cut by calendar day, and the version in force
    when a day begins is carried into it. The versions of a user do not overlap; events
    without one in force are left out.
    """
    carried, started, event = 0, 1, 2  # the order of rows of the same time
    version = F.struct("user_key", "user_name", "clearance_level", "effective_end_date")
    starts = users.filter(
        F.col("effective_end_date").isNull() | (F.col("effective_end_date") > F.col("effective_start_date"))
    ).select("user_id", F.col("effective_start_date").alias("_at"), version.alias("_version"))
    rows = events.select(
        "user_id", F.col("event_timestamp").alias("_at"), F.struct(*events.columns).alias("_event")
    ).withColumn("_kind", F.lit(event))
    points = starts.withColumn("_kind", F.lit(started))
    if hot_users is None:
        both = rows.unionByName(points, allowMissingColumns=True).withColumn("_day", F.lit(None).cast("date"))
    else:
        flagged = F.broadcast(hot_users.select("user_id", F.lit(True).alias("_hot")))  # bounded by its share
        cut = F.when(F.col("_hot"), F.to_date("_at"))
        rows = rows.join(flagged, "user_id", "left").withColumn("_day", cut).drop("_hot")
        points = points.join(flagged, "user_id", "left").withColumn("_day", cut).drop("_hot")
        both = rows.unionByName(points, allowMissingColumns=True).unionByName(
            _carried_in(rows, points, carried), allowMissingColumns=True
        )
    before = (
        Window.partitionBy("user_id", "_day")
        .orderBy("_at", "_kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = both.withColumn("_found", F.last("_version", ignorenulls=True).over(before)).filter(F.col("_kind") == event)
    end = F.col("_found.effective_end_date")
    in_force = F.col("_found").isNotNull() & (end.isNull() | (end > F.col("_at")))
    return found.filter(in_force).select(
        "_event.*", *[F.col(f"_found.{c}").alias(c) for c in ("user_key", "user_name", "clearance_level")]
    )


def _carried_in(rows: DataFrame, points: DataFrame, kind: int) -> DataFrame:
    """For each day of a user who is cut by days, the last version that began before it."""
    days = rows.filter("_day IS NOT NULL").select("user_id", "_day").distinct()
    last = points.filter("_day IS NOT NULL").groupBy("user_id", "_day").agg(F.max_by("_version", "_at").alias("_last"))
    earlier = (
        Window.partitionBy("user_id").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        days.join(last, ["user_id", "_day"], "full")
        .withColumn("_version", F.last("_last", ignorenulls=True).over(earlier))
        .filter("_version IS NOT NULL")
        .select("user_id", "_day", F.col("_day").cast("timestamp_ntz").alias("_at"), "_version", F.lit(kind).alias("_kind"))
    )


# -- versions from dated changes ----------------------------------------------


def change_points(users: DataFrame, tracked=TRACKED) -> DataFrame:
    """(user_id, changed_at, tracked attributes): what the versions say was changed when.

    Members that were only seen in events say nothing about the user.
    """
    return users.filter(~_placeholder()).select("user_id", F.col("effective_start_date").alias("changed_at"), *tracked)


def _placeholder() -> Column:
    return (F.col("user_name") == UNKNOWN) & (F.col("user_type") == UNKNOWN) & (F.col("department") == UNKNOWN)


def versions_of_changes(changes: DataFrame, tracked=TRACKED, also: tuple[str, ...] = ()) -> DataFrame:
    """(user_id, tracked, effective_start_date, effective_end_date) from all changes of
    some users: neighbours with equal attributes are one version, each lasts until the
    next, and the order in which changes came does not matter.

    Of changes of one user at one time the one with the greatest attributes counts, and
    the greatest of each column in ``also``.
    """
    order = Window.partitionBy("user_id").orderBy("changed_at")
    picked = changes.filter("user_id IS NOT NULL AND changed_at IS NOT NULL").groupBy("user_id", "changed_at").agg(
        F.max(F.struct(*tracked)).alias("_new"), *[F.max(c).alias(c) for c in also]
    )
    before = F.lag("_new").over(order)
    islands = picked.withColumn("_before", before).filter(F.col("_before").isNull() | ~F.col("_new").eqNullSafe(F.col("_before")))
    return islands.withColumn("effective_end_date", F.lead("changed_at").over(order)).select(
        "user_id", "_new.*", *also, F.col("changed_at").alias("effective_start_date"), "effective_end_date"
    )


def scd2_rebuild(users: DataFrame, changes: DataFrame, as_of, log: DataFrame | None = None, tracked=TRACKED) -> DataFrame:
    """The dimension after dated ``changes`` (user_id, changed_at, tracked), in any order.

    The versions of the users concerned are made anew from all their changes: those of
    ``log``, those that the dimension itself shows, and the new ones. A late change so
    splits a version that was closed long ago. ``log`` is what was applied before, with the
    ``change_points`` of the first versions; without it, changes that were merged into an
    equal neighbour are forgotten, and a later one between the two would not end where
    they did. A version that begins when one did before keeps its key; the key of an
    unknown member goes to the version that was in force when it was added.

    Rows are counted first, so that the number of tasks follows them; all changes of a
    user, with the keys of the versions that began then, meet in one of them.
    """
    stamp = as_time(as_of)
    parts = tasks_for(users, changes, log)
    ids = _spread(changes.select("user_id"), parts, "user_id").distinct()
    old = users.join(ids, "user_id", "left_semi")
    own = F.struct("user_key", "created_timestamp", "effective_end_date", "updated_timestamp")
    history = old.filter(~_placeholder()).select(
        "user_id", F.col("effective_start_date").alias("changed_at"), *tracked, own.alias("_own")
    )
    if log is not None:
        earlier = log.select("user_id", "changed_at", *tracked).join(ids, "user_id", "left_semi")
        history = history.unionByName(earlier, allowMissingColumns=True)
    points = history.unionByName(changes.select("user_id", "changed_at", *tracked), allowMissingColumns=True)
    versions = versions_of_changes(_spread(points, parts, "user_id"), tracked, ("_own",))
    seen = old.filter(_placeholder()).select(
        "user_id", F.col("effective_start_date").alias("_seen"), F.struct("user_key", "created_timestamp").alias("_first")
    )
    end = F.col("effective_end_date")
    placed = versions.join(seen, "user_id", "left")
    inside = (F.col("effective_start_date") <= F.col("_seen")) & (end.isNull() | (end > F.col("_seen")))
    # An unknown member older than all that is known of the user becomes the first version.
    oldest = F.col("effective_start_date") == F.min("effective_start_date").over(Window.partitionBy("user_id"))
    takes = inside | (oldest & (F.col("_seen") < F.col("effective_start_date")))
    unchanged = F.col("_own").isNotNull() & F.col("_own.effective_end_date").eqNullSafe(end)
    made = (
        placed.withColumn("_kept", F.coalesce("_own.user_key", F.when(takes, F.col("_first.user_key"))))
        .withColumns(
            {
                "is_active": F.lit(True),
                "is_current": end.isNull(),
                "created_timestamp": F.coalesce("_own.created_timestamp", F.when(takes, F.col("_first.created_timestamp")), stamp),
                "updated_timestamp": F.when(unchanged, F.col("_own.updated_timestamp")).otherwise(stamp),
                "_version": F.concat_ws(" ", "user_id", F.col("effective_start_date").cast("string")),
            }
        )
    )
    keyed = made.filter("_kept IS NOT NULL").withColumn("user_key", F.col("_kept"))
    fresh = dense_key(made.filter("_kept IS NULL"), "_version", "user_key", max_key(users, "user_key"), parts)
    rest = conform(users.join(ids, "user_id", "left_anti"), USER_SCHEMA)
    return rest.unionByName(conform(keyed, USER_SCHEMA)).unionByName(conform(fresh, USER_SCHEMA))


# -- masking -----------------------------------------------------------------

MASK = "***@***"


def mask_pii(
    users: DataFrame, role: str, privileged: tuple[str, ...] = ("ADMIN",), columns=("email",)
) -> DataFrame:
    """Replace personal columns unless the role may see them."""
    if role in privileged:
        return users
    return users.withColumns({c: F.lit(MASK) for c in columns})
