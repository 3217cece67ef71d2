"""The incremental pipeline: lines -> landing -> staging -> dimensions and facts.

Each step may be run again after a crash. Landing and staging rely on streaming
checkpoints; new users and facts are appended only where an anti-join finds them
missing, so a half-finished append is completed, not repeated.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions.times import as_time
from ..operators import analytics, dimensions, facts
from ..operators.joins import heavy_keys
from ..operators.key_filter import BLOCKS, KEY_FILTER_SCHEMA, key_filter, merged, possibly_loaded
from ..schemas import (
    FACT_SCHEMA,
    RUN_LOG_SCHEMA,
    STAGING_SCHEMA,
    USER_SCHEMA,
    ZONE_SCHEMA,
)
from ..session import file_system, work_dir
from ..sources.landing import read_events, read_landed
from .consume import STAGE_LOG_SCHEMA, stage_changes
from .ingest import INGEST_BATCH_LOG_SCHEMA, land_raw, log_landed

PIPE = "BADGE_EVENTS_PIPE"
LOAD_LOG_SCHEMA = (
    "load_id long, last_batch_id long, max_zone_key long, rows_loaded long, max_event_key long,"
    " loaded_at timestamp_ntz"
)
# Rows of zones that are not known yet lie in buckets by zone: a new zone reads its own.
WAITING_BUCKETS = 64
WAITING_SCHEMA = STAGING_SCHEMA.replace("_batch_id long", "load_id long")
LATENCY_SCHEMA = "v long, n long"
# A pointer says where a table's rows are. ``whole``: here and nowhere before; else these
# are rows added by a load, of which the newest pointer counts (a load may be run again).
_POINTER_SCHEMA = "name string, version long, folder string, whole boolean, load_id long"
USER_CHANGES_SCHEMA = "user_id string, changed_at timestamp_ntz, " + ", ".join(
    f"{name} string" for name in dimensions.TRACKED
)
_LOGS = ("log/ingest", "log/stage", "log/load", "log/run")
_SWAPPED = ("dim_users", "dim_zones", "fct", "fct_keys", *_LOGS)
_TABLES = [
    ("stg", STAGING_SCHEMA, "_batch_id"),
    ("fct", FACT_SCHEMA, "event_date"),
    ("fct_keys", KEY_FILTER_SCHEMA, "event_date"),
    ("log/stage", STAGE_LOG_SCHEMA, None),
    ("log/load", LOAD_LOG_SCHEMA, None),
    ("log/ingest", INGEST_BATCH_LOG_SCHEMA, None),
    ("log/run", RUN_LOG_SCHEMA, None),
    ("log/current", _POINTER_SCHEMA, None),
]


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class Store:
    """Where the pipeline keeps its tables, on storage all executors reach."""

    spark: SparkSession
    root: str
    # Blocks of the key filters of a date; the same for the whole life of a store.
    key_blocks: int = BLOCKS
    # The pointers as they were, of a store that is pinned to a moment.
    known: tuple | None = None

    def pinned(self) -> Store:
        """The store as it is now: what a job reads and appends to, looked up once."""
        return replace(self, known=tuple(self._pointers().collect()))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _table(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.folder(name))

    def folder(self, name: str) -> str:
        """Where a table's rows are now: as the newest pointer says, if there is one."""
        now = (self.folders([name]) if name in _SWAPPED else []) or [self.path(name)]
        return now[-1]

    def _pointers(self) -> DataFrame:
        return self.spark.read.schema(_POINTER_SCHEMA).parquet(self.path("log/current"))

    def folders(self, names: list[str]) -> list[str]:
        """Where the rows of tables are that grow by added folders: those that the newest
        whole pointer of each and the later added ones name, one for each load."""
        found = []
        rows = self._pointers().filter(F.col("name").isin(names)).collect() if self.known is None else self.known
        for name in names:
            own = [r for r in rows if r.name == name]
            base = max((r for r in own if r.whole), key=lambda r: r.version, default=None)
            added = {}
            for r in sorted(own, key=lambda r: r.version):
                if not r.whole and (base is None or r.version > base.version):
                    added[r.load_id] = r.folder
            found += [base.folder] if base and base.folder else []
            found += added.values()
        return [self.path(folder) for folder in found]

    def point(self, pointers: list[tuple[str, str | None]], whole: bool, load_id: int = 0) -> None:
        """Point to the folders of tables (name, folder), all at once: one file."""
        if not pointers:
            return
        version = self._pointers().agg(F.coalesce(F.max("version"), F.lit(0))).first()[0] + 1
        self.append("log/current", [(name, version, folder, whole, load_id) for name, folder in pointers], _POINTER_SCHEMA)

    def swap(self, name: str, write) -> None:
        """Write a table to a new folder, then point to it.

        Readers see the old rows until the pointer is there. A crash before that leaves a
        folder that nothing points to, and the job may be run again.
        """
        folder = f"{name}-{uuid.uuid4().hex}"
        write(self.path(folder))
        self.point([(name, folder)], whole=True)

    def _read_folders(self, names: list[str], schema: str) -> DataFrame:
        folders = self.folders(names) if names else []
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def raw(self) -> DataFrame:
        return read_landed(self.spark, self.path("raw"))

    def staged(self) -> DataFrame:
        return self._table("stg", STAGING_SCHEMA)

    def staged_batches(self, batches: list[int]) -> DataFrame:
        """Only these batches, read by their folders: no other is listed."""
        folders = [f"{self.path('stg')}/_batch_id={b}" for b in batches]
        if not folders:
            return self.spark.createDataFrame([], STAGING_SCHEMA)
        reader = self.spark.read.schema(STAGING_SCHEMA).option("basePath", self.path("stg"))
        return reader.parquet(*folders)

    def unread(self) -> int:
        """Landed rows that staging has not read, from the two logs."""
        landed = self.ingest_log().agg(F.coalesce(F.sum("rows_inserted"), F.lit(0))).first()[0]
        return landed - self.stage_log().agg(F.coalesce(F.sum("rows_read"), F.lit(0))).first()[0]

    def users(self) -> DataFrame:
        return self._table("dim_users", USER_SCHEMA)

    def user_changes(self) -> DataFrame:
        """All changes of users that were ever applied, the first versions included."""
        return self.spark.read.schema(USER_CHANGES_SCHEMA).parquet(self.path("user_changes"))

    def zones(self) -> DataFrame:
        return self._table("dim_zones", ZONE_SCHEMA)

    def facts(self) -> DataFrame:
        return self._table("fct", FACT_SCHEMA)

    def waiting(self, buckets: list[int] | None = None) -> DataFrame:
        """Rows of zones that were unknown when they came, of all buckets or some."""
        names = [_bucket_name(b) for b in (range(WAITING_BUCKETS) if buckets is None else buckets)]
        return self._read_folders(names, WAITING_SCHEMA)

    def latencies(self) -> DataFrame:
        """How often each latency (seconds from landing to fact) occurs: v, n."""
        return self._read_folders(["latency"], LATENCY_SCHEMA).groupBy("v").agg(F.sum("n").alias("n"))

    def key_filters(self) -> DataFrame:
        return self._table("fct_keys", KEY_FILTER_SCHEMA)

    def marks(self) -> DataFrame:
        """(layer, written_at, n): what each run wrote to each layer, from the logs."""
        written = [
            ("RAW", self.ingest_log(), "server_timestamp", "rows_inserted"),
            ("STAGING", self.stage_log(), "staged_at", "rows_staged"),
            ("ANALYTICS", self.load_log(), "loaded_at", "rows_loaded"),
        ]
        rows = None
        for layer, log, at, n in written:
            own = log.filter(F.col(n) > 0).select(F.lit(layer).alias("layer"), F.col(at).alias("written_at"), F.col(n).alias("n"))
            rows = own if rows is None else rows.unionByName(own)
        return rows

    def stage_log(self) -> DataFrame:
        return self._table("log/stage", STAGE_LOG_SCHEMA)

    def load_log(self) -> DataFrame:
        return self._table("log/load", LOAD_LOG_SCHEMA)

    def ingest_log(self) -> DataFrame:
        return self._table("log/ingest", INGEST_BATCH_LOG_SCHEMA)

    def run_log(self) -> DataFrame:
        return self._table("log/run", RUN_LOG_SCHEMA)

    def append(self, name: str, rows: list[tuple], schema: str) -> None:
        """Append a few log rows as one file."""
        if rows:
            self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(
                self.folder(name)
            )


def _bucket_name(bucket: int) -> str:
    return f"stg_waiting/{bucket}"


def _bucket(zone: Column) -> Column:
    return F.pmod(F.xxhash64(zone), F.lit(WAITING_BUCKETS)).cast("int")


def create(spark: SparkSession, root: str, users: DataFrame, zones: DataFrame) -> Store:
    """A new store with its first dimension members and all other tables empty."""
    store = Store(spark, root)
    for name, schema, partition in _TABLES:
        empty = spark.createDataFrame([], schema).write
        (empty.partitionBy(partition) if partition else empty).parquet(store.path(name))
    dimensions.conform(users, USER_SCHEMA).write.parquet(store.path("dim_users"))
    dimensions.conform(zones, ZONE_SCHEMA).write.parquet(store.path("dim_zones"))
    dimensions.change_points(store.users()).write.parquet(store.path("user_changes"))
    return store


def add_zones(store: Store, members: DataFrame) -> None:
    """Append zones that are new by zone_id."""
    known = store.zones()
    grown = dimensions.add_missing_members(
        known, dimensions.conform(members, ZONE_SCHEMA), "zone_id", "zone_key"
    )
    last = dimensions.max_key(known, "zone_key")
    grown.filter(F.col("zone_key") > last).write.mode("append").parquet(store.folder("dim_zones"))


def apply_user_changes(store: Store, changes: DataFrame, as_of=None) -> None:
    """New versions of changed users, in a new folder that then takes the old one's place."""
    stamp = _utc_now() if as_of is None else as_of
    _log_changes(store, changes.withColumn("changed_at", as_time(stamp)))
    versions = dimensions.scd2_apply(store.users(), changes, stamp)
    store.swap("dim_users", lambda path: versions.write.parquet(path))


def apply_dated_changes(store: Store, changes: DataFrame, as_of=None) -> None:
    """Versions of the users concerned made anew from all their changes, whenever they
    came: ``changes`` says by ``changed_at`` since when each holds.

    The changes are logged first; a crash before the versions are swapped in leaves the
    old ones, and the same changes may be given again.
    """
    stamp = _utc_now() if as_of is None else as_of
    _log_changes(store, changes)
    versions = dimensions.scd2_rebuild(store.users(), changes, stamp, store.user_changes())
    store.swap("dim_users", lambda path: versions.write.parquet(path))


def _log_changes(store: Store, changes: DataFrame) -> None:
    rows = dimensions.conform(changes, USER_CHANGES_SCHEMA)
    rows.write.mode("append").parquet(store.path("user_changes"))


def compact_facts(store: Store, rows_per_file: int = 1_000_000, by_badge: bool = False) -> None:
    """The fact in as few files as its rows need, in a new folder that takes its place;
    ``by_badge`` so that one badge's rows lie in few places of a date."""
    store.swap("fct", lambda path: facts.compact(store.facts(), path, rows_per_file, by_badge))


def compact_logs(store: Store) -> None:
    """Each log as one file; a run adds one, so they are many after a month of minutes.

    The filters of the fact's keys and the latencies are merged as well: a row a date and
    block, and one a latency, instead of those of every load.
    """
    for name, schema, _ in _TABLES:
        if name in _LOGS:
            rows = store._table(name, schema)
            store.swap(name, lambda path: rows.coalesce(1).write.parquet(path))
    store.swap("fct_keys", lambda path: merged(store.key_filters()).write.partitionBy("event_date").parquet(path))
    store.swap("latency", lambda path: store.latencies().coalesce(1).write.parquet(path))


def compact_waiting(store: Store) -> None:
    """All waiting rows in one folder, without those whose zone has come and been loaded."""
    _rewrite_waiting(store, list(range(WAITING_BUCKETS)))


def _rewrite_waiting(store: Store, buckets: list[int]) -> None:
    """These buckets anew, without the rows of zones that the loads have seen."""
    seen = store.load_log().agg(F.coalesce(F.max("max_zone_key"), F.lit(0))).scalar()
    known = store.zones().filter(F.col("zone_key") <= seen).select("zone_id")
    rest = store.waiting(buckets).join(known, "zone_id", "left_anti")
    filled = _write_buckets(store, rest)
    empty = {_bucket_name(b) for b in buckets} - {name for name, _ in filled}
    store.point(filled + [(name, None) for name in sorted(empty)], whole=True)


def _write_buckets(store: Store, rows: DataFrame) -> list[tuple[str, str]]:
    """Rows by bucket in a new folder; the names of the buckets that got any, and where."""
    folder = f"stg_waiting-{uuid.uuid4().hex}"
    placed = rows.withColumn("zone_bucket", _bucket(F.col("zone_id")))
    placed.hint("rebalance", "zone_bucket").write.partitionBy("zone_bucket").parquet(store.path(folder))
    written = store.spark.read.schema(WAITING_SCHEMA + ", zone_bucket int").parquet(store.path(folder))
    filled = sorted(r.zone_bucket for r in written.select("zone_bucket").distinct().collect())  # at most WAITING_BUCKETS
    return [(_bucket_name(b), f"{folder}/zone_bucket={b}") for b in filled]


def vacuum(store: Store, names: tuple[str, ...] = ("dim_users", "dim_zones", "fct", "fct_keys", "latency", "stg_waiting", *_LOGS)) -> list[str]:
    """Delete the folders of swapped tables that no pointer needs any more; their names.

    Only what has been pointed to and then replaced, or never was pointed to: not while
    another job writes to or reads an old state of the store.
    """
    live = {store.folder(name) for name in _SWAPPED}
    live |= set(store.folders(["latency", *map(_bucket_name, range(WAITING_BUCKETS))]))
    deleted = []
    for name in names:
        files, parent = file_system(store.spark, store.path(name).rpartition("/")[0])
        last = name.rpartition("/")[2]
        for entry in files.listStatus(parent):
            folder = entry.getPath().getName()
            path = f"{store.path(name).rpartition('/')[0]}/{folder}"
            made = folder == last or re.fullmatch(rf"{re.escape(last)}-[0-9a-f]{{32}}", folder)
            if made and not any(at == path or at.startswith(f"{path}/") for at in live):
                files.delete(entry.getPath(), True)
                deleted.append(folder)
    return deleted


def ingest(
    store: Store, source: str, channel: str = "CH-0", max_files: int | None = None, ingestion_time=None
) -> None:
    """Land every file not read before and log each micro-batch.

    The log is made from the landing table by a stream of its own: what a crash kept from
    being logged is logged by the next run, and nothing twice.
    """
    lines = read_events(store.spark, source, max_files=max_files)
    query = land_raw(lines, store.path("raw"), store.path("checkpoint/ingest"), ingestion_time)
    query.awaitTermination()
    log_landed(
        store.spark, store.path("raw"), store.folder("log/ingest"), store.path("checkpoint/ingest_log"), channel, PIPE
    )


def stage(store: Store, max_files: int | None = None, staging_time=None) -> None:
    stage_changes(
        store.spark,
        store.path("raw"),
        store.path("stg"),
        store.folder("log/stage"),
        store.path("checkpoint/stage"),
        max_files,
        staging_time,
    )


def process_badge_events(store: Store, load_time=None) -> int:
    """Unknown members first, then facts, for what staging gained; rows loaded.

    Reads the batches after the last finished load, the buckets of rows that waited for a
    zone added since then, and of the fact those times at which the key filters cannot
    rule out a row that is there already. A row of an unknown zone is stored once, by the
    load that first met it, and leaves when its zone has come. Without either there is
    nothing to read or write.
    """
    store = store.pinned()
    done = store.load_log().agg(
        F.coalesce(F.max("load_id"), F.lit(0)).alias("load_id"),
        F.coalesce(F.max("last_batch_id"), F.lit(-1)).alias("batch"),
        F.coalesce(F.max("max_zone_key"), F.lit(0)).alias("zone"),
        F.coalesce(F.max("max_event_key"), F.lit(0)).alias("key"),
    ).first()
    entries = store.stage_log().filter((F.col("_batch_id") > done["batch"]) & (F.col("rows_read") > 0))
    batches = sorted({r["_batch_id"] for r in entries.select("_batch_id").collect()})
    zones = store.zones()
    came = zones.filter(F.col("zone_key") > done["zone"])
    news = came.agg(F.max("zone_key").alias("last"), F.collect_set(_bucket(F.col("zone_id"))).alias("buckets")).first()
    last_zone = done["zone"] if news["last"] is None else news["last"]
    if not batches and last_zone <= done["zone"]:
        return 0
    opened = [b for b in news["buckets"] if store.folders([_bucket_name(b)])]
    fresh = store.staged_batches(batches).drop("_batch_id")
    waited = store.waiting(opened).drop("load_id")
    released = waited.join(came.select("zone_id"), "zone_id", "left_semi") if opened else waited
    load_id = done["load_id"] + 1

    # One pass over the batch tells its users, its days and who holds very many rows.
    scratch = work_dir(store.spark, "profile")
    facts.profile(fresh.unionByName(released), zones).write.parquet(scratch)
    profile = store.spark.read.parquet(scratch)
    members = dimensions.new_members(profile, store.users(), load_time)
    members.write.mode("append").parquet(store.folder("dim_users"))

    placed = fresh.join(zones.select("zone_id"), "zone_id", "left_semi").unionByName(released)
    can_load = profile.filter("placed")
    rows, top, gained = 0, done["key"], []
    spans = facts.spans_of_days(facts.days_of(can_load))
    if spans:
        loaded, taken = known_facts(store, placed, spans, load_id)
        hot = heavy_keys(can_load, "user_id")
        new = facts.fact_load(placed, store.users(), zones, loaded, load_time, hot_users=hot)
        written = Observation()
        facts.write_facts(new, store.folder("fct"), max(top, taken) + 1, written=written)
        rows, top = written.get["rows"], max(top, taken, written.get["key"])
        # All keys after the last finished load: also what an unfinished one has written.
        unlogged = facts.touching(store.facts(), spans).filter(F.col("event_key") > done["key"])
        folder = f"latency-{uuid.uuid4().hex}"
        analytics.latency_counts(unlogged).coalesce(1).write.parquet(store.path(folder))
        gained.append(("latency", folder))
    if batches and not profile.filter("NOT placed").isEmpty():
        waits = facts.unplaced(fresh, zones).withColumn("load_id", F.lit(load_id).cast("long"))
        gained += _write_buckets(store, waits)
    store.point(gained, whole=False, load_id=load_id)
    newest = batches[-1] if batches else done["batch"]
    row = (load_id, newest, last_zone, rows, top, _utc_now())
    store.append("log/load", [row], LOAD_LOG_SCHEMA)
    if opened:
        _rewrite_waiting(replace(store, known=None), opened)
    return rows


def known_facts(store: Store, placed: DataFrame, spans: list[tuple], load_id: int) -> tuple[DataFrame | None, int]:
    """The part of the fact that may hold some of the batch already, if any, and its
    highest key; then the batch's own keys go into the filters.

    The filters come before the rows: whatever crashes, a row that is in the fact has its
    key in a filter.
    """
    dates = facts.dates_within(F.col("event_date"), spans)
    suspects = possibly_loaded(placed, store.key_filters().filter(dates), store.key_blocks)
    again = facts.spans_of_days(facts.days_between(suspects))
    filters = key_filter(placed, load_id, store.key_blocks)
    filters.write.mode("append").partitionBy("event_date").parquet(store.folder("fct_keys"))
    if not again:
        return None, 0
    loaded = facts.touching(store.facts(), again)
    # Keys of an unfinished earlier attempt lie in the same spans.
    return loaded, loaded.agg(F.coalesce(F.max("event_key"), F.lit(0))).first()[0]


def logged(store: Store, name: str, job) -> object:
    """Run a job and append its outcome to the run log."""
    started = _utc_now()
    try:
        result = job()
    except Exception as error:
        row = (name, "FAILED", started, _utc_now(), type(error).__name__, str(error))
        store.append("log/run", [row], RUN_LOG_SCHEMA)
        raise
    store.append("log/run", [(name, "SUCCEEDED", started, _utc_now(), None, None)], RUN_LOG_SCHEMA)
    return result


def run_once(store: Store, source: str, max_files: int | None = None) -> int:
    """One incremental run of the whole chain; staging runs only if rows are unread."""
    ingest(store, source, max_files=max_files)
    if store.unread():
        logged(store, "raw_to_staging_task", lambda: stage(store))
    return logged(store, "staging_to_analytics_task", lambda: process_badge_events(store))
