"""The star schema of a data folder, written once and read by the reports.

Reports run on stored layers, as they would in production: date partitions prune
and only the needed columns are read. Each layer and log is stored when a report first
reads it, with those it is made from and no others.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, functions as F

from ..functions.times import trunc_minute
from ..operators import analytics, dimensions, facts, monitoring, staging
from ..session import file_system, shared_dir
from ..sources import derived


def next_minute(ts: Column) -> Column:
    return trunc_minute(ts) + F.expr("INTERVAL 1 MINUTE")


def staged_rows(raw: DataFrame) -> DataFrame:
    """Staging as a run at the next full minute would write it."""
    return staging.raw_to_staging(raw, next_minute(F.col("ingestion_time")))


def loaded_facts(staged: DataFrame, users: DataFrame, zones: DataFrame, **kwargs) -> DataFrame:
    """Facts as a load one minute after staging would write them."""
    load_time = F.col("staging_time") + F.expr("INTERVAL 1 MINUTE")
    return facts.fact_load(staged, users, zones, load_time=load_time, **kwargs)


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    sf_dir: str
    root: str

    def _complete(self, name: str) -> list[str]:
        """The folders of a part that were written to their end."""
        store, marks = file_system(self.spark, f"{self.root}/{name}/*/_SUCCESS")
        return sorted(mark.getPath().getParent().toString() for mark in store.globStatus(marks) or ())

    def stored(self, name: str) -> str:
        """The folder of a part, which is written first if nobody has.

        It counts once its write is committed, so a half-written one is never read. Of
        two written at the same time the one with the smaller name serves.
        """
        if not self._complete(name):
            PARTS[name](self).parquet(f"{self.root}/{name}/{uuid.uuid4().hex}")
        return self._complete(name)[0]

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.stored(name))

    @property
    def raw(self) -> DataFrame:
        return self._read("raw")

    @property
    def staged(self) -> DataFrame:
        return self._read("stg")

    @property
    def users(self) -> DataFrame:
        return self._read("dim_users")

    @property
    def zones(self) -> DataFrame:
        return self._read("dim_zones")

    @property
    def facts(self) -> DataFrame:
        return self._read("fct")

    @property
    def layers(self) -> dict[str, DataFrame]:
        return {
            "RAW_BADGE_EVENTS": self.raw,
            "STG_BADGE_EVENTS": self.staged,
            "FCT_ACCESS_EVENTS": self.facts,
        }

    def log(self, name: str) -> DataFrame:
        """An operational log (ingest, run or dq) by ``log_date``."""
        return self._read(f"log/{name}")

    @property
    def write_marks(self) -> DataFrame:
        """What each run wrote to each layer, by ``layer`` and ``mark_date``."""
        return self._read("write_marks")

    @property
    def latencies(self) -> DataFrame:
        """How often each latency occurs in the fact."""
        return self._read("latencies")

    def mark(self, name: str) -> Column:
        """A newest time, noted once."""
        return self._read(f"marks/{name}").select(name).scalar()

    def as_of(self) -> Column:
        """Five minutes after the last arrival."""
        return self.mark("arrival") + F.expr("INTERVAL 5 MINUTES")

    def last_event(self) -> Column:
        return self.mark("event")


def _raw(wh: Warehouse) -> DataFrameWriter:
    raw = derived.raw_rows(wh.spark, wh.sf_dir).withColumn("ingest_date", F.to_date("ingestion_time"))
    return raw.hint("rebalance", "ingest_date").write.partitionBy("ingest_date")


def _users(wh: Warehouse) -> DataFrameWriter:
    enrolled = derived.users(wh.spark, wh.sf_dir)
    return dimensions.upsert_unknown_users(wh.staged, enrolled, wh.mark("arrival")).write


def _facts(wh: Warehouse) -> DataFrameWriter:
    return facts.facts_writer(loaded_facts(wh.staged, wh.users, wh.zones))


def _write_marks(wh: Warehouse) -> DataFrameWriter:
    noted = (
        monitoring.write_marks(wh.raw, "RAW", "ingestion_time")
        .unionByName(monitoring.write_marks(wh.staged, "STAGING", "staging_time"))
        .unionByName(monitoring.write_marks(wh.facts, "ANALYTICS", "fact_load_time"))
    )
    return noted.hint("rebalance", "layer", "mark_date").write.partitionBy("layer", "mark_date")


def _log(rows: DataFrame, ts: str) -> DataFrameWriter:
    dated = rows.withColumn("log_date", F.to_date(ts)).hint("rebalance", "log_date")
    return dated.write.partitionBy("log_date")


def _mark(rows: DataFrame, ts: str, name: str) -> DataFrameWriter:
    return rows.agg(F.max(ts).alias(name)).write


# How each part is written; a part reads the others that it needs.
PARTS: dict[str, Callable[[Warehouse], DataFrameWriter]] = {
    "raw": _raw,
    "stg": lambda wh: staged_rows(wh.raw).write,
    "dim_zones": lambda wh: derived.zones(wh.spark, wh.sf_dir).write,
    "dim_users": _users,
    "fct": _facts,
    "latencies": lambda wh: analytics.latency_counts(wh.facts).write,
    "write_marks": _write_marks,
    "log/ingest": lambda wh: _log(derived.ingest_log(wh.spark, wh.sf_dir), "server_timestamp"),
    "log/run": lambda wh: _log(derived.run_log(wh.spark, wh.sf_dir), "scheduled_time"),
    "log/dq": lambda wh: _log(derived.dq_results(wh.raw, wh.staged), "measurement_time"),
    "marks/arrival": lambda wh: _mark(wh.raw, "ingestion_time", "arrival"),
    "marks/event": lambda wh: _mark(wh.facts, "event_timestamp", "event"),
    "marks/line": lambda wh: _mark(derived.lines(wh.spark, wh.sf_dir), "received_at", "line"),
    "marks/measurement": lambda wh: _mark(wh.log("dq"), "measurement_time", "measurement"),
}


def build(wh: Warehouse) -> None:
    """Write all that is not stored yet."""
    for name in PARTS:
        wh.stored(name)


# To be raised with every change of what is stored, so that older layers are left alone.
LAYOUT = 4
BUILT_FROM = ("events", "customer", "orders", "nation", "region")


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse of ``sf_dir``: one for all applications that share a folder.

    It is known by its input, so a changed table leads to a new one.
    """
    known = hashlib.sha1(
        repr([LAYOUT] + [derived.stamp(spark, f"{sf_dir}/{name}.parquet") for name in BUILT_FROM]).encode()
    ).hexdigest()
    return Warehouse(spark, sf_dir, f"{shared_dir(spark)}/badgeflow/warehouse-{known}")
