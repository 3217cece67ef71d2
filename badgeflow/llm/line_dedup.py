"""Incremental, reversible line dedup: sharded cuckoo filters over exact counts.

The exact tables say which lines there are, in which documents, and how often. A line
held by ``min_docs`` documents or more is frequent, and loses all its places but those
in the largest doc_id. The frequent lines' keys stand in cuckoo filters, one a shard of
the key space, which answer for nearly all lines that nothing need be looked up, and
let keys go again: documents can be deleted, and their lines' other places return.

An index lies in a folder and lasts as long as that: any application opens it, inserts
or deletes documents, and only the shards that these touch are written anew. A list of
what lies where is appended to last, so a change is there as a whole or not at all.

Fan et al., "Cuckoo Filter: Practically Better Than Bloom". False positives are
resolved by a join with the exact counts, so the result is exact.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from badgeflow.llm.common import stored, table
from badgeflow.session import work_dir

MIN_CHARS = 40
MIN_DOCS = 5
# Text for which one shard is made, where the caller does not say how many.
SHARD_BYTES = 256 << 20
# Filters up to this size go to all tasks; beyond it the lines go to their filters.
FILTER_BYTES = 64 << 20
# Tasks among which the lines of one filter are dealt then.
SALTS = 16
SPACE = " \t\n\x0b\x0c\r"
SLOTS = 4
KICKS = 500


def long_lines(text: str | None, min_chars: int) -> list[tuple[int, bytes]]:
    """(line number, 16-byte key) of the lines whose stripped form is long enough."""
    out = []
    for number, line in enumerate((text or "").split("\n")):
        if len(line) >= min_chars and len(bare := line.strip(SPACE)) >= min_chars:
            out.append((number, hashlib.blake2b(bare.encode().lower(), digest_size=16).digest()))
    return out


class Cuckoo:
    """16-bit fingerprints in buckets of four; a key has two buckets it may be in."""

    def __init__(self, data: bytes | None = None, room: int = 0):
        if data is None:
            buckets = 1 << max(0, int(np.ceil(np.log2(max(1, room) / (SLOTS * 0.9)))))
            self.table = np.zeros((buckets, SLOTS), np.uint16)
        else:
            self.table = np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """keys: (n, 2) uint64. Fingerprint, first and second bucket of each."""
        mask = np.uint64(len(self.table) - 1)
        mark = (keys[:, 1] & np.uint64(0xFFFF)).astype(np.uint16)
        mark[mark == 0] = 1
        one = (keys[:, 0] >> np.uint64(8)) & mask
        return mark, one.astype(np.int64), (one ^ self._step(mark)).astype(np.int64)

    def _step(self, mark: np.ndarray) -> np.ndarray:
        return (mark.astype(np.uint64) * np.uint64(0x5BD1E995)) & np.uint64(len(self.table) - 1)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        mark, one, two = self._places(keys)
        return ((self.table[one] == mark[:, None]) | (self.table[two] == mark[:, None])).any(axis=1)

    def add(self, keys: np.ndarray) -> bool:
        """False if no room was found; the filter is then to be built anew, larger."""
        pick = np.random.default_rng(len(self.table))
        for mark, *places in zip(*self._places(keys)):
            at = next((p for p in places if not self.table[p].all()), None)
            for _ in range(KICKS):
                if at is not None and not self.table[at].all():
                    self.table[at, int(np.argmin(self.table[at] != 0))] = mark
                    break
                at = places[0] if at is None else at
                slot = int(pick.integers(SLOTS))
                mark, self.table[at, slot] = self.table[at, slot], mark
                at = int(np.uint64(at) ^ self._step(np.array([mark]))[0])
            else:
                return False
        return True

    def remove(self, keys: np.ndarray) -> None:
        """Of keys that were added: one fingerprint each."""
        for mark, *places in zip(*self._places(keys)):
            for place in places:
                slots = np.flatnonzero(self.table[place] == mark)
                if len(slots):
                    self.table[place, slots[0]] = 0
                    break

    def data(self) -> bytes:
        return self.table.tobytes()


def key_words(keys) -> np.ndarray:
    """16-byte keys as (n, 2) uint64."""
    return np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (keys[:, 0] >> np.uint64(40)) % np.uint64(shards)


def shard_column(shards: int):
    """The shard of a key in SQL; agrees with ``shard_of``."""
    # Bytes 5 to 7 of the little-endian first word, the highest first.
    head = F.concat(*[F.hex(F.substring("key", at, 1)) for at in (8, 7, 6)])
    return (F.conv(head, 16, 10).cast("long") % shards).cast("int").alias("shard")


def numbered_rows(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text). A row is known by a digest of its id and text: rows that are
    alike lose the same lines, and rows without an id are as many as they have texts."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    return rows.select(F.unhex(F.left(F.sha2(F.encode(name, "UTF-8"), 256), F.lit(32))).alias("row"), "doc_id", "text")


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, row, doc_id): each long line of a document once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows, ids = [], [], []
            for row, doc_id, text in zip(batch[0].to_pylist(), batch[1].to_pylist(), batch[2]):
                own = dict.fromkeys(key for _, key in long_lines(text.as_py(), min_chars))
                keys += own
                rows += [row] * len(own)
                ids += [doc_id] * len(own)
            yield line_batch(keys, rows, ids)

    return numbered_rows(docs).mapInArrow(run, LINE)


LINE = "key binary, row binary, doc_id bigint"


def line_batch(keys: list[bytes], rows: list[bytes], ids: list[int | None]) -> pa.RecordBatch:
    columns = [pa.array(keys, pa.binary()), pa.array(rows, pa.binary()), pa.array(ids, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["key", "row", "doc_id"])


POSTINGS = "key binary, doc_id bigint, shard int"
COUNTS = "key binary, refs bigint, keeper bigint, shard int"
FILTERS = "data binary, shard int"
SCHEMAS = {"postings": POSTINGS, "counts": COUNTS, "filters": FILTERS}
MANIFEST = "version bigint, name string, shard int, folder string"
SETTINGS = "shards int, min_chars int, min_docs int"


@dataclass(frozen=True)
class LineIndex:
    """postings (key, doc_id), counts (key, refs, keeper) and filters (data), by shard.

    A document is a doc_id: rows that share one are one document, and rows without one
    hold no line, though they lose those that are frequent elsewhere. Every change writes
    new folders and leaves the old ones, so an index that was opened before stays as it
    was, and a job that fails can be run again from the index it began with.
    """

    spark: SparkSession
    root: str
    shards: int
    min_chars: int = MIN_CHARS
    min_docs: int = MIN_DOCS
    # (name, shard) -> folder, and the number of the last change
    places: tuple[tuple[str, int, str], ...] = ()
    version: int = 0

    @staticmethod
    def create(
        spark: SparkSession, root: str, shards: int, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
    ) -> LineIndex:
        """An empty index at ``root``, where there must be none yet."""
        settings = spark.createDataFrame([(shards, min_chars, min_docs)], SETTINGS)
        settings.coalesce(1).write.parquet(f"{root}/settings")
        spark.createDataFrame([], MANIFEST).write.parquet(f"{root}/manifest")
        return LineIndex(spark, root, shards, min_chars, min_docs)

    @staticmethod
    def open(spark: SparkSession, root: str) -> LineIndex:
        """The index at ``root`` after its last change."""
        shards, min_chars, min_docs = spark.read.schema(SETTINGS).parquet(f"{root}/settings").first()
        index = LineIndex(spark, root, shards, min_chars, min_docs)
        rows = spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
        newest = rows.groupBy("name", "shard").agg(F.max(F.struct("version", "folder")).alias("at")).collect()  # three a shard
        places = tuple(sorted((r.name, r.shard, r["at"].folder) for r in newest if r["at"].folder is not None))
        return replace(index, places=places, version=max((r["at"].version for r in newest), default=0))

    @staticmethod
    def build(
        docs: DataFrame,
        min_chars: int = MIN_CHARS,
        min_docs: int = MIN_DOCS,
        root: str | None = None,
        shards: int | None = None,
    ) -> LineIndex:
        """An index of the lines of ``docs``, at ``root`` or among the application's scratch."""
        spark = docs.sparkSession
        if shards is None:
            size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
            shards = 1 + size // SHARD_BYTES
        return LineIndex.create(spark, root or work_dir(spark, "line-index"), shards, min_chars, min_docs).insert(docs)

    def _read(self, name: str, shards: set[int] | None = None) -> DataFrame:
        """A table, of all shards or some; only their folders are listed."""
        rows = None
        found = [(shard, folder) for n, shard, folder in self.places if n == name and (shards is None or shard in shards)]
        by_folder: dict[str, list[int]] = {}
        for shard, folder in found:
            by_folder.setdefault(folder, []).append(shard)
        for folder, own in by_folder.items():
            base = f"{self.root}/{folder}/{name}"
            part = self.spark.read.schema(SCHEMAS[name]).option("basePath", base).parquet(*[f"{base}/shard={s}" for s in own])
            rows = part if rows is None else rows.unionByName(part)
        return self.spark.createDataFrame([], SCHEMAS[name]) if rows is None else rows

    @property
    def postings(self) -> DataFrame:
        return self._read("postings")

    @property
    def counts(self) -> DataFrame:
        return self._read("counts")

    @property
    def filters(self) -> DataFrame:
        return self._read("filters")

    def _own_lines(self, docs: DataFrame) -> DataFrame:
        """(shard, key, doc_id) of documents with an id, each once."""
        lines = line_keys(docs, self.min_chars).where("doc_id IS NOT NULL").select("key", "doc_id").distinct()
        return stored(lines.select(shard_column(self.shards), "key", "doc_id"), "lines")

    def insert(self, docs: DataFrame) -> LineIndex:
        """With the lines of more documents; lines that are there already count once."""
        added = self._own_lines(docs)
        touched = self._shards_of(added)
        known = self._read("postings", touched)
        fresh = added if not known.inputFiles() else added.join(known, ["shard", "key", "doc_id"], "left_anti")
        return self._changed(touched, known.unionByName(fresh.select("key", "doc_id", "shard")))

    def delete(self, docs: DataFrame) -> LineIndex:
        """Without the documents whose doc_id is in ``docs`` (their texts as inserted)."""
        gone = self._own_lines(docs)
        touched = self._shards_of(gone)
        left = self._read("postings", touched).join(gone, ["shard", "key", "doc_id"], "left_anti")
        return self._changed(touched, left.select("key", "doc_id", "shard"))

    @staticmethod
    def _shards_of(rows: DataFrame) -> set[int]:
        return {r.shard for r in rows.select("shard").distinct().collect()}  # as many as there are shards

    def _changed(self, touched: set[int], postings: DataFrame) -> LineIndex:
        """The index with these postings in the shards touched; the others stay as they are."""
        if not touched:
            return self
        folder, version = f"change-{uuid.uuid4().hex}", self.version + 1
        at = lambda name: f"{self.root}/{folder}/{name}"
        # A line in very many documents is split over tasks by them; small shards share one.
        postings.hint("rebalance", "shard").write.partitionBy("shard").parquet(at("postings"))
        written = self.spark.read.schema(POSTINGS).parquet(at("postings"))
        # Summed before the shuffle, so a line in a third of all documents is a row a task.
        counted = written.groupBy("shard", "key").agg(F.count("*").alias("refs"), F.max("doc_id").alias("keeper"))
        counted.select("key", "refs", "keeper", "shard").hint("rebalance", "shard").write.partitionBy("shard").parquet(at("counts"))
        counts = self.spark.read.schema(COUNTS).parquet(at("counts"))
        self._new_filters(touched, counts).write.partitionBy("shard").parquet(at("filters"))
        entries = []
        for name in SCHEMAS:
            filled = self._shards_of(self.spark.read.schema(SCHEMAS[name]).parquet(at(name)))
            entries += [(version, name, shard, folder if shard in filled else None) for shard in sorted(touched)]
        self.spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")
        kept = [place for place in self.places if place[1] not in touched]
        made = [(name, shard, folder) for _, name, shard, folder in entries if folder is not None]
        return replace(self, places=tuple(sorted(kept + made)), version=version)

    def _new_filters(self, touched: set[int], counts: DataFrame) -> DataFrame:
        """(data, shard): the filters of the shards touched, with the keys that became
        frequent and without those that no longer are; one that is full is made anew."""
        enough = F.col("refs") >= self.min_docs
        was = self._read("counts", touched).where(enough).select("shard", "key")
        now = counts.where(enough).select("shard", "key")
        both = (
            was.withColumn("before", F.lit(True))
            .join(now.withColumn("after", F.lit(True)), ["shard", "key"], "full")
            .select("shard", "key", F.coalesce("before", F.lit(False)).alias("before"), F.coalesce("after", F.lit(False)).alias("after"))
        )

        def update(shard: tuple, old: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
            after, before = keys["after"].astype(bool), keys["before"].astype(bool)
            made = Cuckoo(old["data"].iloc[0]) if len(old) else Cuckoo(room=max(64, int(after.sum())))
            gone, come = keys.loc[before & ~after, "key"], keys.loc[after & ~before, "key"]
            if len(gone):
                made.remove(key_words(gone))
            room = 2 * max(64, int(after.sum()))
            full = len(come) > 0 and not made.add(key_words(come))
            while full:
                made = Cuckoo(room=room)
                full, room = not made.add(key_words(keys.loc[after, "key"])), 2 * room
            return pd.DataFrame({"data": [made.data()], "shard": [shard[0]]})

        old = self._read("filters", touched)
        return old.groupBy("shard").cogroup(both.groupBy("shard")).applyInPandas(update, FILTERS)

    def _suspects(self, docs: DataFrame) -> DataFrame:
        """(key, row, doc_id) of the lines of ``docs`` that the filters hold; a few are not
        frequent. Small filters go to the lines, large ones are met by shard and salt."""
        filters = self.filters
        size = filters.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0))).first()[0]
        if size > FILTER_BYTES:
            return self._met(line_keys(docs, self.min_chars), filters)
        tables = self.spark.sparkContext.broadcast({r.shard: bytes(r.data) for r in filters.collect()})
        shards, min_chars = self.shards, self.min_chars

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = {shard: Cuckoo(data) for shard, data in tables.value.items()}
            for batch in batches:
                keys, rows, ids = [], [], []
                for row, doc_id, text in zip(batch[0].to_pylist(), batch[1].to_pylist(), batch[2]):
                    own = dict.fromkeys(key for _, key in long_lines(text.as_py(), min_chars))
                    keys += own
                    rows += [row] * len(own)
                    ids += [doc_id] * len(own)
                if not keys:
                    continue
                words = key_words(keys)
                shard, hit = shard_of(words, shards), np.zeros(len(keys), bool)
                for number, one in held.items():
                    mine = np.flatnonzero(shard == number)
                    hit[mine] = one.contains(words[mine])
                found = np.flatnonzero(hit).tolist()
                yield line_batch([keys[i] for i in found], [rows[i] for i in found], [ids[i] for i in found])

        return numbered_rows(docs).mapInArrow(run, LINE)

    def _met(self, lines: DataFrame, filters: DataFrame) -> DataFrame:
        """The lines that the filter of their shard holds, each filter in SALTS tasks."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now = held = None
            for batch in batches:
                shards, salts = batch[0].to_pylist(), batch[1].to_pylist()
                keys, rows, ids, data = (batch[i].to_pylist() for i in (2, 3, 4, 5))
                found, start = [], 0
                while start < len(shards):
                    end, place = start, (shards[start], salts[start])
                    while end < len(shards) and (shards[end], salts[end]) == place:
                        end += 1
                    if place != now:
                        now, held = place, None
                    if data[start] is not None:  # a filter comes before the lines that it answers
                        held, start = Cuckoo(data[start]), start + 1
                    if held is not None and start < end:
                        hit = held.contains(key_words(keys[start:end]))
                        found += [start + i for i in np.flatnonzero(hit).tolist()]
                    start = end
                yield line_batch([keys[i] for i in found], [rows[i] for i in found], [ids[i] for i in found])

        salt = F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int").alias("salt")
        each = filters.select("shard", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), "data")
        both = lines.select(shard_column(self.shards), salt, "key", "row", "doc_id").unionByName(each, allowMissingColumns=True)
        first = F.col("data").isNull()
        met = both.repartition("shard", "salt").sortWithinPartitions("shard", "salt", first)
        return met.select("shard", "salt", "key", "row", "doc_id", "data").mapInArrow(run, LINE)

    def apply(self, docs: DataFrame) -> DataFrame:
        """(doc_id, text, n_lines, n_dropped): documents without their dropped lines.

        NULL and empty texts are one empty line, and stay empty; texts of any length are
        taken whole. The documents need not be those of the index: a line goes where the
        index has it as frequent and another document as its keeper. Rows that repeat a
        doc_id lose and keep the same lines; rows without one lose every frequent line.
        """
        frequent = self.counts.where(F.col("refs") >= self.min_docs).select("key", "keeper")
        drops = (
            self._suspects(docs)
            .join(frequent, "key")
            .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
            .groupBy("row")
            .agg(F.collect_set("key").alias("drops"))
        )
        min_chars = self.min_chars

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts, lines, dropped = [], [], []
                for text, drops in zip(batch[1], batch[2]):
                    kept = (text.as_py() or "").split("\n")
                    lines.append(len(kept))
                    if drops.is_valid:
                        gone = set(drops.as_py())
                        numbers = {n for n, key in long_lines(text.as_py(), min_chars) if key in gone}
                        kept = [line for n, line in enumerate(kept) if n not in numbers]
                    texts.append("\n".join(kept))
                    dropped.append(lines[-1] - len(kept))
                yield pa.RecordBatch.from_arrays(
                    [batch[0], pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                    ["doc_id", "text", "n_lines", "n_dropped"],
                )

        return (
            numbered_rows(docs)
            .join(drops, "row", "left")
            .select("doc_id", "text", "drops")
            .mapInArrow(run, "doc_id bigint, text string, n_lines bigint, n_dropped bigint")
        )


def op10_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Lines of every document, how many go, and the digest of what stays."""
    docs = table(spark, sf_dir, "documents")
    kept = LineIndex.build(docs).apply(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))
