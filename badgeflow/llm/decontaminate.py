"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Wu and Manber, "A Fast Algorithm for Multi-Pattern Searching". The symbols are words,
a block is two of them. For each block the shift table holds how far the window may
move so that no occurrence is passed; a block in no pattern moves it by the whole
window but one word. Where the shift is 0, the bucket of that suffix block names the
patterns that may end here, and these are compared word by word.

Words are numbers of one dictionary, items lie one after another in one array of them, a
pattern is a place in it, and shifts and buckets are sorted arrays: about 30 bytes for a
word of the benchmark, beside the dictionary. Patterns of one length form one matcher:
nearly all are windows of ten words, and shorter ones (items of fewer words) must not
shorten the shifts of the others.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from badgeflow.llm.common import DOCUMENT_COLUMNS, stored, table

WINDOW = 10
# Benchmark text handled by one set of tables; a larger benchmark is searched in more
# passes, whose results are stored in between, so that a task holds one set at a time.
BLOCK_BYTES = 16 << 20
UNKNOWN = -1
# Moves that a matcher remembers, so that common blocks are looked up once.
MOVES = 100_000

# Lower-cases A-Z; every other byte outside 0-9, a-z and non-ASCII becomes a space.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split() if text else []


class Matcher:
    """The tables for the patterns of one length, that begin at ``starts`` in ``words``."""

    def __init__(self, length: int, words: np.ndarray, starts: np.ndarray, known: int):
        self.length, self.words, self.known = length, words, known
        self.block = min(2, length)
        self.widest = length - self.block + 1
        # Every block of a pattern lets the window move so far that its end is reached; of
        # all such moves of one block the least counts. Later ends are put first.
        blocks, shifts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for end in range(length, self.block - 1, -1):
            here = np.unique(self.blocks(words, starts + end))
            here = here[~_in(here, blocks)]
            merged = np.concatenate([blocks, here])
            order = np.argsort(merged, kind="stable")
            blocks = merged[order]
            shifts = np.concatenate([shifts, np.full(len(here), length - end)])[order]
        self.shift_blocks, self.shifts = blocks, shifts
        self.moves: dict[int, int] = {}  # those looked up lately
        suffix = self.blocks(words, starts + length)
        order = np.argsort(suffix, kind="stable")
        self.suffixes, self.starts = suffix[order], starts[order].astype(np.int32)

    def blocks(self, words: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The blocks that end before these places, as numbers."""
        last = words[ends - 1].astype(np.int64)
        if self.block == 1:
            return last
        first = words[ends - 2].astype(np.int64)
        return first * self.known + last

    def find(self, words: list, get) -> Iterator[tuple[int, np.ndarray]]:
        """(place, starts of the patterns) of every occurrence, left to right.

        ``get`` gives the number of a word, None for one that no pattern has.
        """
        n, length, pair, widest, known = len(words), self.length, self.block == 2, self.widest, self.known
        held, shifts, moves = self.shift_blocks, self.shifts, self.moves
        end = length
        while end <= n:
            block = get(words[end - 1])
            if block is not None and pair:
                first = get(words[end - 2])
                block = None if first is None else first * known + block
            if block is None:
                end += widest
                continue
            move = moves.get(block)
            if move is None:
                at = held.searchsorted(block)
                move = int(shifts[at]) if at < len(held) and held[at] == block else widest
                if len(moves) == MOVES:
                    moves.clear()
                moves[block] = move
            if move:
                end += move
                continue
            bucket = self.starts[self.suffixes.searchsorted(block) : self.suffixes.searchsorted(block, "right")]
            for step in range(length):
                if not len(bucket):
                    break
                word = get(words[end - length + step])
                bucket = bucket[self.words[bucket + step] == (UNKNOWN if word is None else word)]
            if len(bucket):
                yield end - length, bucket
            end += 1


def _in(some: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which of some are in a sorted array."""
    if not len(of):
        return np.zeros(len(some), bool)
    return of[np.minimum(np.searchsorted(of, some), len(of) - 1)] == some


class Benchmark:
    """The items' words and the matchers over them."""

    def __init__(self, items: Iterable[tuple[int, str | None]], window: int):
        self.ids: dict[bytes, int] = {}
        ids = self.ids
        parts, owners, ends, total = [], [], [], 0
        starts: dict[int, list[np.ndarray]] = {}
        for item_id, text in items:
            own = np.array([ids.setdefault(w, len(ids)) for w in words_of(text)], np.int32)
            if not len(own):
                continue
            length = min(window, len(own))
            starts.setdefault(length, []).append(np.arange(total, total + len(own) - length + 1))
            parts.append(own)
            total += len(own)
            owners.append(item_id)
            ends.append(total)
        self.owners, self.ends = owners, np.array(ends, np.int64)
        words = np.concatenate([*parts, np.zeros(0, np.int32)])
        self.matchers = [Matcher(n, words, np.concatenate(starts[n]), len(ids)) for n in sorted(starts)]

    def items_of(self, starts: np.ndarray) -> set[int]:
        return {self.owners[i] for i in np.searchsorted(self.ends, starts, "right").tolist()}


def joined(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching [from, to) merged, in order."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


SPANS = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
SPAN = T.StructType([T.StructField("lo", T.IntegerType()), T.StructField("hi", T.IntegerType())])
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(SPAN)),
        T.StructField("items", T.ArrayType(T.LongType())),
    ]
)


def _search(df: DataFrame, items: list[tuple[int, str]], window: int, text: str) -> DataFrame:
    """One pass over all rows; adds to n_words, spans and items of earlier passes."""
    names = [c for c in df.columns if c not in FOUND.names]
    again = len(names) < len(df.columns)
    shared = df.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        benchmark = Benchmark(shared.value, window)
        for batch in batches:
            counts, spans, found = [], [], []
            before = list(zip(batch["spans"].to_pylist(), batch["items"].to_pylist())) if again else None
            for row, value in enumerate(batch[text]):
                words = words_of(value.as_py())
                hits, ids = [], set()
                if before:
                    hits = [(s["lo"], s["hi"]) for s in before[row][0]]
                    ids.update(before[row][1])
                for matcher in benchmark.matchers:
                    for place, patterns in matcher.find(words, benchmark.ids.get):
                        hits.append((place, place + matcher.length))
                        ids |= benchmark.items_of(patterns)
                counts.append(len(words))
                spans.append([{"lo": lo, "hi": hi} for lo, hi in joined(hits)])
                found.append(sorted(ids))
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in names]
                + [pa.array(counts, pa.int64()), pa.array(spans, SPANS), pa.array(found, pa.list_(pa.int64()))],
                [*names, *FOUND.names],
            )

    schema = T.StructType([df.schema[c] for c in names] + FOUND.fields)
    return df.mapInArrow(run, schema)


def search(
    docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...], window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The ``keep`` columns of every document, with n_words, spans (merged runs of hit
    words, [lo, hi)) and items (ids with an occurring window, sorted).

    The benchmark is read in blocks of about ``block_bytes`` of text; each is one narrow
    pass over the documents, so nothing shuffles, and the block bounds what is broadcast
    and what a task holds: passes are stored one by one.

    NULL and empty texts have no words; texts of any length are searched whole. Items without words or without an id match
    nothing. Items with equal windows are all reported. An empty benchmark leaves
    every document without hits.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    numbered = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    columns = list(dict.fromkeys([*keep, "text"]))
    found = docs.select(*columns)
    for block in range(blocks):
        part = [(r.item_id, r.text) for r in numbered.where(F.col("block") == block).select("item_id", "text").collect()]
        found = _search(found, part, window, "text")
        if block + 1 < blocks:
            found = stored(found, "decontaminate")
    return found.select(*keep, *FOUND.names)


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a hit word, with the columns of documents."""
    return search(docs, benchmark, DOCUMENT_COLUMNS).where(F.size("items") == 0).select(*DOCUMENT_COLUMNS)


def op7_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Words of every document, those inside an occurring benchmark window, and the items."""
    found = search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ("doc_id",))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + (s["hi"] - s["lo"]))
    ids = F.concat_ws(",", F.array_sort(F.transform("items", lambda i: i.cast("string"))))
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )
