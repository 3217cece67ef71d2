"""Token ids packed into rows of fixed length, best fit decreasing.

Ding et al., "Fewer Truncations Improve Language Modeling". Documents longer than a
row are split without loss; the pieces, longest first, each go to the row with the
least room that still holds them, found in a segment tree over the room left. Rows
are written as binary id matrices with cumulative segment lengths and position resets.

A task packs its documents in groups of bounded size as it reads them. Nothing is
shuffled, a task repeated after a lost executor writes the same rows, and a group of
a few thousand rows leaves almost no room unused.
"""

from __future__ import annotations

import base64
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from badgeflow.llm.common import table

ROW_TOKENS = 2048
GROUP_TOKENS = 4 << 20
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END = 50256

# Fixed value: the published splitting pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

SPACE_RUN = re.compile(r"\s\s")
# White space other than the blank and \n; where a text has any, or two of the common
# ones in a row, words cannot be encoded one by one.
RARE_SPACE = tuple(
    chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"
)
PAIRS = ("  ", " \n", "\n ", "\n\n")

SCHEMA = """
    pack string, row int, n_tokens int, n_segments int,
    doc_ids array<bigint>, starts array<bigint>, cu_seqlens array<int>, position_resets array<int>,
    input_ids binary
"""


class Tokenizer:
    """Byte-level BPE of a public vocabulary.

    A text whose white space stands alone splits at its blanks without a change of
    ids, as no piece of the pattern reaches past a word into the next blank. Words
    are then looked up in a bounded cache, which holds what came first.
    """

    def __init__(self, ranks: bytes, cache_words: int = 300_000):
        import tiktoken

        pairs = (line.split() for line in ranks.splitlines() if line.strip())
        self.encode = tiktoken.Encoding(
            "packing", pat_str=PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={}
        ).encode_ordinary
        self.cache: dict[str, bytes] = {}
        self.room = cache_words

    def _word(self, word: str) -> bytes:
        ids = np.array(self.encode(" " + word), np.uint16).tobytes()
        if self.room and len(word) <= 40:
            self.cache[word] = ids
            self.room -= 1
        return ids

    def __call__(self, text: str) -> bytes:
        """Little-endian 16-bit ids."""
        if any(p in text for p in PAIRS) or any(c in text for c in RARE_SPACE):
            return np.array(self.encode(text), np.uint16).tobytes()
        first, *rest = text.split(" ")
        get, word = self.cache.get, self._word
        head = np.array(self.encode(first), np.uint16).tobytes()
        return head + b"".join([get(w) or word(w) for w in rest])


class Rooms:
    """Rows by room left: a segment tree finds the least room that is large enough."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = bytearray(2 * self.size)
        self.rows: dict[int, list[int]] = defaultdict(list)

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        at = room + self.size
        while at and not self.tree[at]:
            self.tree[at] = 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) with the least room >= need, removed from the tree."""
        tree, at = self.tree, need + self.size
        if not tree[at]:
            while at > 1 and (at & 1 or not tree[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if tree[2 * at] else 2 * at + 1
        room = at - self.size
        row = self.rows[room].pop()
        if not self.rows[room]:
            tree[at] = 0
            at >>= 1
            while at and not (tree[2 * at] or tree[2 * at + 1]):
                tree[at] = 0
                at >>= 1
        return room, row


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Rows of piece numbers; longest pieces first, ties in the given order."""
    rooms, rows = Rooms(capacity), []
    for piece in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[piece])
        found = rooms.take(need)
        if found is None:
            rows.append([piece])
            left, row = capacity - need, len(rows) - 1
        else:
            room, row = found
            rows[row].append(piece)
            left = room - need
        if left:
            rooms.put(left, row)
    return rows


def pack_group(name: str, doc_ids: list, ids: list[np.ndarray], capacity: int, end: int) -> pa.RecordBatch:
    """The packed rows of one group of documents, short rows filled up with ``end``."""
    pieces = [(doc, at) for doc, tokens in enumerate(ids) for at in range(0, len(tokens), capacity)]
    lengths = np.array([min(capacity, len(ids[doc]) - at) for doc, at in pieces], np.int64)
    rows = best_fit(lengths, capacity)
    out: dict[str, list] = defaultdict(list)
    for number, row in enumerate(rows):
        matrix, edges = np.full(capacity, end, np.uint16), [0]
        for piece in row:
            doc, at = pieces[piece]
            n = int(lengths[piece])
            matrix[edges[-1] : edges[-1] + n] = ids[doc][at : at + n]
            edges.append(edges[-1] + n)
        out["pack"].append(name)
        out["row"].append(number)
        out["n_tokens"].append(edges[-1])
        out["n_segments"].append(len(row))
        out["doc_ids"].append([doc_ids[pieces[p][0]] for p in row])
        out["starts"].append([pieces[p][1] for p in row])
        out["cu_seqlens"].append(edges)
        out["position_resets"].append(edges[:-1])
        out["input_ids"].append(matrix.astype("<u2").tobytes())
    types = {
        "pack": pa.string(), "row": pa.int32(), "n_tokens": pa.int32(), "n_segments": pa.int32(),
        "doc_ids": pa.list_(pa.int64()), "starts": pa.list_(pa.int64()), "cu_seqlens": pa.list_(pa.int32()),
        "position_resets": pa.list_(pa.int32()), "input_ids": pa.binary(),
    }
    return pa.RecordBatch.from_arrays([pa.array(out[c], t) for c, t in types.items()], list(types))


def packer(ranks: Callable[[], bytes], capacity: int, group_tokens: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenize, task = Tokenizer(ranks()), TaskContext.get().partitionId()
        doc_ids, ids, held, group = [], [], 0, 0
        for batch in batches:
            for doc_id, text in zip(batch[0].to_pylist(), batch[1]):
                tokens = np.frombuffer(tokenize(text.as_py() or "") + np.uint16(end).tobytes(), np.uint16)
                doc_ids.append(doc_id)
                ids.append(tokens)
                held += len(tokens)
                if held >= group_tokens:
                    yield pack_group(f"{task}-{group}", doc_ids, ids, capacity, end)
                    doc_ids, ids, held, group = [], [], 0, group + 1
        if ids:
            yield pack_group(f"{task}-{group}", doc_ids, ids, capacity, end)

    return run


def vocabulary(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def pack(
    docs: DataFrame,
    capacity: int = ROW_TOKENS,
    vocabulary_path: str = VOCABULARY,
    end: int = END,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """Packed rows of all documents; every document's tokens are closed by ``end``.

    * input_ids: ``capacity`` little-endian 16-bit ids, filled up with ``end``
    * cu_seqlens: where segments begin, and where the last one ends (n_tokens)
    * position_resets: where the position starts again from 0
    * doc_ids, starts: the document of each segment and its first token there, so the
      segments of a document, by start, give back all of its ids

    NULL and empty texts are one ``end``, so every row of ``docs`` appears; repeated
    rows are packed each by itself, and NULL ids stay NULL. No documents, no rows. The
    driver reads the vocabulary (about 1 MB) and sends it to the tasks.
    """
    if not 0 < capacity < 1 << 16:
        raise ValueError("a row holds 1 to 65535 tokens")
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(vocabulary_path))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(packer(lambda: shared.value, capacity, group_tokens, end), SCHEMA)


def unpack(row) -> list[tuple[int, int, list[int]]]:
    """(doc_id, start, ids) of each segment of a packed row."""
    ids = np.frombuffer(row["input_ids"], "<u2")
    edges = row["cu_seqlens"]
    return [(d, s, ids[a:b].tolist()) for d, s, a, b in zip(row["doc_ids"], row["starts"], edges, edges[1:])]


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed rows of 2,048 token ids."""
    return pack(table(spark, sf_dir, "documents"))
