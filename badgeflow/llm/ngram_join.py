"""Exact n-gram Jaccard join of documents, down to its connected components.

Wang et al., "Leveraging Set Relations in Exact Set Similarity Join". Two documents
link when their sets of word shingles have a Jaccard likeness of at least 85 %.

1. Equal sets become one class, which stands for all its documents.
2. Shingles have one global order, rare ones first (an estimate of how rare is enough:
   any order gives exact results). Two linked sets share a shingle in their prefixes.
3. Index lists (classes by prefix shingle) with the same members are one list with a
   weight. Short lists give pairs, whose weights bound the overlap; long lists are not
   paired but tied together by size. What hangs together is a group.
4. Each group is joined in one task by index lists of blocks. A block is skipped by the
   sizes and positions it holds (index-level skipping). A set linked to another shares
   its answers: whatever the other reaches needs no comparison, and lists that lie
   within one component are skipped whole (answer-level skipping).
5. Groups above a bound are joined in blocks, and pairs of blocks only where they are
   not connected yet.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from badgeflow.llm.common import stored, table
from badgeflow.llm.components import components

SHINGLE = 4
# Link: 100 * intersection >= 85 * union.
NUMERATOR, DENOMINATOR = 85, 100
SKETCH = 1 << 20
SKETCH_CHUNK = 1 << 12
PAIRED = 64
GROUP_SHINGLES = 2_000_000
BLOCK = 64
SALTS = 32
# Sides of at most so many rows (40 bytes each) are sent to all tasks.
BROADCAST_ROWS = 500_000
PIECE_BYTES = 256 << 10

LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint64) + np.uint64(1)
SOLID = np.array([b != 0x20 and not 0x09 <= b <= 0x0D for b in range(256)])
RADIX = 0x9E3779B97F4A7C15
RADIX_INVERSE = pow(RADIX, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n - 1) modulo 2**64."""
    if len(_powers.get(base, ())) < n:
        steps = np.full(max(n, PIECE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps)
    return _powers[base][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """The finishing steps of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts that lie one after another, and the first word of
    each text (one more entry than texts). A-Z count as a-z."""
    n = len(data)
    solid = SOLID[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    open_before = np.zeros(n, bool)
    open_before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~open_before | edge[:n]))
    open_after = np.zeros(n, bool)
    open_after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~open_after | edge[1:])) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(LOWER[data] * powers(RADIX, n), out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * powers(RADIX_INVERSE, n + 1)[starts]
    return mixed(hashes + (ends - starts).astype(np.uint64)), np.searchsorted(starts, offsets)


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each text its distinct shingle hashes, sorted; pieces bound the memory."""
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    row = 0
    while row < len(texts):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + PIECE_BYTES, side="right")) - 1)
        hashes, first = word_hashes(data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row])
        grams = hashes.copy()
        for step in range(1, shingle):
            grams = mixed(grams[:-1] * np.uint64(RADIX)) + hashes[step:] if len(grams) > 1 else grams[:0]
        grams = mixed(grams)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= shingle:
                yield np.unique(grams[a : b - shingle + 1])
            elif b > a:
                whole = hashlib.blake2b(hashes[a:b].tobytes(), digest_size=8).digest()
                yield np.frombuffer(whole, np.uint64)
            else:
                yield np.zeros(0, np.uint64)
        row = last


def least_part(size):
    """The smallest overlap with a linked set, and its least size."""
    return -(-size * NUMERATOR // DENOMINATOR)


def least_overlap(a, b):
    """The overlap from which sets of these sizes link."""
    return -(-(a + b) * NUMERATOR // (NUMERATOR + DENOMINATOR))


def prefix(size: int) -> int:
    return size - least_part(size) + 1


def index_prefix(size: int) -> int:
    """Enough of a set that is sought by sets at least as large."""
    return size - least_overlap(size, size) + 1


class Groups:
    """Union-find over 0 to n - 1."""

    def __init__(self, n: int):
        self.parent = list(range(n))
        # Pairs compared whole, told from a similar set's answer alone, and from it and
        # the shingles in which the two differ.
        self.compared = self.told = self.derived = 0

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, a: int, b: int) -> None:
        self.parent[self.root(a)] = self.root(b)


class IndexList:
    """The sets that hold a shingle in their prefix, smallest first, in blocks.

    rest: the part of a set from its position on, which bounds what may be shared.
    """

    __slots__ = ("entries", "block_rest", "block_size", "first", "split")

    def __init__(self, first: int):
        self.entries: list[tuple[int, int, int]] = []
        self.block_rest: list[int] = []
        self.block_size: list[int] = []
        self.first, self.split = first, False

    def add(self, number: int, size: int, rest: int) -> None:
        if len(self.entries) % BLOCK == 0:
            self.block_rest.append(rest)
            self.block_size.append(size)
        else:
            self.block_rest[-1] = max(self.block_rest[-1], rest)
            self.block_size[-1] = size
        self.entries.append((number, size, rest))

    def candidates(self, size: int, rest: int) -> Iterator[tuple[int, int]]:
        """(number, bound): members that may share enough with a set of this size."""
        start = bisect_left(self.block_size, least_part(size))
        for block in range(start, len(self.block_size)):
            low = max(least_part(size), self.entries[block * BLOCK][1])
            if min(rest, self.block_rest[block]) < least_overlap(size, low):
                continue
            for number, other, other_rest in self.entries[block * BLOCK : block * BLOCK + BLOCK]:
                if other >= least_part(size) and min(rest, other_rest) >= least_overlap(size, other):
                    yield number, other


class Answers:
    """What a set shares with others, computed for itself or from a set like it.

    A set that links to an earlier one takes that as its model. With v shared with the
    model, g of the model's shingles gone and c come, it shares with any third set what
    the model does, less at most g and more at most c: often that settles whether they
    link, and else only the shingles that differ are looked up.
    """

    def __init__(self, ranked: list[np.ndarray], mark: np.ndarray, groups: Groups):
        self.ranked, self.mark, self.groups = ranked, mark, groups
        self.known: dict[int, dict[int, int]] = {}
        self.models: dict[int, int] = {}
        self.model: int | None = None

    def begin(self, x: int) -> None:
        self.x, self.size, self.model, self.own = x, len(self.ranked[x]), None, {}

    def take(self, model: int) -> None:
        """Answers of ``model`` from here on; x's own so far stand."""
        base = self.ranked[model]
        self.model = self.models[self.x] = model
        self.gone = base[~self.mark[base]]
        self.come = np.setdiff1d(self.ranked[self.x], base, assume_unique=True)

    def linked(self, y: int) -> bool:
        """Whether x and y link."""
        other = self.ranked[y]
        total = self.size + len(other)
        enough = lambda shared: DENOMINATOR * shared >= NUMERATOR * (total - shared)
        answer = None if self.model is None else self.known[self.model].get(y)
        if answer is None:
            self.groups.compared += 1
            shared = int(np.count_nonzero(self.mark[other]))
            self.own[y] = shared
            found = enough(shared)
            if found and self.model is None:
                self.take(y if y in self.known else self.models[y])
            return found
        if enough(answer - len(self.gone)) or not enough(answer + len(self.come)):
            self.groups.told += 1
            return enough(answer - len(self.gone))
        self.groups.derived += 1
        return enough(answer - _held(self.gone, other) + _held(self.come, other))

    def end(self) -> None:
        """Sets without a model are models of later ones."""
        if self.model is None:
            self.known[self.x] = self.own


def _held(some: np.ndarray, of: np.ndarray) -> int:
    """How many of some ranks are in a sorted set."""
    at = np.searchsorted(of, some)
    at[at == len(of)] = 0
    return int(np.count_nonzero(of[at] == some))


def join_group(sets: list[np.ndarray], known: list[int] | None = None) -> Groups:
    """The components of the links among sets; ``known`` labels are joined beforehand."""
    groups = Groups(len(sets))
    leader: dict[int, int] = {}
    for number, label in enumerate(known or ()):
        groups.join(number, leader.setdefault(label, number))
    sizes = [len(s) for s in sets]
    tokens, numbers, times = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_inverse=True, return_counts=True)
    rank = np.empty(len(tokens), np.int64)
    rank[np.lexsort((tokens, times))] = np.arange(len(tokens))
    alone = int((times == 1).sum())  # the ranks of shingles that one set holds alone
    ends = np.cumsum([0, *sizes])
    ranked = [np.sort(rank[numbers[a:b]]) for a, b in zip(ends[:-1], ends[1:])]
    mark = np.zeros(len(tokens), bool)
    answers = Answers(ranked, mark, groups)
    index: dict[int, IndexList] = {}
    for x in sorted(range(len(sets)), key=lambda i: (sizes[i], i)):
        size, own = sizes[x], ranked[x]
        if not size:
            continue
        mark[own] = True
        answers.begin(x)
        refused: set[int] = set()
        skip = int(np.searchsorted(own, alone))
        for at in range(skip, prefix(size)):
            listed = index.get(int(own[at]))
            if listed is None or (not listed.split and groups.root(listed.first) == groups.root(x)):
                continue
            mine, same = groups.root(x), True
            for y, other in listed.candidates(size, size - at):
                if groups.root(y) == mine:
                    continue
                same = False
                if y in refused:
                    continue
                if answers.linked(y):
                    groups.join(x, y)
                    mine = groups.root(x)
                else:
                    refused.add(y)
            if not same and listed.split:
                listed.split = any(groups.root(y) != groups.root(listed.first) for y, _, _ in listed.entries)
        answers.end()
        for at in range(skip, index_prefix(size)):
            listed = index.setdefault(int(own[at]), IndexList(x))
            listed.split = listed.split or groups.root(listed.first) != groups.root(x)
            listed.add(x, size, size - at)
        mark[own] = False
    return groups


def _summed(chunks: DataFrame, *by: str) -> DataFrame:
    """Chunks of counts (chunk, part, counts) added up over ``by``."""

    def run(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c.as_py(), np.uint32).astype(np.int64) for c in rows["counts"])
        head = rows.slice(0, 1)
        counts = pa.array([total.clip(0, 0xFFFFFFFF).astype(np.uint32).tobytes()], pa.binary())
        return head.set_column(head.schema.get_field_index("counts"), "counts", counts)

    return chunks.groupBy(*by).applyInArrow(run, chunks.schema)


def _classes(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, n_shingles, rep) of every row, and the counts of the sketch's cells.

    rep is the smallest doc_id with the same set. The sketch counts all shingles of all
    documents in a fixed number of cells; rare cells come first in the global order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cells = np.zeros(SKETCH, np.int64)
        names = ["doc_id", "n_shingles", "key", "chunk", "part", "counts"]
        for batch in batches:
            sizes, keys = [], []
            for grams in shingle_sets(batch[1]):
                np.add.at(cells, (grams % np.uint64(SKETCH)).astype(np.int64), 1)
                sizes.append(len(grams))
                keys.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None)
            none = pa.nulls(len(sizes), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch[0], pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), none, none, pa.nulls(len(sizes), pa.binary())],
                names,
            )
        chunks = cells.clip(0, 0xFFFFFFFF).astype(np.uint32).reshape(-1, SKETCH_CHUNK)
        used = np.flatnonzero(chunks.any(axis=1))
        none = pa.nulls(len(used), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                none,
                none,
                pa.nulls(len(used), pa.binary()),
                pa.array(used.astype(np.int32)),
                pa.array(np.full(len(used), TaskContext.get().partitionId() % 64, np.int32)),
                pa.array([chunks[i].tobytes() for i in used], pa.binary()),
            ],
            names,
        )

    schema = "doc_id bigint, n_shingles bigint, key binary, chunk int, part int, counts binary"
    seen = stored(docs.mapInArrow(run, schema), "ngram-sets")
    # Two levels, so that no task adds up the chunks of all tasks.
    chunks = seen.where("chunk IS NOT NULL").select("chunk", "part", "counts")
    cells = np.zeros((SKETCH // SKETCH_CHUNK, SKETCH_CHUNK), np.int64)
    for row in _summed(_summed(chunks, "chunk", "part"), "chunk").collect():
        cells[row.chunk] = np.frombuffer(row.counts, np.uint32)
    members = seen.where("chunk IS NULL").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    repeated = (
        members.where("key IS NOT NULL")
        .groupBy("key")
        .agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"))
        .where("n > 1")
        .select("key", "rep", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    reps = members.join(repeated, ["key", "salt"], "left").select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep"))
    return stored(reps, "ngram-classes"), cells.ravel().clip(0, 0xFFFFFFFF).astype(np.uint32)


def _prefixes(docs: DataFrame, order: np.ndarray) -> DataFrame:
    """(token, doc_id, size): the prefix of each set; of equal sets in a task, one.

    ``order`` (4 MB) goes to all tasks; its size is that of the sketch.
    """
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, done = shared.value, set()
        for batch in batches:
            tokens, ids, sizes, lengths = [], [], [], []
            for doc_id, grams in zip(batch[0].to_pylist(), shingle_sets(batch[1])):
                key = hashlib.blake2b(grams.tobytes(), digest_size=16).digest()
                if not len(grams) or doc_id is None or key in done:
                    continue
                done.add(key)
                n = prefix(len(grams))
                tokens.append(grams[np.lexsort((grams, weight[(grams % np.uint64(SKETCH)).astype(np.int64)]))[:n]])
                ids.append(doc_id)
                sizes.append(len(grams))
                lengths.append(n)
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(tokens).view(np.int64)),
                        pa.array(np.repeat(np.array(ids, np.int64), lengths)),
                        pa.array(np.repeat(np.array(sizes, np.int32), lengths)),
                    ],
                    ["token", "doc_id", "size"],
                )

    return docs.mapInArrow(run, "token bigint, doc_id bigint, size int")


def _lists(docs: DataFrame, members: DataFrame, order: np.ndarray) -> DataFrame:
    """(list, node, size, n, weight): index lists of two classes or more. Lists with
    the same members are one, of their number as weight."""
    entries = stored(_prefixes(docs, order), "ngram-prefixes")
    shared = entries.groupBy("token").count().where("count > 1").select("token")
    reps = members.select("doc_id", "rep").distinct()
    rows = stored(
        entries.join(shared, "token").join(reps, "doc_id").select("token", F.col("rep").alias("node"), "size").distinct(),
        "ngram-lists",
    )
    low = lambda seed: F.xxhash64(F.lit(seed), "node")
    lists = rows.groupBy("token").agg(
        F.count("*").alias("n"), F.min("node").alias("lowest"), F.bit_xor(low(1)).alias("x"), F.bit_xor(low(2)).alias("y")
    )
    distinct = (
        lists.where("n > 1")
        .groupBy("n", "lowest", "x", "y")
        .agg(F.min("token").alias("token"), F.count("*").alias("weight"))
        .select("token", "n", "weight")
    )
    return stored(rows.join(distinct, "token").withColumnRenamed("token", "list"), "ngram-lists")


def _ties(lists: DataFrame) -> DataFrame:
    """(a, b) edges that hold together all classes that may link."""
    short, long = lists.where(F.col("n") <= PAIRED), lists.where(F.col("n") > PAIRED)

    def sql(function, *sizes: str) -> Column:
        """The integer bounds above as SQL: ceilings of exact fractions."""
        if function is least_part:
            return F.ceil(F.col(sizes[0]) * NUMERATOR / F.lit(DENOMINATOR).cast("decimal(9,0)")).cast("long")
        return F.ceil((F.col(sizes[0]) + F.col(sizes[1])) * NUMERATOR / F.lit(NUMERATOR + DENOMINATOR).cast("decimal(9,0)")).cast("long")

    # Prefix shingles of a class in long lists, which no pair's weight counts.
    uncounted = long.groupBy("node").agg(F.sum("weight").alias("uncounted"))
    left = short.select("list", "weight", F.col("node").alias("a"), F.col("size").alias("size_a"))
    right = short.select("list", F.col("node").alias("b"), F.col("size").alias("size_b"))
    smaller, larger = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    pairs = (
        left.join(right, "list")
        .where((F.col("a") < F.col("b")) & (smaller * DENOMINATOR >= larger * NUMERATOR))
        .groupBy("a", "b", "size_a", "size_b")
        .agg(F.sum("weight").alias("shared"))
        .join(uncounted.select(F.col("node").alias("a"), F.col("uncounted").alias("more_a")), "a", "left")
        .join(uncounted.select(F.col("node").alias("b"), F.col("uncounted").alias("more_b")), "b", "left")
    )
    more = F.least(F.coalesce("more_a", F.lit(0)), F.coalesce("more_b", F.lit(0)))
    # Beyond the prefixes, at most the rest of one of the two sets can be shared.
    beyond = F.greatest(sql(least_part, "size_a"), sql(least_part, "size_b")) - 1
    near = pairs.where(F.col("shared") + more + beyond >= sql(least_overlap, "size_a", "size_b")).select("a", "b")
    # Long lists: sizes of linked sets lie in one band or two neighbouring ones.
    banded = long.select("list", "node", F.floor(F.ln(F.col("size").cast("double")) / -np.log(NUMERATOR / DENOMINATOR)).alias("band"))
    heads = banded.groupBy("list", "band").agg(F.min("node").alias("head"))
    to_head = banded.join(heads, ["list", "band"]).select(F.col("node").alias("a"), F.col("head").alias("b"))
    across = heads.join(
        heads.select("list", (F.col("band") - 1).alias("band"), F.col("head").alias("next")), ["list", "band"]
    ).select(F.col("head").alias("a"), F.col("next").alias("b"))
    return near.unionByName(to_head).unionByName(across)


def _joined(groups: DataFrame) -> DataFrame:
    """(node, root) per group of (group, node, label, text); label joins beforehand."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        nodes = rows["node"].to_pylist()
        sets = [grams for chunk in rows["text"].chunks for grams in shingle_sets(chunk)]
        found = join_group(sets, rows["label"].to_pylist())
        lowest: dict[int, int] = {}
        for number, node in enumerate(nodes):
            root = found.root(number)
            lowest[root] = min(lowest.get(root, node), node)
        roots = [lowest[found.root(number)] for number in range(len(nodes))]
        return pa.table({"node": pa.array(nodes, pa.int64()), "root": pa.array(roots, pa.int64())})

    return groups.select("group", "node", "label", "text").groupBy("group").applyInArrow(run, "node bigint, root bigint")


def _in_blocks(rows: DataFrame) -> DataFrame:
    """(node, root) for the groups above the bound: (group, node, size, blocks, text).

    First each block by itself, then one set of each component found in each block (in
    as many blocks again as they fill), then those pairs of blocks that still hold more
    than one component: there every pair of sets not yet connected is looked at.
    """
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = stored(rows.withColumn("block", block), "ngram-blocks")
    key = lambda *parts: F.concat_ws("/", *[F.col(p).cast("string") for p in parts])
    links = stored(_joined(rows.select(key("group", "block").alias("group"), "node", F.col("node").alias("label"), "text")), "ngram-links")
    heads = rows.join(links.where("node = root").select("node"), "node", "left_semi")
    total = heads.groupBy("group").agg(F.ceil(F.sum("size") / F.lit(GROUP_SHINGLES)).cast("int").alias("parts"))
    heads = heads.join(total, "group").withColumn("part", F.pmod(F.xxhash64(F.lit(7), "node"), F.col("parts")).cast("int"))
    links = stored(
        links.unionByName(_joined(heads.select(key("group", "part").alias("group"), "node", F.col("node").alias("label"), "text"))),
        "ngram-links",
    )
    labelled = rows.join(components(links, "node", "root").withColumnRenamed("root", "label"), "node", "left").withColumn(
        "label", F.coalesce("label", "node")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = labelled.withColumn("other", other).where("other != block").select(
        F.concat_ws("/", F.col("group").cast("string"), F.least("block", "other"), F.greatest("block", "other")).alias("group"),
        "node", "label",
    )
    open_ = paired.groupBy("group").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("group")
    todo = paired.join(open_, "group").join(rows.select("node", "text"), "node")
    return components(links.unionByName(_joined(todo)), "node", "root")


def join_documents(docs: DataFrame, group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    component_id is the smallest doc_id reachable by links, the document's own
    included. NULL and empty texts have no shingles and link with nothing. Of rows that
    share a doc_id, each has the component of its own text; where both texts are first
    named by that doc_id, they count as one document. Rows without a doc_id are in the
    component of equal texts that have one, else in none (NULL).
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    members, order = _classes(rows)
    lists = _lists(rows, members, order)
    groups = components(_ties(lists))
    sizes = lists.groupBy("node").agg(F.max("size").alias("size"))
    nodes = groups.withColumnRenamed("root", "group").join(sizes, "node")
    total = nodes.groupBy("group").agg(F.ceil(F.sum("size") / F.lit(group_shingles)).cast("int").alias("blocks"))
    nodes = stored(nodes.join(total, "group"), "ngram-nodes")
    # Few of all documents have a neighbour: where their number is small, the texts
    # need no shuffle to be found; else they are joined by a shuffle.
    wanted = F.broadcast(nodes) if nodes.count() <= BROADCAST_ROWS else nodes
    texts = rows.select(F.col("doc_id").alias("node"), "text").join(wanted, "node")
    found = _joined(texts.where("blocks = 1").withColumn("label", F.col("node")))
    if not nodes.where("blocks > 1").isEmpty():
        found = found.unionByName(_in_blocks(texts.where("blocks > 1").select("group", "node", "size", "blocks", "text")))
    return members.join(found, members["rep"] == found["node"], "left").select(
        "doc_id", "n_shingles", F.coalesce("root", "rep").alias("component_id")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """Of each component the document with the smallest doc_id, with all its columns.

    Of rows repeated with doc_id and text, one stays. Rows without a doc_id all stay.
    """
    found = stored(join_documents(docs), "ngram-components")
    gone = found.where("doc_id != component_id").select("doc_id").distinct()
    # As above: where few go, the texts that stay need no shuffle.
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    kept = docs.join(gone, "doc_id", "left_anti")
    repeated = found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(repeated, "doc_id", "left_anti").unionByName(once)


def op9_ngram_join(spark, sf_dir: str) -> DataFrame:
    """Shingles and component of every document."""
    return join_documents(table(spark, sf_dir, "documents"))
