"""A trie of conversations by their turns, from adaptive radix trees built in parallel.

A turn's id is 16 bytes, the first half of the SHA-256 of role and text, big-endian as
printed; a conversation's key is the ids of its turns in order. Each task inserts the
keys it happens to have into radix trees, and gives a row for each byte depth that is
the end of a turn; rows of one node from different tasks are known by a digest of the
path and merged. So nothing depends on how conversations lie: a first turn shared by a
third of them is one row from each task.

Sums over subtrees take no walk down or up the merged trie. Each node's own figure is
credited to the smallest of its members; the sum over a node's members of what they are
credited is then the sum over its subtree, but for those nodes above it that have the
same smallest member, and these are taken off along that member's path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from badgeflow.llm.common import stored, table
from badgeflow.llm.radix import RadixTree
from badgeflow.operators.joins import heavy_keys, salted_join

WIDTH = 16
ROOT = bytes(WIDTH)
# A key is at most so many turns: of a longer conversation, each stretch is a key by itself.
STRETCH = 256
# Turns that a task holds in its trees before it gives their nodes and begins anew.
TREE_TURNS = 200_000
EMPTY_SHA256 = hashlib.sha256().hexdigest()


def below(path: bytes, turn: bytes) -> bytes:
    """The digest of a path and one more turn."""
    return hashlib.blake2b(path + turn, digest_size=WIDTH).digest()


def turn_ids(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, id, size): what the trie needs of each turn; texts stay where they are.

    NULL roles and texts are empty; rows without conv_id belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # The length of the role keeps (role, text) apart from any other split of the same letters.
    named = F.concat_ws(":", F.length(role).cast("string"), F.concat(role, text))
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.left(F.sha2(F.encode(named, "UTF-8"), 256), F.lit(2 * WIDTH))).alias("id"),
        F.octet_length(text).cast("long").alias("size"),
    ).where("conv_id IS NOT NULL")


def numbered(ids: DataFrame) -> DataFrame:
    """(conv_id, at, id, size): turns in order, from 1. NULL turns come first, ties by id."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "id", "size")
    return ids.select("conv_id", F.row_number().over(order).cast("long").alias("at"), "id", "size")


def spliced(turns: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Conversations rebuilt: (conv_id, at, id, size), a row without id for each one.

    Conversation c begins with the first h turns of c - c % family, as many as there are,
    and goes on with its own turns after the first h; h = crc32(c) % most.
    """
    head = F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % most
    own = F.struct("conv_id", (F.col("at") + most).alias("at"), "id", "size")
    exists = F.struct("conv_id", F.lit(0).cast("long").alias("at"), F.lit(None).cast("binary").alias("id"), F.lit(0).cast("long").alias("size"))

    def lent(to: int):
        """This turn in conversation conv_id + to, if that takes it from here."""
        other = F.try_add(F.col("conv_id"), F.lit(to).cast("long"))
        taken = F.crc32(F.encode(other.cast("string"), "UTF-8")) % most
        relative = (other - other % family) == F.col("conv_id")
        return F.when(relative & (F.col("at") <= taken), F.struct(other.alias("conv_id"), "at", "id", "size"))

    first = F.when(F.col("conv_id") % family == 0, F.array(*[lent(to) for to in range(1 - family, family)]))
    rows = F.flatten(
        F.filter(
            F.array(
                F.array(F.when(F.col("at") == 1, exists), F.when(F.col("at") > head, own)),
                F.when(F.col("at") < most, first),
            ),
            lambda part: part.isNotNull(),
        )
    )
    rows = numbered(turn_ids(turns)).select(F.explode(rows).alias("row")).where("row IS NOT NULL").select("row.*")
    # The row at 0 comes first; a conversation without one is only lent to.
    known = F.min("at").over(Window.partitionBy("conv_id").orderBy("at")) == 0
    return rows.withColumn("known", known).where("known").drop("known")


KEYS = "conv_id bigint, path binary, depth bigint, key binary, sizes array<bigint>, last boolean"


def keys(rows: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """A row a stretch of a conversation: the path and depth it begins at, the ids and
    text sizes of its turns, and whether the conversation ends with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        conv = path = key = sizes = None
        depth, known = 0, False

        def close(last: bool) -> None:
            nonlocal path, key, sizes, depth
            made.append((conv, path, depth, bytes(key), sizes, last))
            for at in range(0, len(key), WIDTH):
                path = below(path, bytes(key[at : at + WIDTH]))
            depth, key, sizes = depth + len(sizes), bytearray(), []

        def given() -> pa.RecordBatch:
            columns = zip(*made) if made else [[]] * 6
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.bool_()]
            names = ["conv_id", "path", "depth", "key", "sizes", "last"]
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            for row, turn, size in zip(batch[0].to_pylist(), batch[1].to_pylist(), batch[2].to_pylist()):
                if not known or row != conv:
                    if known:
                        close(True)
                    conv, known = row, True
                    path, depth, key, sizes = ROOT, 0, bytearray(), []
                if turn is None:
                    continue
                if len(sizes) == stretch:
                    close(False)
                key += turn
                sizes.append(size)
            if len(made) > 2000:
                yield given()
                made = []
        if known:
            close(True)
        yield given()

    # Rows of a conversation meet, in order, by the window's own shuffle and sort.
    order = Window.partitionBy("conv_id").orderBy("at")
    placed = rows.withColumn("place", F.row_number().over(order)).sortWithinPartitions("conv_id", "place")
    return placed.select("conv_id", "id", "size").mapInArrow(run, KEYS)


PARTS = (
    "path binary, parent binary, depth bigint, n bigint, first bigint, size bigint, leaves bigint, saved bigint,"
    " ended array<bigint>"
)


def tree_nodes(tree: RadixTree, path: bytes, depth: int, sizes: dict[bytes, int]) -> Iterator[tuple]:
    """A row for each depth of a tree at which a turn ends, as in PARTS.

    Depth 0 itself is a node only of the trie's root: that of a later stretch is the last
    node of the stretch before.
    """
    # (node, index of its parent, its rows (path, parent, depth, size)), parents first
    order: list[tuple] = []
    stack = [(tree.root, -1, tree.root.prefix, path, depth)]
    while stack:
        node, parent, run, at, level = stack.pop()
        rows = [(at, None, 0, 0)] if parent < 0 and depth == 0 else []
        while len(run) >= WIDTH:
            turn, run = run[:WIDTH], run[WIDTH:]
            at, above, level = below(at, turn), at, level + 1
            rows.append((at, above, level, sizes[turn]))
        mine = len(order)
        order.append((node, parent, rows))
        stack += [(kid, mine, run + bytes((byte,)) + kid.prefix, at, level) for byte, kid in node.kids()]
    sums = [[node.n, node.first, node.leaves, node.saved] for node, _, _ in order]
    for mine in range(len(order) - 1, -1, -1):
        node, parent, rows = order[mine]
        n, first, leaves, saved = sums[mine]
        for row in rows:
            ended = node.ended if row is rows[-1] else None
            yield row[0], row[1], row[2], n, first, row[3], leaves, saved, ended
        if parent >= 0:
            over = sums[parent]
            over[0] += n
            over[1] = first if over[1] is None or (first is not None and first < over[1]) else over[1]
            over[2] += leaves
            over[3] += saved


def parts(keyed: DataFrame, tree_turns: int = TREE_TURNS) -> DataFrame:
    """Nodes of the trees that each task makes from its keys (and leaves and saved of each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("path", pa.binary()), ("parent", pa.binary())]
            + [(name, pa.int64()) for name in ("depth", "n", "first", "size", "leaves", "saved")]
            + [("ended", pa.list_(pa.int64()))]
        )
        trees: dict[bytes, tuple[RadixTree, int]] = {}
        sizes: dict[bytes, int] = {}
        held = 0

        def given() -> Iterator[pa.RecordBatch]:
            rows = []
            for path, (tree, depth) in trees.items():
                for row in tree_nodes(tree, path, depth, sizes):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield batch_of(rows)
                        rows = []
            if rows:
                yield batch_of(rows)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(column), field.type) for column, field in zip(zip(*rows), schema)], schema=schema
            )

        for batch in batches:
            for conv, path, depth, key, texts, last, leaves, saved in zip(*(column.to_pylist() for column in batch)):
                if path not in trees:
                    trees[path] = RadixTree(), depth
                trees[path][0].place(key).add(conv, leaves, saved, last)
                for at, size in zip(range(0, len(key), WIDTH), texts):
                    sizes[key[at : at + WIDTH]] = size
                held += len(texts) + 1
                if held >= tree_turns:
                    yield from given()
                    trees, sizes, held = {}, {}, 0
        yield from given()

    return keyed.select("conv_id", "path", "depth", "key", "sizes", "last", "leaves", "saved").mapInArrow(run, PARTS)


def ends_digest(ended: DataFrame) -> DataFrame:
    """(path, ends_sha256) from (path, ended): the ids in order, joined by commas, hashed.

    Ids are put in order and joined in blocks of 1024 numbers; a node's blocks are then
    hashed one after another as they come, so that no list of ids is ever held.
    """
    each = ended.select("path", F.explode("ended").alias("conv_id"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    blocks = each.groupBy("path", F.shiftright("conv_id", 10).alias("block")).agg(joined.alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = hashed = None
        for batch in batches:
            paths, digests = [], []
            for path, ids in zip(batch[0].to_pylist(), batch[1].to_pylist()):
                if path == now:
                    hashed.update(b"," + ids.encode())
                    continue
                if now is not None:
                    paths.append(now)
                    digests.append(hashed.hexdigest())
                now, hashed = path, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.binary()), pa.array(digests, pa.string())], ["path", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([hashed.hexdigest()])], ["path", "ends_sha256"])

    ordered = blocks.repartition("path").sortWithinPartitions("path", "block")
    return ordered.select("path", "ids").mapInArrow(run, "path binary, ends_sha256 string")


def prefix_trie(rows: DataFrame, stretch: int = STRETCH, tree_turns: int = TREE_TURNS) -> DataFrame:
    """The nodes of the trie of all conversations in ``rows``.

    rows: (conv_id, at, id, size), a turn each in order of ``at``; a row without id adds
    no turn, but a conversation that has no other is a member of the root. Conversations
    of any length are taken in stretches; copies and shared beginnings are one row from
    each task. No conversations give no nodes, not even a root.
    """
    keyed = stored(keys(rows, stretch), "conversation-keys")
    none = {"leaves": F.lit(0).cast("long"), "saved": F.lit(0).cast("long")}
    made = stored(parts(keyed.withColumns(none), tree_turns), "trie-parts")
    nodes = stored(
        made.groupBy("path").agg(
            F.max("parent").alias("parent"),
            F.max("depth").alias("depth"),
            F.min("first").alias("conv_id"),
            F.sum("n").alias("n_convs"),
            F.max("size").alias("size"),
        ),
        "trie-nodes",
    )
    counts = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("path")).agg(F.count("*").alias("n_children"))
    nodes = stored(
        nodes.join(counts, "path", "left").select(
            "path",
            "parent",
            "depth",
            "conv_id",
            "n_convs",
            ((F.col("n_convs") - 1) * F.col("size")).alias("own"),
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
        ),
        "trie-children",
    )
    credit = nodes.groupBy("conv_id").agg(
        F.max((F.col("n_children") == 0).cast("long")).alias("leaves"), F.sum("own").alias("saved")
    )
    credited = keyed.join(credit.where("leaves > 0 OR saved > 0"), "conv_id")
    sums = parts(credited, tree_turns).groupBy("path").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    member = Window.partitionBy("conv_id").orderBy("depth")
    above = F.coalesce(F.sum("own").over(member.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = nodes.select("*", above.alias("above"), F.row_number().over(member).alias("place"))
    # Along one member's path the parent's smallest member is the same; only where it
    # begins is the parent to be looked up, and parents of very many nodes are salted.
    begins = placed.where("place = 1 AND parent IS NOT NULL").select("path", "parent")
    parents = nodes.select(F.col("path").alias("parent"), F.col("conv_id").alias("other"))
    looked_up = salted_join(begins, parents, "parent", heavy_keys(begins, "parent"), ("path",)).select("path", "other")
    ends = ends_digest(made.where("ended IS NOT NULL").select("path", "ended"))
    return (
        placed.join(sums, "path", "left")
        .join(looked_up, "path", "left")
        .join(ends, "path", "left")
        .select(
            "conv_id",
            "depth",
            F.when(F.col("parent").isNotNull(), F.coalesce("other", "conv_id")).alias("parent_conv_id"),
            "n_convs",
            "n_children",
            F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"),
            (F.coalesce("saved", F.lit(0)) - F.col("above")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
        )
    )


def conversation_trie(turns: DataFrame, **options) -> DataFrame:
    """The trie of conversations (conv_id, turn, role, text) as they are.

    Turns without a number come first; ties are ordered by the digest of role and text,
    so repeated rows are turns of their own. NULL roles and texts are empty; rows without
    conv_id are in no conversation; other columns are not read.
    """
    return prefix_trie(numbered(turn_ids(turns)), **options)


def op12_conversation_trie(spark, sf_dir: str) -> DataFrame:
    """The trie of all conversations, rebuilt with beginnings that they share."""
    return prefix_trie(spliced(table(spark, sf_dir, "conversations")))
