"""Tries of conversations against one built from plain tuples, and the trees by themselves."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from badgeflow.llm import conversations as C
from badgeflow.llm.radix import Direct, Indexed, RadixTree, Sorted

TURNS = "conv_id bigint, turn bigint, role string, text string"


def brute_force(rebuilt):
    """rebuilt: conv_id -> list of (role, text). A dict per node, by what the contract says."""
    members = {}
    for conv, turns in rebuilt.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(conv)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    out = []

    def sums(path):
        """(leaves, saved) of a subtree."""
        kids = children.get(path, [])
        own = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        below = [sums(kid) for kid in kids]
        leaves, saved = sum(b[0] for b in below) + (not kids), sum(b[1] for b in below) + own
        ends = sorted(c for c in members[path] if len(rebuilt[c]) == len(path))
        out.append(
            (
                min(members[path]),
                len(path),
                min(members[path[:-1]]) if path else None,
                len(members[path]),
                len(kids),
                leaves,
                saved,
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
        return leaves, saved

    if members:
        sums(())
    return sorted(out)


def rebuilt_of(rows):
    """Conversations as the query rebuilds them."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {conv: [t[2:] for t in sorted(turns, key=lambda t: t[:2])] for conv, turns in own.items()}
    out = {}
    for conv, turns in own.items():
        head = zlib.crc32(str(conv).encode()) % 9
        base = conv - (abs(conv) % 5) * (1 if conv >= 0 else -1)
        out[conv] = own.get(base, [])[:head] + turns[head:]
    return own, out


def collected(nodes):
    return sorted(map(tuple, nodes.collect()))


def talk(seed, convs=60):
    pick = random.Random(seed)
    rows = []
    for conv in range(-12, convs):
        if pick.random() < 0.15:
            continue
        turns = [] if pick.random() < 0.1 else [pick.choice("ab") * pick.randrange(3) for _ in range(pick.randrange(1, 14))]
        for turn, text in enumerate(turns):
            rows.append((conv, turn, "user" if turn % 2 == 0 else pick.choice(["assistant", None]), text or pick.choice([None, "é"])))
    rows += [(1000 + i, 0, "user", "same") for i in range(40)]
    rows += [(2**62, 0, "user", "same"), (2**63 - 1, None, "user", "last"), (2**63 - 1, 3, None, None), (None, 0, "user", "nobody")]
    return rows


def test_rebuilt_conversations(spark):
    rows = talk(1)
    frame = spark.createDataFrame(rows, TURNS)
    _, want = rebuilt_of(rows)
    assert any(not turns for turns in want.values()), "a conversation without turns is to be among them"
    assert collected(C.prefix_trie(C.spliced(frame))) == brute_force(want)


@pytest.mark.parametrize("stretch, tree_turns", [(1, 1), (2, 5), (3, 10**6), (256, 7)])
def test_any_stretch_and_any_size_of_trees(spark, stretch, tree_turns):
    rows = talk(2)
    own, _ = rebuilt_of(rows)
    got = collected(C.conversation_trie(spark.createDataFrame(rows, TURNS), stretch=stretch, tree_turns=tree_turns))
    assert got == brute_force(own)


def test_edges(spark):
    empty = spark.createDataFrame([], TURNS)
    assert C.conversation_trie(empty).collect() == [] and C.prefix_trie(C.spliced(empty)).collect() == []
    nobody = spark.createDataFrame([(None, 0, "user", "x")], TURNS)
    assert C.conversation_trie(nobody).collect() == []
    # Repeated rows are turns of their own; role and text do not run into each other.
    rows = [(1, 0, "a", "bc"), (1, 0, "a", "bc"), (2, 0, "ab", "c"), (3, None, None, None), (3, 0, "", "")]
    frame = spark.createDataFrame(rows, TURNS)
    own, _ = rebuilt_of(rows)
    assert collected(C.conversation_trie(frame)) == brute_force(own)
    names = ["id", "size", "at", "path", "depth", "n", "first", "key", "known", "place", "other", "block", "own"]
    assert collected(C.conversation_trie(frame.withColumns({name: F.lit("x") for name in names}))) == brute_force(own)


def test_very_long_conversation_and_text(spark):
    rows = [(1, i, "user", f"turn {i}") for i in range(1500)] + [(2, i, "user", f"turn {i}") for i in range(1200)]
    rows += [(2, 1200, "user", "é" * 3_000_000)]
    got = {(r.conv_id, r.depth): r for r in C.conversation_trie(spark.createDataFrame(rows, TURNS)).collect()}
    assert len(got) == 1502
    assert (got[1, 0].n_convs, got[1, 0].n_leaves) == (2, 2)
    assert got[1, 0].saved_tokens == sum(len(f"turn {i}") for i in range(1200))
    assert (got[2, 1201].parent_conv_id, got[2, 1201].n_children, got[1, 1200].n_children) == (1, 0, 2)
    assert got[1, 1500].ends_sha256 == hashlib.sha256(b"1").hexdigest()


def test_ends_of_a_large_group_in_order(spark):
    ids = [-5000, -1, 0, 7, 1023, 1024, 99_999] + list(range(2000, 6000, 3))
    rows = spark.createDataFrame([(bytes(16), ids[::2]), (bytes(16), ids[1::2]), (b"x" * 16, [10, 9])], "path binary, ended array<bigint>")
    got = {bytes(r.path): r.ends_sha256 for r in C.ends_digest(rows).collect()}
    digest = lambda some: hashlib.sha256(",".join(map(str, sorted(some))).encode()).hexdigest()
    assert got == {bytes(16): digest(ids), b"x" * 16: digest([9, 10])}


def test_first_turn_of_all_is_one_row_a_task(spark):
    """What a task sends for a turn that all conversations share does not grow with them."""
    rows = spark.range(4000).selectExpr("id AS conv_id", "1L AS at", "unhex(sha2('hi', 256)) AS id", "2L AS size")
    rows = rows.withColumn("id", F.substring("id", 1, 16)).repartition(4)
    keyed = C.keys(rows).withColumns({"leaves": F.lit(0).cast("long"), "saved": F.lit(0).cast("long")})
    made = C.parts(keyed).select("depth", "n").collect()
    assert sum(r.n for r in made if r.depth == 1) == 4000 and len(made) <= 2 * keyed.rdd.getNumPartitions()


def inorder(node, path=b""):
    """(key, members) of a tree, in byte order."""
    path += node.prefix
    if node.n:
        yield path, node.n
    for byte, kid in sorted(node.kids(), key=lambda item: item[0]):
        yield from inorder(kid, path + bytes((byte,)))


@pytest.mark.parametrize("letters, width", [(2, 12), (7, 5), (256, 2)])
def test_tree_holds_what_was_placed(letters, width):
    pick = random.Random(letters)
    tree, want = RadixTree(), {}
    for n in range(3000):
        key = bytes(pick.randrange(letters) for _ in range(pick.randrange(width)))
        tree.place(key).add(n, 0, 0, False)
        want[key] = want.get(key, 0) + 1
    assert list(inorder(tree.root)) == sorted(want.items())


def test_layouts_grow():
    tree, seen = RadixTree(), []
    for byte in range(256):
        tree.place(bytes((byte * 7 % 256, 1))).add(byte, 0, 0, False)
        layout = tree.root.layout
        seen.append((type(layout), layout.room))
    assert list(dict.fromkeys(seen)) == [(Sorted, 4), (Sorted, 16), (Indexed, 48), (Direct, 256)]
    assert [seen.index(x) for x in dict.fromkeys(seen)] == [0, 4, 16, 48]
    assert sum(1 for _ in inorder(tree.root)) == 256
