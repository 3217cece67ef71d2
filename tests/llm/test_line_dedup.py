import hashlib
from collections import defaultdict

import numpy as np
import pytest

from badgeflow.llm import line_dedup
from badgeflow.llm.line_dedup import Cuckoo, LineIndex, key_words, op10_line_dedup, shard_column, shard_of

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, min_chars=40, min_docs=5):
    """{doc_id: (n_lines, n_dropped, text)} for (doc_id, text) with unique ids."""
    key = lambda line: line.strip(SPACE).translate(LOWER)
    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(doc_id)
    out = {}
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < min_docs or max(holders[key(x)]) == doc_id]
        out[doc_id] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def applied(index, docs):
    return {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in index.apply(docs).collect()}


def test_whole_table(spark, sf_dir, corpus):
    want = {i: (n, d, hashlib.sha256(t.encode()).hexdigest()) for i, (n, d, t) in brute(corpus).items()}
    rows = op10_line_dedup(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in rows} == want
    assert len(rows) == len(want)


A, B, C = "a" * 40, "The quick brown fox jumps over the lazy dog again", "ü" * 41
DOCS = [
    (1, f"{A}\n{B}\nown 1"), (2, f" {A}\t\n{B.upper()}\n{A}"), (3, f"{A.upper()}\r\n{C}"), (4, f"{A}\n{C}\n"),
    (5, f"x\n{A}\n{B}"), (6, f"{B}\n{C}\n{C}"), (7, f"{B}\n{C}"), (8, f"{C}\n{'a' * 39}"), (9, None), (10, ""),
    (11, f" {A}\n{B}"),
]


@pytest.fixture
def docs(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id bigint, text string")


def test_insert_and_delete_are_exact(docs):
    everything = docs(DOCS)
    whole = LineIndex.build(everything)
    assert applied(whole, everything) == brute(DOCS)
    grown = LineIndex.build(docs(DOCS[:4])).insert(docs(DOCS[4:]))
    assert applied(grown, everything) == brute(DOCS)
    # Without the keeper of A and two holders of B and C their other places return.
    gone, left = [d for d in DOCS if d[0] in (5, 6, 11)], [d for d in DOCS if d[0] not in (5, 6, 11)]
    less = grown.delete(docs(gone))
    assert applied(less, docs(left)) == brute(left)
    back = less.insert(docs(gone))
    assert applied(back, everything) == brute(DOCS)
    state = lambda index: sorted((bytes(r.key), r.refs, r.keeper) for r in index.counts.collect())
    assert state(back) == state(whole) == state(grown)


def test_large_filters_and_many_shards(docs, monkeypatch):
    rows = [(i, "\n".join(f"line number {(i * 7 + j) % 40} of a text that repeats itself" for j in range(9))) for i in range(60)]
    want = brute(rows)
    assert any(d for _, d, _ in want.values())
    index = LineIndex.build(docs(rows), shards=7)
    assert index.shards == 7 and applied(index, docs(rows)) == want
    half = LineIndex.build(docs(rows[:30]), shards=7).insert(docs(rows[30:]))
    assert applied(half, docs(rows)) == want
    monkeypatch.setattr(line_dedup, "FILTER_BYTES", -1)
    assert applied(index, docs(rows)) == want


@pytest.mark.parametrize("filter_bytes", [64 << 20, -1])
def test_index_of_other_documents(docs, monkeypatch, filter_bytes):
    """Documents that the index has not seen lose the lines that it has as frequent,
    however large its filters are."""
    monkeypatch.setattr(line_dedup, "FILTER_BYTES", filter_bytes)
    index = LineIndex.build(docs([(i, f"{A}\nown {i}") for i in range(6)]))
    got = index.apply(docs([(7, f"{A}\nother"), (3, f"{B}\n{A}"), (5, A)])).collect()
    assert {(r.doc_id, r.n_dropped, r.text) for r in got} == {(7, 1, "other"), (3, 1, B), (5, 0, A)}


def test_a_lasting_index(spark, docs, tmp_path):
    """Another application opens the index, deletes a document, and its lines return;
    shards that a change does not touch stay where they are."""
    root = str(tmp_path / "index")
    built = LineIndex.build(docs(DOCS[:5]), root=root, shards=16)
    assert LineIndex.open(spark, root) == built
    other = spark.newSession()
    opened = LineIndex.open(other, root).insert(other.createDataFrame(DOCS[5:], "doc_id bigint, text string"))
    assert applied(LineIndex.open(spark, root), docs(DOCS)) == brute(DOCS)
    gone, left = [DOCS[10]], DOCS[:10]
    less = LineIndex.open(spark, root).delete(docs(gone))
    assert applied(LineIndex.open(spark, root), docs(left)) == brute(left)
    moved = {shard for _, shard, _ in set(less.places) ^ set(opened.places)}
    assert 0 < len(moved) <= 2 < len({shard for _, shard, _ in opened.places})
    # What was opened before the change is as it was.
    assert applied(opened, docs(DOCS)) == brute(DOCS)
    with pytest.raises(Exception):
        LineIndex.create(spark, root, 3)


def test_crash_before_a_change_is_listed(spark, docs, tmp_path, monkeypatch):
    root = str(tmp_path / "index")
    LineIndex.build(docs(DOCS[:5]), root=root)

    def die(*args):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(LineIndex, "_new_filters", die)
    with pytest.raises(RuntimeError):
        LineIndex.open(spark, root).insert(docs(DOCS[5:]))
    monkeypatch.undo()
    index = LineIndex.open(spark, root)
    assert index.version == 1
    again = index.insert(docs(DOCS[5:])).insert(docs(DOCS[5:]))
    assert applied(again, docs(DOCS)) == brute(DOCS)


def test_cuckoo_filter():
    pick = np.random.default_rng(5)
    keys = pick.integers(0, 2**63, (3000, 2)).astype(np.uint64)
    made = Cuckoo(room=3000)
    assert made.add(keys[:2000])
    assert made.contains(keys[:2000]).all() and made.contains(keys[2000:]).mean() < 0.01
    again = Cuckoo(made.data())
    again.remove(keys[:1000])
    assert again.contains(keys[1000:2000]).all() and again.contains(keys[:1000]).mean() < 0.01
    assert not Cuckoo(room=4).add(keys[:100])


def test_shards_agree_in_sql_and_numpy(spark):
    keys = [hashlib.blake2b(bytes([i]), digest_size=16).digest() for i in range(50)]
    df = spark.createDataFrame([(bytearray(k),) for k in keys], "key binary")
    got = {bytes(r.key): r.shard for r in df.select("key", shard_column(7)).collect()}
    assert [got[k] for k in keys] == shard_of(key_words(keys), 7).tolist()


def test_edges(edges, clashing, nothing):
    rows = LineIndex.build(edges).apply(edges).collect()
    assert len(rows) == edges.count()
    assert {(r.n_lines, r.n_dropped, r.text) for r in rows if r.doc_id in (3, 4)} == {(1, 0, "")}
    assert sorted(map(str, LineIndex.build(clashing).apply(clashing).collect())) == sorted(map(str, rows))
    empty = LineIndex.build(nothing)
    assert empty.apply(nothing).count() == 0
    assert empty.insert(edges).delete(edges).counts.where("keeper IS NOT NULL").count() == 0


def test_repeated_rows_and_rows_without_id(docs):
    """Rows of one doc_id are one document; rows without one are none, and lose what is
    frequent elsewhere."""
    rows = [(1, A), (1, A), (2, A), (None, A), (None, A), (3, A)]
    assert all(r.n_dropped == 0 for r in LineIndex.build(docs(rows)).apply(docs(rows)).collect())
    rows += [(4, A), (5, f"{A}\n{A}"), (5, "other")]
    got = sorted((str(r.doc_id), r.n_dropped) for r in LineIndex.build(docs(rows)).apply(docs(rows)).collect())
    assert got == [("1", 1), ("1", 1), ("2", 1), ("3", 1), ("4", 1), ("5", 0), ("5", 0), ("None", 1), ("None", 1)]
    lost = [(None, B)] * 6
    assert all(r.n_dropped == 0 for r in LineIndex.build(docs(lost)).apply(docs(lost)).collect())


def test_very_long_document(docs):
    long = "\n".join(f"line {i} of a document that has very many lines in it" for i in range(60_000))
    rows = [(1, long), (2, long), (3, long), (4, long), (5, long + "\nend")]
    got = {r.doc_id: (r.n_lines, r.n_dropped) for r in LineIndex.build(docs(rows)).apply(docs(rows)).collect()}
    assert got == {1: (60_000, 60_000), 2: (60_000, 60_000), 3: (60_000, 60_000), 4: (60_000, 60_000), 5: (60_001, 0)}
