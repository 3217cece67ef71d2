import hashlib
import random
import re

import numpy as np
import pyarrow.dataset as ds

from badgeflow.llm.common import DOCUMENT_COLUMNS
from badgeflow.llm.decontaminate import Benchmark, Matcher, clean_documents, joined, op7_decontaminate, search, words_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    """(n_words, n_hit, items) of each text, by trying every window at every place."""
    windows = {}
    for item_id, text in items:
        words = plain_words(text)
        for at in range(max(len(words) - window, 0) + 1 if words else 0):
            windows.setdefault(tuple(words[at : at + window]), set()).add(item_id)
    lengths = {len(w) for w in windows}
    out = []
    for text in docs:
        words = plain_words(text)
        hit, found = set(), set()
        for at in range(len(words)):
            for n in lengths:
                owners = windows.get(tuple(words[at : at + n])) if at + n <= len(words) else None
                if owners:
                    hit.update(range(at, at + n))
                    found |= owners
        out.append((len(words), len(hit), sorted(found)))
    return out


def test_whole_table(spark, sf_dir, corpus):
    items = [(r["item_id"], r["text"]) for r in ds.dataset(f"{sf_dir}/benchmark.parquet").to_table().to_pylist()]
    want = {i: w for (i, _), w in zip(corpus, brute([t for _, t in corpus], items))}
    rows = op7_decontaminate(spark, sf_dir).collect()
    assert len(rows) == len(want)
    assert any(r.contaminated for r in rows)
    for r in rows:
        n, hit, found = want[r.doc_id]
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, hit, len(found), digest, hit > 0)


ITEMS = [
    (1, "A b, c d e f g h i j k"),
    (2, "b c d e f g h i j k l"),
    (3, "Short one"),
    (4, "zz"),
    (5, "!!"),
    (6, None),
    (7, "a a a a a a a a a a a a"),
    (2, "again under an id that two items have in one table"),
    (11, "short ONE"),
]
TEXTS = [
    "x a b c d e f g h i j k l y",
    "a b c d e f g h i",
    "this is a short one, and zz: zzz",
    "a " * 25,
    "A B C D E F G H I J a b c d e f g h i j",
    "Ünï 漢字 short-one",
    "",
    None,
    "b c d e f g h i j K L again under an id that two items have in one table",
]


def test_windows_short_items_and_blocks(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    items = spark.createDataFrame([*ITEMS, (None, "x a b c")], "item_id bigint, text string")
    want = brute(TEXTS, [i for i in ITEMS if i[1] is not None])
    for block_bytes in (1 << 20, 40):
        for r in search(docs, items, ("doc_id",), block_bytes=block_bytes).collect():
            assert (r.n_words, sum(s.hi - s.lo for s in r.spans), r["items"]) == want[r.doc_id]


def test_words_and_spans():
    for text in TEXTS:
        assert [w.decode() for w in words_of(text)] == plain_words(text)
    assert joined([(5, 7), (0, 2), (2, 3), (6, 9)]) == [(0, 3), (5, 9)]


def test_matcher_moves_past_no_occurrence():
    pick = random.Random(3)
    for length in (1, 2, 3, 10):
        text = np.array([pick.randrange(3) for _ in range(3000)], np.int32)
        patterns = [text[at : at + length] for at in (5, 700, 2000, 700)] + [np.full(length, 9, np.int32)]
        words, starts = np.concatenate(patterns), np.arange(len(patterns)) * length
        want = [
            (at, [int(s) for s, p in zip(starts, patterns) if (p == text[at : at + length]).all()])
            for at in range(3000 - length + 1)
        ]
        found = [(at, sorted(s.tolist())) for at, s in Matcher(length, words, starts, 10).find(text.tolist(), lambda x: x)]
        assert found == [(at, some) for at, some in want if some]


def test_tables_of_a_large_block_are_small():
    """Random words, the worst case: under 60 bytes of arrays for a word of the benchmark."""
    pick = np.random.default_rng(4)
    words = np.array([f"w{i}" for i in range(50_000)])
    items = [(i, " ".join(words[pick.integers(0, 50_000, 500)])) for i in range(400)]
    made = Benchmark(items, 10)
    arrays = [a for m in made.matchers for a in (m.words, m.shift_blocks, m.shifts, m.suffixes, m.starts)]
    assert sum(a.nbytes for a in arrays) < 60 * 200_000
    text = f"x y {' '.join(items[7][1].split()[100:112])} z"
    (matcher,) = made.matchers
    hits = [(at, made.items_of(s)) for at, s in matcher.find(words_of(text), made.ids.get)]
    assert hits == [(2, {7}), (3, {7}), (4, {7})]


def test_edges(spark, edges, clashing, nothing):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    rows = search(edges, items, ("doc_id",)).collect()
    assert len(rows) == edges.count()
    assert {r.n_words for r in rows if r.doc_id in (3, 4, 5)} == {0}
    assert sorted(map(str, search(clashing, items, ("doc_id",)).collect())) == sorted(map(str, rows))
    assert search(nothing, items, ("doc_id",)).count() == 0
    assert all(not r.spans for r in search(edges, none, ("doc_id",)).collect())
    assert clean_documents(edges, none).count() == edges.count()
    assert clean_documents(clashing, items).columns == list(DOCUMENT_COLUMNS)
