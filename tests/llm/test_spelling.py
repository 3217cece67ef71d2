"""Near words, forms and roots against a comparison of all words with all."""

import random
import re
import zlib

import pytest

from badgeflow.llm import spelling as S


def edited(a, b):
    """Edit distance of two strings."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, above + (x != y))
    return row[-1]


def brute_force(words, ratio=S.RATIO):
    """words: word -> n. Rows as the query returns them."""
    near = {a: [b for b in words if abs(len(a) - len(b)) < 2 and edited(a, b) == 1] for a in words}
    best = {a: min(near[a], key=lambda b: (-words[b], b), default=None) for a in words}
    form = {a: b if b is not None and words[b] >= ratio * words[a] else None for a, b in best.items()}

    def root(a):
        while form[a] is not None:
            a = form[a]
        return a

    return sorted(((a, form[a], root(a), n, len(near[a]), words.get(form[a])) for a, n in words.items()), key=repr)


def counted(rows, least_chars=S.LEAST_CHARS, least_count=S.LEAST_COUNT, loses=S.LOSES):
    """rows: (doc_id, text). Words and their counts, a run at a time."""
    words = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % loses == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least_chars:
                words[run] = words.get(run, 0) + 1
    return {word: n for word, n in words.items() if n >= least_count}


def some_words(seed, number, letters="abcé", longest=9):
    pick = random.Random(seed)
    words = {}
    while len(words) < number:
        size = pick.randrange(3, longest)
        words["".join(pick.choice(letters) for _ in range(size))] = 5 ** pick.randrange(1, 7) + pick.randrange(3)
    return words


def collected(frame):
    return sorted(map(tuple, frame.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


def frame_of(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n bigint")


def test_near_is_distance_one():
    pick = random.Random(1)
    for _ in range(4000):
        a = "".join(pick.choice("abc") for _ in range(pick.randrange(7)))
        b = "".join(pick.choice("abc") for _ in range(pick.randrange(7)))
        assert S.near(a.encode(), b.encode()) == (edited(a, b) == 1)


@pytest.mark.parametrize("groups, node_words, leaf_words", [(1, 0, 2), (3, 2, 1), (16, 12, 24), (16, 1, 1000)])
def test_trie_asks_each_pair_once(monkeypatch, groups, node_words, leaf_words):
    monkeypatch.setattr(S, "NODE_WORDS", node_words)
    monkeypatch.setattr(S, "LEAF_WORDS", leaf_words)
    words = [w.encode("latin-1") for w in some_words(2, 400)]
    trie = S.CountTrie(groups)
    for n, word in enumerate(words):
        trie.add(word, n)
    found, looked = [], 0
    for word in words:
        for other, n in trie.candidates(word):
            assert words[n] == other
            looked += 1
            if S.near(word, other) and S.asks(word, other, groups):
                found.append(frozenset((word, other)))
    want = {frozenset((a, b)) for a in words for b in words if a < b and edited(a, b) == 1}
    assert len(found) == len(set(found)) and set(found) == want
    assert groups == 1 or looked < len(words) ** 2 / 2


@pytest.mark.parametrize(
    "groups, upper, key_words", [(16, 5, 20_000), (16, 5, 1), (4, 2, 3), (16, 0, 1), (3, 3, 1), (1, 1, 1), (16, 16, 20_000)]
)
def test_variants_by_brute_force(spark, groups, upper, key_words):
    words = some_words(groups * 100 + upper, 500)
    got = S.variants(frame_of(spark, words), groups=groups, upper=upper, key_words=key_words)
    assert collected(got) == brute_force(words)


def test_forms_in_a_row_and_ties(spark):
    words = {"colour" + "x" * i: 5**i for i in range(1, 14)}
    words |= {"aaaaab": 5, "aaaaac": 25, "aaaaad": 25, "aaaaae": 24, "alonealone": 7, "éclair": 5, "eclair": 24, "éclaira": 25}
    got = {row[0]: row for row in collected(S.variants(frame_of(spark, words)))}
    assert list(got.values()) == brute_force(words)
    assert got["colourx"][2] == "colour" + "x" * 13
    assert got["aaaaab"][1:] == ("aaaaac", "aaaaac", 5, 3, 25)
    assert got["alonealone"][1:] == (None, "alonealone", 7, 0, None)


def test_very_long_words(spark):
    long = "ab" * 100_000
    words = {long: 5, long + "c": 50, "c" + long: 50, long[1:]: 4, "x" * 50_000: 9, "x" * 49_999 + "y": 99}
    got = {row[0]: row for row in collected(S.variants(frame_of(spark, words), key_words=1))}
    assert got[long][1] == long + "c" and got[long][4] == 3
    assert got["x" * 50_000][2] == "x" * 49_999 + "y"


def test_counts_by_brute_force(spark, corpus):
    words = counted(corpus)
    assert words and any(len(w) != len(w.encode()) for w in words)
    docs = spark.createDataFrame(corpus, "doc_id bigint, text string")
    assert {r.word: r.n for r in S.counted(docs).collect()} == words
    few = S.counted(docs, least_chars=3, least_count=2, loses=3)
    assert {r.word: r.n for r in few.collect()} == counted(corpus, 3, 2, 3)


def test_edges(spark, edges, nothing, clashing):
    assert S.spelling_variants(nothing).collect() == []
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    want = brute_force(counted(rows, 3, 1))
    assert collected(S.spelling_variants(edges, 3, 1)) == want == collected(S.spelling_variants(clashing, 3, 1))
    # What Latin-1 does not have, or has between the two ranges, parts words.
    odd = [(1, "Straßen×÷ÿĀnextµwords中\U0001f600END??tail")] * 5
    assert counted(odd, 3) == {r.word: r.n for r in S.counted(spark.createDataFrame(odd, "doc_id bigint, text string"), 3).collect()}


def test_counts_passed_on_early(spark, corpus, monkeypatch):
    docs = spark.createDataFrame(corpus[:40], "doc_id bigint, text string")
    monkeypatch.setattr(S, "COUNTED", 10)
    assert {r.word: r.n for r in S.counted(docs, 3, 2).collect()} == counted(corpus[:40], 3, 2)
