import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from badgeflow.llm import ngram_join
from badgeflow.llm.common import DOCUMENT_COLUMNS
from badgeflow.llm.components import components
from badgeflow.llm.ngram_join import Answers, Groups, join_documents, join_group, one_of_each, op9_ngram_join, shingle_sets

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_set(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate(LOWER)) if w]
    return frozenset(tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))) if words else frozenset()


def brute(docs):
    """{doc_id: (n_shingles, component_id)} by comparing all pairs that share a shingle."""
    sets = {i: plain_set(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    pairs = {(a, b) for ids in holders.values() for a in ids for b in ids if a < b}
    for a, b in pairs:
        shared = len(sets[a] & sets[b])
        if 100 * shared >= 85 * len(sets[a] | sets[b]):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: (len(sets[i]), root(i)) for i in sets}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_whole_table(spark, sf_dir, corpus):
    assert found(op9_ngram_join(spark, sf_dir)) == brute(corpus)


def chained_texts(n=70, seed=4):
    """Chains of texts, each a few words from the last; many share one long passage."""
    pick = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(60))
    out = []
    for chain in range(6):
        words = [f"w{pick.randrange(4000)}" for _ in range(pick.choice([4, 30, 120]))]
        for _ in range(n // 6):
            words = list(words)
            for _ in range(pick.randrange(3)):
                words[pick.randrange(len(words))] = f"x{pick.randrange(10**6)}"
            out.append(" ".join(words) if chain % 2 else " ".join(words) + " " + passage)
    out += [passage.upper(), passage, passage + "\n", "a b c", "A  b\tc", "a b", "", None, " \n"]
    return list(enumerate(out, 1))


@pytest.mark.parametrize("paired, bound", [(64, 2_000_000), (1, 2_000_000), (3, 300)])
def test_chains_passages_and_blocks(spark, monkeypatch, paired, bound):
    monkeypatch.setattr(ngram_join, "PAIRED", paired)
    monkeypatch.setattr(ngram_join, "GROUP_SHINGLES", bound)
    docs = chained_texts()
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert found(join_documents(df, group_shingles=bound)) == brute(docs)


def test_join_group_equals_all_pairs():
    pick = np.random.default_rng(8)
    for turn in range(30):
        base = pick.integers(0, 10**6, 60).astype(np.uint64)
        sets = []
        for _ in range(25):
            change = pick.random(60) < pick.choice([0.0, 0.03, 0.08, 0.3])
            some = np.where(change, pick.integers(0, 10**6, 60).astype(np.uint64), base)
            sets.append(np.unique(some[: pick.integers(1, 61)]))
        got = join_group(sets)
        want = join_group([], None)
        want = ngram_join.Groups(len(sets))
        for a in range(len(sets)):
            for b in range(a):
                shared = len(np.intersect1d(sets[a], sets[b]))
                if 100 * shared >= 85 * (len(sets[a]) + len(sets[b]) - shared):
                    want.join(a, b)
        same = lambda g: {frozenset(i for i in range(25) if g.root(i) == g.root(j)) for j in range(25)}
        assert same(got) == same(want)


def test_shingles_equal_the_plain_ones():
    texts = ["a b c d e", "A B C D E", "a  b\tc\nd\x0be", "x a b c d", "a b", "b a", "a", "ab", "", None, "ü ñ 漢 字", "a b c d a b c d", "aé b c d"]
    array = pa.array([t or "" for t in texts], pa.string())
    sets = list(shingle_sets(array)) + list(shingle_sets(array.slice(2, 3)))
    texts += texts[2:5]
    for i, a in enumerate(texts):
        assert len(sets[i]) == len(plain_set(a))
        for j, b in enumerate(texts):
            assert len(np.intersect1d(sets[i], sets[j])) == len(plain_set(a) & plain_set(b)), (a, b)


def test_pieces_change_nothing(monkeypatch):
    pick = random.Random(6)
    texts = pa.array([" ".join(f"w{pick.randrange(99)}" for _ in range(pick.randrange(60))) for _ in range(50)])
    whole = [s.tolist() for s in shingle_sets(texts)]
    monkeypatch.setattr(ngram_join, "PIECE_BYTES", 100)
    assert [s.tolist() for s in shingle_sets(texts)] == whole


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 300), (7, 7), (400, 399)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100, 300: 100, 399: 399, 400: 399}
    assert components(df.limit(0)).count() == 0


def test_edges(edges, clashing, nothing):
    rows = join_documents(edges).collect()
    assert len(rows) == edges.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[2].component_id == by_id[1].component_id == 1
    assert by_id[8].component_id == 7 and by_id[10].component_id == 10
    assert [(by_id[i].n_shingles, by_id[i].component_id) for i in (3, 4, 5)] == [(0, 3), (0, 4), (0, 5)]
    assert all(r.component_id is None for r in rows if r.doc_id is None)
    assert sorted(map(str, join_documents(clashing).collect())) == sorted(map(str, rows))
    assert join_documents(nothing).count() == 0


def test_one_document_of_each_group_stays(edges, clashing, nothing):
    kept = [r.doc_id for r in one_of_each(edges).collect()]
    assert sorted(i for i in kept if i is not None) == [-9, 1, 3, 4, 5, 6, 7, 10, 11, 2**62]
    assert kept.count(None) == 2
    assert one_of_each(clashing.select(*DOCUMENT_COLUMNS)).count() == len(kept)
    assert one_of_each(nothing).count() == 0


def test_answers_derived_from_a_similar_set():
    """Families of near copies that share half of their shingles with other families: most
    answers of a copy come from another copy's, and the links are those of all pairs."""
    pick = random.Random(6)
    core = list(range(1, 60))
    sets = []
    for _ in range(12):
        base = core + pick.sample(range(1000, 1040), 9)
        for _ in range(8):
            gone = set(pick.sample(base, pick.randrange(2)))
            come = [pick.randrange(10**6, 10**7) for _ in range(pick.randrange(2))]
            sets.append(np.array(sorted(set(base) - gone | set(come)), np.uint64))
    links = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b))
    got = join_group(sets)
    parent = Groups(len(sets))
    for a in range(len(sets)):
        for b in range(a):
            if links(sets[a], sets[b]):
                parent.join(a, b)
    same = lambda groups: {(a, b) for a in range(len(sets)) for b in range(a) if groups.root(a) == groups.root(b)}
    assert same(got) == same(parent)
    assert got.told + got.derived > 0
    # What every answer says is what comparing the two sets says.
    tokens, numbers = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum([0] + [len(s) for s in sets])
    ranked = [np.sort(numbers[a:b]) for a, b in zip(ends[:-1], ends[1:])]
    mark = np.zeros(len(tokens), bool)
    groups = Groups(len(sets))
    answers = Answers(ranked, mark, groups)
    for x in range(len(sets)):
        mark[:] = False
        mark[ranked[x]] = True
        answers.begin(x)
        for y in reversed(range(x)):
            assert answers.linked(y) == links(sets[x], sets[y])
        answers.end()
    pairs = len(sets) * (len(sets) - 1) // 2
    assert groups.compared + groups.told + groups.derived == pairs and groups.compared < pairs / 2
