"""Matching statistics, phrases and spans against plain searches of the same texts."""

import random
import re

import pytest

from badgeflow.llm.licences import SuffixAutomaton, Scanner, labelled, pieces, scan
from badgeflow.llm.licence_texts import PHRASES

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(WORD, lower)


def places_of(words):
    """Every place of every phrase, by comparing at each word."""
    found = []
    for phrase, label in PHRASES:
        need = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(need)] == need]
    return found


def longest_ending(runs, sequence, end):
    for size in range(end, 0, -1):
        if tuple(sequence[end - size : end]) in runs:
            return size
    return 0


def test_matching_statistics_are_the_longest_runs():
    pick = random.Random(3)
    for _ in range(60):
        sources = [[pick.randrange(3) for _ in range(pick.randrange(1, 12))] for _ in range(pick.randrange(1, 5))]
        made = SuffixAutomaton(sources)
        runs = {tuple(s[i:j]) for s in sources for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        # Every state's runs are those of one set of ends, so the states count the sets.
        ends = {}
        for run in runs:
            at = frozenset((n, i + len(run)) for n, s in enumerate(sources) for i in range(len(s)) if tuple(s[i : i + len(run)]) == run)
            ends.setdefault(at, []).append(len(run))
        reached = {0}
        for run in runs:
            state = 0
            for symbol in run:
                state = made.next[state][symbol]
            reached.add(state)
        assert len(reached) == len(ends) + 1
        names = [(f"l{n}", " ".join(f"w{x}" for x in s)) for n, s in enumerate(sources)]
        scanner = Scanner(names, [], match_words=1)
        text = [pick.randrange(4) for _ in range(40)]
        _, _, matches = scanner.stream(" ".join(f"w{x}" for x in text).encode())
        sizes = [longest_ending(runs, text, end) for end in range(1, len(text) + 1)]
        whole = [
            (end, size) for end, size in enumerate(sizes, 1) if size and (end == len(text) or sizes[end] != size + 1)
        ]
        assert [(end, size) for end, size, _ in matches] == whole
        for end, size, state in matches:
            found = {(n, i + size) for n, s in enumerate(sources) for i in range(len(s)) if s[i : i + size] == text[end - size : end]}
            assert set(scanner.places[state]) == found


def best_chain(own, gap, size):
    """Most words of a wording that any chain of these matches covers, by trying all."""
    best = 0

    def go(chain, covered):
        nonlocal best
        best = max(best, covered)
        end, place, words = chain
        for e, p, w in own:
            if e > end and p > place and e - w > end - words and p - w > place - words:
                if e - w - end <= gap and p - w - place <= gap:
                    go((e, p, w), covered + min(w, e - end, p - place))

    for one in own:
        go(one, one[2])
    return best / size


def test_chains_cover_the_most():
    pick = random.Random(5)
    for _ in range(80):
        wording = [f"w{pick.randrange(6)}" for _ in range(14)]
        scanner = Scanner([("x", " ".join(wording))], [], match_words=2, gap_words=3, cover=0.5)
        text = [w if pick.random() < 0.8 else "none" for w in wording] + ["other"] * pick.randrange(3) + wording[: pick.randrange(14)]
        _, _, matches = scanner.stream(" ".join(text).encode())
        own = [(end, place, size) for end, size, state in matches for _, place in scanner.places[state]]
        spans = scanner.chains(matches)
        assert max((s.share for s in spans), default=0) == pytest.approx(best_chain(own, 3, 14))
        for span in spans:
            assert 0 < span.share <= 1 and 0 <= span.first and span.first + span.words <= len(text)


def test_pieces_cut_no_word():
    text = "Mit Licensé, über 9-lives\nx" * 50
    for size in (1, 2, 7, 64, 10_000):
        assert [w for part in pieces(text.encode(), size) for w in part] == [w.encode() for w in words_of(text)]


def rows_of(frame):
    return {row.doc_id: row for row in labelled(scan(frame)).collect()}


def test_base_places_by_brute_force(spark, sf_dir):
    from badgeflow.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in QUERIES["op11_licences"](spark, sf_dir).collect()}
    assert got.keys() == texts.keys()
    for doc_id, text in texts.items():
        words, row = words_of(text), got[doc_id]
        found = places_of(words)
        assert (row.n_words, row.n_base) == (len(words), len(found))
        assert (row.first_word, row.last_word) == (min((i for i, _ in found), default=None), max((i for i, _ in found), default=None))
        assert row.base_labels == ",".join(sorted({label for _, label in found}))
        assert set(row.base_labels.split(",")) - {""} <= set(row.labels.split(","))
        assert 0 <= row.score <= 1
        for sign, label in (("Licensed under CC BY-NC 4.0.", "cc-by-nc"), ("Released under the MIT License.", "mit")):
            assert (label in row.labels.split(",")) == (sign in (text or ""))


def test_wordings(spark):
    texts = [
        (1, "Copyright X\n\nPermission is hereby granted, free of charge, to any individual obtaining a copy of this software and"
            " associated documentation files (the 'Software'), to deal in the Software without restriction, including without"
            " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
            " Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
            " the above copyright notice and this permission notice shall be included in all copies or substantial portions of it."),
        (2, "a book on the MIT license and the Mit  LICENSE, mit licenses not"),
        (3, "the of to any this in"),
        (4, "Distributed under the terms of the GNU Lesser General Public License, version 3. Licensed under CC BY-SA 4.0"),
        (5, "mit apache license"),
    ]
    got = rows_of(spark.createDataFrame(texts, "doc_id bigint, text string"))
    assert (got[1].labels, got[1].base_labels, got[1].n_base) == ("mit", "", 0) and got[1].score > 0.9
    assert (got[2].labels, got[2].n_base, got[2].first_word, got[2].last_word, got[2].score) == ("mit", 2, 4, 8, 0.5)
    assert (got[3].labels, got[3].score) == ("", 0.0)
    assert got[4].labels == "cc-by-sa,gpl,lgpl" and got[4].base_labels == "gpl" and got[4].score == 1.0
    assert (got[5].labels, got[5].first_word) == ("apache", 1)


def test_edges(spark, edges, nothing, clashing):
    assert labelled(scan(nothing)).collect() == []
    got = labelled(scan(edges)).collect()
    assert len(got) == edges.count() and sorted(map(tuple, got), key=repr) == sorted(map(tuple, labelled(scan(clashing)).collect()), key=repr)
    empty = [r for r in got if r.doc_id in (3, 4, 5)]
    assert all((r.n_words, r.n_base, r.first_word, r.labels, r.score) == (0, 0, None, "", 0.0) for r in empty)


def test_long_text_across_pieces():
    """Matches and places run on where one piece of a long text ends and the next begins."""
    filler, line = "lorem " * 300_000, "Released under the MIT License. "
    text = (filler + line) * 3
    words, found, matches = Scanner().stream(text.encode())
    assert words == 3 * 300_005 and [start for start, _ in found] == [300_003 + 300_005 * i for i in range(3)]
    spans = Scanner().spans(matches)
    assert [(s.first, s.words, s.share) for s in spans] == [(300_000 + 300_005 * i, 5, 1.0) for i in range(3)]
