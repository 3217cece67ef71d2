"""Licence scans: a generalised suffix automaton over the words of licence wordings.

A text is streamed through the automaton, word by word. After each word the state and
a length say which is the longest run of words ending there that stands in some wording
(the matching statistics), and, through the suffix links, which phrases end there. Runs
that cannot be continued and are long enough are matches; matches that follow each other
both in the text and in one wording are chained into spans, and a span that covers
enough of its wording gives the text that wording's label.

The wordings are few and fixed, so the automaton is small and travels with the task; a
text is read once, where it lies, in pieces of bounded size. No shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from badgeflow.llm.common import table
from badgeflow.llm.decontaminate import WORD_BYTES
from badgeflow.llm.licence_texts import PHRASES, TEMPLATES

# A match of fewer words says nothing about a licence.
MATCH_WORDS = 4
# Words that may be missing or added between two matches of one span.
GAP_WORDS = 12
# Share of a wording that a span must cover to give its label.
COVER = 0.75
# Bytes of text that are split into words at a time.
PIECE_BYTES = 1 << 20


def pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of a text in order, some at a time; no word is cut."""
    start = 0
    while start < len(text):
        end = start + size
        while end < len(text) and WORD_BYTES[text[end]] != 0x20:
            end += 1
        yield text[start:end].translate(WORD_BYTES).split()
        start = end


class SuffixAutomaton:
    """All runs of all sequences: each state is a set of runs with the same ends."""

    def __init__(self, sequences: Iterable[list]):
        self.next: list[dict] = [{}]
        self.link = [0]
        self.length = [0]
        for sequence in sequences:
            last = 0
            for symbol in sequence:
                last = self._extend(last, symbol)

    def _add(self, length: int, link: int, after: dict) -> int:
        self.next.append(dict(after))
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state: int, symbol, target: int) -> int:
        """A state for the runs of target that are as long as state allows, and no longer."""
        made = self._add(self.length[state] + 1, self.link[target], self.next[target])
        self.link[target] = made
        while self.next[state].get(symbol) == target:
            self.next[state][symbol] = made
            if state == 0:
                break
            state = self.link[state]
        return made

    def _extend(self, last: int, symbol) -> int:
        target = self.next[last].get(symbol)
        if target is not None:  # another sequence has been here
            return target if self.length[target] == self.length[last] + 1 else self._split(last, symbol, target)
        made = self._add(self.length[last] + 1, 0, {})
        state = last
        while symbol not in self.next[state]:
            self.next[state][symbol] = made
            if state == 0:
                return made
            state = self.link[state]
        target = self.next[state][symbol]
        exact = self.length[target] == self.length[state] + 1
        self.link[made] = target if exact else self._split(state, symbol, target)
        return made

    def ancestors(self, state: int) -> Iterator[int]:
        """The state and those of its shorter suffixes, without the root."""
        while state:
            yield state
            state = self.link[state]

    def walk(self, sequence: list) -> Iterator[int]:
        """The states of a sequence's beginnings."""
        state = 0
        for symbol in sequence:
            state = self.next[state][symbol]
            yield state


@dataclass(frozen=True)
class Span:
    """Words first..first+words-1 of a text, that cover so many words of a wording."""

    template: int
    first: int
    words: int
    covered: int
    share: float


class Scanner:
    """Finds wordings (label, text) and the places of phrases (phrase, label)."""

    def __init__(
        self,
        templates: list[tuple[str, str]] = TEMPLATES,
        phrases: list[tuple[str, str]] = PHRASES,
        match_words: int = MATCH_WORDS,
        gap_words: int = GAP_WORDS,
        cover: float = COVER,
    ):
        self.match_words, self.gap_words, self.cover = match_words, gap_words, cover
        split = lambda text: text.encode().translate(WORD_BYTES).split()
        self.labels = [label for label, _ in templates]
        self.phrase_labels = [label for _, label in phrases]
        wordings, named = [split(text) for _, text in templates], [split(text) for text, _ in phrases]
        words = dict.fromkeys(word for each in wordings + named for word in each)
        self.ids = {word: number for number, word in enumerate(words)}
        sequences = [[self.ids[word] for word in each] for each in wordings + named]
        self.sizes = [len(each) for each in wordings]
        self.automaton = SuffixAutomaton(sequences)
        states = len(self.automaton.next)
        # Where in the wordings the runs of a state end, of the states that can be matches.
        self.places: list[list[tuple[int, int]]] = [[] for _ in range(states)]
        for template, sequence in enumerate(sequences[: len(wordings)]):
            for end, state in enumerate(self.automaton.walk(sequence), 1):
                for holder in self.automaton.ancestors(state):
                    if self.automaton.length[holder] >= match_words:
                        self.places[holder].append((template, end))
        # Phrases that end where a state's runs end, with the length a run needs to hold them.
        at: dict[int, list[tuple[int, int]]] = {}
        for phrase, sequence in enumerate(sequences[len(wordings) :]):
            if sequence:
                *_, state = self.automaton.walk(sequence)
                at.setdefault(state, []).append((phrase, len(sequence)))
        self.phrases = [
            tuple(found for holder in self.automaton.ancestors(state) for found in at.get(holder, ())) for state in range(states)
        ]

    def stream(self, text: bytes) -> tuple[int, list[tuple[int, int]], list[tuple[int, int, int]]]:
        """(words, places of phrases as (start, phrase), matches as (end, words, state)).

        A match is a run that the next word does not continue; matches may overlap.
        """
        get, floor = self.ids.get, self.match_words
        after, link, length, phrases = self.automaton.next, self.automaton.link, self.automaton.length, self.phrases
        found, matches = [], []
        at = state = size = 0
        for words in pieces(text):
            for symbol in map(get, words):
                if symbol is None:
                    if state:
                        if size >= floor:
                            matches.append((at, size, state))
                        state = size = 0
                    at += 1
                    continue
                step = after[state].get(symbol)
                if step is None:
                    if size >= floor:
                        matches.append((at, size, state))
                    while step is None:  # the root continues with every word of a wording
                        state = link[state]
                        size = length[state]
                        step = after[state].get(symbol)
                state = step
                size += 1
                at += 1
                if phrases[state]:
                    found += [(at - need, phrase) for phrase, need in phrases[state] if size >= need]
        if size >= floor:
            matches.append((at, size, state))
        return at, found, matches

    def chains(self, matches: list[tuple[int, int, int]]) -> list[Span]:
        """Spans of every wording: matches in order in the text and in the wording, with
        small gaps, so chained that they cover the most words of the wording."""
        anchors: dict[int, list[tuple[int, int, int]]] = {}
        for end, size, state in matches:
            for template, place in self.places[state]:
                anchors.setdefault(template, []).append((end, place, size))
        spans = []
        for template, own in anchors.items():
            own.sort()
            spans += self._chain(template, own)
        return spans

    def _chain(self, template: int, own: list[tuple[int, int, int]]) -> Iterator[Span]:
        """own: (end in the text, end in the wording, words), in order."""
        covered, before, start = [size for _, _, size in own], [-1] * len(own), 0
        for i, (end, place, size) in enumerate(own):
            # Nothing that ends so far ahead of this match can be followed by it.
            while end - size - own[start][0] > self.gap_words:
                start += 1
            for j in range(start, i):
                end_j, place_j, size_j = own[j]
                if not (end_j < end and place_j < place and end_j - size_j < end - size and place_j - size_j < place - size):
                    continue
                if place - size - place_j > self.gap_words:
                    continue
                gained = covered[j] + min(size, end - end_j, place - place_j)
                if gained > covered[i]:
                    covered[i], before[i] = gained, j
        used = [False] * len(own)
        for i in sorted(range(len(own)), key=lambda i: (-covered[i], i)):
            first = last = i
            while last >= 0 and not used[last]:
                used[last] = True
                first, last = last, before[last]
            if last >= 0:  # the beginning belongs to a longer span
                continue
            begin = own[first][0] - own[first][2]
            yield Span(template, begin, own[i][0] - begin, covered[i], covered[i] / self.sizes[template])

    def spans(self, matches: list[tuple[int, int, int]]) -> list[Span]:
        """The best spans: of those that lie mostly within a better one, none."""
        chosen: list[Span] = []
        group: list[Span] = []
        reach = 0
        for span in sorted(self.chains(matches), key=lambda s: (s.first, s.template)):
            if group and span.first >= reach:
                chosen += self._best(group)
                group, reach = [], 0
            group.append(span)
            reach = max(reach, span.first + span.words)
        return chosen + self._best(group)

    @staticmethod
    def _best(group: list[Span]) -> list[Span]:
        """Of spans that touch each other."""
        kept: list[Span] = []
        for span in sorted(group, key=lambda s: (-s.covered, -s.share, s.first, s.template)):
            shared = (min(span.first + span.words, k.first + k.words) - max(span.first, k.first) for k in kept)
            if all(2 * words <= span.words for words in shared):
                kept.append(span)
        return sorted(kept, key=lambda s: s.first)


SPAN = "struct<label: string, first_word: bigint, n_words: bigint, covered: bigint, share: double>"
SCANNED = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint,"
    f" base_labels array<string>, spans array<{SPAN}>"
)


def scan(docs: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """A row a document: its words, the places of phrases, and the spans of wordings.

    NULL and empty texts have no words and no spans; a text of any length is read in
    pieces, and matches run on across them. Rows that repeat a doc_id, or have none, are
    each a row of the result. Columns other than doc_id and text are not read, and an
    empty table gives an empty one. Of two wordings that a place covers equally well,
    the one that is covered to the larger share stands, then the first of the list.
    """
    scanner = scanner or Scanner()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct(
            [("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("covered", pa.int64()), ("share", pa.float64())]
        )
        schema = pa.schema(
            [(name, pa.int64()) for name in ("doc_id", "n_words", "n_base", "first_word", "last_word")]
            + [("base_labels", pa.list_(pa.string())), ("spans", pa.list_(span))]
        )
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch[0].to_pylist(), batch[1]):
                words, found, matches = scanner.stream(text.as_py() or b"")
                starts = [start for start, _ in found]
                rows.append(
                    {
                        "doc_id": doc_id,
                        "n_words": words,
                        "n_base": len(found),
                        "first_word": min(starts, default=None),
                        "last_word": max(starts, default=None),
                        "base_labels": sorted({scanner.phrase_labels[phrase] for _, phrase in found}),
                        "spans": [
                            {
                                "label": scanner.labels[s.template],
                                "first_word": s.first,
                                "n_words": s.words,
                                "covered": s.covered,
                                "share": s.share,
                            }
                            for s in scanner.spans(matches)
                        ],
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, SCANNED)


def labelled(scanned: DataFrame, cover: float = COVER) -> DataFrame:
    """With the labels of phrases and of spans that cover enough, and the best share.

    The score is the largest share of a wording that a span covers; a text that only
    names a licence (a phrase without its wording) has 0.5 at least.
    """
    enough = F.transform(F.filter("spans", lambda s: s.share >= cover), lambda s: s.label)
    best = F.coalesce(F.array_max(F.transform("spans", lambda s: s.share)), F.lit(0.0))
    return scanned.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_labels", enough)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.greatest(best, F.lit(0.5))).otherwise(best).alias("score"),
    )


def op11_licences(spark, sf_dir: str) -> DataFrame:
    """Places of licence names, and licences recognised by their wording, in all documents."""
    return labelled(scan(table(spark, sf_dir, "documents")))
