"""Groups of spelling variants: near words found in a trie of letter-group counts.

Letters are dealt to groups, and a word is described by how many letters of each group it
has. One replaced letter takes one from a group and gives one to another (or to the same);
an inserted letter gives one. So in a trie that arranges words by their successive counts,
the words near a given one are reached by a depth-first search that follows equal counts
but for a budget of one surplus and one deficit; the words at the leaves it reaches are
verified letter by letter.

The upper levels of the trie are the key by which words are dealt to tasks, each task
holding the lower levels for its keys. A word is sent, as a question, to the keys that its
budget can reach. Each pair is asked for once: the shorter word asks for the longer, and
of two as long as each other that which lacks a letter of the earlier group. Keys with
very many words are dealt further by halves of the word, of which a single change leaves
one as it was.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from badgeflow.llm.common import stored, table

LEAST_CHARS = 6
LEAST_COUNT = 5
# A word's form has at least so many times its occurrences.
RATIO = 5
# One run in so many loses a letter before it is counted.
LOSES = 199
GROUPS = 16
# Levels of the trie above those that a task holds.
UPPER = 5
# Words under one key of the upper levels; beyond, they are dealt by halves as well. No
# more than KEYS such keys are ever listed.
KEY_WORDS = 20_000
KEYS = 50_000
# Distinct words that a task counts before it passes the counts on.
COUNTED = 200_000
# Words at a leaf that are looked through one by one; of more, only those with an equal half.
LEAF_WORDS = 24
# Words that a node of the trie holds before it is divided.
NODE_WORDS = 12

# In Latin-1 a letter of the alphabet here is one byte; all else, and what Latin-1 does not
# have (written as "?"), parts words.
LETTER_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256)
)


def runs(text: str | None) -> list[bytes]:
    """Runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z lower-cased, in Latin-1."""
    return (text or "").encode("latin-1", "replace").translate(LETTER_BYTES).split()


def worn(run: bytes, seed: int, loses: int) -> bytes:
    """The run, or, for one in ``loses``, the run without one letter.

    seed: the checksum of what stands before the run, the document's id and a colon.
    """
    mark = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if mark % loses:
        return run
    at = mark % len(run)
    return run[:at] + run[at + 1 :]


def counted(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, loses: int = LOSES) -> DataFrame:
    """(word, n): runs of all texts, some without a letter, that are long and frequent enough.

    A run is judged by its document and letters, so all its places in one document are
    alike. Each task sums what it reads before the shuffle; NULL texts have no runs, and a
    missing doc_id is written as nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter[bytes] = Counter()

        def given() -> pa.RecordBatch:
            words = [word.decode("latin-1") for word in totals]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(totals.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch[0].to_pylist(), batch[1]):
                seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(runs(text.as_py())).items():
                    if len(word) >= least_chars and len(word := worn(word, seed, loses)) >= least_chars:
                        totals[word] += n
                if len(totals) >= COUNTED:
                    yield given()
                    totals.clear()
        yield given()

    parts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def vector(word: bytes, groups: int = GROUPS) -> tuple[int, ...]:
    """How many letters of each group a word has. Letters that follow each other in the
    alphabet are in different groups."""
    counts = [0] * groups
    for letter in word:
        counts[letter % groups] += 1
    return tuple(counts)


def near(a: bytes, b: bytes) -> bool:
    """Whether one inserted, deleted or replaced letter turns one into the other."""
    if len(a) > len(b):
        a, b = b, a
    more, half = len(b) - len(a), len(a) // 2
    if more > 1 or (a[:half] != b[:half] and a[half:] != b[half + more :]) or a == b:
        return False
    same = 0
    while same < len(a) and a[same] == b[same]:
        same += 1
    return a[same + 1 - more :] == b[same + 1 :]


def halves(word: bytes, longer: int) -> tuple[bytes, bytes]:
    """Beginning and end of a word, as they are cut in the shorter word of a pair: this
    one (0), or one that has a letter less (1). A single change leaves one of them."""
    size = len(word) - longer
    return word[: size // 2], word[len(word) - (size - size // 2) :]


def asks(a: bytes, b: bytes, groups: int = GROUPS) -> bool:
    """Whether of two near words a asks for b: the shorter one, or the one that lacks a
    letter of the earlier group, or the first."""
    if len(a) != len(b):
        return len(a) < len(b)
    counts, others = vector(a, groups), vector(b, groups)
    return (counts, a) < (others, b)


class Leaf:
    """Words with the same counts; of many, those are looked at that share a half."""

    def __init__(self):
        self.words: list[tuple[bytes, int]] = []
        self.halves: dict[tuple[int, int, bytes], list[tuple[bytes, int]]] | None = None

    def candidates(self, word: bytes, longer: int) -> Iterable[tuple[bytes, int]]:
        if len(self.words) <= LEAF_WORDS:
            return self.words
        if self.halves is None:
            self.halves = {}
            for other in self.words:
                for by in (0, 1):
                    for side, half in enumerate(halves(other[0], by)):
                        self.halves.setdefault((by, side, half), []).append(other)
        head, tail = halves(word, 0)
        ends = self.halves.get((longer, 1, tail), ())
        return [*self.halves.get((longer, 0, head), ()), *(o for o in ends if o[0][: len(head)] != head)]


class CountTrie:
    """Words by the counts of one letter group after another. Below a node of few words
    there are no levels: they are kept as they are until there are more."""

    def __init__(self, groups: int = GROUPS, skip: int = 0):
        """skip: upper levels that the words here are known to have in common."""
        self.groups, self.skip = groups, skip
        self.root: dict | list | Leaf = [] if skip < groups else Leaf()

    def add(self, word: bytes, n: int) -> None:
        counts = vector(word, self.groups)
        above, node, level = None, self.root, self.skip
        while isinstance(node, dict):
            above, level = node, level + 1
            node = above.get(counts[level - 1])
        if node is None:
            node = above[counts[level - 1]] = [] if level < self.groups else Leaf()
        if isinstance(node, Leaf):
            node.words.append((word, n))
            return
        node.append((word, n, counts))
        if len(node) > NODE_WORDS:
            made = self._split(node, level)
            if above is None:
                self.root = made
            else:
                above[counts[level - 1]] = made

    def _split(self, words: list[tuple[bytes, int, tuple[int, ...]]], level: int) -> dict:
        """The words one level lower; those that are still too many in one place, further."""
        below: dict[int, list | dict | Leaf] = {}
        for entry in words:
            below.setdefault(entry[2][level], []).append(entry)
        for count, entries in below.items():
            if level + 1 == self.groups:
                leaf = Leaf()
                leaf.words = [entry[:2] for entry in entries]
                below[count] = leaf
            elif len(entries) > NODE_WORDS:
                below[count] = self._split(entries, level + 1)
        return below

    def candidates(self, word: bytes, more: int = 1, less: int = 1) -> Iterator[tuple[bytes, int]]:
        """Words at all places that a surplus and then a deficit in one group each can
        reach. Words near this one that it asks for are all among them, once."""
        counts = vector(word, self.groups)
        stack = [(self.root, self.skip, more, less)]
        while stack:
            node, level, more, less = stack.pop()
            if isinstance(node, dict):
                count = counts[level]
                if (below := node.get(count)) is not None:
                    stack.append((below, level + 1, more, less))
                if more and (below := node.get(count + 1)) is not None:
                    stack.append((below, level + 1, 0, less))
                if less and not more and (below := node.get(count - 1)) is not None:
                    stack.append((below, level + 1, 0, 0))
            elif isinstance(node, Leaf):
                yield from node.candidates(word, 1 if less and not more else 0)
            else:
                for other, n, _ in node:
                    yield other, n


def reached(counts: tuple[int, ...], upper: int) -> Iterator[tuple[tuple[int, ...], int, int]]:
    """(counts of the upper levels, surplus left, deficit left): where a word's budget leads."""
    own = counts[:upper]
    yield own, 1, 1
    for i in range(upper):
        up = own[:i] + (own[i] + 1,) + own[i + 1 :]
        yield up, 0, 1
        for j in range(i + 1, upper):
            if own[j]:
                yield up[:j] + (own[j] - 1,) + up[j + 1 :], 0, 0


def upper_key(word: Column, groups: int = GROUPS, upper: int = UPPER) -> Column:
    """The counts of the upper levels, joined by commas."""
    letters = [b for b in range(256) if LETTER_BYTES[b] != 0x20 and not 0x41 <= b <= 0x5A]
    counts = []
    for group in range(upper):
        own = bytes(b for b in letters if b % groups == group).decode("latin-1")
        counts.append((F.length(word) - F.length(F.translate(word, own, ""))).cast("string"))
    return F.concat_ws(",", *counts)


# cut: 0 for keys that are not dealt further; else 1 and 2 for the beginnings and ends of
# words as long, 3 and 4 for those of words that are longer.
DEALT = "key string, asked boolean, word string, n bigint, more int, less int, cut int"
NEAR = "word string, n_near bigint, best_n bigint, best string"


def dealt(words: DataFrame, hot: set[str], groups: int = GROUPS, upper: int = UPPER) -> DataFrame:
    """A row for each key that holds a word, and for each that the word asks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for word, n in zip(batch[0].to_pylist(), batch[1].to_pylist()):
                name = word.encode("latin-1")
                counts = vector(name, groups)
                for target, more, less in reached(counts, upper):
                    key, own = ",".join(map(str, target)), more == 1
                    if key not in hot:
                        rows.append((key, True, word, n, more, less, 0))
                        if own:
                            rows.append((key, False, word, n, 0, 0, 0))
                        continue
                    for longer in (0, 1):
                        if longer == 0 or less:
                            for side, half in enumerate(halves(name, 0)):
                                cut = 1 + 2 * longer + side
                                rows.append((f"{key}|{cut}{half.decode('latin-1')}", True, word, n, more, less, cut))
                        if own:
                            for side, half in enumerate(halves(name, longer)):
                                cut = 1 + 2 * longer + side
                                rows.append((f"{key}|{cut}{half.decode('latin-1')}", False, word, n, 0, 0, cut))
            kinds = [pa.string(), pa.bool_(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            columns = zip(*rows) if rows else [[]] * 7
            names = ["key", "asked", "word", "n", "more", "less", "cut"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    return words.select("word", "n").mapInArrow(run, DEALT)


def answered(rows: DataFrame, groups: int = GROUPS, upper: int = UPPER) -> DataFrame:
    """(word, n_near, best_n, best): of the words that a key holds, for each word that
    asked it or was found, how many are near and the most frequent of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, trie = None, CountTrie(groups, upper)
        found: dict[bytes, tuple[int, int, bytes]] = {}

        def meet(word: bytes, other: bytes, n: int) -> None:
            count, best_n, best = found.get(word, (0, 0, b""))
            if n > best_n or (n == best_n and other < best):
                best_n, best = n, other
            found[word] = count + 1, best_n, best

        def given() -> pa.RecordBatch:
            text = lambda names: pa.array([name.decode("latin-1") for name in names], pa.string())
            answers = found.values()
            return pa.RecordBatch.from_arrays(
                [text(found), pa.array([a[0] for a in answers], pa.int64()), pa.array([a[1] for a in answers], pa.int64())]
                + [text(a[2] for a in answers)],
                ["word", "n_near", "best_n", "best"],
            )

        for batch in batches:
            for key, asked, text, n, more, less, cut in zip(*(column.to_pylist() for column in batch)):
                if key != now:
                    now, trie = key, CountTrie(groups, upper)
                    if len(found) >= COUNTED:
                        yield given()
                        found.clear()
                word = text.encode("latin-1")
                if not asked:
                    trie.add(word, n)
                    continue
                half = len(word) // 2
                for other, other_n in trie.candidates(word, more, less):
                    if not near(word, other) or not asks(word, other, groups):
                        continue
                    if cut and (len(other) - len(word) != (cut > 2) or (cut % 2 == 0 and other[:half] == word[:half])):
                        continue
                    meet(word, other, other_n)
                    meet(other, word, n)
        yield given()

    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Words that a key holds come before those that ask it. The number of tasks is given,
    # as they work much longer than their bytes would suggest.
    return rows.repartition(tasks, "key").sortWithinPartitions("key", "asked").mapInArrow(run, NEAR)


def neighbours(words: DataFrame, groups: int = GROUPS, upper: int = UPPER, key_words: int = KEY_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) for the words (word, n) that have a near one; best is
    the most frequent, and of these the first by code points."""
    keyed = words.groupBy(upper_key(F.col("word"), groups, upper).alias("key")).agg(F.count("*").alias("held"))
    # Above this there cannot be more than KEYS keys.
    most = max(key_words, words.count() // KEYS)
    hot = {row.key for row in keyed.where(F.col("held") > most).collect()}
    answers = answered(dealt(words, hot, groups, upper), groups, upper)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return answers.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top")).select(
        "word", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the last word that forms lead to.

    Each round goes twice as far. A form is RATIO times as frequent as its word, so the
    longest way has as many steps as the largest count has digits to that base, and the
    rounds are few; only words that still move go into the next one.
    """
    moving = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    done: DataFrame | None = None
    while True:
        onward = moving.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if done is not None:
            onward = onward.unionByName(done.select(F.col("word").alias("root"), F.col("root").alias("next")))
        there = F.col("next").isNull().alias("there")
        went = stored(moving.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), there), "spelling-roots")
        ended = went.where("there").select("word", "root")
        done = ended if done is None else done.unionByName(ended)
        moving = went.where("NOT there").select("word", "root")
        if moving.isEmpty():
            return done


def variants(
    words: DataFrame, ratio: int = RATIO, groups: int = GROUPS, upper: int = UPPER, key_words: int = KEY_WORDS
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for the words (word, n) of one row each.

    A word's form is its most frequent near word, if that is ``ratio`` times as frequent;
    of equally frequent ones the first by code points. Words are of any length; no words
    give no rows.
    """
    kept = stored(words.select("word", "n"), "spelling-words")
    found = stored(neighbours(kept, groups, upper, key_words), "spelling-near")
    formed = F.col("best_n") >= ratio * F.col("n")
    judged = stored(
        kept.join(found, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(formed, F.col("best")).alias("form"),
            F.when(formed, F.col("best_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    ways = roots(judged.where("form IS NOT NULL"))
    return judged.join(ways, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, loses: int = LOSES) -> DataFrame:
    """Words of all texts, with the spelling that each is taken for.

    NULL and empty texts have no words; a text may be of any length, rows may repeat, and
    columns other than doc_id and text are not read. No words give an empty table.
    """
    return variants(counted(docs, least_chars, least_count, loses))


def op13_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return spelling_variants(table(spark, sf_dir, "documents"))
