"""Quality classifier: a generalised additive model with pairwise interactions.

Lou et al., "Accurate Intelligible Models with Pairwise Interactions". Features are
counts over the whole text. Each is cut into bins, and cyclic boosting fits shallow
trees, one feature at a time, round by round; their sums are one lookup table for each
feature. Then the pairs of features that explain most of what is left get tables of
two dimensions in the same way. A score is the sum of the tables' entries.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from badgeflow.llm.common import DOCUMENT_COLUMNS, table

# At most so many labelled rows are fitted on: those with the smallest hash of doc_id.
TRAINING_ROWS = 20_000
THRESHOLD = 0.3
BINS = 32

LETTERS = [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
BYTE_CLASSES = {
    "letters": LETTERS,
    "capitals": range(0x41, 0x5B),
    "digits": range(0x30, 0x3A),
    "space": [0x20, *range(0x09, 0x0E)],
    "sentence": [ord(c) for c in ".,;:?'\"()-"],
    "shouts": [ord("!")],
    "symbols": [b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) not in ".,;:?'\"()-!"],
    "control": [*range(0, 9), *range(0x0E, 0x20), 0x7F],
}
FEATURES = (
    "log_bytes", *BYTE_CLASSES, "word_length", "word_spread", "distinct_words", "top_word",
    "sentence_ends", "log_line", "repeated_lines",
)
CLASS_MATRIX = np.array([[float(b in set(kinds)) for kinds in BYTE_CLASSES.values()] for b in range(256)])


def features(texts: list[str | None]) -> np.ndarray:
    """A row of FEATURES for each text; all 0 for NULL and empty texts."""
    out = np.zeros((len(texts), len(FEATURES)))
    histograms = np.zeros((len(texts), 256))
    for row, text in enumerate(texts):
        if not text:
            continue
        data = text.encode()
        histograms[row] = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
        words, lines = text.split(), text.split("\n")
        tally = Counter(words)
        n = max(1, len(words))
        lengths = np.fromiter(map(len, tally), float, len(tally))
        times = np.fromiter(tally.values(), float, len(tally))
        mean = float(lengths @ times) / n
        ends = sum(data.count(mark) for mark in (b". ", b".\n", b"! ", b"!\n", b"? ", b"?\n"))
        out[row, 0] = np.log1p(len(data))
        out[row, 1 + len(BYTE_CLASSES) :] = (
            mean,
            np.sqrt(max(0.0, float(lengths**2 @ times) / n - mean * mean)),
            len(tally) / n,
            max(times, default=0.0) / n,
            ends / n,
            np.log1p(len(text) / len(lines)),
            1 - len(set(lines)) / len(lines),
        )
    total = np.maximum(1.0, histograms.sum(axis=1, keepdims=True))
    out[:, 1 : 1 + len(BYTE_CLASSES)] = histograms @ CLASS_MATRIX / total
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _cut(gradient: np.ndarray, weight: np.ndarray, least: float) -> tuple[float, int] | None:
    """(gain, first bin on the right) of the best cut along the last axis."""
    g, h = gradient.cumsum()[:-1], weight.cumsum()[:-1]
    gain = g**2 / (h + 1) + (gradient.sum() - g) ** 2 / (weight.sum() - h + 1)
    gain = np.where((h >= least) & (weight.sum() - h >= least), gain, -np.inf)
    at = int(np.argmax(gain)) if len(gain) else 0
    return (float(gain[at]), at + 1) if len(gain) and np.isfinite(gain[at]) else None


def shallow_tree(gradient: np.ndarray, weight: np.ndarray, depth: int, least: float) -> np.ndarray:
    """The values a tree of ``depth`` cuts gives to the bins of one feature."""
    found = _cut(gradient, weight, least) if depth else None
    if found is None:
        return np.full(len(gradient), gradient.sum() / (weight.sum() + 1))
    at = found[1]
    return np.concatenate(
        [shallow_tree(gradient[:at], weight[:at], depth - 1, least), shallow_tree(gradient[at:], weight[at:], depth - 1, least)]
    )


def pair_tree(gradient: np.ndarray, weight: np.ndarray, least: float) -> tuple[float, np.ndarray]:
    """(gain, values) of the tree with one cut along each feature that gains most.

    All pairs of cuts are tried together, from sums over the rectangles they make, so an
    interaction is found even where neither feature tells anything alone.
    """

    def corners(x: np.ndarray) -> tuple[np.ndarray, ...]:
        sums = x.cumsum(axis=0).cumsum(axis=1)
        low = sums[:-1, :-1]
        top, left = sums[:-1, -1:] - low, sums[-1:, :-1] - low
        return low, top, left, sums[-1, -1] - low - top - left

    if min(gradient.shape) < 2:
        return -np.inf, np.zeros_like(gradient)
    parts = list(zip(corners(gradient), corners(weight)))
    gain = sum(g**2 / (h + 1) for g, h in parts)
    rows, columns = weight.sum(axis=1).cumsum()[:-1, None], weight.sum(axis=0).cumsum()[None, :-1]
    enough = (np.minimum(rows, weight.sum() - rows) >= least) & (np.minimum(columns, weight.sum() - columns) >= least)
    gain = np.where(enough, gain, -np.inf)
    i, j = np.unravel_index(np.argmax(gain), gain.shape)
    if not np.isfinite(gain[i, j]):
        return -np.inf, np.zeros_like(gradient)
    low, top, left, rest = (g[i, j] / (h[i, j] + 1) for g, h in parts)
    out = np.full_like(gradient, rest)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1] = low, top, left
    return float(gain[i, j]), out


@dataclass
class AdditiveModel:
    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)]

    def score(self, x: np.ndarray) -> np.ndarray:
        total, bins = np.full(len(x), self.base), self.bins(x)
        for own, values in zip(bins, self.tables):
            total += values[own]
        for i, j, values in self.pairs:
            total += values[bins[i], bins[j]]
        return sigmoid(total)


def fit(
    x: np.ndarray, y: np.ndarray, rounds: int = 120, pair_rounds: int = 40, n_pairs: int = 6, rate: float = 0.15, least: float = 2.0
) -> AdditiveModel:
    """Without rows of both classes the model is their smoothed share."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return model
    model.edges = [np.unique(np.quantile(column, np.arange(1, BINS) / BINS)) for column in x.T]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = model.bins(x)
    logit = np.full(len(y), model.base)

    def residual() -> tuple[np.ndarray, np.ndarray]:
        p = sigmoid(logit)
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for own, values in zip(bins, model.tables):
            g, h = residual()
            n = len(values)
            step = rate * shallow_tree(np.bincount(own, g, n), np.bincount(own, h, n), 2, least)
            values += step
            logit += step[own]

    def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        shape = len(model.tables[i]), len(model.tables[j])
        cell = bins[i] * shape[1] + bins[j]
        g, h = residual()
        return tuple(np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (g, h))

    ranked = sorted(combinations(range(len(bins)), 2), key=lambda p: -pair_tree(*grid(*p), least)[0])
    model.pairs = [(i, j, np.zeros((len(model.tables[i]), len(model.tables[j])))) for i, j in ranked[:n_pairs]]
    for _ in range(pair_rounds):
        for i, j, values in model.pairs:
            step = rate * pair_tree(*grid(i, j), least)[1]
            values += step
            logit += step[bins[i], bins[j]]
    return model


def held_out(doc_id: Column) -> Column:
    """Whether the document is kept from training: crc32 of its id as text, modulo 5."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``rows`` labelled documents that are not held out.

    Labels without an id or a quality are left out; of labels that contradict each
    other the majority counts, and of rows with one doc_id one text.
    """
    usable = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~held_out(F.col("doc_id")))
    label = usable.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    order = F.xxhash64("doc_id")
    # Enough of all labels that `rows` of them have the smallest hashes, and no more.
    share = min(1.0, (rows + 10 * rows**0.5 + 100) / max(1, usable.count()))
    low = order < int(-(1 << 63) + share * ((1 << 64) - 1) * 0.999999) if share < 1 else F.lit(True)
    chosen = label.where(low).orderBy(order, "doc_id").limit(rows)
    # At most `rows` pairs of numbers: their size is bounded.
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array(features(batch["text"].to_pylist()).tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["label"], values], ["doc_id", "label", "x"])

    sample = (
        found.select(F.col("doc_id").cast("long").alias("doc_id"), "label", "text")
        .mapInArrow(run, "doc_id bigint, label int, x array<double>")
        .groupBy("doc_id", "label")
        .agg(F.min("x").alias("x"))
        .orderBy("doc_id")
        .collect()
    )
    return np.array([r.x for r in sample]).reshape(-1, len(FEATURES)), np.array([r.label for r in sample], float)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> AdditiveModel:
    return fit(*training_rows(docs, labels, rows))


def score(docs: DataFrame, model: AdditiveModel, keep: tuple[str, ...]) -> DataFrame:
    """The ``keep`` columns of every document with ``score``, 0 to 1.

    NULL and empty texts are scored as a text without any characters.
    """
    columns = list(dict.fromkeys([*keep, "text"]))
    rows = docs.select(*columns)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = shared.value.score(features(batch["text"].to_pylist()))
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), pa.array(values)], [*keep, "score"])

    return rows.mapInArrow(run, T.StructType([*(rows.schema[c] for c in keep), T.StructField("score", T.DoubleType())]))


def good_documents(docs: DataFrame, model: AdditiveModel, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score at least ``threshold``, with the columns of documents."""
    return score(docs, model, DOCUMENT_COLUMNS).where(F.col("score") >= threshold).select(*DOCUMENT_COLUMNS)


def op4_quality(spark, sf_dir: str) -> DataFrame:
    """A score for every document, from a model fitted to the labels."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")), ("doc_id",))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
