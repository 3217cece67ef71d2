import random
import zlib

import numpy as np
import pyarrow.dataset as ds
import pytest
from pyspark.sql import functions as F

from badgeflow.llm import quality
from badgeflow.llm.common import DOCUMENT_COLUMNS
from badgeflow.llm.quality import FEATURES, features, fit, good_documents, held_out, op4_quality, pair_tree, score, shallow_tree, train, training_rows

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in op4_quality(spark, SF).collect()}
    labels = ds.dataset(f"{SF}/labels.parquet").to_table().to_pylist()
    ids = ds.dataset(f"{SF}/documents.parquet").to_table(columns=["doc_id"])["doc_id"].to_pylist()
    assert sorted(rows) == sorted(ids)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    out = [r for r in labels if rows[r["doc_id"]].held_out]
    right = sum(rows[r["doc_id"]].predicted == r["quality"] for r in out)
    assert len(out) > 50 and right / len(out) >= 0.95


def test_training_is_bounded_and_never_sees_held_out_rows(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(400)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(400)] + [(7, 1, 0), (7, 1, 0), (None, 1, 0), (8, None, 0)], "doc_id bigint, quality int, toxic int")
    used = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(400))
    x, y = training_rows(docs, labels)
    assert len(x) == len(y) == used
    x, y = training_rows(docs, labels, rows=50)
    assert len(x) == 50
    again = training_rows(docs.repartition(7), labels.repartition(3), rows=50)
    assert (again[0] == x).all() and (again[1] == y).all()


def test_pairs_learn_what_single_features_cannot():
    pick = np.random.default_rng(0)
    x = pick.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    alone = fit(x, y, n_pairs=0).score(x)
    both = fit(x, y, n_pairs=1)
    assert both.pairs[0][:2] == (0, 1)
    assert ((both.score(x) > 0.5) == y).mean() > 0.95 > ((alone > 0.5) == y).mean()


def test_score_is_the_sum_of_table_entries():
    pick = np.random.default_rng(1)
    x, y = pick.random((500, 2)), pick.integers(0, 2, 500).astype(float)
    model = fit(x, y, rounds=5, pair_rounds=3, n_pairs=1)
    for row, got in zip(x[:20], model.score(x[:20])):
        bins = [int((model.edges[f] <= row[f]).sum()) for f in range(2)]
        total = model.base + sum(model.tables[f][bins[f]] for f in range(2))
        i, j, table = model.pairs[0]
        assert got == pytest.approx(1 / (1 + np.exp(-(total + table[bins[i], bins[j]]))))


def test_shallow_trees_find_the_best_cut():
    random.seed(2)
    for _ in range(20):
        g, h = np.array([random.uniform(-1, 1) for _ in range(8)]), np.ones(8)
        gain = lambda a, b: g[a:b].sum() ** 2 / (h[a:b].sum() + 1)
        best = max(range(1, 8), key=lambda c: gain(0, c) + gain(c, 8))
        want = [g[:best].sum() / (best + 1)] * best + [g[best:].sum() / (8 - best + 1)] * (8 - best)
        assert shallow_tree(g, h, 1, 1.0) == pytest.approx(want)
    g = np.zeros((4, 4))
    g[:2, :2] = g[2:, 2:] = 5.0
    g[:2, 2:] = g[2:, :2] = -5.0
    values = pair_tree(g, np.ones((4, 4)), 1.0)[1]
    assert (np.sign(values) == np.sign(g)).all()


def test_one_class_and_no_rows():
    assert fit(np.zeros((0, 2)), np.zeros(0)).score(np.zeros((1, 2)))[0] == pytest.approx(0.5)
    assert fit(np.ones((8, 2)), np.ones(8)).score(np.zeros((1, 2)))[0] == pytest.approx(0.9)


def test_features_of_odd_texts():
    x = features([None, "", "a", "  \n\n", "!!!", "ü" * 10, "x " * 50_000])
    assert x.shape == (7, len(FEATURES)) and np.isfinite(x).all()
    assert not x[0].any() and not x[1].any()
    assert x[6][FEATURES.index("top_word")] == 1.0


def test_edges(spark, edges, clashing, nothing):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = train(edges, labels)
    rows = score(edges, model, ("doc_id",)).collect()
    assert len(rows) == edges.count() and all(r.score == 0.5 for r in rows)
    assert good_documents(clashing, model).columns == list(DOCUMENT_COLUMNS)
    assert good_documents(edges, model, 0.6).count() == 0
    assert score(nothing, train(nothing, labels), ("doc_id",)).count() == 0
    assert edges.where(F.col("doc_id").isNull()).where(held_out(F.col("doc_id"))).count() == 0
    assert quality.THRESHOLD == 0.3
