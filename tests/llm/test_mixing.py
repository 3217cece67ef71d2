import re
from collections import Counter

import pyarrow.dataset as ds
import pytest

from badgeflow.llm.common import DOCUMENT_COLUMNS
from badgeflow.llm.mixing import draws, mix_documents, op3_mix, sized, split_quotas, targets


def shares(sizes, weights=(5, 2, 1), cap=3):
    """Targets by sharing again and again what capped sources cannot take."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, left, open_ = dict.fromkeys(order, 0.0), float(sum(sizes.values())), set(order)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            out[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if out[s] > cap * sizes[s]:
                left += out[s] - cap * sizes[s]
                out[s] = float(cap * sizes[s])
                open_.discard(s)
    return out


@pytest.mark.parametrize(
    "sizes",
    [{"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 5, None: 3}, {"a": 0, "b": 10}, {"a": 7}, {"a": 0}, {s: ord(s) ** 3 % 997 for s in "abcdefgh"}],
)
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in targets(df).collect()}
    assert got == pytest.approx(shares(sizes))


def test_whole_table(spark, sf_dir):
    rows = op3_mix(spark, sf_dir).collect()
    docs = {r["doc_id"]: r for r in ds.dataset(f"{sf_dir}/documents.parquet").to_table().to_pylist()}
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for i, r in docs.items()}
    size = Counter()
    for i, r in docs.items():
        size[r["source"]] += words[i]
    want, taken = shares(size), Counter()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        source = docs[r.doc_id]["source"]
        assert (r.size, r.source_size) == (words[r.doc_id], size[source])
        assert r.target == pytest.approx(want[source])
        assert 0 <= r.taken <= 3 * r.size
        assert len(r.shards) == -(-r.taken // r.size) if r.size else True
        taken[source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in size)
    # Reruns agree, and shards hold equally many draws.
    again = {r.doc_id: (r.taken, r.shards) for r in op3_mix(spark, sf_dir).collect()}
    assert again == {r.doc_id: (r.taken, r.shards) for r in rows}
    per_shard = Counter(s for r in rows for s in r.shards)
    assert max(per_shard.values()) - min(per_shard.values()) <= 1


def test_the_tree_splits_exactly_and_fairly(spark):
    quotas = {"a": 5000, "b": 1000, "c": 1, None: 37, "e": 0}
    df = spark.createDataFrame(list(quotas.items()), "source string, quota bigint")
    total = sum(quotas.values())
    spread = []
    for seed in range(5):
        rows = {r.source: r.shard_quotas for r in split_quotas(df, 6, seed).collect()}
        assert {s: sum(q) for s, q in rows.items()} == quotas
        sums = [sum(q[i] for q in rows.values()) for i in range(6)]
        assert max(sums) - min(sums) <= 1 and sum(sums) == total
        spread += [x - 1000 / 6 for x in rows["b"]]
    # A hypergeometric count of 1000 in 6038 has a deviation of about 10.8.
    deviation = (sum(x * x for x in spread) / len(spread)) ** 0.5
    assert 5 < deviation < 18


def test_mixed_documents(spark, edges):
    made = [(i, "w " * (i % 50), "en", f"s{i % 7}", 0) for i in range(400)]
    df = spark.createDataFrame(made, edges.schema)
    plan = {r.doc_id: r for r in draws(sized(df)).collect()}
    mixed = mix_documents(df).collect()
    times = Counter(r.doc_id for r in mixed)
    texts = {r.doc_id: r.text for r in df.collect()}
    for doc_id, r in plan.items():
        assert times[doc_id] == r.passes + (r.part > 0 and 2 * r.part >= r["size"])
    assert all(r.text == texts[r.doc_id] for r in mixed)
    assert {r.shard for r in mixed} <= set(range(8))


def test_edges(edges, clashing, nothing):
    rows = draws(sized(edges)).collect()
    assert len(rows) == edges.count()
    assert sum(r.taken for r in rows if r.doc_id in (3, 4, 5)) == 0
    assert mix_documents(clashing).select(*DOCUMENT_COLUMNS).count() == mix_documents(edges).count()
    assert draws(sized(nothing)).count() == 0 and mix_documents(nothing).count() == 0


def test_the_main_path_is_sql_only(spark, sf_dir):
    plan = op3_mix(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
