import zlib

from badgeflow.llm import sharding
from badgeflow.llm.sharding import op2_jump_shards, shard

MASK = (1 << 64) - 1


def jump(key, shards):
    """The published algorithm, with integers that wrap."""
    key, at, to = (key or 0) & MASK, -1, 0
    while to < shards:
        at = to
        key = (key * 2862933555777941757 + 1) & MASK
        to = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


def test_whole_table(spark, sf_dir, corpus):
    rows = op2_jump_shards(spark, sf_dir).collect()
    texts = dict(corpus)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    slots = {}
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert (r.shard, r.grown_shard) == (jump(r.doc_id, 8), jump(r.doc_id, 9))
        assert r.grown_shard in (r.shard, 8)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_any_count_and_key(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), 12345678901234, None]
    df = spark.createDataFrame([(k, "t") for k in keys], "doc_id bigint, text string")
    for shards in (1, 2, 7, 100):
        got = {r.doc_id: (r.shard, r.grown_shard) for r in shard(df, shards).collect()}
        assert got == {k: (jump(k, shards), jump(k, shards + 1)) for k in keys}


def test_keys_that_take_more_steps(spark, monkeypatch):
    monkeypatch.setattr(sharding, "STEPS", 2)
    rows = shard(spark.range(300).selectExpr("id AS doc_id", "'x' AS text"), 50).collect()
    assert {r.doc_id: (r.shard, r.grown_shard) for r in rows} == {k: (jump(k, 50), jump(k, 51)) for k in range(300)}


def test_few_rows_move(spark):
    df = spark.range(20_000).selectExpr("id AS doc_id", "'x' AS text")
    rows = shard(df, 8).groupBy("shard", "grown_shard").count().collect()
    moved = sum(r["count"] for r in rows if r.grown_shard == 8)
    assert abs(moved - 20_000 / 9) < 250
    sizes = {s: sum(r["count"] for r in rows if r.shard == s) for s in range(8)}
    assert all(abs(n - 2500) < 250 for n in sizes.values())


def test_edges(edges, clashing, nothing):
    rows = shard(edges, 3).collect()
    assert len(rows) == edges.count()
    for number in range(3):
        slots = sorted(r.slot for r in rows if r.shard == number)
        assert slots == list(range(len(slots)))
    empty = [r for r in rows if r.doc_id in (3, 4)]
    assert all((r.size, r.text_crc32) == (1, 0) for r in empty)
    assert sorted(map(str, shard(clashing, 3).collect())) == sorted(map(str, rows))
    assert shard(nothing, 3).count() == 0


def test_the_main_path_is_sql_only(spark, sf_dir):
    plan = op2_jump_shards(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
