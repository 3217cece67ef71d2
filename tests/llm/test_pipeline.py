import zlib

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from badgeflow.llm import packing
from badgeflow.llm.common import DOCUMENT_COLUMNS, stored, table
from badgeflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), f"test-{name}")
        out[name] = docs
    return out


def test_stages_hand_on_documents(stages):
    assert list(stages) == ["good", "distinct", "decontaminated", "mixed", "packed"]
    for name in list(stages)[:-1]:
        assert stages[name].columns == list(DOCUMENT_COLUMNS)


def test_each_stage_does_its_work(spark, stages, corpus):
    from test_decontaminate import brute as hits
    from test_ngram_join import brute as components

    texts = dict(corpus)
    good = {r.doc_id: r.text for r in stages["good"].collect()}
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    assert all(texts[i] == t for i, t in good.items())
    seen = [i for i in labels if zlib.crc32(str(i).encode()) % 5]
    assert sum((i in good) == labels[i] for i in seen) >= 0.95 * len(seen)

    distinct = {r.doc_id: r.text for r in stages["distinct"].collect()}
    assert set(distinct) == {i for i, (_, c) in components(sorted(good.items())).items() if i == c}

    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    ids = sorted(distinct)
    clean = {i for i, (_, n, _) in zip(ids, hits([distinct[i] for i in ids], items)) if not n}
    kept = [r.doc_id for r in stages["decontaminated"].collect()]
    assert sorted(kept) == sorted(clean)

    mixed = stages["mixed"].collect()
    assert {r.doc_id for r in mixed} <= clean and all(texts[r.doc_id] == r.text for r in mixed)
    packed = stages["packed"].collect()
    tokens = sum(r.n_tokens for r in packed)
    tokenize = packing.Tokenizer(packing.vocabulary(packing.VOCABULARY))
    assert tokens == sum(len(tokenize(r.text)) // 2 + 1 for r in mixed)


def test_run_gives_the_last_stage(spark, stages):
    rows = corpus_pipeline.run(spark, SF).select("doc_ids", "n_tokens")
    assert rows.agg(F.sum("n_tokens")).first() == stages["packed"].agg(F.sum("n_tokens")).first()


def test_edges(spark, edges, nothing, clashing):
    """Nulls, empty and long texts, ties and repeated rows through every stage."""
    key = lambda r: (r.doc_id is None, r.doc_id, r.text)
    rows = lambda df: sorted(map(key, df.collect()), key=repr)
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = rows(edges)
        after = rows(stored(stage(spark, edges, SF), f"edges-{name}"))
        assert set(after) <= set(before)
        if name == "good":
            assert all(after.count(row) in (0, before.count(row)) for row in set(before))
        elif name == "distinct":
            # One of documents 1 and 2, of 7 and 8 and of the two rows of 10; all without an id.
            ids = [doc_id for _, doc_id, _ in after]
            assert sorted(i for i in ids if i is not None) == sorted([1, 3, 4, 5, 6, 7, -9, 10, 11, 2**62]) and ids.count(None) == 2
        elif name == "decontaminated":
            assert after == before
        elif name == "mixed":
            assert all(after.count(row) <= 3 * before.count(row) for row in set(before))
        plain = rows(stage(spark, clashing.select(*clashing.columns), SF))
        assert plain == after
    packed = corpus_pipeline.packed(spark, edges, SF)
    held = sorted((repr(i) for r in packed.collect() for i in r.doc_ids))
    assert set(held) == {repr(r.doc_id) for r in edges.collect()}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF).count() == 0, name
