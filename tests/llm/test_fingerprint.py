import hashlib
import re

import xxhash
from pyspark.sql import functions as F

from badgeflow.llm.fingerprint import TUPLES, fingerprints, op1_order_minhash

MASK = (1 << 64) - 1


def signed(x, bits=64):
    return x - (1 << bits) if x >> (bits - 1) else x


def xx_long(value, seed):
    """XXH64 of a number's eight bytes, as Spark chains it over several values."""
    return xxhash.xxh64_intdigest((value & MASK).to_bytes(8, "little"), seed & MASK)


def murmur_long(value, seed):
    """Murmur3 of a number's two halves, as Spark's hash()."""
    h = seed
    for part in (value & 0xFFFFFFFF, (value >> 32) & 0xFFFFFFFF):
        k = part * 0xCC9E2D51 & 0xFFFFFFFF
        k = ((k << 15) | (k >> 17)) * 0x1B873593 & 0xFFFFFFFF
        h ^= k
        h = (((h << 13) | (h >> 19)) * 5 + 0xE6546B64) & 0xFFFFFFFF
    h ^= 8
    h = (h ^ (h >> 16)) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ (h >> 13)) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ (h >> 16)


def brute_force(text):
    """For each tuple, all numbered k-mers in the tuple's order, and the first two of them."""
    words = [w for w in re.split(r"[ \t\n\x0b\f\r]+", text or "") if w]
    kmers = [words[i : i + 2] for i in range(max(1, len(words) - 1))] if words else []
    seen, numbered = {}, []
    for place, kmer in enumerate(kmers):
        h = 42
        for word in kmer:
            h = xxhash.xxh64_intdigest(word.encode(), h)
        nth = seen[h] = seen.get(h, -1) + 1
        numbered.append((h if nth == 0 else xx_int(nth, xx_long(h, 42)), place))
    out = []
    for i in range(TUPLES):
        point = (i * ((1 << 64) // TUPLES) + (1 << 63)) & MASK
        order = sorted(numbered, key=lambda x: ((x[0] - point) & MASK, x[1]))
        if not order:
            out.append("00000000")
            continue
        a, b = sorted((order * 2)[:2] if len(order) == 1 else order[:2], key=lambda x: x[1])
        out.append(f"{murmur_long(b[0], murmur_long(a[0], 42)):08x}")
    return "".join(out)


def xx_int(value, seed):
    """XXH64 of a number's four bytes."""
    return xxhash.xxh64_intdigest((value & 0xFFFFFFFF).to_bytes(4, "little"), seed & MASK)


def same(a, b):
    """Share of equal groups of eight digits."""
    assert isinstance(a, str) and len(a) == len(b) == 8 * TUPLES
    return sum(a[i : i + 8] == b[i : i + 8] for i in range(0, len(a), 8)) / TUPLES


def test_edits_and_neighbours_on_the_whole_table(spark, sf_dir, corpus):
    got = {r.doc_id: r for r in op1_order_minhash(spark, sf_dir).collect()}
    order = corpus[::-1]
    assert len(got) == len(order)
    for at, (doc_id, text) in enumerate(order):
        next_id, next_text = order[(at + 1) % len(order)]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + next_text[:cut]
        row = got[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint == brute_force(text) and row.edited_fingerprint == brute_force(edited)
        assert row.near_edited == same(row.fingerprint, row.edited_fingerprint)
        assert row.near_next == same(row.fingerprint, got[next_id].fingerprint)


def texts_near(spark, a, b):
    df = spark.createDataFrame([(1, a), (2, b)], "doc_id bigint, text string")
    return next(r.near_next for r in fingerprints(df).collect() if r.doc_id == 2)


def test_order_and_repeats_count(spark):
    words = [f"w{i}" for i in range(300)]
    text = " ".join(words)
    assert texts_near(spark, text, text) == 1.0
    one_edit = " ".join(words[:150] + ["x"] + words[150:])
    turned = " ".join(words[150:] + words[:150])
    assert texts_near(spark, text, one_edit) > 0.9
    # The same k-mers but one, in another order: order matters, so it is less alike.
    assert 0.2 < texts_near(spark, text, turned) < 0.85
    assert texts_near(spark, "a b " * 50, "a b " * 100) < 0.9
    assert texts_near(spark, text, " ".join(f"v{i}" for i in range(300))) == 0.0


def test_edges(edges, clashing, nothing):
    rows = fingerprints(edges).collect()
    assert len(rows) == edges.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[1][0].fingerprint == by_id[2][0].fingerprint
    assert by_id[3][0].fingerprint == by_id[4][0].fingerprint == by_id[5][0].fingerprint
    assert by_id[3][0].n_chars == 0 and len(by_id[10]) == 2
    assert by_id[10][1].fingerprint == by_id[10][0].fingerprint
    assert all(r.near_next == 0.0 for r in by_id[None])
    assert all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in rows)
    # After the last document in descending order (the smallest id) comes the first.
    first = "far away"
    assert by_id[-9][0].edited_sha256 == hashlib.sha256(("negative id"[: 11 - 3] + first[:3]).encode()).hexdigest()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.fingerprint)
    assert sorted(fingerprints(clashing).collect(), key=key) == sorted(rows, key=key)
    assert fingerprints(nothing).count() == 0


def test_ties_and_few_words_by_brute_force(spark):
    texts = ["", "one", "one two", "a a a a a a", "a b a b a b a b c", " x\ty\nz ", "ü ö " * 30 + "end", "same " * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.fingerprint for r in fingerprints(df).collect()}
    assert got == {i: brute_force(text) for i, text in enumerate(texts)}


def test_very_long_text(spark):
    """Order counts to the end of a text of three million words."""
    ids = spark.range(2).withColumnRenamed("id", "doc_id")
    words = F.transform(F.sequence(F.lit(1), F.lit(3_000_000)), lambda i: F.concat(F.lit("w"), i.cast("string")))
    turned = F.concat(F.slice(words, 1_500_001, 1_500_000), F.slice(words, 1, 1_500_000))
    text = F.array_join(F.when(F.col("doc_id") == 0, words).otherwise(turned), " ")
    rows = {r.doc_id: r for r in fingerprints(ids.select("doc_id", text.alias("text"))).collect()}
    assert rows[0].n_chars == rows[1].n_chars > 20_000_000
    # Nearly all k-mers are shared, and about half of the pairs of them are turned round.
    assert 0.15 < rows[0].near_next < 0.85


def test_the_main_path_is_sql_only(spark, sf_dir):
    plan = op1_order_minhash(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
