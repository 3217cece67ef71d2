import random

import numpy as np
import pytest

from badgeflow.llm.packing import (
    END, PATTERN, ROW_TOKENS, VOCABULARY, Rooms, Tokenizer, best_fit, op8_pack, pack, unpack, vocabulary,
)


@pytest.fixture(scope="module")
def plain():
    """The public tokenizer without any shortcut."""
    import base64

    import tiktoken

    pairs = (line.split() for line in vocabulary(VOCABULARY).splitlines())
    ranks = {base64.b64decode(a): int(b) for a, b in pairs}
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def documents_of(rows):
    """doc_id to all ids, put together again from the packed rows."""
    pieces = {}
    for row in rows:
        for doc_id, start, ids in unpack(row):
            pieces.setdefault(doc_id, []).append((start, ids))
    out = {}
    for doc_id, parts in pieces.items():
        ids = []
        for start, more in sorted(parts):
            assert start == len(ids)
            ids += more
        out[doc_id] = ids
    return out


def test_round_trip_of_the_whole_table(spark, sf_dir, corpus, plain):
    rows = op8_pack(spark, sf_dir).collect()
    assert documents_of(rows) == {i: plain(t) + [END] for i, t in corpus}
    used = 0
    for r in rows:
        ids = np.frombuffer(r.input_ids, "<u2")
        assert len(ids) == ROW_TOKENS and (ids[r.n_tokens :] == END).all()
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and r.position_resets == r.cu_seqlens[:-1]
        assert len(r.doc_ids) == len(r.starts) == r.n_segments and sorted(r.cu_seqlens) == r.cu_seqlens
        used += r.n_tokens
    assert used > 0.98 * len(rows) * ROW_TOKENS
    assert sorted(map(str, op8_pack(spark, sf_dir).collect())) == sorted(map(str, rows))


TEXTS = ["", " ", "a", " a", "a ", "a  b", "a\n b", "x\n\n y", "it's we'll ", "tab\tx", "a b　c d", "漢字 ünï 12 34.5!!", "<|endoftext|> x", "a b\n", "\na"]


@pytest.mark.parametrize("text", TEXTS)
def test_word_lookup_changes_no_ids(text, plain):
    tokenize = Tokenizer(vocabulary(VOCABULARY), cache_words=3)
    for _ in range(2):
        assert np.frombuffer(tokenize(text), np.uint16).tolist() == plain(text)


def test_best_fit_takes_the_least_room():
    pick = random.Random(1)
    for _ in range(20):
        capacity = pick.choice([7, 64, 100])
        lengths = np.array([pick.randint(1, capacity) for _ in range(200)])
        rooms, want = [], []
        for piece in sorted(range(200), key=lambda i: -lengths[i]):
            fits = [room for room, _ in rooms if room >= lengths[piece]]
            if fits:
                at = max(i for i, (room, _) in enumerate(rooms) if room == min(fits))
                room, row = rooms.pop(at)
            else:
                room, row = capacity, len(want)
                want.append(0)
            want[row] += lengths[piece]
            if room > lengths[piece]:
                rooms.append((room - lengths[piece], row))
        rows = best_fit(lengths, capacity)
        assert sorted(p for row in rows for p in row) == list(range(200))
        assert sorted(lengths[row].sum() for row in rows) == sorted(want)


def test_rooms():
    rooms = Rooms(10)
    for room, row in ((3, 0), (10, 1), (3, 2), (7, 3)):
        rooms.put(room, row)
    assert rooms.take(4) == (7, 3)
    assert rooms.take(4) == (10, 1)
    assert rooms.take(4) is None
    assert {rooms.take(1), rooms.take(3)} == {(3, 0), (3, 2)}
    assert rooms.take(1) is None


def test_edges(edges, clashing, nothing, plain):
    rows = pack(edges, capacity=50, group_tokens=1000).collect()
    found = documents_of([r.asDict() | {"doc_ids": [(r.pack, d) for d in r.doc_ids]} for r in rows if not {10, None} & set(r.doc_ids)])
    texts = {r.doc_id: r.text for r in edges.collect()}
    for (_, doc_id), ids in found.items():
        assert ids == plain(texts[doc_id] or "") + [END]
    assert sum(d == 10 for r in rows for d in r.doc_ids) >= 2
    assert sum(r.n_tokens for r in rows) == sum(len(plain(r.text or "")) + 1 for r in edges.collect())
    assert sum(r.n_tokens for r in pack(clashing, capacity=50).collect()) == sum(r.n_tokens for r in rows)
    assert pack(nothing).count() == 0
    with pytest.raises(ValueError):
        pack(edges, capacity=1 << 16)
