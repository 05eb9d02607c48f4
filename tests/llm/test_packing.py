from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sintonia.llm import packing as P

HOW = P.default_packing()


def tokens(texts):
    enc = P.encoder(HOW.tokenizer).tokenizer
    return [np.array([*x.ids, 0], "<u4") for x in enc.encode_batch(texts, add_special_tokens=False)]


def check(rows, texts_of, capacity):
    """rows of pack(): whole documents, cut right, gapless sequences."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for seq in by_seq.values():
        seq.sort(key=lambda r: r.offset)
        at = 0
        for r in seq:
            assert r.offset == at
            at += r.length
        assert at <= capacity
    assert by_doc.keys() == set(texts_of)
    ids = dict(zip(texts_of, tokens([t or "" for t in texts_of.values()])))
    for doc, own in by_doc.items():
        own.sort(key=lambda r: r.piece)
        at = 0
        for k, r in enumerate(own):
            assert (r.piece, r.start) == (k, at)
            assert r.ids_crc32 == zlib.crc32(ids[doc][at : at + r.length].tobytes())
            assert r.length == capacity or k == 0
            at += r.length
        assert at == len(ids[doc])
        assert len(own) == -(-at // capacity)
    return len(by_seq)


def test_pack_sample_is_whole_and_nearly_full(sample):
    rows = P.pack(sample, HOW).collect()
    n = check(rows, {r.doc_id: r.text for r in sample.collect()}, HOW.capacity)
    least = -(-sum(r.length for r in rows) // HOW.capacity)
    assert n <= least * 1.01 + 1


def test_edge_rows(docs, spark):
    rows = [(1, None), (2, ""), (None, "a b"), (4, "word " * 3000), (5, "  x\n\t y  "), (6, "x" * 5000), (7, "xy" * 100_000)]
    out = P.pack(docs(rows), HOW).collect()
    check(out, {k: t for k, t in rows}, HOW.capacity)
    assert P.pack(docs([]), HOW).collect() == []


def test_repeated_rows_are_each_packed(docs):
    out = P.pack(docs([(1, "one two three")] * 700), HOW).collect()
    places = Counter((r.sequence_id, r.offset) for r in out)
    assert len(out) == 700 and max(places.values()) == 1
    assert len({r.sequence_id for r in out}) == -(-sum(r.length for r in out) // 2048)


def test_sequences_hold_the_tokens(docs):
    rows = [(k, f"text number {k} " * (k % 50 + 1)) for k in range(60)]
    got = Counter(t for r in P.sequences(docs(rows), HOW).collect() for t in r.ids)
    assert got == Counter(int(t) for x in tokens([t for _, t in rows]) for t in x)


alphabet = st.sampled_from([" ", "  ", "\n", "\t", "a", "'s", "7", "é", "\xa0", "\x1c", "\x85", "!", "<|endoftext|>", "ß", "\r\n", "　", "Ж", "日", "ʼ", "ª", "²"])


@settings(max_examples=300, deadline=None)
@given(st.lists(alphabet, max_size=20).map("".join))
def test_encoder_gives_the_tokenizer_s_ids(text):
    e = P.encoder(HOW.tokenizer)
    assert next(e.encode([text])) == np.array(e.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 64), st.integers(1, 40)), max_size=12))
def test_plan_places_every_piece_once(items):
    how = P.Packing("", capacity=64, groups=8)
    counts = np.zeros(65, np.int64)
    for length, n in items:
        counts[length] += n
    plan = P.make_plan(counts, how)
    placed, room = Counter(), defaultdict(list)
    for length, rank, first, per, offset in plan.entries:
        after = sorted(e[1] for e in plan.entries if e[0] == length and e[1] > rank)
        n = (after[0] if after else int(counts[length])) - rank
        placed[length] += n
        for j in range(n):
            room[first + j // per].append((offset + j % per * length, length))
    assert placed == Counter({k: int(c) for k, c in enumerate(counts) if c})
    for own in room.values():
        own.sort()
        assert [o for o, _ in own] == list(np.cumsum([0] + [x for _, x in own])[:-1])
        assert sum(x for _, x in own) <= 64
    assert len(room) == plan.sequences


@pytest.mark.parametrize("n", [1, 2047, 2048, 2049, 4096, 5000])
def test_cuts(n):
    own = P.cuts(n, 2048)
    assert sum(x for _, x in own) == n and all(x == 2048 for _, x in own[1:])
