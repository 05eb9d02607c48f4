from __future__ import annotations

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sintonia.llm import license_scan as S


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text):
    w = words(text)
    places, labels = [], set()
    for phrase, label in S.PHRASES.items():
        p = phrase.split()
        here = [k for k in range(len(w)) if w[k : k + len(p)] == p]
        places += here
        labels |= {label} if here else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_matches_brute_force(sample):
    text = {r.doc_id: r.text for r in sample.collect()}
    rows = S.scan(sample).collect()
    assert len(rows) == len(text)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert r.labels == ",".join(sorted(set(r.labels.split(",")))) and 0 <= r.score <= 1


def test_edge_rows(docs):
    mit = S.NOTICES[1][1]
    rows = [(1, None), (2, ""), (None, "CC BY cc-by"), (3, "filler " * 50_000 + mit + " filler" * 50_000), (3, "All rights reserved."), (4, "Cc By\x7fcc\x00by é")]
    got = S.scan(docs(rows)).collect()
    assert [(r.n_words, r.labels, r.score) for r in got[:2]] == [(0, "", 0.0)] * 2
    for r, (_, t) in zip(got, rows):
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(t)
    assert got[3].labels == "mit" and got[3].spans[0].first == 50_000
    assert S.scan(docs([])).collect() == []


def test_chain_survives_small_edits_and_ignores_fragments():
    scanner, rng = S.Scanner(), random.Random(5)
    for label, notice in S.NOTICES[1:3] + S.NOTICES[7:10]:
        w = notice.split()
        edited = w[:9] + ["inserted"] + w[9:]
        del edited[len(edited) // 2]
        assert label in scanner.scan(" ".join(edited).encode())["labels"].split(",")
        assert label not in scanner.scan(" ".join(w[: len(w) // 3]).encode())["labels"].split(",")
        rng.shuffle(w)
        assert scanner.scan(" ".join(w).encode())["labels"] in ("", "gpl")


vocabulary = [b"a", b"b", b"c", b"d"]
sentence = st.lists(st.sampled_from(vocabulary), min_size=1, max_size=8)


@settings(max_examples=150, deadline=None)
@given(st.lists(sentence, min_size=1, max_size=4), st.lists(st.sampled_from([*vocabulary, b"z"]), max_size=25))
def test_matching_statistics(notices, text):
    auto = S.Automaton(notices)
    inside = lambda w: [(n, k + len(w) - 1) for n, t in enumerate(notices) for k in range(len(t) - len(w) + 1) if t[k : k + len(w)] == w]
    longest = []
    for end in range(len(text)):
        size = 0
        while size <= end and inside(text[end - size : end + 1]):
            size += 1
        longest.append(size)
    # a piece is maximal where the next word does not lengthen it
    want = [(e, n) for e, n in enumerate(longest) if n >= 2 and (e + 1 == len(text) or longest[e + 1] <= n)]
    pieces = auto.pieces(text, 2)
    assert [(e, n) for e, n, _ in pieces] == want
    for e, n, state in pieces:
        assert sorted(set(auto.ends[state])) == sorted(inside(text[e - n + 1 : e + 1]))


WHOLE = [(label, text) for label, text in S.NOTICES if len(text) > 700]


@pytest.mark.parametrize("label,text", WHOLE, ids=[label for label, _ in WHOLE])
def test_a_whole_licence_is_one_span(label, text):
    scanner = S.Scanner()
    n = len(S.words_of(text.encode()))
    got = scanner.scan(f"Project notes, twelve words long or so, come first. {text.upper()} And after.".encode())
    assert label in got["labels"].split(",") and got["score"] == 1.0
    assert any(s["label"] == label and s["last"] - s["first"] == n - 1 for s in got["spans"])
    # half of it, or its words shuffled, is not the licence
    words = text.split()
    half = scanner.scan(" ".join(words[: len(words) // 2]).encode())
    assert not any(s["label"] == label and s["last"] - s["first"] > 0.6 * n for s in half["spans"])
    random.Random(1).shuffle(words)
    assert not scanner.scan(" ".join(words).encode())["spans"]


def _longest_ends(words, notices, least):
    """(last word, length) wherever the longest piece of a notice that ends there ends."""
    out = []
    for end in range(len(words)):
        for length in range(end + 1, 0, -1):
            piece = words[end - length + 1 : end + 1]
            if any(piece == t[k : k + length] for t in notices for k in range(len(t) - length + 1)):
                if length >= least:
                    out.append((end, length, piece))
                break
    # a piece counts where it cannot be made longer
    return [(e, n, p) for e, n, p in out if not any(e2 == e + 1 and n2 == n + 1 for e2, n2, _ in out)]


def _best_cover(spans, gap, at=0, last=None):
    """Most words that a chain of the placed pieces can cover, by trying all."""
    best = 0
    for k in range(at, len(spans)):
        a, b, ta, tb = spans[k]
        gain = b - a + 1
        if last is not None:
            pb, ptb = last
            shift = max(0, pb + 1 - a, ptb + 1 - ta)
            if not (pb < b and ptb < tb and a - pb <= gap + 1 and ta - ptb <= gap + 1 and shift <= b - a):
                continue
            gain -= shift
        best = max(best, gain + _best_cover(spans, gap, k + 1, (b, tb)))
    return best


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=14), st.lists(st.lists(st.sampled_from("abcd"), min_size=3, max_size=7), min_size=1, max_size=2))
def test_chains_cover_what_brute_force_covers(words, notices):
    limits = S.Limits(min_match=2, max_gap=2)
    words, texts = [w.encode() for w in words], [[w.encode() for w in t] for t in notices]
    automaton = S.Automaton(texts)
    pieces = automaton.pieces(words, limits.min_match)
    assert [(e, n) for e, n, _ in pieces] == [(e, n) for e, n, _ in _longest_ends(words, texts, limits.min_match)]
    got = {}
    for notice, _, _, share in S.chains(pieces, automaton, [len(t) for t in texts], limits):
        got[notice] = max(got.get(notice, 0.0), share)
    for k, t in enumerate(texts):
        spans = [
            (e - n + 1, e, p, p + n - 1)
            for e, n, piece in _longest_ends(words, texts, limits.min_match)
            for p in range(len(t) - n + 1)
            if t[p : p + n] == piece
        ]
        assert got.get(k, 0.0) == min(1.0, _best_cover(spans, limits.max_gap) / len(t))
