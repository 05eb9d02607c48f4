from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sintonia.llm import divergence as D

WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCALE = 1_000_000_000


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, how):
    """Rows of the report by the definition, over (text, lang, source)."""
    by, df = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        ws = words(text)
        by[lang or "", source or ""].update(ws)
        df[lang or ""].update(set(ws))
    out = {}
    for lang, source in by:
        kept = [t for t, n in df[lang].items() if n >= how.least_docs]
        totals = {s: sum(by[lang, s][t] for t in kept) for k, s in by if k == lang}
        whole = {t: sum(by[lang, s][t] for s in totals) for t in kept}

        def p(s, t):
            return 1 + SCALE * (by[lang, s][t] + 1) // (totals[s] + len(kept))

        pairs = [(s, sum((p(source, t) - p(s, t)) ** 2 // p(s, t) for t in kept)) for s in totals if s != source]
        terms = []
        for t in kept:
            a, q = p(source, t), 1 + SCALE * (whole[t] + 1) // (sum(totals.values()) + len(kept))
            if by[lang, source][t] and a > q:
                terms.append((t, (a - q) ** 2 // q))
        for part, found, top in (("pair", pairs, None), ("term", terms, how.top)):
            for rank, (item, value) in enumerate(sorted(found, key=lambda x: (-x[1], x[0].encode()))[:top], 1):
                out[lang, source, part, item] = (value, rank)
    return out


def report(df, how):
    got = D.audit(df, how).collect()
    out = {(r.lang, r.source, r.part, r.item): (r.value, r["rank"]) for r in got}
    assert len(out) == len(got)
    return out


@pytest.mark.parametrize("top", [3, 200])
def test_report_matches_brute_force(sample, top):
    rows = [(r.text, r.lang, r.source) for r in sample.where("doc_id < 250").collect()]
    how = D.Audit(top=top)
    assert report(sample.where("doc_id < 250"), how) == brute(rows, how)


def test_edge_rows(spark):
    rows = [
        (1, None, None, None, 0), (2, "", "", "", 0), (3, "Éa é a Ñb ñb", "x", "s1", 0), (4, "éa É a ñb Zz9zz", "x", "s2", 0),
        (4, "éa É a ñb Zz9zz", "x", "s2", 0), (5, "a zz zz", "x", None, 0), (6, "no one else", "x", "lone", 0),
        (7, "a zz " * 400_000, "x", "s1", 0), (8, None, "empty lang", "a", 0), (9, None, "empty lang", "b", 0),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = df.selectExpr("*", "'x' AS term", "1 AS sid", "1 AS n", "'y' AS item", "1 AS rank", "1 AS value")
    how = D.Audit(least_docs=3, top=2)
    got = report(clash, how)
    assert got == brute([r[1:4] for r in rows], how)
    # a group without kept terms is still compared; a language without any gives zeros
    assert ("x", "lone", "pair", "s1") in got and got["empty lang", "a", "pair", "b"] == (0, 1)
    assert not [k for k in got if k[0] == ""]  # one group only, no terms
    assert D.audit(clash.where("doc_id < 0")).collect() == []


def test_ties_go_to_the_earlier_term_in_utf8(spark):
    rows = [(f"common zed {c}" if k < 3 else "common", "l", "s" if k < 3 else "t") for c in ("b", "a", "ü", "z") for k in range(6)]
    df = spark.createDataFrame([(i, *r, 0) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    how = D.Audit(top=4)
    got = report(df, how)
    assert got == brute(rows, how)
    order = sorted((v[1], k[3]) for k, v in got.items() if k[1:3] == ("s", "term"))
    assert [t for _, t in order] == ["zed", "a", "b", "z"]


points = st.lists(st.tuples(st.integers(1, 6), st.integers(1, 6)), max_size=60)


@settings(max_examples=150, deadline=None)
@given(points, st.integers(1, 4), st.integers(1, 9))
def test_skyband_is_what_fewer_than_k_dominate(found, k, step):
    n, whole = (np.array([p[i] for p in found], np.int64) for i in (0, 1))
    want = [
        i for i in range(len(found)) if sum(n[j] >= n[i] and whole[j] <= whole[i] for j in range(i)) < k
    ]
    assert sorted(D.skyband(n, whole, k, step).tolist()) == want


@settings(max_examples=100, deadline=None)
@given(points, points, st.integers(1, 3))
def test_skyband_of_a_union_lies_in_the_skybands(a, b, k):
    both = np.array(sorted([*a, *b]) or np.empty((0, 2)), np.int64).reshape(-1, 2)
    pick = lambda m: m[D.skyband(m[:, 0], m[:, 1], k)]
    halves = np.concatenate([pick(both[::2]), pick(both[1::2])])
    assert {tuple(r) for r in pick(both)} <= {tuple(r) for r in halves}


def test_shares_are_exact_beyond_64_bits():
    for count, total in product([0, 1, 7, 10**9, 4 * 10**12], [5 * 10**12, 9 * 10**15]):
        assert int(D.shares(np.array([count]), total, 1000)[0]) == 1 + SCALE * (count + 1) // total


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(D, "_PIECE", 7)
    text = "Abc défgh-ijklmnopqrstuvw 1x ñ" * 5
    assert [w.decode() for part in D.pieces(text.encode()) for w in part] == words(text)


def test_hot_source_and_hot_term_over_many_partitions(spark):
    rows = [(i, "the the " + ("hot " * (i % 7)) + f"w{i % 11}x", "l", "hot" if i % 3 else f"s{i % 5}", 0) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(23)
    assert report(df, D.Audit(top=5)) == brute([r[1:4] for r in rows], D.Audit(top=5))
