from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sintonia.llm import near_dedup as N
from sintonia.llm.common import components


def shingles(text, width=5):
    w = (text or "").encode().lower().split()
    return frozenset(zip(*[w[k:] for k in range(width)])) if len(w) >= width else frozenset([tuple(w)] if w else [])


def brute(rows, percent):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                up[find(a)] = find(b)
    least = {}
    for k, (d, _) in enumerate(rows):
        r = find(k)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return [(d, len(s), least[find(k)]) for k, ((d, _), s) in enumerate(zip(rows, sets))]


def words(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(n)]


def family(rng, base, n, most):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, most)):
            w[rng.randrange(len(w))] = words(rng, 1)[0]
        out.append(" ".join(w))
    return out


def rows_of(seed=1):
    rng = random.Random(seed)
    texts = [t for _ in range(6) for t in family(rng, words(rng, 120), 8, 5)]
    texts += family(rng, words(rng, 150), 90, 6)  # larger than a region below
    passage = words(rng, 40)
    texts += [" ".join(words(rng, 60) + passage + words(rng, 60)) for _ in range(60)]
    texts += [" ".join(words(rng, 3)) for _ in range(5)] + ["a b c", "A  b\nC", "", "  \n"]
    rng.shuffle(texts)
    return [(k * 7 + 3, t) for k, t in enumerate(texts)]


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def test_components_match_brute_force(docs):
    for percent in (80, 85):
        rows = rows_of(percent)
        how = N.Forest(percent=percent, region=16, pivots=4, heavy=40, block=2000)
        out = N.groups(docs(rows), how)
        assert got(out) == sorted(brute(rows, percent), key=str)
        assert all(r.kept == (r.doc_id == r.component_id) for r in out.collect())


def test_edge_rows(docs):
    rng = random.Random(2)
    long = " ".join(words(rng, 30_000))
    rows = [(5, None), (6, ""), (9, "one two three"), (2, "one TWO\tthree"), (None, "one two three"), (None, "alone"), (7, long), (8, long + " end"), (3, "x y z a b"), (3, "x y z a b")]
    out = N.groups(docs(rows), N.Forest(percent=85)).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in out), key=str) == sorted(
        [(5, 5, True), (6, 6, True), (9, 2, False), (2, 2, True), (None, 2, False), (None, None, True), (7, 7, True), (8, 7, False), (3, 3, True), (3, 3, True)], key=str
    )
    assert N.groups(docs([])).collect() == []


def test_drop_near_keeps_one_of_each(docs):
    rows = rows_of(4)
    df = docs(rows)
    out = N.drop_near(df)
    assert out.columns == df.columns
    assert {r.doc_id for r in out.collect()} == {d for d, _, c in brute(rows, 80) if d == c}


def test_hot_prefix_is_dealt_deeper(docs):
    # 400 near copies of one text: far more than a region, and a heavy key
    rng = random.Random(9)
    rows = list(enumerate(family(rng, words(rng, 200), 400, 2)))
    out = N.groups(docs(rows), N.Forest(percent=85, region=32, heavy=64))
    assert {r.component_id for r in out.collect()} == {c for _, _, c in brute(rows, 85)}


@pytest.mark.parametrize("percent", [80, 85])
def test_template_pages_keep_their_copies(docs, percent):
    """1,500 pages that share most of their words, so that any two are alike to 0.75, and
    of each a copy just over the threshold: all regions are overfull."""
    rng = random.Random(percent)
    length, own = 400, 53
    template = words(rng, length - own)
    rows = []
    for k in range(1500):
        page = template + words(rng, own)
        copy = list(page)
        at = length - own // 2
        # replaced words at the end of a page take as many shingles as there are, less four before
        while True:
            changed = copy[: at + 1] + words(rng, length - at - 1)
            a, b = shingles(" ".join(page)), shingles(" ".join(changed))
            if 100 * len(a & b) >= percent * len(a | b):
                break
            at += 1
        rows += [(2 * k, " ".join(page)), (2 * k + 1, " ".join(changed))]
    a, b = shingles(rows[0][1]), shingles(rows[2][1])
    assert 0.74 < len(a & b) / len(a | b) < 0.77
    found = {r.doc_id: r.component_id for r in N.groups(docs(rows), N.Forest(percent=percent)).collect()}
    lost = sum(found[2 * k + 1] != found[2 * k] for k in range(1500))
    assert lost == 0 and len(set(found.values())) == 1500


def test_a_component_reached_through_an_overfull_region(docs):
    # two large groups of copies and single texts, all in the same regions
    rng = random.Random(11)
    base = words(rng, 300)
    other = base[:255] + words(rng, 45)
    rows = list(enumerate(family(rng, base, 90, 3) + family(rng, other, 90, 3) + [" ".join(base[:k] + words(rng, 300 - k)) for k in range(200, 290, 3)]))
    for block in (1000, 10**6):
        out = N.groups(docs(rows), N.Forest(percent=80, region=16, heavy=60, block=block))
        assert got(out) == sorted(brute(rows, 80), key=str)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1), min_size=1, max_size=6), st.lists(st.sets(st.integers(0, 30), min_size=1), min_size=1, max_size=6))
def test_crossed(asked, others):
    sides = [[np.array(sorted(s), np.uint64) for s in side] for side in (asked, others)]
    near = N.crossed(*sides, 60, columns=4)
    for a, x in enumerate(asked):
        for b, y in enumerate(others):
            assert near[a, b] == (100 * len(x & y) >= 60 * len(x | y))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1), min_size=2, max_size=9), st.integers(1, 9))
def test_overlaps(sets, columns):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    both = N.overlaps(arrays, columns)
    for a in range(len(sets)):
        for b in range(len(sets)):
            if a != b:
                assert both[a, b] == len(sets[a] & sets[b])


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 200), st.integers(1, 3))
def test_split_regions_keep_every_group_whole_or_deeper(n, values):
    rng = np.random.default_rng(n)
    how = N.Forest(region=8, deepest=6)
    order = rng.integers(0, values, (n, 6)).astype(np.uint16)
    order[:, 0] = 1  # one region at depth 1
    found = list(N.split_regions(order, 1, how))
    assert all(2 <= len(p) <= how.region for _, p in found)
    for depth, part in found:
        assert (order[part][:, : min(depth, 6)] == order[part[0]][: min(depth, 6)]).all()


def test_components_of_a_chain_a_star_and_nothing(spark):
    chain = [(k, k + 1) for k in range(40)]
    star = [(1000, 1000 + k) for k in range(1, 50)]
    df = spark.createDataFrame(chain + star + [(7, 7)], "a long, b long")
    root = {r.node: r.root for r in components(df).collect()}
    assert root == {**{k: 0 for k in range(41)}, **{1000 + k: 1000 for k in range(50)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
