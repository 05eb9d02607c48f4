from __future__ import annotations

import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sintonia.llm import budget_mix as B


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes, mix):
    """Rounds of sharing: who would pass the limit stops there, the rest share on."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: mix.weights[k % len(mix.weights)] for k, s in enumerate(names)}
    limit = {s: mix.max_repeats * sizes[s] for s in names}
    left, open_, out = mix.total * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] >= limit[s]}
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            out[s] = limit[s]
            left -= limit[s]
        open_ -= over
    return out


def check(rows, got, mix=B.Mix()):
    sizes = Counter()
    for r in rows:
        sizes[r[2]] += size(r[1])
    targets = brute_targets(sizes, mix)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], size(r[1])) for r in rows)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= mix.max_repeats
        taken[r.source] += r.taken
    return targets, taken


def test_sample(sample):
    rows = [(r.doc_id, r.text, r.source) for r in sample.collect()]
    targets, taken = check(rows, B.plan(sample).collect())
    for s, t in targets.items():
        assert t - 3 <= taken[s] <= t + 1e-6


def test_edges(docs):
    rows = [(1, None, "a"), (2, "", "a"), (3, "w " * 7, None), (None, "x y z", "b"), (4, "long " * 50_000, "b"), (5, "p q", "é"), (5, "p q", "é"), (6, "", "void")]
    check(rows, B.plan(docs(rows)).collect())
    assert B.plan(docs([])).collect() == []


def test_reruns_agree_whatever_the_partitions(docs):
    rows = [(k, "w " * (k % 17 + 1), f"s{k % 3}" if k % 2 else "hot") for k in range(600)]
    a = sorted(map(tuple, B.plan(docs(rows)).collect()))
    b = sorted(map(tuple, B.plan(docs(rows[::-1]).repartition(7)).collect()))
    assert a == b
    other = sorted(map(tuple, B.plan(docs(rows), B.Mix(seed=5)).collect()))
    assert other != a


def test_mixed_documents_follow_the_plan(docs):
    rows = [(k, "w " * (k % 9 + 1), "hot" if k % 3 else f"s{k % 2}") for k in range(300)] + [(1, "w w", "hot")] * 4
    df = docs(rows)
    out = B.mix_documents(df)
    assert out.columns == df.columns
    want, got = defaultdict(int), Counter(r.doc_id for r in out.collect())
    for r in B.plan(df).collect():
        want[r.doc_id] += r.copies
    assert got == Counter({k: n for k, n in want.items() if n})
    assert B.mix_documents(docs([])).collect() == []


items = st.lists(st.tuples(st.integers(1, 12), st.integers(0, 4)), min_size=1, max_size=5, unique_by=lambda x: x[0])


@settings(max_examples=200, deadline=None)
@given(items, st.integers(0, 60))
def test_knapsack_is_optimal(parts, budget):
    parts.sort()
    lengths, room = (np.array(x, np.int64) for x in zip(*parts))
    best = max(t for c in itertools.product(*[range(n + 1) for n in room]) if (t := int(np.dot(c, lengths))) <= budget)
    got = B.knapsack(lengths, room, budget)
    assert int(got @ lengths) == best and (got <= room).all() and (got >= 0).all()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 400), st.integers(1, 30)), min_size=1, max_size=30, unique_by=lambda x: x[0]), st.floats(0, 1))
def test_fit_stays_within_budget_and_near_it(parts, share):
    parts.sort()
    lengths, counts = (np.array(x, np.int64) for x in zip(*parts))
    budget = int(share * int(lengths @ counts))
    got = B.fit(lengths, counts, budget, reach=512)
    assert (got >= 0).all() and (got <= counts).all()
    assert budget - int(lengths[-1]) < int(got @ lengths) <= budget or budget < lengths[0]
