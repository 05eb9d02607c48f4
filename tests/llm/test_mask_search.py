from __future__ import annotations

import dataclasses
import math
import re
from collections import Counter

import numpy as np
import pytest

from sintonia.llm import mask_search as M

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, top=20):
    counts = [(k, Counter(terms(t))) for k, t in rows]
    sizes = [sum(c.values()) for _, c in counts]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in items:
        asked, scored = Counter(terms(text)), []
        for (k, c), n in zip(counts, sizes):
            score = 0
            for t, reps in asked.items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += reps * w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * (75 + (25 * n * n_docs) // n_terms)))
            if score > 0:
                scored.append((-score, k is None, k))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item_id, rank, k, -s) for rank, (s, _, k) in enumerate(scored[:top], 1)]
    return out


def found(docs, items, how=M.Search()):
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in M.search(docs, items, how).collect()), key=key)


def items_df(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.fixture
def asked(spark):
    return spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").where("item_id < 12")


@pytest.mark.parametrize("how", [M.Search(), M.Search(top=3, cells=1 << 12), M.Search(items=5), M.Search(terms=40)])
def test_search_matches_brute_force(sample, asked, how):
    part = sample.where("doc_id < 400").repartition(5)
    rows = [(r.doc_id, r.text) for r in part.collect()]
    want = brute(rows, sorted((r.item_id, r.text) for r in asked.collect()), how.top)
    assert found(part, asked, how) == want


def test_edge_rows(spark, docs):
    rows = [
        (1, None), (2, ""), (3, "..."), (4, "Alpha beta"), (5, "alpha beta"), (None, "ALPHA beta"), (6, "éa ÉA 9x"), (7, "alpha " * 300_000),
        (4, "Alpha beta"), (8, "gamma delta"),
    ]
    df = docs(rows).selectExpr("*", "1 AS score", "1 AS terms", "1 AS tfs", "1 AS item", "1 AS item_id")
    items = [(1, "alpha alpha"), (2, None), (3, ""), (4, "nowhere"), (5, "éa 9X"), (6, "beta gamma")]
    got = found(df, items_df(spark, items).selectExpr("*", "1 AS rank", "'x' AS doc_id"))
    assert got == brute(rows, items)
    assert {r[0] for r in got} == {1, 5, 6}
    # equal scores by ascending doc_id, null last, repeated rows each
    assert [r[2] for r in got if r[0] == 6] == [8, 4, 4, 5, None]
    assert found(docs([]), items_df(spark, items)) == [] and found(df, items_df(spark, [])) == []


def test_ties_across_masks_and_chunks(spark, docs):
    rows = [(k, "x y" if k % 2 else "y x") for k in range(200, 0, -1)] + [(k, "other words") for k in range(201, 400)]
    how = M.Search(top=7, cells=64)
    items = [(1, "x y"), (2, "words"), (2, "words")]
    got = found(docs(rows).repartition(3), items_df(spark, items), how)
    one, two = brute(rows, items[:1], 7), brute(rows, items[1:2], 7)
    assert got == sorted([*one, *two, *two], key=lambda r: (r[0], r[1]))
    assert [r[2] for r in one] == list(range(1, 8))


def test_one_very_common_term_in_many_partitions(spark, docs):
    rows = [(k, "common " * (1 + k % 5) + (f"rare{k}x" if k % 40 == 0 else "filler")) for k in range(1000)]
    items = [(1, "common rare40x"), (2, "common")]
    assert found(docs(rows).repartition(29), items_df(spark, items)) == brute(rows, items)


def test_groups_are_the_distinct_columns():
    rng = np.random.default_rng(3)
    for size in (1, 5, 64, 65, 150):
        present = rng.random((size, 300)) < (0.5 if size < 10 else 0.01)
        masks, group = M.group_by_mask(present)
        assert (masks[group] == present.T).all()
        assert len({m.tobytes() for m in masks}) == len(masks) == group.max() + 1


def test_masks_below_the_best_are_not_evaluated(monkeypatch):
    looked = []
    add = M.Best.add
    monkeypatch.setattr(M.Best, "add", lambda self, score, *a: (looked.append(len(score)), add(self, score, *a))[1])
    n = 4000
    gains = np.ones((2, n), np.int32)
    present = np.ones((2, n), bool)
    present[0, 100:] = gains[0, 100:] = 0  # few documents hold the first term
    block = M.Block([1], {b"a": 0, b"b": 1}, [np.array([0, 1])], [np.array([1, 1])])
    best = [M.Best(20)]
    M.search_chunk(best, block, np.array([50, 1]), gains, present, np.zeros(n, np.int64), np.arange(n))
    assert best[0].doc.tolist() == list(range(20)) and sum(looked) == 100
    # a later chunk without the first term is not looked at
    M.search_chunk(best, block, np.array([50, 1]), gains[:, 100:], present[:, 100:], np.zeros(n - 100, np.int64), np.arange(n - 100))
    assert sum(looked) == 100


def test_long_texts_are_counted_in_pieces(monkeypatch):
    text = ("Ab cdé-fghijklmnop 12 " * 9).encode()
    whole = M.term_counts(text)
    monkeypatch.setattr(M, "_PIECE", 5)
    assert M.term_counts(text) == whole and whole[0] == len(terms(text.decode()))
    assert dataclasses.astuple(M.Search()) == (20, 2048, 1 << 15, 1 << 23)
