from __future__ import annotations

import hashlib
import re
from collections import defaultdict

from sintonia.llm import exact_dedup as E


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    by = defaultdict(list)
    for k, t in rows:
        by[norm(t)].append(k)
    return {t: (min((k for k in ks if k is not None), default=None), len(ks)) for t, ks in by.items()}


def test_groups_match_brute_force(sample):
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    want, text = brute(rows), dict(rows)
    for r in E.groups(sample, counters=16).collect():
        keep, size = want[norm(text[r.doc_id])]
        assert (r.keep_id, r.group_size, r.kept) == (keep, size, keep == r.doc_id)
        assert r.text_sha256 == hashlib.sha256(norm(text[r.doc_id]).encode()).hexdigest()


def test_edge_rows(docs):
    rows = [(3, None), (1, ""), (2, " "), (4, "a\tb"), (5, "a  b"), (None, "a b"), (6, "a b"), (7, "x" * 300_000), (7, "x" * 300_000)]
    got = E.groups(docs(rows)).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.text_sha256): r for r in got}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert by[3, sha("")].keep_id == 1 and by[1, sha("")].kept and by[2, sha(" ")].kept
    assert [by[k, sha("a b")].keep_id for k in (4, 5, None)] == [4, 4, 4]
    assert sum(r.kept for r in got if r.doc_id == 7) == 1  # equal rows: one stays
    assert E.groups(docs([])).collect() == []


def test_hot_group_is_settled_map_side(docs):
    rows = [(k, "the same  text" if k % 3 == 0 else f"text {k}") for k in range(900)]
    got = E.groups(docs(rows), counters=8)
    assert got.where("kept").count() == 601 and got.where("group_size = 300").count() == 300


def test_drop_copies_keeps_all_columns_and_one_row_each(docs):
    rows = [(k, "hot" if k % 2 else f"t{k % 10}") for k in range(200)] + [(0, "t0")] * 3
    df = docs(rows)
    out = E.drop_copies(df, counters=4)
    assert out.columns == df.columns
    got = {(r.doc_id, r.text) for r in out.collect()}
    assert out.count() == len(got) == 6
    assert got == {(keep, t) for t, (keep, _) in brute(rows).items()}
    assert E.drop_copies(docs([])).collect() == []


def test_plan_is_native(sample):
    plan = E.groups(sample)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian"))
