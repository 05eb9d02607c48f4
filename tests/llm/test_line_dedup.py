from __future__ import annotations

import hashlib
from collections import Counter
from dataclasses import replace

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sintonia.llm import line_dedup as L

WS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WS))


def brute(rows, least=10):
    seen = Counter()
    for _, t in rows:
        seen.update({key(x) for x in (t or "").split("\n")} - {""})
    out = []
    for k, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if seen[key(x)] < least or not key(x)]
        out.append((k, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in df.collect()), key=str)


ROWS = (
    [(k, f"Shared line\nown {k}\n\n{' SHARED LINE ' if k % 2 else 'shared line'}\r") for k in range(12)]
    + [(50 + k, f"rare\n{k}") for k in range(9)]
    + [(90, None), (91, ""), (None, "\n\n"), (92, "Étoile shared"), (93, "a\n" * 30_000)]
    + [(94, "twice")] * 10
)


def test_matches_brute_force(docs, sample):
    assert got(L.rewrite(L.insert(None, docs(ROWS)), docs(ROWS))) == brute(ROWS)
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    assert got(L.rewrite(L.insert(None, sample), sample)) == brute(rows)


def test_without_broadcast_the_same(docs):
    rules = L.Rules(broadcast_bytes=0, salts=3)
    df = docs(ROWS)
    assert got(L.rewrite(L.insert(None, df, rules), df)) == brute(ROWS)


def test_empty_table(docs):
    state = L.insert(None, docs([]))
    assert L.rewrite(state, docs([])).collect() == []
    assert got(L.rewrite(state, docs(ROWS[:3]))) == brute(ROWS[:3])


def test_insert_and_delete_are_reversible(docs):
    rules = L.Rules(min_docs=3, shards=4)
    first = [(k, f"common\nline {k % 4}\nown {k}") for k in range(10)]
    second = [(100 + k, f"line {k % 4}\nlate\nown {k}") for k in range(6)]
    one = L.insert(None, docs(first), rules)
    both = L.insert(one, docs(second))
    whole = L.insert(None, docs(first + second), rules)
    counts = lambda s: sorted(tuple(r) for r in s.refs.select("hi", "lo", "n").collect())
    assert counts(both) == counts(whole)
    assert got(L.rewrite(both, docs(first + second))) == brute(first + second, 3)
    back = L.delete(both, docs(second))
    assert counts(back) == counts(one)
    assert got(L.rewrite(back, docs(first))) == brute(first, 3)


def test_a_mistaken_filter_is_corrected_by_the_counts(docs):
    df = docs(ROWS)
    state = L.insert(None, df)
    wrong = state.refs.where("n = 9 OR n = 1").select("hi", "lo", F.lit(1).alias("step"))
    broken = replace(state, filters=L._update(state, wrong))
    probe = L._probe(broken)
    both = np.array(wrong.select("hi", "lo").collect(), np.int64)
    assert probe.maybe(both[:, 0], both[:, 1]).all() and not probe.hot(both[:, 0], both[:, 1]).any()
    assert got(L.rewrite(broken, df)) == brute(ROWS)


def test_both_ways_agree_on_documents_the_state_has_not_seen(docs):
    """Many shared lines fill the filters; unseen lines in great number meet them."""
    rules = L.Rules(min_docs=3, shards=2)
    shared = [f"shared {k}" for k in range(4000)]
    state = L.insert(None, docs([(d, "\n".join(shared)) for d in range(3)]), rules)
    new = [(100 + d, "\n".join([f"unseen {d} {k}" for k in range(20_000)] + shared[d::500])) for d in range(10)]
    known = set(map(key, shared))
    want = sorted(((k, t.count("\n") + 1, sum(key(x) in known for x in t.split("\n")), "\n".join(x for x in t.split("\n") if key(x) not in known)) for k, t in new), key=str)
    unseen = L._pairs(b"".join(L._digest(x.encode()) for _, t in new for x in t.split("\n") if key(x) not in known)).astype(np.int64)
    assert L._probe(state).maybe(unseen[:, 0], unseen[:, 1]).any()  # filters alone would drop some
    assert got(L.rewrite(state, docs(new))) == want
    assert got(L.rewrite(replace(state, rules=replace(rules, broadcast_bytes=0)), docs(new))) == want


def test_keys_alike_in_their_upper_half():
    shared = np.array([(5, 1), (5, 2), (7, 1)], np.int64)
    made = L._filled([5, 5, 7])
    probe = L.Probe([(0, made.cells.tobytes())], 1, shared)
    asked = np.array([(5, 1), (5, 2), (5, 3), (7, 1), (7, 2), (8, 1)], np.int64)
    assert probe.hot(asked[:, 0], asked[:, 1]).tolist() == [True, True, False, True, False, False]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(-(2**63), 2**63 - 1), unique=True, max_size=300))
def test_cuckoo_never_loses_a_key(keys):
    made = L._filled(keys)
    there = lambda hi: any(
        L._mark(hi) in made.cells[b] for b in ((hi & made.mask), made._other(hi & made.mask, L._mark(hi)))
    )
    assert all(map(there, keys))
    gone = keys[::2]
    assert all(made.delete(k) for k in gone)
    assert all(map(there, keys[1::2]))


def test_digest_of_kept_text(docs):
    out = L.rewrite(L.insert(None, docs(ROWS)), docs(ROWS)).select("doc_id", "text", F.sha2("text", 256).alias("s"))
    assert all(r.s == hashlib.sha256(r.text.encode()).hexdigest() for r in out.collect())
