from __future__ import annotations

import math
import subprocess
import sys
import tracemalloc
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from sintonia.llm import context_mix as M

SMALL = M.Mixer(slot_bits=14, block_bits=10, frequent=64)


def toks(text):
    return [*(text or "").encode().lower().split(), b""]


def out_of(k):
    return zlib.crc32(("" if k is None else str(k)).encode()) % 7 == 2


def brute(rows):
    c = Counter(t for k, x in rows if not out_of(k) for t in toks(x))
    n, v = sum(c.values()), len(c)
    score = lambda x: sum(math.log10((c[t] + 1) / (n + v + 1)) for t in toks(x))
    return {k: (out_of(k), len(toks(x)), sum(c[t] > 0 for t in toks(x)), n, score(x)) for k, x in rows}


def check(df, how):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = brute(rows)
    got = M.score(df, how).collect()
    assert len(got) == len(rows)
    for r in got:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert r.base_score == pytest.approx(w[4], rel=1e-9, abs=1e-9)
        assert r.score < 0
    return got


def test_sample_base_is_exact_and_held_out_texts_are_predicted(sample):
    got = check(sample, SMALL)  # few frequent words, so that most go through the join
    text = {r.doc_id: r.text.encode() for r in sample.collect()}
    held = [r for r in got if r.held_out]
    size = sum(len(text[r.doc_id]) for r in held)
    values = np.bincount(np.frombuffer(b"".join(text[r.doc_id] for r in held), np.uint8)) / size
    order0 = -(values[values > 0] * np.log2(values[values > 0])).sum()
    assert -sum(r.score for r in held) / math.log10(2) / size < 0.75 * order0


def test_edge_rows(docs):
    rows = [(1, None), (2, ""), (None, "a b a"), (3, "é 日本 " * 2000), (4, "A a\tb"), (5, "unseen"), (19, "x" * 50_000)]
    check(docs(rows), SMALL)
    assert M.score(docs([]), SMALL).collect() == []
    same = M.score(docs([(1, "a b")] * 3), SMALL).collect()
    assert len({tuple(r) for r in same}) == 1 and len(same) == 3


def model(texts):
    values = np.bincount(np.frombuffer(b"".join(t + b"\xff" for t in texts), np.uint8), minlength=256)
    code = M.Code(values)
    tables = np.zeros((len(SMALL.orders), 2 * SMALL.slots), np.int64)
    M.count_tables(texts, code, SMALL, tables)
    return M.Model(code, M.stretched(tables), SMALL), code, tables


def test_probabilities_of_all_continuations_add_up():
    m, _, _ = model([b"the cat sat on the mat", b"the dog"])
    # weights stay within the first block: chains of bytes, then the end or any byte
    one = [10 ** m.log10(bytes([b])) for b in range(255)]
    assert sum(one) < 1
    end = 10 ** m.log10(b"")
    first = {}
    for b in range(255):
        # P(b) = P(text b ends) / P(end after b); sum over second symbols of two-byte texts
        first[b] = one[b] + sum(10 ** m.log10(bytes([b, c])) for c in (32, 97, 101))
    assert end + sum(first.values()) <= 1 + 1e-6


def test_code_is_a_prefix_code():
    _, code, _ = model([b"abracadabra"])
    assert sum(2.0 ** -int(s) for s in code.size) == pytest.approx(1)


def unpacked(blocks):
    rows = sorted(blocks.collect(), key=lambda r: r.block)
    assert [r.block for r in rows] == list(range(len(rows)))
    return np.concatenate([np.frombuffer(zlib.decompress(r.counts), "<i8") for r in rows]).reshape(len(SMALL.orders), -1)


def test_tables_add_up(spark, sample):
    _, code, _ = model([b"some text"])
    texts = sample.select("text").repartition(5)
    whole = np.zeros((len(SMALL.orders), 2 * SMALL.slots), np.int64)
    for r in texts.collect():
        M.count_tables([r.text.encode()], code, SMALL, whole)
    blocks = M.added(M.table_blocks(texts, code, SMALL))
    assert (unpacked(blocks) == whole).all()
    assert (M.stretch_of(blocks, SMALL) == M.stretched(whole)).all()
    # the texts left out for tuning are taken in by the end
    parts = M.table_blocks(texts.where("length(text) % 3 = 0"), code, SMALL).unionAll(M.table_blocks(texts.where("length(text) % 3 <> 0"), code, SMALL))
    assert (unpacked(M.added(parts)) == whole).all()
    assert (M.trained(texts, code, SMALL, texts.count()).stretch == M.stretched(whole)).all()


def test_counts_are_those_of_single_decisions_and_fold_to_smaller_tables():
    rng = np.random.default_rng(5)
    texts = [bytes(rng.integers(97, 105, 3000, np.uint8)) for _ in range(4)]
    wide = M.Mixer(slot_bits=20, block_bits=10)
    _, code, _ = model(texts)
    counted, direct = (np.zeros((3, 2 * wide.slots), np.uint32) for _ in range(2))
    M.count_tables(texts, code, wide, counted)
    narrow = np.zeros((3, 2 * SMALL.slots), np.uint32)
    M.count_tables(texts, code, SMALL, narrow)
    for t in texts:
        symbols = M.padded([t])
        at, path = code.decisions(symbols[8:])
        for k, c in enumerate(M.contexts(symbols, wide.orders)):
            np.add.at(direct[k], 2 * M.slots_of(c[at], code.node_part[path], 20).astype(np.int64) + code.bit[path], 1)
    assert (counted == direct).all()
    # the first bits of a slot number are the slot number of a smaller table
    assert (direct.reshape(3, SMALL.slots, -1, 2).sum(axis=2).reshape(3, -1) == narrow).all()


def test_tables_grow_with_the_square_root_of_the_training_bytes():
    bits = [M.Mixer().sized(n).slot_bits for n in (0, 10**6, 10**8, 10**10, 4 * 10**10, 10**14)]
    assert bits == [12, 15, 19, 22, 23, 24]
    assert M.Mixer(slot_bits=14).sized(10**10).slot_bits == 14


def test_start_is_learned_on_texts_the_tables_have_not_seen(spark, sample):
    texts = [r.text.encode() for r in sample.orderBy("doc_id").collect()]
    seen, tuning, fresh = texts[:600], texts[600:800], texts[800:]
    m, code, _ = model(seen)
    frame = spark.createDataFrame([(t.decode(),) for t in tuning], "text string").repartition(3)
    start = M.learned_start(frame, m)
    # Newton's steps, redone in one piece
    again = M.Start.plain(SMALL)
    for _ in range(SMALL.rounds):
        again = M.newton_step(again, *M.Model(code, m.stretch, SMALL, again).slopes(tuning), SMALL)
    assert np.array_equal(start.weights, again.weights) and np.array_equal(start.seen, again.seen)
    # the gradient is that of the code length: numerically, at one gate
    sums, cells = m.slopes(tuning[:20])
    assert cells.sum() == sum(int(code.size[M.padded([t])[8:]].sum()) for t in tuning[:20])
    step, flat = 1e-2, {}
    plain = M.Mixer(slot_bits=14, block_bits=10, map_share=0.0, first_step=1 << 20, step=1 << 20)
    for sign in (-1, 1):
        moved = M.Start.plain(plain)
        moved.weights[0] += np.float32(sign * step)
        flat[sign] = sum(M.Model(code, m.stretch, plain, moved).log10(t) for t in tuning[:20]) * math.log(10)
    assert (flat[1] - flat[-1]) / (2 * step) == pytest.approx(sums[0].sum(), rel=0.02, abs=5)
    # learned starts predict unseen texts better, short ones too
    better = M.Model(code, m.stretch, SMALL, start)
    for part in (fresh, [t[:300] for t in fresh]):
        assert sum(map(better.log10, part)) > sum(map(m.log10, part))
    assert np.array_equal(M.learned_start(frame.limit(0), m).weights, M.Start.plain(SMALL).weights)


def test_scores_do_not_depend_on_neighbours():
    m, _, _ = model([b"the cat sat on the mat " * 300])
    text = b"the mat sat on the cat " * 400
    a = m.log10(text)
    m.log10(b"something else")
    assert m.log10(text) == a


def test_long_texts_are_counted_by_pieces_and_scored_in_bounded_memory(monkeypatch):
    m, code, _ = model([b"the cat sat on the mat"])
    text = b"some longer text about cats and mats " * 500
    whole, cut = (np.zeros((len(SMALL.orders), 2 * SMALL.slots), np.int64) for _ in range(2))
    M.count_tables([text, b"short"], code, SMALL, whole)
    monkeypatch.setattr(M, "_LONG", 1000)
    M.count_tables([text, b"short"], code, SMALL, cut)
    assert (whole == cut).all()
    monkeypatch.undo()
    large = b"the cat sat on the mat. " * (50_000_000 // 24)  # 50 MB
    tracemalloc.start()
    M.count_tables([large], code, SMALL, whole)
    assert m.log10(large) < 0
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400 << 20


def bytes_counted(texts):
    values = np.zeros((256 * M._CLASSES, 256), np.int64)
    for t in texts:
        M.count_bytes(t, values.reshape(-1))
    return values


def test_start_is_learned_on_every_training_text(spark, sample, monkeypatch):
    texts = [r.text.encode() for r in sample.limit(200).collect()]
    values = bytes_counted(texts)
    code, cells, step = M.Code(values, most_trees=8, least=100), [], M.newton_step
    monkeypatch.setattr(M, "newton_step", lambda start, sums, c, how: cells.append(c) or step(start, sums, c, how))
    frame = spark.createDataFrame([(t.decode(),) for t in texts], "text string").repartition(3)
    m = M.trained(frame, code, SMALL, len(texts))
    size = [code.size[(code.tree_of[M.before(s)] << 8) + s[8:]].sum() for s in (M.padded([t]) for t in texts)]
    assert [int(c.sum()) for c in cells] == [int(sum(size))] * SMALL.rounds
    whole = np.zeros((len(SMALL.orders), 2 * SMALL.slots), np.uint32)
    M.count_tables(texts, code, SMALL, whole)
    assert (m.stretch == M.stretched(whole)).all()
    # a text and its copies are in one half: none is predicted by tables that hold it
    again = M.trained(spark.createDataFrame([(texts[0].decode(),)] * 50, "text string"), code, SMALL, 50)
    assert again.start.weights == pytest.approx(M.Start.plain(SMALL).weights, abs=1e-3)


def test_trees_follow_the_bytes_before():
    texts = [b"the cat sat on the mat " * 40, "é 日本 A1".encode() * 30, b""]
    values = bytes_counted(texts)
    assert values.sum() == sum(len(t) + 1 for t in texts)
    code = M.Code(values, most_trees=3, least=20)
    assert code.tree_of.max() == np.count_nonzero(values.reshape(M._CLASSES, 256, 256).sum(axis=(0, 2))) + 3
    for tree in range(code.tree_of.max() + 1):
        assert sum(2.0 ** -int(s) for s in code.size[256 * tree : 256 * tree + 256]) == pytest.approx(1)
    flat = M.Code(values.sum(axis=0))
    for t in texts:
        s = M.padded([t])
        context, k = M.before(s), 0
        at, path = code.decisions(s[8:], None, context)
        for i in range(len(t) + 1):
            key = 256 * int(code.tree_of[int(M._CLASS[s[i + 6]]) * 256 + int(s[i + 7])]) + int(s[i + 8])
            start, n = int(code.span[key] >> 8), int(code.size[key])
            assert path[k : k + n].tolist() == list(range(start, start + n)) and (at[k : k + n] == i).all()
            k += n
        assert k == len(at) and (not t or len(at) < len(flat.decisions(s[8:])[0]))


def test_texts_are_scored_alike_alone_and_together(sample):
    texts = [r.text.encode() for r in sample.limit(60).collect()] + [b"", b"x" * 30_000, b"", "é".encode()]
    code = M.Code(bytes_counted(texts[:30]), most_trees=8, least=100)
    tables = np.zeros((len(SMALL.orders), 2 * SMALL.slots), np.uint32)
    M.count_tables(texts[:30], code, SMALL, tables)
    m = M.Model(code, M.stretched(tables), SMALL)
    together = m.log10s(texts)
    assert [m.log10(t) for t in texts] == together
    assert m.log10s(texts[::-1])[::-1] == together


def test_blocks_are_packed_in_the_fewest_bytes_and_add_up(spark):
    blocks = [np.array([0, top], np.uint64) for top in (1, 2**16 - 1, 2**16, 2**32 - 1, 2**32)]
    rows = M.packed(range(5), blocks).to_pylist()
    assert [r["width"] for r in rows] == [2, 2, 4, 4, 8]
    assert M.packed([0], blocks[:1], 8).to_pylist()[0]["width"] == 8
    frame = spark.createDataFrame([(0, r["counts"], r["width"]) for r in rows], M._BLOCK).repartition(3)
    (sums,) = M.added(frame).collect()
    assert np.frombuffer(zlib.decompress(sums.counts), "<i8").tolist() == [0, sum(int(b[1]) for b in blocks)]
    _, code, _ = model([b"some text"])
    texts = spark.createDataFrame([("the cat sat on the mat",)], "text string")
    assert {r.width for r in M.table_blocks(texts, code, SMALL).collect()} == {2}


def test_joint_numbers_are_those_of_single_decisions():
    texts = [b"the cat sat on the mat", b"", b"A1 dog"]
    m, code, _ = model(texts[:1])
    joint, want = M.empty_joint(SMALL), M.empty_joint(SMALL)
    m.add_joint(texts, joint)
    level = M.levels(m.stretch).astype(int) + M._SIDE
    for t in texts:
        s = M.padded([t])
        at, path = code.decisions(s[8:], None, M.before(s))
        hashes = M.contexts(s, SMALL.orders)
        for i, k in zip(at.tolist(), path.tolist()):
            part, step = code.node_part[k : k + 1], int(code.steps[k])
            found = [int(row[M.slots_of(h[i : i + 1], part, SMALL.slot_bits)[0]]) for row, h in zip(level, hashes)]
            unknown = m.stretch[-1][M.slots_of(hashes[-1][i : i + 1], part, SMALL.slot_bits)[0]] == 0
            cell = int(M._WHITE[s[i + 7]]) + 2 * (step >> 9) + M._KINDS * int(unknown)
            for f in found:
                cell = cell * M._WIDTH + f
            want[2 * cell + (step >> 8 & 1)] += 1
    assert (joint == want).all()


def test_zeros_and_ones_are_counted_by_cell():
    zero, one = M.bits_by_cell(np.array([2, 0, 2, 2]), np.array([1, 0, 0, 1], np.uint8), 4)
    assert zero.tolist() == [1, 0, 1, 0] and one.tolist() == [0, 0, 2, 0]


def test_arrays_of_a_block_are_not_mapped_anew_each_time():
    code = """
import resource, sys
import numpy as np
from sintonia.llm import context_mix as M

if sys.argv[1] == "keep":
    M.keep_memory()
faults = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_minflt
for _ in range(30):
    begin = faults()
    a = [np.ones(200_000) for _ in range(8)]
    a.clear()
print(faults() - begin)
"""
    root = Path(M.__file__).resolve().parents[2]
    plain, kept = (int(subprocess.run([sys.executable, "-c", code, how], cwd=root, capture_output=True, check=True, text=True).stdout) for how in ("plain", "keep"))
    assert kept < 500 and kept <= plain
