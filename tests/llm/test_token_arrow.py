from __future__ import annotations

import dataclasses
import json
import random
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sintonia.llm import token_arrow as A

LAYOUT = dataclasses.replace(A.default_layout(), length=64, batch=4, file_ids=3000)


def tokenizer():
    t = Tokenizer.from_file(LAYOUT.tokenizer)
    t.encode_special_tokens = True
    return t


def brute(rows):
    """Ids of every text by the library, in ascending doc_id order, nulls last."""
    t = tokenizer()
    return [(k, t.encode(x or "", add_special_tokens=False).ids + [1]) for k, x in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))]


def expected(rows):
    out, start = [], 0
    for k, ids in brute(rows):
        out.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def written(df, path, how=LAYOUT):
    A.write_sequences(df, str(path), how)
    return sorted(str(p) for p in Path(path).glob("part-*"))


def read(spark, path):
    rows = A.read_documents(spark, str(path)).collect()
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows), key=lambda r: r[1])


def test_query_matches_the_library(spark, sample, tmp_path):
    part = sample.where("doc_id < 300")
    rows = [(r.doc_id, r.text) for r in part.collect()]
    written(part, tmp_path / "f")
    assert read(spark, tmp_path / "f") == expected(rows)


def test_files_are_plain_arrow_and_give_sequences_without_copies(sample, tmp_path):
    part = sample.where("doc_id < 120")
    files = written(part, tmp_path / "f")
    assert len(files) > 3
    stream = [i for _, ids in brute([(r.doc_id, r.text) for r in part.collect()]) for i in ids]
    found = sorted((A.SequenceFile(f) for f in files), key=lambda f: f.place)
    at = 0
    for f, path in zip(found, sorted(files, key=lambda p: A.SequenceFile(p).place)):
        with pa.memory_map(path) as m:
            assert pa.ipc.open_file(m).read_all().num_rows == len(f)  # any Arrow reader
        for i in random.Random(1).sample(range(len(f)), len(f)):  # in any order
            ids, bits = f.ids(i), np.unpackbits(f.mask(i), bitorder="little")
            held = min(64, f.n_ids - 64 * i)
            assert ids.shape == bits.shape == (64,) and bits.sum() == held and bits[:held].all()
            assert ids[:held].tolist() == stream[at + 64 * i : at + 64 * i + held] and not ids[held:].any()
        before = pa.total_allocated_bytes()
        views = [f.ids(i) for i in range(len(f))]
        assert not any(v.flags.owndata or v.flags.writeable for v in views)
        assert pa.total_allocated_bytes() == before
        at += f.n_ids
    assert at == len(stream)
    with pytest.raises(IndexError):
        found[0].ids(len(found[0]))


def test_documents_by_sequence(sample, tmp_path):
    part = sample.where("doc_id < 40")
    files = sorted((A.SequenceFile(f) for f in written(part, tmp_path / "f")), key=lambda f: f.place)
    got = [(d["doc_id"], d["n"]) for f in files for i in range(len(f)) for d in f.documents(i)]
    assert got == [(k, len(ids)) for k, ids in brute([(r.doc_id, r.text) for r in part.collect()])]


def test_edge_rows(spark, docs, tmp_path):
    rows = [(5, None), (3, ""), (None, "last of all"), (7, "twice"), (7, "twice"), (1, "word " * 100_000), (2, "<|endoftext|> Ünï ﬁ 漢字 \x00\x1c"), (-4, " \n")]
    df = docs(rows).selectExpr("*", "'x' AS ids", "'x' AS mask", "'x' AS start", "'x' AS file", "'x' AS task")
    written(df, tmp_path / "f")
    got = read(spark, tmp_path / "f")
    assert got == expected(rows)
    assert got[0][:3] == (-4, 0, 1) and got[-1][0] is None and (5, 1) in [(r[0], r[2]) for r in got]
    written(docs([]), tmp_path / "none")
    assert read(spark, tmp_path / "none") == []


def test_one_doc_id_in_most_rows(spark, docs, tmp_path):
    rows = [(9 if k % 3 else k, f"row {k % 3} " * 20) for k in range(600)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = written(docs(rows).repartition(16), tmp_path / "f")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len({A.SequenceFile(f).place[0] for f in files}) > 4  # spread over tasks
    got, want = read(spark, tmp_path / "f"), expected(rows)
    assert [r[0] for r in got] == [r[0] for r in want] and sorted(r[2] for r in got) == sorted(r[2] for r in want)
    assert all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:]))


def test_words_give_the_librarys_ids():
    own, library, rng = A.encoder(LAYOUT.tokenizer), tokenizer(), random.Random(4)
    assert own.fast and own.kind.itemsize == 2
    wild = [chr(c) for c in range(1, 0x2FF)]
    tame = list("abcdeft'sremldv 19. ABCÉß\n\t")
    texts = ["".join(rng.choice(wild if rng.random() < 0.2 else tame) for _ in range(rng.randint(0, 50))) for _ in range(4000)]
    texts += [t.replace("</w>", " ") for t in library.get_vocab()]  # every token as a text
    for text, ids in zip(texts, own.encode(texts)):
        assert np.frombuffer(ids, own.kind).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_other_tokenizers_go_through_the_library(tmp_path):
    made = json.loads(Path(LAYOUT.tokenizer).read_text())
    made["normalizer"]["normalizers"].pop()  # keeps case
    (tmp_path / "t.json").write_text(json.dumps(made))
    own = A.WordEncoder(str(tmp_path / "t.json"))
    assert not own.fast
    want = Tokenizer.from_file(str(tmp_path / "t.json")).encode("Some Words", add_special_tokens=False).ids
    assert np.frombuffer(own.ids("Some Words"), own.kind).tolist() == want


def test_damage_is_noticed(sample, tmp_path):
    data = Path(written(sample.where("doc_id < 5"), tmp_path / "f")[0]).read_bytes()
    with pytest.raises((pa.ArrowInvalid, OSError, ValueError)):
        A.SequenceFile(pa.py_buffer(data[:-40]))
