from __future__ import annotations

import base64
import hashlib
import random
import struct
from pathlib import Path

import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from sintonia.llm import warc_zstd as W
from sintonia.llm.common import scratch_path

PAGES = "page_id long, url string, html string"


def b32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def round_trip(spark, rows, **how):
    root = scratch_path(spark, "warc")
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "'x' AS digest", "'y' AS last")
    W.write_archives(df, root, **how)
    return W.read_archives(spark, root).where("record_type IN ('response', 'revisit') OR error IS NOT NULL").collect()


ROWS = [
    (1, "http://a.example/x y\r\nInjected: 1", "<p>same</p>"),
    (2, None, "<p>same</p>"),
    (9, "http://b.example/é", "<p>same</p>"),
    (3, "u", None),
    (4, "u", ""),
    (None, "u", "<p>same</p>"),
    (5, "u", "héllo 日本 \r\n\r\n WARC/1.1" * 3),
    (6, "u", "x" * 300_000),
    (9, "http://b.example/é", "<p>same</p>"),
]


def test_round_trip(spark):
    got = round_trip(spark, ROWS)
    assert len(got) == len(ROWS) and not any(r.error for r in got)
    want = {1: "9", 2: "9", 9: None, 3: "4", 4: None, None: "9", 5: None, 6: None}
    html = {k: t for k, _, t in ROWS}
    for r in got:
        k = int(r.page_id) if r.page_id else None
        assert r.refers_to == want[k] and r.record_type == ("revisit" if want[k] else "response")
        assert r.payload_digest == b32(html[k]) and r.payload_bytes == len((html[k] or "").encode())
        assert r.payload == (None if want[k] else (html[k] or "").encode())
    assert {r.url for r in got if r.page_id == "1"} == {"http://a.example/x%20y%0D%0AInjected:%201"}


def test_archives_are_closed_at_a_byte_limit(spark):
    rng = random.Random(1)
    rows = [(k, f"http://a.example/{k}", "".join(rng.choices("abcdefghij <>/", k=4000))) for k in range(400)]
    rows.append((900, "u", "".join(rng.choices("abcdefghij <>/", k=300_000))))  # longer than an archive
    root = scratch_path(spark, "warc")
    W.write_archives(spark.createDataFrame(rows, PAGES).repartition(2), root, archive_bytes=64 << 10, sample_bytes=32 << 10, dict_bytes=2 << 10)
    files = [f for f in Path(root.removeprefix("file:")).glob("part-*")]
    sizes = sorted(f.stat().st_size for f in files)
    # each but the one with the long record ends within one record of the limit
    assert len(files) > 8 and sizes[-2] < (64 << 10) + 8000 and sizes[-1] < 400_000
    for f in files:  # every archive stands alone
        found = list(W.read_frames(f.read_bytes()))
        assert all(error is None for _, error in found) and found[0][0].startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    got = W.read_archives(spark, root).where("record_type = 'response'").collect()
    assert {int(r.page_id): r.payload.decode() for r in got} == {k: t for k, _, t in rows} and len(got) == len(rows)


def test_least_payload(spark):
    got = round_trip(spark, ROWS, least_payload=1)
    assert {r.page_id: r.record_type for r in got if r.page_id in ("3", "4")} == {"3": "response", "4": "response"}


def test_empty_table(spark):
    assert round_trip(spark, []) == []


INFO = W.record("warcinfo", "urn:archive:info", "2024-01-01T00:00:00Z", [], b"")
records = st.lists(st.binary(max_size=300), min_size=1, max_size=40)


@settings(max_examples=40, deadline=None)
@given(records, st.sampled_from([1, 200, 1 << 20]), st.sampled_from([1, 500, 1 << 20]))
def test_archives_round_trip(blocks, sample_bytes, archive_bytes):
    made = [W.record("resource", f"urn:x:{k}", "2024-01-01T00:00:00Z", [], b) for k, b in enumerate(blocks)]
    sep, back = W.EMPTY_FRAME.encode(), []
    for archive in W.archives(iter(made), INFO, sample_bytes=sample_bytes, dict_bytes=4096, level=3, archive_bytes=archive_bytes):
        assert struct.unpack_from("<I", archive)[0] == W.DICT_MAGIC
        info, *found = [r for r, e in W.read_frames(archive + sep, step=64)]
        # one frame per record, after the archive's own
        assert info == INFO and found and archive.count(W.FRAME_MAGIC) >= len(found) + 1
        back += found
    assert back == made


def test_damage_is_told():
    made = [W.page_record(str(k), "u", b"payload %d" % k, W.base32_sha1(b"payload %d" % k), None, "2024-01-01T00:00:00Z") for k in range(30)]
    sep = W.EMPTY_FRAME.encode()
    (data,) = W.archives(iter(made), INFO, sample_bytes=1 << 20, dict_bytes=4096, level=3, archive_bytes=1 << 30)
    data += sep
    assert [e for _, e in W.read_frames(data[:-20])][-1]
    broken = bytearray(data)
    broken[-len(sep) - 6] ^= 0xFF  # the last frame's content or checksum
    assert [e for _, e in W.read_frames(bytes(broken))][-1]
    wrong = W.page_record("1", "u", b"payload", W.base32_sha1(b"other"), None, "2024-01-01T00:00:00Z")
    assert W.parse(wrong)["error"] == "payload differs from its length or digest"
    assert W.parse(made[0][:-1])["error"] == "block length differs from Content-Length"
    assert W.parse(b"HTTP/1.1 200 OK\r\n\r\n")["error"] == "not a WARC record"
    assert W.parse(made[0].replace(b"WARC-Date", b"X-Date"))["error"] == "no WARC-Date"


@pytest.mark.parametrize("packed", [False, True])
def test_dictionary_may_be_compressed(packed):
    body = zstandard.ZstdCompressionDict(b"raw content of some records " * 20, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    raw = body.as_bytes()
    raw = zstandard.ZstdCompressor().compress(raw) if packed else raw
    frame = zstandard.ZstdCompressor(dict_data=body).compress(b"raw content of some records and more")
    data = struct.pack("<II", W.DICT_MAGIC, len(raw)) + raw + frame
    assert list(W.read_frames(data)) == [(b"raw content of some records and more", None)]
