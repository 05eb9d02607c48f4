"""WARC archives in Zstandard frames: writer and reader.

An archive is a leading skippable frame that holds the dictionary, then one frame per
record.  A task trains the dictionary of each archive on the first records it puts there
(``sample_bytes`` at most) and closes the archive at ``archive_bytes``; a record is never
cut.  Archives go out through Spark's text writer, a row and a file each, whose commit
makes retried tasks safe on any file system; its line separator is an empty skippable
frame, so the file stays a valid sequence of frames.

The reader takes archives whole, loads the dictionary from the leading frame, decodes
frame by frame and checks declared sizes, required headers, block length, trailer and
payload digest; what fails is told in ``error``.

Defined results: a null payload is empty; a null url gives no target header; of records
with equal payloads the largest page_id is the response (a null page_id counts as
smallest); rows that repeat that page_id and payload are responses too; further columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sintonia.llm.common import scratch_path, table, written

#: Fixed values of the Zstandard format: skippable frames of the dictionary and of no
#: content; the magic number of a frame.
DICT_MAGIC = 0x184D2A5D
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")


# ---- records ----------------------------------------------------------------


def _header_text(value: str) -> str:
    """One line, without control characters or blanks that would end a header."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(kind: str, ident: str, date: str, extra: list[tuple[str, str]], block: bytes) -> bytes:
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{ident}>"), ("WARC-Date", date), *extra, ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def page_record(page_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    extra = [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if url is not None:
        extra.append(("WARC-Target-URI", _header_text(url)))
    if refers_to is None:
        return record("response", f"urn:page:{page_id}", date, extra, http + payload)
    extra += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    return record("revisit", f"urn:page:{page_id}", date, extra, http)


def parse(raw: bytes) -> dict:
    """The record's fields; ``error`` says what is wrong, else None."""
    out: dict = dict.fromkeys(("page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload", "error"))
    head, sep, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
    if not sep or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        return out | {"error": "not a WARC record"}
    if lacking := [k for k in _REQUIRED if k not in fields]:
        return out | {"error": f"no {lacking[0]}"}
    length = int(fields["Content-Length"]) if fields["Content-Length"].isdigit() else -1
    if rest[length:] != b"\r\n\r\n" or length < 0:
        return out | {"error": "block length differs from Content-Length"}
    kind = fields["WARC-Type"]
    urn = lambda k: fields[k].removeprefix("<urn:page:").removesuffix(">") if k in fields else None
    out |= {"record_type": kind, "url": fields.get("WARC-Target-URI")}
    if kind not in ("response", "revisit"):
        return out
    http, _, payload = rest[:length].partition(b"\r\n\r\n")
    size = next((int(x[16:]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length: ")), -1)
    digest = fields.get("WARC-Payload-Digest", "").removeprefix("sha1:")
    out |= {"page_id": urn("WARC-Record-ID"), "payload_digest": digest, "payload_bytes": size}
    if kind == "revisit":
        return out | {"refers_to": urn("WARC-Refers-To")}
    if size != len(payload) or digest != base32_sha1(payload):
        return out | {"error": "payload differs from its length or digest"}
    return out | {"payload": payload}


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- frames -----------------------------------------------------------------


def dictionary(samples: list[bytes], size: int) -> zstandard.ZstdCompressionDict:
    """Trained on the samples; too few to train on serve as raw content."""
    try:
        return zstandard.train_dictionary(size, samples, k=512, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[:size], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archives(
    records: Iterator[bytes], info: bytes, *, sample_bytes: int, dict_bytes: int, level: int, archive_bytes: int
) -> Iterator[bytes]:
    """Whole archives of the records, each begun by ``info`` and closed once it holds
    ``archive_bytes``."""
    ended = False
    while not ended:
        first, held = [], 0
        for r in records:
            first.append(r)
            held += len(r)
            if held >= min(sample_bytes, archive_bytes):
                break
        else:
            ended = True
        if not first:
            return
        made = dictionary([r[:65536] for r in first], dict_bytes)
        raw = made.as_bytes()
        zip_ = zstandard.ZstdCompressor(level=level, dict_data=made, write_checksum=True, write_content_size=True)
        frames = [struct.pack("<II", DICT_MAGIC, len(raw)) + raw, zip_.compress(info)]
        size = sum(map(len, frames))
        first.reverse()
        while first or not ended:
            if first:
                r = first.pop()
            else:
                r = next(records, None) if size < archive_bytes else None
                if r is None:
                    ended = size < archive_bytes
                    break
            frames.append(zip_.compress(r))
            size += len(frames[-1])
        yield b"".join(frames)


def read_frames(data: bytes, step: int = 65536) -> Iterator[tuple[bytes | None, str | None]]:
    """(record, None) per frame, or (None, what is wrong) and then no more."""
    view, at = memoryview(data), 0
    unzip = zstandard.ZstdDecompressor()
    while at < len(view):
        if len(view) - at < 8:
            yield None, "archive ends within a frame"
            return
        magic, size = struct.unpack_from("<II", view, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            body = bytes(view[at + 8 : at + 8 + size])
            if len(body) < size:
                yield None, "archive ends within a frame"
                return
            if magic == DICT_MAGIC and at == 0:
                if body[:4] == FRAME_MAGIC:
                    body = zstandard.ZstdDecompressor().decompress(body)
                unzip = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
            at += 8 + size
            continue
        try:
            declared = zstandard.get_frame_parameters(view[at : at + 18]).content_size
            frame, parts = unzip.decompressobj(), []
            while not frame.eof and at < len(view):
                piece = view[at : at + step]
                parts.append(frame.decompress(piece))
                at += len(piece) - len(frame.unused_data)
            if not frame.eof:
                yield None, "archive ends within a frame"
                return
        except zstandard.ZstdError as e:
            yield None, f"frame: {e}"
            return
        raw = b"".join(parts)
        yield (raw, None) if declared in (len(raw), zstandard.CONTENTSIZE_UNKNOWN) else (None, "frame size differs from the declared one")


# ---- Spark ------------------------------------------------------------------


def write_archives(
    pages: DataFrame,
    root: str,
    *,
    least_payload: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    sample_bytes: int = 2 << 20,
    dict_bytes: int = 32 << 10,
    level: int = 3,
    archive_bytes: int = 64 << 20,
) -> None:
    """Archives of ``pages(page_id, url, html)`` under ``root``.

    Groups of equal payloads are found on digests alone.  Only digests of more than
    one page are joined back (by a broadcast if Spark measures them small, else by a
    sort-merge join whose hot digests AQE splits)."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", F.unhex(F.sha1("html")))
    groups = (
        rows.groupBy("digest")
        .agg(F.count("*").alias("n"), F.max("page_id").alias("last"), F.max(F.octet_length("html")).alias("bytes"))
        .where((F.col("n") > 1) & (F.col("bytes") >= least_payload))
        .select("digest", "last")
    )
    joined = rows.join(written(groups, "payloads"), "digest", "left").select(
        F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("page_id"),
        "url",
        "html",
        "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last").cast("string")).alias("refers_to"),
    )

    info = record("warcinfo", "urn:archive:info", date, [("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")

    def records(batches):
        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*batch.columns):
                yield page_record(
                    page_id.as_py(), url.as_py(), html.as_py().encode(), base64.b32encode(digest.as_py()).decode(), refers_to.as_py(), date
                )

    def run(batches):
        sizes = dict(sample_bytes=sample_bytes, dict_bytes=dict_bytes, level=level, archive_bytes=archive_bytes)
        for archive in archives(records(batches), info, **sizes):
            yield pa.RecordBatch.from_arrays([pa.array([archive], pa.binary())], names=["archive"])

    whole = joined.mapInArrow(run, "archive binary").select(F.col("archive").cast("string").alias("value"))
    whole.write.option("lineSep", EMPTY_FRAME).option("compression", "none").option("maxRecordsPerFile", 1).text(root)


READ = "page_id string, url string, record_type string, refers_to string, payload_digest string, payload_bytes long, payload binary, error string"
_READ_ARROW = pa.schema(
    [(k, pa.string()) for k in ("page_id", "url", "record_type", "refers_to", "payload_digest")]
    + [("payload_bytes", pa.int64()), ("payload", pa.binary()), ("error", pa.string())]
)


def read_archives(spark: SparkSession, root: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives under ``root`` (``payloads=False`` checks
    the payloads and leaves them out)."""

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for raw, error in read_frames(content.as_py()):
                    row = parse(raw) if error is None else {"error": error}
                    size += len(raw or b"")
                    if not payloads:
                        row["payload"] = None
                    held.append(row)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=_READ_ARROW)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=_READ_ARROW)

    return spark.read.format("binaryFile").load(root).select("content").mapInArrow(run, READ)


def op7_zstd_archives(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    root = scratch_path(spark, "archives")
    write_archives(pages, root)
    ids = pages.schema["page_id"].dataType
    number = lambda c: F.nullif(F.col(c), F.lit("")).cast(ids).alias(c)
    return (
        read_archives(spark, root, payloads=False)
        .where("record_type <> 'warcinfo' OR error IS NOT NULL")
        .select(number("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to"), "error")
    )


OP7_SQL = r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), bits AS (
  SELECT *, list_aggregate(list_transform(range(1, 41), lambda i: substr(
    '0000000100100011010001010110011110001001101010111100110111101111', 4 * strpos('0123456789abcdef', hex[i]) - 3, 4)),
    'string_agg', '') AS b
  FROM p
), d AS (
  SELECT *, list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + 16 * b[5*i+1]::INT + 8 * b[5*i+2]::INT + 4 * b[5*i+3]::INT + 2 * b[5*i+4]::INT + b[5*i+5]::INT, 1)),
    'string_agg', '') AS payload_digest
  FROM bits
), g AS (SELECT hex, max(page_id) AS last FROM d GROUP BY hex)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to,
       CAST(NULL AS VARCHAR) AS error
FROM d JOIN g USING (hex)
"""
