"""Quality rules: word and repeat counts, then compression bands.

Each whole text is compressed with zstandard, and so is each of its fixed chunks.  A
ratio (bytes over compressed bytes) above the band of its length means repetitive
text, one below it means text that does not compress (keys, encoded data, noise).
The band depends on the length because a short text has little to repeat and pays the
frame's overhead.

Defined results: a null or empty text has no words, all counts 0, and is rejected by
the base rule; repeated rows are judged each; further columns are ignored by
``judge`` and carried by ``keep_good``.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sintonia.llm.common import WHITE, fresh, table

SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Bands:
    """Ratio limits by length in bytes: a row ``(from, lowest, highest)`` holds for
    lengths from ``from`` up to the next row.  The lows lie between what random text or
    base64 reaches at the end of a row (1.05 to 1.18 below 512 bytes, 1.25 at 1 KB, 1.31
    at 4 KB, 1.33 at 100 KB) and the least of prose at its start (1.11 at 256 bytes, 1.26
    at 512, 1.47 at 1 KB, 1.66 at 2 KB, 1.87 at 4 KB)."""

    whole: tuple[tuple[int, float, float], ...] = (
        (0, 0.0, 1e9),
        (128, 0.95, 4.0),
        (256, 1.06, 4.0),
        (384, 1.14, 4.0),
        (512, 1.22, 4.5),
        (640, 1.26, 4.5),
        (768, 1.3, 4.5),
        (1024, 1.38, 4.5),
        (2048, 1.5, 5.0),
        (4096, 1.6, 5.0),
        (8192, 1.6, 6.0),
        (65536, 1.6, 8.0),
    )
    #: Further lows of texts whose bytes are mostly ASCII: hex reaches 1.9 at 8 KB and
    #: 1.96 at 100 KB, prose 2.1 and 2.3 at least.  Below 8 KB the two overlap.
    ascii_low: tuple[tuple[int, float, float], ...] = ((0, 0.0, 1e9), (8192, 1.95, 1e9), (16384, 2.05, 1e9))
    #: Limits of one fixed chunk, by its length likewise.
    chunk: tuple[tuple[int, float, float], ...] = ((0, 0.0, 1e9), (512, 1.22, 1e9), (1024, 1.38, 6.0), (2048, 1.5, 6.0), (4096, 1.6, 6.0))
    chunk_bytes: int = 4096
    #: Share of a text's chunks that may lie outside their band.
    odd_chunks: float = 0.25
    level: int = 3


def _limits(bands: tuple[tuple[int, float, float], ...], size: int) -> tuple[float, float]:
    return next((low, high) for start, low, high in reversed(bands) if size >= start)


def _repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    again = np.fromiter(map((1).__lt__, map(seen.__getitem__, windows)), bool, len(windows))
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(windows)] |= again
    return int(covered.sum())


def measure(text: bytes, points: int) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a UTF-8 text
    of ``points`` code points."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (
        len(words),
        points - (len(text) - len(text.translate(None, WHITE))),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeat_words(words),
    )


def compression(text: bytes, bands: Bands, zip_: zstandard.ZstdCompressor) -> tuple[float, int, int, bool]:
    """(whole ratio, chunks outside their band, chunks, verdict)."""
    if not text:
        return 0.0, 0, 0, True
    ratio = len(text) / len(zip_.compress(text))
    low, high = _limits(bands.whole, len(text))
    if 2 * np.count_nonzero(np.frombuffer(text, np.uint8) < 128) > len(text):
        low = max(low, _limits(bands.ascii_low, len(text))[0])
    step = bands.chunk_bytes
    odd = total = 0
    if len(text) > step:
        view = memoryview(text)
        for k in range(0, len(text), step):
            part = view[k : k + step]
            a, b = _limits(bands.chunk, len(part))
            total += 1
            odd += not a <= len(part) / len(zip_.compress(part)) <= b
    return ratio, odd, total, low <= ratio <= high and odd <= bands.odd_chunks * total


MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, zstd_ratio double, odd_chunks long, chunks long"


def _columns(texts: pa.Array, bands: Bands) -> list[list]:
    zip_ = zstandard.ZstdCompressor(level=bands.level)
    points = pc.utf8_length(texts)
    out: list[list] = [[] for _ in range(10)]
    for value, n in zip(texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()), points):
        text = value.as_py() or b""
        counts = measure(text, n.as_py() or 0)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        ratio, odd, total, good = compression(text, bands, zip_)
        for column, x in zip(out, chain(counts, (failed, good and not failed, ratio, odd, total))):
            column.append(x)
    return out


def judge(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: the counts, the base rule's verdict
    and the method's (``kept``).  No shuffle: each text is judged where it is read."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *T.StructType.fromDDL(MEASURES).fields])
    arrow = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] + [pa.int64()] * 2

    def run(batches):
        for batch in batches:
            made = [pa.array(x, t) for x, t in zip(_columns(batch.column(1), bands), arrow)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def keep_good(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The rows of ``docs`` that pass, all columns.  Judged in place: an Arrow UDF
    adds the verdict and the filter drops it again, so nothing is joined."""
    verdict = fresh(docs.columns, "kept")

    @F.arrow_udf(T.BooleanType())
    def passes(texts: pa.Array) -> pa.Array:
        return pa.array(_columns(texts, bands)[6], pa.bool_())

    return docs.withColumn(verdict, passes(F.col("text"))).where(F.col(verdict)).select(*docs.columns)


def op2_compression_bands(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))
