"""Token ids as Arrow files of equal-length sequences.

A file is a plain Arrow IPC file (the stream format with a footer), so any Arrow reader
maps it into memory and takes sequence ``i`` without reading or copying the others.
Every batch but a file's last has ``batch`` rows of

* ``ids``: fixed-size list of ``length`` unsigned integers, of 16 bits if the vocabulary
  fits, else 32;
* ``mask``: fixed-size list of ``length`` booleans, false behind the last id of a file;
* ``docs``: the documents that begin in the sequence: doc_id, offset in it, ids.

Documents follow each other in ascending doc_id order, each with its end id.  They are
ranged by doc_id over the tasks; a task closes a file after the document that fills it,
so no document is cut, and only a file's last sequence is padded.  The schema's metadata
holds the place of the file (task, number), its ids and its sequences: sorted by place,
the files are one run of ids.

Spark's own writer writes the files, so that its commit protocol and any store it knows
serve: a row is a file without its last six bytes, the format's closing mark, which the
writer adds as the line separator.

Defined results: a null or empty text is the end id alone; a null doc_id comes last;
rows that repeat a doc_id are written each, in the order they are read; an empty table
gives no files; further columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sintonia.llm.common import scratch_path, table, written
from sintonia.llm.packing import _byte_letters

#: Fixed value: an Arrow IPC file ends with these bytes.
_CLOSING = b"ARROW1"


@dataclass(frozen=True)
class Layout:
    tokenizer: str
    end_id: int = 1
    #: Ids of a sequence, a multiple of eight so that packed masks begin at bytes.
    length: int = 2048
    #: Sequences of a batch.
    batch: int = 256
    #: Ids of a file; a document that goes beyond is still written whole.
    file_ids: int = 1 << 23


# ---- tokens ---------------------------------------------------------------------


def _latin(kind: str) -> str:
    """Characters below U+0180 of a general category, as the inside of a class."""
    return "".join(re.escape(chr(c)) for c in range(0x180) if unicodedata.category(chr(c)).startswith(kind))


#: Beyond these characters, libraries may disagree on letters, spaces or cases.
_OTHER = re.compile("[^\x09-\x0d\x20-\x7e\xa1-\u017f]|\u0130")
_L, _N = _latin("L"), _latin("N")
#: Fixed value: how the tokenizer cuts a text into words, for the characters above.
_CUTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\s{_L}{_N}]+")
#: Follows every word for tiktoken; no text that gets there holds it.
_END = "\0"
_ENCODERS: dict[str, WordEncoder] = {}


def _ranks(made: dict) -> dict[bytes, int] | None:
    """Bytes of every token by id, a word's end written as ``_END``, if the file is a
    byte-level BPE with word ends, of the cuts above, whose ids are the order of its
    merges; else None."""
    model = made["model"]
    normal = [(n.get("type"), n.get("content")) for n in (made.get("normalizer") or {}).get("normalizers", [])]
    cuts = (made.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    split = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
    extra = [model.get(k) for k in ("dropout", "continuing_subword_prefix", "ignore_merges")]
    if (
        normal != [("NFC", None), ("Replace", " "), ("Lowercase", None)]
        or cuts[0] != split
        or [(c.get("type"), c.get("add_prefix_space"), c.get("use_regex")) for c in cuts[1:]] != [("ByteLevel", False, False)]
        or model.get("end_of_word_suffix") != "</w>"
        or any(extra)
    ):
        return None
    vocab, letters = model["vocab"], _byte_letters()
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    if len(vocab) != 512 + len(pairs) or any(vocab.get(a + b) != 512 + k for k, (a, b) in enumerate(pairs)):
        return None
    ranks = {}
    for token, k in vocab.items():
        body, end = (token[:-4], _END) if token.endswith("</w>") and len(token) > 4 else (token, "")
        ranks[bytes(letters[c] for c in body) + end.encode()] = k
    return ranks if len(ranks) == len(vocab) else None


class WordEncoder:
    """Ids of the tokenizer in a file, as bytes of ``kind``.

    A byte-level BPE with word ends is run by tiktoken from the file's own vocabulary:
    the last byte of a word and its end merge before anything else, so an end is a byte
    of its own there.  Same ids, several times faster.  Texts with characters beyond the
    Latin blocks, and other kinds of tokenizer, go through the tokenizers library."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as f:
            ranks = _ranks(json.load(f))
        self.fast = ranks and tiktoken.Encoding(path, pat_str=rf"[^{_END}]*{_END}", mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> bytes:
        if self.fast and not _OTHER.search(text):
            words = _CUTS.findall(text.lower())
            found = self.fast.encode_ordinary(_END.join(words) + _END) if words else []
        else:
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(found, self.kind).tobytes()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        return map(self.ids, texts)


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


# ---- files ------------------------------------------------------------------------


def schema(length: int, kind: pa.DataType, ids: pa.DataType) -> pa.Schema:
    docs = pa.list_(pa.struct([("doc_id", ids), ("offset", pa.int32()), ("n", pa.int64())]))
    return pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length)), ("docs", docs)])


def file_bytes(docs: list[tuple], texts: list[bytes], kind: np.dtype, ids: pa.DataType, how: Layout, place: tuple[int, int]) -> bytes:
    """One file of the documents ``docs(doc_id)``, whose ids are ``texts``."""
    flat = np.frombuffer(b"".join(texts), kind)
    sizes = np.array([len(t) // kind.itemsize for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    rows = -(-len(flat) // how.length)
    padded = np.zeros(rows * how.length, kind)
    padded[: len(flat)] = flat
    # mask bits, least first: as many ones as ids, then zeros
    mask = np.packbits(np.arange(rows * how.length) < len(flat), bitorder="little")
    of = starts // how.length
    offsets = pa.array(np.searchsorted(of, np.arange(rows + 1)), pa.int32())
    items = pa.StructArray.from_arrays(
        [pa.array(docs, ids), pa.array(starts % how.length, pa.int32()), pa.array(sizes, pa.int64())], names=["doc_id", "offset", "n"]
    )
    made = schema(how.length, pa.from_numpy_dtype(kind), ids).with_metadata(
        {"task": str(place[0]), "file": str(place[1]), "ids": str(len(flat)), "sequences": str(rows), "length": str(how.length), "batch": str(how.batch)}
    )
    columns = [
        pa.FixedSizeListArray.from_arrays(pa.array(padded), how.length),
        pa.FixedSizeListArray.from_arrays(pa.Array.from_buffers(pa.bool_(), len(padded), [None, pa.py_buffer(mask)]), how.length),
        pa.ListArray.from_arrays(offsets, items),
    ]
    out = pa.BufferOutputStream()
    with pa.ipc.new_file(out, made) as f:
        f.write_table(pa.Table.from_arrays([pa.chunked_array([c]) for c in columns], schema=made), max_chunksize=how.batch)
    return out.getvalue().to_pybytes()


class SequenceFile:
    """Random access to the sequences of one file.  ``source`` is a path (mapped into
    memory) or a buffer of the file's bytes; nothing is copied or read ahead."""

    def __init__(self, source: str | pa.Buffer):
        self._reader = pa.ipc.open_file(pa.memory_map(source) if isinstance(source, str) else pa.BufferReader(source))
        meta = {k.decode(): int(v) for k, v in self._reader.schema.metadata.items()}
        self.place = meta["task"], meta["file"]
        self.n_ids, self.length, self.batch, self._rows = meta["ids"], meta["length"], meta["batch"], meta["sequences"]
        if self._rows != -(-self.n_ids // self.length) or self._reader.num_record_batches != -(-self._rows // self.batch):
            raise ValueError("sequences differ from the declared ones")

    def __len__(self) -> int:
        return self._rows

    def _row(self, i: int) -> tuple[pa.RecordBatch, int]:
        if not 0 <= i < self._rows:
            raise IndexError(i)
        return self._reader.get_batch(i // self.batch), i % self.batch

    def ids(self, i: int) -> np.ndarray:
        """A view of the file."""
        batch, row = self._row(i)
        return batch.column("ids").values.to_numpy(zero_copy_only=True)[row * self.length : (row + 1) * self.length]

    def mask(self, i: int) -> np.ndarray:
        """A view of the file: bits, eight to a byte, least first."""
        batch, row = self._row(i)
        bits = np.frombuffer(batch.column("mask").values.buffers()[1], np.uint8)
        return bits[row * self.length // 8 : (row + 1) * self.length // 8]

    def documents(self, i: int) -> list[dict]:
        """The documents that begin in sequence ``i``."""
        batch, row = self._row(i)
        return batch.column("docs")[row].as_py()

    def walk(self) -> Iterator[tuple[object, int, np.ndarray]]:
        """(doc_id, start in the file, ids) of every document, batch by batch."""
        open_doc, parts, missing = None, [], 0
        for b in range(self._reader.num_record_batches):
            batch = self._reader.get_batch(b)
            flat = batch.column("ids").values.to_numpy(zero_copy_only=True)
            first = b * self.batch * self.length
            used = 0
            if missing:
                parts.append(flat[:missing])
                used = len(parts[-1])
                missing -= used
                if missing:
                    continue
                yield (*open_doc, np.concatenate(parts))
            docs = batch.column("docs")
            row_of = np.repeat(np.arange(batch.num_rows), docs.value_lengths().to_numpy())
            items = docs.flatten()
            offsets = items.field("offset").to_numpy() + row_of * self.length
            for doc_id, at, n in zip(items.field("doc_id").to_pylist(), offsets.tolist(), items.field("n").to_pylist()):
                if at != used:
                    raise ValueError("documents do not follow each other")
                own = flat[at : at + n]
                used = at + len(own)
                if len(own) == n:
                    yield doc_id, first + at, own
                else:
                    open_doc, parts, missing = (doc_id, first + at), [own], n - len(own)
        if missing:
            raise ValueError("file ends within a document")


# ---- Spark ---------------------------------------------------------------------


def write_sequences(docs: DataFrame, root: str, how: Layout) -> None:
    """Files of ``docs(doc_id, text)`` under ``root``.  Ranging takes a row number as
    well, so that rows which repeat one doc_id spread over tasks."""
    placed = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("rid"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("rid")]
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, task = encoder(how.tokenizer), TaskContext.get().partitionId()
        end = np.array([how.end_id], tokens.kind).tobytes()
        names, texts, held, number, ids = [], [], 0, 0, None

        def closed() -> pa.RecordBatch:
            data = file_bytes(names, texts, tokens.kind, ids, how, (task, number))
            return pa.RecordBatch.from_arrays([pa.array([data[: -len(_CLOSING)]], pa.binary())], names=["file"])

        for batch in batches:
            ids = batch.schema.field(0).type
            for doc_id, own in zip(batch.column(0).to_pylist(), tokens.encode([t or "" for t in batch.column(1).to_pylist()])):
                names.append(doc_id)
                texts.append(own + end)
                held += len(texts[-1]) // tokens.kind.itemsize
                if held >= how.file_ids:
                    yield closed()
                    names, texts, held, number = [], [], 0, number + 1
        if names:
            yield closed()

    files = ordered.select("doc_id", "text").mapInArrow(run, "file binary").select(F.col("file").cast("string").alias("value"))
    # one row to a file, closed by the separator
    files.write.option("lineSep", _CLOSING.decode()).option("compression", "none").option("maxRecordsPerFile", 1).text(root)


def read_documents(spark: SparkSession, root: str, ids_type: str = "long") -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files under
    ``root``; ``start`` counts the ids of all documents before it."""

    def run(batches):
        names = ["task", "file", "doc_id", "at", "n_tokens", "ids_crc32"]
        for batch in batches:
            for content in batch.column(0):
                f = SequenceFile(content.as_buffer())
                rows = [(*f.place, k, at, len(own), zlib.crc32(own.astype("<u4"))) for k, at, own in f.walk()]
                if sum(r[4] for r in rows) != f.n_ids:
                    raise ValueError("ids differ from the declared ones")
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows)))), schema=made)

    kinds = {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    made = pa.schema(
        [("task", pa.int64()), ("file", pa.int64()), ("doc_id", kinds[ids_type]), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    )
    found = spark.read.format("binaryFile").load(root).select("content")
    rows = written(
        found.mapInArrow(run, f"task long, file long, doc_id {ids_type}, at long, n_tokens long, ids_crc32 long"), "documents"
    )
    # ids before each file: within its task, and of the tasks before (one row per task)
    sizes = rows.groupBy("task", "file").agg(F.sum("n_tokens").alias("n"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    in_task = sizes.withColumn("here", before(Window.partitionBy("task").orderBy("file")))
    tasks = sizes.groupBy("task").agg(F.sum("n").alias("n")).withColumn("there", before(Window.orderBy("task")))
    files = in_task.drop("n").join(tasks.drop("n"), "task")
    return rows.join(files, ["task", "file"]).select(
        "doc_id", (F.col("at") + F.col("here") + F.col("there")).alias("start"), "n_tokens", "ids_crc32"
    )


def default_layout() -> Layout:
    import public_tokenizers

    return Layout(public_tokenizers.path("word_bpe_49k.json"))


def op12_fixed_list_files(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    root = scratch_path(spark, "sequences")
    write_sequences(docs, root, default_layout())
    return read_documents(spark, root, docs.schema["doc_id"].dataType.simpleString())
