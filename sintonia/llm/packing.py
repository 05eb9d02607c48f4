"""Best-fit packing by a linear grouping scheme.

Documents are tokenised once; what is longer than a sequence is cut.  The plan needs
only how many pieces there are of each length (at most ``capacity`` numbers, whatever
the corpus), so it is made on the driver:

1. lengths over ``small`` of the capacity are sorted and split into groups of equal
   cardinality, and each group is rounded up to its largest length;
2. a linear program over configurations (column generation with a knapsack) packs
   these few sizes;
3. actual lengths take the places of the rounded ones, and what that leaves free is
   filled best-fit: the largest length that still fits, again and again, small ones
   included; leftovers are packed the same way.

Pieces then find their place by their rank within their length.  Ranks come from counts
per (length, hash bucket), so a length that holds a third of all pieces is spread over
``buckets``.

Defined results: a null or empty text is the end id alone; rows that repeat a doc_id are
packed each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sintonia.llm.common import table, written


@dataclass(frozen=True)
class Packing:
    tokenizer: str
    capacity: int = 2048
    end_id: int = 0
    #: Lengths up to this share of the capacity are small.
    small: float = 0.125
    groups: int = 32
    buckets: int = 128
    #: The linear program stops this near its lower bound.
    gap: float = 5e-4


# ---- tokens -----------------------------------------------------------------

#: Fixed value: how a byte-level tokenizer cuts a text before it merges bytes.
_CUTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Beyond the Latin blocks, libraries may disagree on which characters are letters.
_NOT_LATIN = re.compile("[^\x00-\u024f]")
_ENCODERS: dict[str, Encoder] = {}


def _byte_letters() -> dict[str, int]:
    """The byte-level alphabet: bytes that print stand for themselves, the others, in
    order, for the code points from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + k): b for k, b in enumerate(others)}


def _merge_ranks(path: str) -> dict[bytes, int] | None:
    """Bytes of every token by id, if the file is a plain byte-level BPE whose ids are
    the order of its merges; else None."""
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    model, cuts = made["model"], made.get("pre_tokenizer") or {}
    own = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    extra = [model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")]
    if model.get("type") != "BPE" or made.get("normalizer") or any(extra) or any(cuts.get(k) != v for k, v in own.items()):
        return None
    vocab, letters = model["vocab"], _byte_letters()
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    if any(vocab.get(a + b) != 256 + k for k, (a, b) in enumerate(pairs)):
        return None
    return {bytes(letters[c] for c in token): k for token, k in vocab.items() if k < 256 + len(pairs)}


class Encoder:
    """Ids of the tokenizer in a file, as little-endian unsigned 32-bit bytes.

    A plain byte-level BPE is run by tiktoken from the file's own vocabulary, several
    times faster and with the same ids; texts with characters beyond the Latin blocks,
    and other kinds of tokenizer, go through the tokenizers library."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        ranks = _merge_ranks(path)
        self.fast = ranks and tiktoken.Encoding(path, pat_str=_CUTS, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> bytes:
        if self.fast and not _NOT_LATIN.search(text):
            return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        return map(self.ids, texts)


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; the first may be shorter."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    return [(0, first)] * bool(first) + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, how: Packing, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``, as bytes) of
    ``docs(doc_id, text)``."""
    fields = T.StructType.fromDDL("piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids).fields
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *fields])
    end = int(how.end_id).to_bytes(4, "little")

    def run(batches):
        tokens = encoder(how.tokenizer)
        for batch in batches:
            rows, out = [], []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for k, ids in enumerate(tokens.encode(texts)):
                ids += end
                for piece, (start, length) in enumerate(cuts(len(ids) // 4, how.capacity)):
                    own = ids[4 * start : 4 * (start + length)]
                    rows.append(k)
                    out.append((piece, start, length, zlib.crc32(own), *([own] if with_ids else ())))
            columns = list(zip(*out)) or [()] * len(fields)
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            made = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *made], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


# ---- plan -------------------------------------------------------------------


def grouped(counts: np.ndarray, least: int, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Linear grouping of the lengths over ``least``: rounded sizes, descending, and
    how many items each stands for.  ``counts[length]`` items have a length."""
    lengths = np.flatnonzero(counts)
    lengths = lengths[lengths > least][::-1]
    if not len(lengths):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    upto = np.cumsum(counts[lengths])
    total = int(upto[-1])
    edges = np.unique(np.linspace(0, total, min(groups, total) + 1).astype(np.int64))
    size_of = lengths[np.searchsorted(upto, edges[:-1], side="right")]  # the largest of each group
    sizes, at = np.unique(size_of, return_inverse=True)
    demand = np.bincount(at, weights=np.diff(edges)).astype(np.int64)
    return sizes[::-1].copy(), demand[::-1].copy()


def _best_configuration(value: np.ndarray, sizes: np.ndarray, demand: np.ndarray, capacity: int) -> np.ndarray:
    """The configuration of largest value that fits, one item more in each round (at
    most capacity / smallest size)."""
    without = np.arange(capacity + 1) - sizes[:, None]  # room left by each size
    fits = without >= 0
    without = np.maximum(without, 0)
    best, chosen = np.zeros(capacity + 1), []
    for _ in range(capacity // int(sizes.min())):
        with_item = np.where(fits, best[without] + value[:, None], -1.0)
        pick = with_item.argmax(axis=0)
        now = with_item[pick, np.arange(capacity + 1)]
        better = now > best + 1e-12
        if not better.any():
            break
        chosen.append(np.where(better, pick, -1))
        best = np.where(better, now, best)
    column, room = np.zeros(len(sizes)), capacity
    for pick in reversed(chosen):
        if pick[room] >= 0:
            column[pick[room]] += 1
            room -= int(sizes[pick[room]])
    return np.minimum(column, demand)


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float) -> list[tuple[np.ndarray, int]]:
    """(items per size, how often) from the linear program over configurations,
    rounded down; what is missing then is left to the caller."""
    m = len(sizes)
    if not m:
        return []
    basis = np.diag(np.minimum(capacity // sizes, demand).astype(float))
    amounts = demand / np.diag(basis)
    for _ in range(20 * m):
        inverse = np.linalg.inv(basis)
        amounts = np.maximum(inverse @ demand, 0)
        dual = inverse.sum(axis=0)
        column = _best_configuration(dual, sizes, demand, capacity)
        worth = float(dual @ column)
        if worth <= 1 + 1e-9 or float(dual @ demand) / worth >= (1 - gap) * amounts.sum():
            break
        way = inverse @ column
        up = way > 1e-9
        ratio = np.full(m, np.inf)
        ratio[up] = amounts[up] / way[up]
        basis[:, int(ratio.argmin())] = column
    order = np.argsort(-amounts)
    return [(basis[:, k].astype(np.int64), int(amounts[k] + 1e-9)) for k in order if amounts[k] >= 1]


@dataclass
class Plan:
    """Runs of equal sequences.  Entry k: of length ``length[k]``, ranks from
    ``rank[k]`` on go ``per[k]`` to a sequence, from sequence ``first[k]`` on, at
    ``offset[k]``."""

    capacity: int
    sequences: int = 0
    entries: list[tuple[int, int, int, int, int]] = field(default_factory=list)

    def arrays(self) -> tuple[np.ndarray, ...]:
        rows = np.array(sorted(self.entries), np.int64).reshape(-1, 5)
        return tuple(rows[:, k].copy() for k in range(5))


class _Stock:
    """How many pieces of each length are left."""

    def __init__(self, counts: np.ndarray):
        self.left = [int(c) for c in counts]
        self.below = list(range(len(self.left)))  # the next length down that may be left

    def largest(self, most: int) -> int:
        """The largest length up to ``most`` that is left, or 0."""
        path, at = [], most
        while at > 0 and not (self.below[at] == at and self.left[at]):
            path.append(at)
            at = self.below[at] if self.below[at] != at else at - 1
        for p in path:
            self.below[p] = at
        return at


def make_plan(counts: np.ndarray, how: Packing) -> Plan:
    """Sequences for ``counts[length]`` pieces of each length from 1 to capacity."""
    plan, stock = Plan(how.capacity), _Stock(counts)
    ranks = [0] * (how.capacity + 1)

    def emit(times: int, targets: list[int]) -> int:
        """One run of sequences alike: pieces near the target sizes, then best-fit."""
        used: dict[int, int] = {}
        order: list[int] = []
        room, k = how.capacity, 0
        while room > 0:
            at = stock.largest(min(room, targets[k]) if k < len(targets) else room)
            while at and stock.left[at] <= used.get(at, 0):
                at = stock.largest(at - 1)
            k += 1
            if not at:
                if k > len(targets):
                    break
                continue
            many = 1 if k <= len(targets) else min(room // at, stock.left[at] - used.get(at, 0))
            if at not in used:
                order.append(at)
            used[at] = used.get(at, 0) + many
            room -= many * at
        if not used:
            return 0
        times = min([times, *(stock.left[at] // n for at, n in used.items())])
        offset = 0
        for at in order:
            n = used[at]
            plan.entries.append((at, ranks[at], plan.sequences, n, offset))
            ranks[at] += n * times
            stock.left[at] -= n * times
            offset += n * at
        plan.sequences += times
        return times

    sizes, demand = grouped(np.where(np.arange(len(counts)) < how.capacity, counts, 0), int(how.small * how.capacity), how.groups)
    while counts[how.capacity] and stock.left[how.capacity]:
        emit(stock.left[how.capacity], [how.capacity])
    for column, times in configurations(sizes, demand, how.capacity, how.gap):
        # the last place takes the largest length that fits what the others leave
        targets = [int(s) for s, n in zip(sizes, column) for _ in range(n)][:-1]
        while times > 0 and (done := emit(times, targets)):
            times -= done
    while stock.largest(how.capacity):
        emit(stock.left[stock.largest(how.capacity)], [])
    return plan


# ---- Spark ------------------------------------------------------------------


def place(cut: DataFrame, how: Packing) -> DataFrame:
    """``cut`` (a written table of ``pieces``) with ``sequence_id`` and ``offset``."""
    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(how.buckets)).cast("int")
    counted = cut.groupBy("length", bucket.alias("bucket")).agg(F.count("*").alias("n")).toArrow()
    # at most capacity x buckets numbers
    per = np.zeros((how.capacity + 1, how.buckets), np.int64)
    per[counted.column("length").to_numpy(), counted.column("bucket").to_numpy()] = counted.column("n").to_numpy()
    made = make_plan(per.sum(axis=1), how)
    before = np.cumsum(per, axis=1) - per
    sent = cut.sparkSession.sparkContext.broadcast((before, made.arrays()))
    same = Window.partitionBy("length", "bucket").orderBy(
        F.xxhash64("doc_id", "piece"), F.col("doc_id").asc_nulls_last(), "piece", "start", "ids_crc32"
    )
    ranked = cut.withColumn("bucket", bucket).withColumn("nth", F.row_number().over(same) - 1)
    schema = T.StructType([*cut.schema.fields, *T.StructType.fromDDL("sequence_id long, offset long").fields])

    kept = cut.columns

    def run(batches):
        before, (lengths, ranks, firsts, pers, offsets) = sent.value
        top = int(ranks.max(initial=0)) + 1
        keys = lengths * top + ranks
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = before[length, batch.column("bucket").to_numpy()] + batch.column("nth").to_numpy()
            at = np.searchsorted(keys, length * top + np.minimum(rank, top - 1), side="right") - 1
            turn = rank - ranks[at]
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(firsts[at] + turn // pers[at]), pa.array(offsets[at] + turn % pers[at] * length)], names=schema.names
            )

    return ranked.mapInArrow(run, schema)


def pack(docs: DataFrame, how: Packing) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id,
    offset``."""
    return place(written(pieces(docs, how), "pieces"), how)


def sequences(docs: DataFrame, how: Packing) -> DataFrame:
    """The packed sequences: ``sequence_id, ids`` (at most ``capacity`` of them)."""
    placed = place(written(pieces(docs, how, with_ids=True), "pieces"), how)

    def joined(t: pa.Table) -> pa.Table:
        order = np.argsort(t.column("offset").to_numpy())
        raw = t.column("ids").to_pylist()
        ids = np.frombuffer(b"".join(raw[k] for k in order), "<u4").astype(np.int64)
        return pa.table({"sequence_id": [t.column("sequence_id")[0].as_py()], "ids": [ids]})

    return placed.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInArrow(joined, "sequence_id long, ids array<long>")


def default_packing() -> Packing:
    import public_tokenizers

    return Packing(public_tokenizers.path("byte_bpe_50k.json"))


def op10_linear_grouping(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"), default_packing())
