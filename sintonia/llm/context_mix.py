"""Language-model scoring by online logistic context mixing.

A text is coded byte by byte, each byte as a path of binary decisions in a Huffman tree
of the training bytes after the same last byte and kind of byte before it; a byte that
UTF-8 never uses ends the text.  For every decision several predictors, each a table of
bit counts under a hashed context (two, four or six bytes before) and the tree node, give a
probability.  A gate, made of the depth in the tree, the kind of byte before and whether
the longest context is known, chooses the weights that mix them in the logistic domain.
An adaptive map from (gate, probability) to probability is averaged in.  Weights and map
start for every text from what was learned on the training texts and are refined online,
from one block of decisions to the next; blocks double from ``first_step`` bytes to
``step``.  A block is predicted before anything learns from it, so the product is a
probability of the whole text.  Blocks of several texts are computed together, but scores
do not depend on other texts or their order.

The tables count every training text; tasks count on their own, and their tables are
added block by block.  Their slots grow with the square root of the training bytes, up
to ``most_bits``.  Every training text also teaches the start: each half of them (by a
hash of the text) is predicted by the other half's tables, in one pass that counts the
decisions by gate and level of each prediction.  These counts, of a fixed size, are all
that the start weights (by Newton's method) and the map need.  Then the halves' tables
are added.  A plain unigram score with add-one smoothing comes besides: words that may be
frequent (at most ``frequent`` of them, whatever the corpus) are broadcast with their
counts, the others meet theirs in a join, where none is frequent.

Defined results: a null text is empty (the end alone); a null doc_id hashes as empty
text; repeated rows are scored each; with no training text every count is 0; further
columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter, deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sintonia.llm.common import discard, table, text_or_empty, written

END = 255
#: Words never hold this byte, so keys that start with it count bytes.
BYTE_KEY = b"\xff"
#: What stands before a text for its first contexts.
PAD = BYTE_KEY * 8


@dataclass(frozen=True)
class Mixer:
    #: Contexts: how many bytes before (even numbers).
    orders: tuple[int, ...] = (2, 4, 6)
    #: 2 ** slot_bits slots a context; None: ``root_slots`` a square root of the training
    #: bytes, as a power of two from 2 ** block_bits to 2 ** most_bits (a byte each when
    #: they are broadcast, eight in a task that counts).
    slot_bits: int | None = None
    root_slots: int = 32
    most_bits: int = 24
    #: Slots per row when tables are added up.
    block_bits: int = 12
    #: Bytes of the first block; blocks double up to ``step``.
    first_step: int = 512
    step: int = 4096
    #: Newton steps for the start weights, and the pull towards ``first_weight``.
    rounds: int = 3
    pull: float = 50.0
    first_weight: float = 0.42
    rate: float = 1.2
    map_steps: int = 24
    #: Decisions that a probability, and at most a learned map entry, stand for.
    map_prior: float = 12.0
    map_start: float = 24.0
    map_share: float = 0.5
    frequent: int = 1 << 20

    @property
    def slots(self) -> int:
        return 1 << self.slot_bits

    def sized(self, training_bytes: int) -> Mixer:
        """The same with ``slot_bits`` told."""
        if self.slot_bits is not None:
            return self
        bits = math.ceil(math.log2(max(1.0, self.root_slots * math.sqrt(training_bytes))))
        return replace(self, slot_bits=min(max(bits, self.block_bits), self.most_bits))


# ---- binary code ------------------------------------------------------------


#: A text begins as after white space.
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32, END]] = True
_A, _B, _NODE = np.array([0x9E3779B1, 0x85EBCA6B, 0x9E3779B1 * 0x85EBCA6B & 0xFFFFFFFF], np.uint32)

#: Classes of the byte before the last: each small letter, white space or none, capitals,
#: digits, other ASCII, continuation and leading bytes.
_CLASSES = 32
_CLASS = np.full(256, 29, np.uint16)
_CLASS[ord("a") : ord("z") + 1] = np.arange(1, 27)
_CLASS[ord("A") : ord("Z") + 1] = 27
_CLASS[ord("0") : ord("9") + 1] = 28
_CLASS[128:192] = 30
_CLASS[192:] = 31
_CLASS[_WHITE] = 0


def taken(values: np.ndarray, index: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """``values[index]``, quicker where every index is known to exist."""
    return values.take(index, mode="clip", out=out)


def before(symbols: np.ndarray) -> np.ndarray:
    """Class of the byte before the last and the last byte, as one number below
    ``256 * _CLASSES``, for each position from ``len(PAD)`` on."""
    pad = len(PAD)
    return (taken(_CLASS, symbols[pad - 2 : -2]) << 8) + symbols[pad - 1 : -1]


class Code:
    """Huffman trees of 256 symbols: path of (node, bit) of each symbol in each tree.

    Counts per symbol make one tree.  Counts per (``before``, symbol) make a tree for each
    of the ``most_trees`` commonest ``before`` that occur ``least`` times, else the last
    byte's tree serves, or one of all counts."""

    def __init__(self, counts: np.ndarray, most_trees: int = 1024, least: int = 4096):
        counts = np.asarray(counts)
        self.tree_of = np.zeros(256 * _CLASSES, np.int32)
        trees = [counts if counts.ndim == 1 else counts.sum(axis=0)]
        if counts.ndim == 2:
            last = counts.reshape(_CLASSES, 256, 256).sum(axis=0)
            for byte in np.flatnonzero(last.any(axis=1)):
                self.tree_of[byte::256] = len(trees)
                trees.append(last[byte])
            times = counts.sum(axis=1)
            common = np.argsort(-times, kind="stable")[:most_trees]
            for context in common[times[common] >= least]:
                self.tree_of[context] = len(trees)
                trees.append(counts[context])
        paths = [path for tree in trees for path in huffman(tree)]
        size = np.array([len(p) for p in paths], np.int64)
        #: first decision and, in the last 8 bits, number of decisions
        self.span = ((np.cumsum(size) - size) << 8 | size).astype(np.uint32)
        #: node, bit and depth (at most 11) of each decision, in 8, 1 and 4 bits
        self.steps = np.array([x | min(k, 11) << 9 for p in paths for k, x in enumerate(p)], np.uint16)

    @property
    def size(self) -> np.ndarray:
        return self.span & 255

    @property
    def node_part(self) -> np.ndarray:
        return node_parts(self.steps)

    @property
    def bit(self) -> np.ndarray:
        return (self.steps >> 8 & 1).astype(np.uint8)

    def decisions(self, symbols: np.ndarray, coded: np.ndarray | None = None, context: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``symbols``, index into steps) of each decision of the symbols that
        are coded (all if not told), in the trees of ``context`` (the first if not told)."""
        span = taken(self.span, symbols if context is None else (taken(self.tree_of, context) << 8) + symbols).astype(np.int64)
        size = span & 255
        if coded is not None:
            size *= coded
        shift = (span >> 8) - np.cumsum(size) + size
        at = np.repeat(np.arange(len(symbols)), size)
        path = taken(shift, at)
        path += np.arange(len(at))
        return at, path


def huffman(counts: np.ndarray) -> list[list[int]]:
    """The path of each symbol: node | bit << 8 of each decision."""
    heap = [(int(c) + 1, s, s) for s, c in enumerate(counts)]
    heapq.heapify(heap)
    children = []
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        new = 256 + len(children)
        children.append((a[2], b[2]))
        heapq.heappush(heap, (a[0] + b[0], new, new))
    paths: list[list[int]] = [[] for _ in range(256 + len(children))]
    for node in range(len(children) - 1, -1, -1):
        for bit, child in enumerate(children[node]):
            paths[child] = [*paths[256 + node], node | bit << 8]
    return paths[:256]


def node_parts(steps: np.ndarray) -> np.ndarray:
    return (steps & 255).astype(np.uint32) * _NODE


def padded(texts: list[bytes]) -> np.ndarray:
    """The texts as symbols, each between ``PAD`` ends and its own end."""
    return np.frombuffer(b"".join(PAD + t + BYTE_KEY for t in texts), np.uint8)


def not_pads(sizes: list[int]) -> np.ndarray:
    """Which positions from ``len(PAD)`` on are not in the pads before parts of these
    sizes, all joined."""
    coded = np.ones(sum(sizes) + len(PAD) * (len(sizes) - 1), bool)
    ends = np.cumsum([n + len(PAD) for n in sizes[:-1]], dtype=np.int64)
    for k in range(len(PAD)):  # the pads of all but the first part
        coded[ends - len(PAD) + k] = False
    return coded


def contexts(symbols: np.ndarray, orders: tuple[int, ...]) -> list[np.ndarray]:
    """A 32-bit hash of the ``order`` symbols before each position from ``len(PAD)``
    on, for even orders of up to ``len(PAD)``: pairs of symbols, mixed one by one."""
    s = symbols.astype(np.uint32)
    pairs = (s[:-1] * _A + s[1:]) * _B  # pairs[k]: symbols k and k + 1
    pairs ^= pairs >> np.uint32(15)
    n, pad = len(symbols), len(PAD)
    out, h = [], np.zeros(n - pad, np.uint32)
    for back in range(2, max(orders) + 1, 2):
        h = (h + pairs[pad - back : n - back]) * _A
        if back in orders:
            out.append((h ^ (h >> np.uint32(15))) * _B)
    return out


def slots_of(context: np.ndarray, node_part: np.ndarray, bits: int) -> np.ndarray:
    h = context + node_part
    h >>= np.uint32(32 - bits)
    return h


# ---- training ---------------------------------------------------------------


#: Bytes that are counted at a time; what they need stays in the processor's cache.
_PIECE = 1 << 14
_LONG = 4 * _PIECE


def count_tables(texts: list[bytes], code: Code, how: Mixer, tables: np.ndarray) -> None:
    """Add the decisions of ``texts`` to ``tables[context, 2 * slot + bit]``; long texts
    by pieces, each after the bytes before it, so that memory does not grow with them."""
    for text in (t for t in texts if len(t) > _LONG):
        symbols = np.frombuffer(PAD + text + BYTE_KEY, np.uint8)
        for at in range(0, len(symbols) - len(PAD), _LONG):
            part = symbols[at : at + _LONG + len(PAD)]
            _count(part, np.ones(len(part) - len(PAD), bool), code, how, tables)
    texts = [t for t in texts if len(t) <= _LONG]
    if not texts:
        return
    symbols = padded(texts)
    _count(symbols, not_pads([len(t) + 1 for t in texts]), code, how, tables)


def _count(symbols: np.ndarray, coded: np.ndarray, code: Code, how: Mixer, tables: np.ndarray) -> None:
    at, path = code.decisions(symbols[len(PAD) :], coded, before(symbols))
    steps = taken(code.steps, path)
    part, bit = node_parts(steps), (steps >> 8 & 1).astype(np.uint32)
    for k, c in enumerate(contexts(symbols, how.orders)):
        cell = slots_of(taken(c, at), part, how.slot_bits)
        cell <<= np.uint32(1)
        cell |= bit
        np.add.at(tables[k], cell.astype(np.int64), tables.dtype.type(1))


#: Steps of a stretched probability in a table.
_FINE = 16


def stretched(counts: np.ndarray) -> np.ndarray:
    """ln(p / (1 - p)) per slot in sixteenths, from (zero, one) counts by turns in the
    last axis; an unseen slot says nothing."""
    zero, one = counts[..., 0::2].astype(np.float64), counts[..., 1::2].astype(np.float64)
    return np.clip(np.rint(_FINE * (np.log(one + 0.4) - np.log(zero + 0.4))), -127, 127).astype(np.int8)


# ---- scoring ----------------------------------------------------------------

_KINDS = 24  # 12 depths, after white space or not
_GATES = 2 * _KINDS

#: Bytes of several texts that are predicted together.
_TOGETHER = 1 << 15

#: For learning, stretched probabilities are cut into levels on either side of 0: their
#: greatest values and middles.
_TOPS = np.array([0, 2, 6, 11, 18, 28, 43, 68, 127])
_MIDDLES = np.array([0, 1.5, 4.5, 9, 15, 23.5, 36, 56, 98])
_SIDE = len(_TOPS) - 1
_WIDTH = 2 * _SIDE + 1


def levels(stretch: np.ndarray) -> np.ndarray:
    every = np.arange(-128, 128)
    level = np.sign(every) * np.searchsorted(_TOPS, np.minimum(np.abs(every), 127))
    return np.roll(level, 128).astype(np.int8)[stretch.view(np.uint8)]


@dataclass
class Start:
    """What a text begins with: weights per (context, gate) and the map's counts."""

    weights: np.ndarray
    seen: np.ndarray
    ones: np.ndarray

    @staticmethod
    def plain(how: Mixer) -> Start:
        cells = _GATES * how.map_steps
        weights = np.full((len(how.orders), _GATES), how.first_weight, np.float32)
        return Start(weights, np.zeros(cells, np.float32), np.zeros(cells, np.float32))


def mix(weights: np.ndarray, x: np.ndarray, gate: np.ndarray, how: Mixer) -> tuple[np.ndarray, np.ndarray]:
    """(probability of a one, cell of the map) of each decision."""
    mixed = taken(weights[0], gate)
    mixed *= x[0]
    for w, row in zip(weights[1:], x[1:]):
        more = taken(w, gate)
        more *= row
        mixed += more
    np.clip(mixed, -8, 8, out=mixed)
    steps = (how.map_steps - 1) / 16
    step = mixed * mixed.dtype.type(steps)
    step += mixed.dtype.type(8 * steps + 0.5)
    cell = gate * how.map_steps
    cell += step.astype(np.int32)
    np.negative(mixed, out=mixed)
    np.exp(mixed, out=mixed)
    mixed += 1
    return np.reciprocal(mixed, out=mixed), cell


class Model:
    def __init__(self, code: Code, stretch: np.ndarray, how: Mixer, start: Start | None = None):
        self.code, self.stretch, self.how = code, stretch, how
        self.start = start or Start.plain(how)

    def _inputs(self, parts: list[np.ndarray], tables: np.ndarray, apart: int = _GATES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(position, bit, what ``tables`` hold per context, gate) of the decisions of
        ``parts`` of texts, each after its pad or the bytes before; a gate is ``apart``
        times the part's number more."""
        symbols = np.concatenate(parts) if len(parts) > 1 else parts[0]
        sizes = [len(p) - len(PAD) for p in parts]
        at, path = self.code.decisions(symbols[len(PAD) :], not_pads(sizes) if len(parts) > 1 else None, before(symbols))
        steps = taken(self.code.steps, path)
        part, high = node_parts(steps), (steps >> 8).astype(np.uint8)
        found = np.empty((len(self.how.orders), len(at)), np.int8)
        for row, values, h in zip(found, tables, contexts(symbols, self.how.orders)):
            taken(values, slots_of(taken(h, at), part, self.how.slot_bits), out=row)
        owner = np.repeat(np.arange(len(parts)) * apart, [n + len(PAD) for n in sizes])[: len(symbols) - len(PAD)]
        owner += taken(_WHITE, symbols[len(PAD) - 1 : -1])
        gate, kind = taken(owner, at), high & 30  # twice the depth
        kind += (found[-1] == 0).view(np.uint8) * np.uint8(_KINDS)  # the longest context says nothing
        gate += kind
        return at, high & 1, found, gate

    def log10(self, text: bytes) -> float:
        """log10 probability of the text and its end."""
        return self.log10s([text])[0]

    def log10s(self, texts: list[bytes]) -> list[float]:
        """log10 probability of each text and its end; blocks of several texts are
        predicted together, each with its own text's weights and map."""
        how = self.how
        whole = [padded([t]) for t in texts]
        state = [np.repeat(v[None], len(texts), axis=0) for v in (self.start.weights, self.start.seen, self.start.ones)]
        totals, at, step = np.zeros(len(texts)), [0] * len(texts), [how.first_step] * len(texts)
        waiting: tuple[deque[int], deque[int]] = deque(), deque()  # whether the next block is the last

        def left(k: int) -> int:
            return len(whole[k]) - len(PAD) - at[k]

        for k in range(len(texts)):
            waiting[left(k) <= step[k]].append(k)
        while waiting[0] or waiting[1]:
            last = not waiting[0]
            queue, some, size = waiting[last], [], 0
            while queue and (not some or size + min(left(queue[0]), step[queue[0]]) <= _TOGETHER):
                some.append(queue.popleft())
                size += min(left(some[-1]), step[some[-1]])
            totals[some] += self._block([whole[k][at[k] : at[k] + step[k] + len(PAD)] for k in some], some, state, not last)
            for k in [] if last else some:
                at[k], step[k] = at[k] + step[k], min(2 * step[k], how.step)
                waiting[left(k) <= step[k]].append(k)
        return (totals / math.log(10)).tolist()

    def _block(self, parts: list[np.ndarray], owners: list[int], state: list[np.ndarray], refine: bool) -> np.ndarray:
        """Sum of ln probability of each part; its owner's ``state`` learns from it."""
        how, n = self.how, len(parts)
        weights, seen, ones = (v[owners] for v in state)
        at, bit, found, gate = self._inputs(parts, self.stretch)
        x = found.astype(np.float32)
        p, cell = mix((weights.transpose(1, 0, 2) * np.float32(1 / _FINE)).reshape(len(how.orders), -1), x, gate, how)
        # the map's say: p + map_share * (ones - seen * p) / (seen + map_prior)
        pull = how.map_share / (seen + how.map_prior)
        final = p * taken(1 - pull * seen, cell)
        final += taken(pull * ones, cell)
        y = bit.astype(np.float32)
        final += y
        final -= 1
        np.log(np.abs(final, out=final), out=final)
        begins = np.cumsum([0, *(len(part) for part in parts[:-1])])
        totals = np.add.reduceat(final, np.searchsorted(at, begins), dtype=np.float64)
        if refine:
            error = y - p
            zero, one = bits_by_cell(cell, bit, seen.size)
            both = zero + one
            pace = how.rate / _FINE / np.maximum(both.reshape(-1, how.map_steps).sum(axis=1), 64)
            for i, row in enumerate(x):
                row *= error
                weights[:, i] += (pace * np.bincount(gate, weights=row, minlength=n * _GATES)).reshape(n, -1)
            seen += both.reshape(n, -1)
            ones += one.reshape(n, -1)
            for v, new in zip(state, (weights, seen, ones)):
                v[owners] = new
        return totals

    def add_joint(self, texts: Iterable[bytes], joint: np.ndarray, table: np.ndarray | None = None) -> None:
        """Add the decisions of ``texts`` to ``joint``, numbers of each (gate, level per
        context, bit); ``table``: the levels, if they were made before."""
        table = levels(self.stretch) if table is None else table

        def add(parts: list[np.ndarray]) -> None:
            _, y, found, gate = self._inputs(parts, table, 0)
            cell = found[0].astype(np.int32)
            for row in found[1:]:
                cell *= _WIDTH
                cell += row
            cell <<= 1
            cell += y
            gate *= 2 * _WIDTH ** len(found)
            gate += cell
            gate += _WIDTH ** len(found) - 1  # 2 * _SIDE of each context: no level is below 0
            np.add.at(joint, gate, joint.dtype.type(1))

        held, size = [], 0
        for text in texts:
            whole = padded([text])
            for at in range(0, len(whole) - len(PAD), _TOGETHER):
                held.append(whole[at : at + _TOGETHER + len(PAD)])
                size += len(held[-1])
                if size > _TOGETHER:
                    add(held)
                    held, size = [], 0
        if held:
            add(held)

    def slopes(self, texts: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``slopes_of`` the decisions of ``texts`` by the start weights."""
        joint = empty_joint(self.how)
        self.add_joint(texts, joint)
        return slopes_of(joint, self.start, self.how)


def empty_joint(how: Mixer) -> np.ndarray:
    return np.zeros(2 * _GATES * _WIDTH ** len(how.orders), np.uint32)


def slopes_of(joint: np.ndarray, start: Start, how: Mixer) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all decisions in ``joint`` by the weights of ``start``: per gate the
    gradient and the upper half of the curvature; zeros and ones per map cell."""
    n = len(how.orders)
    times = joint.reshape(-1, 2)
    found = np.flatnonzero(times.any(axis=1))
    times, rest = times[found].astype(np.float64), found
    x = np.empty((n, len(found)))
    for i in range(n - 1, -1, -1):
        rest, level = np.divmod(rest, _WIDTH)
        level -= _SIDE
        x[i] = np.sign(level) * _MIDDLES[np.abs(level)] / _FINE
    p, cell = mix(start.weights.astype(np.float64), x, rest, how)
    both = times.sum(axis=1)
    error, bend = times[:, 1] - both * p, both * p * (1 - p)
    terms = [error * row for row in x] + [bend * x[i] * x[j] for i in range(n) for j in range(i, n)]
    sums = np.array([np.bincount(rest, weights=term, minlength=_GATES) for term in terms])
    size = _GATES * how.map_steps
    cells = np.array([np.bincount(cell, weights=t, minlength=size) for t in times.T]).astype(np.int64)
    return sums, cells


def bits_by_cell(cell: np.ndarray, bit: np.ndarray, cells: int) -> np.ndarray:
    """Number of zeros, and of ones, per cell."""
    both = cell << 1
    both += bit
    return np.bincount(both, minlength=2 * cells).reshape(cells, 2).T


def newton_step(start: Start, sums: np.ndarray, cells: np.ndarray, how: Mixer) -> Start:
    """The start after one step."""
    n = len(how.orders)
    weights = start.weights.astype(np.float64)
    for gate in range(_GATES):
        bend = np.zeros((n, n))
        bend[np.triu_indices(n)] = sums[n:, gate]
        bend += np.triu(bend, 1).T + how.pull * np.eye(n)
        slope = sums[:n, gate] - how.pull * (weights[:, gate] - how.first_weight)
        weights[:, gate] += np.linalg.solve(bend, slope)
    weights = np.rint(np.clip(weights, -2, 4) * 4096) / 4096  # alike however the sums were cut
    seen = cells.sum(axis=0)
    kept = np.minimum(seen, how.map_start)
    return Start(weights.astype(np.float32), kept.astype(np.float32), (cells[1] / np.maximum(seen, 1) * kept).astype(np.float32))


# ---- Spark ------------------------------------------------------------------


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 7 == 2


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()  # bytes: A-Z and ASCII white space only


def _slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in small parts, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def keep_memory(size: int = 24 << 20) -> None:
    """Make and free an array of ``size`` bytes that nothing touches.  The C library then
    serves arrays up to that size from memory it keeps (about twice as much at most);
    else each block's arrays go back to the system and are mapped anew, page by page."""
    np.empty(size, np.uint8)


def _texts(batch: pa.RecordBatch, column: int = 0) -> list[bytes]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def count_bytes(text: bytes, values: np.ndarray) -> None:
    """Add the text's (``before``, byte) to ``values``; a long text by pieces."""
    symbols = np.frombuffer(PAD + text + BYTE_KEY, np.uint8)
    for at in range(0, len(symbols) - len(PAD), _LONG):
        part = symbols[at : at + _LONG + len(PAD)]
        np.add.at(values, (before(part).astype(np.int64) << 8) + part[len(PAD) :], 1)


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, n``: words, the end (empty) and (``before``, byte) of ``texts(text)``, the
    latter as a key of ``BYTE_KEY`` and three bytes."""

    def rows(words: Iterable[bytes], ns: Iterable[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(ns, pa.int64())], names=["word", "n"])

    def run(batches):
        counts: Counter[bytes] = Counter()
        values = np.zeros(_CLASSES << 16, np.int64)
        for batch in _slices(batches):
            for text in _texts(batch):
                counts.update(words_of(text))
                counts[b""] += 1
                count_bytes(text, values)
                if len(counts) > 200_000:
                    yield rows(list(counts), list(counts.values()))
                    counts = Counter()
        found = np.flatnonzero(values)
        yield rows([*counts, *(BYTE_KEY + k.to_bytes(3) for k in found.tolist())], [*counts.values(), *values[found].tolist()])

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


_BLOCK = "block int, counts binary, width int"


def packed(numbers: Iterable[int], blocks: Iterable[np.ndarray], least: int = 2) -> pa.RecordBatch:
    """Rows of ``_BLOCK``: the counts of a block as numbers of ``width`` bytes, the fewest
    (``least`` at least) that hold them."""
    counts, widths = [], []
    for block in blocks:
        widths.append(next(w for w in (2, 4, 8) if w >= least and (w == 8 or int(block.max()) >> 8 * w == 0)))
        counts.append(zlib.compress(block.astype(f"<u{widths[-1]}").tobytes(), 1))
    columns = [pa.array(numbers, pa.int32()), pa.array(counts, pa.binary()), pa.array(widths, pa.int32())]
    return pa.RecordBatch.from_arrays(columns, names=["block", "counts", "width"])


def table_blocks(texts: DataFrame, code: Code, how: Mixer) -> DataFrame:
    """``block, counts``: counts of the decisions of ``texts(text)``, packed blocks of
    ``contexts x 2 * slots`` numbers; a row per task and block, to be added."""
    width = 2 << how.block_bits

    def rows(tables):
        blocks = tables.reshape(-1, width)
        for at in range(0, len(blocks), 256):
            part = blocks[at : at + 256]
            yield packed(range(at, at + len(part)), part)

    def count(batches):
        keep_memory()
        tables, size, done = None, 0, 0
        held: list[bytes] = []
        for batch in _slices(batches):
            for text in _texts(batch):
                if tables is None:
                    tables = np.zeros((len(how.orders), 2 * how.slots), np.uint32)
                held.append(text)
                size += len(text) + 1
                if size > _PIECE:
                    count_tables(held, code, how, tables)
                    held, size, done = [], 0, done + size
                if done > 1 << 30:  # counts stay within 32 bits
                    yield from rows(tables)
                    tables, done = None, 0
        if held:
            count_tables(held, code, how, tables)
        if tables is not None:
            yield from rows(tables)

    return texts.mapInArrow(count, _BLOCK)


def added(blocks: DataFrame) -> DataFrame:
    """One row per block, the sum of all its rows, in numbers of 8 bytes."""

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts, width in zip(*(c.to_pylist() for c in batch.columns)):
                some = np.frombuffer(zlib.decompress(counts), f"<u{width}")
                if block in sums:
                    sums[block] += some
                else:
                    sums[block] = some.astype(np.uint64)
        if sums:
            yield packed(list(sums), sums.values(), 8)

    return blocks.repartition("block").mapInArrow(run, _BLOCK)


def stretch_of(blocks: DataFrame, how: Mixer) -> np.ndarray:
    """The stretched tables, contexts x slots bytes, of ``added`` blocks; only bytes come
    to the driver."""

    def run(batches):
        for batch in batches:
            made = [stretched(np.frombuffer(zlib.decompress(c), "<i8")).tobytes() for c in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["block", "stretch"])

    out = np.zeros((len(how.orders) * (how.slots >> how.block_bits), 1 << how.block_bits), np.int8)
    got = blocks.mapInArrow(run, "block int, stretch binary").toArrow()
    for block, raw in zip(got.column("block"), got.column("stretch")):
        out[block.as_py()] = np.frombuffer(raw.as_py(), np.int8)
    return out.reshape(len(how.orders), -1)


def joint_blocks(texts: DataFrame, model: Model) -> DataFrame:
    """``block, counts``: ``Model.add_joint`` of ``texts(text)`` in packed blocks; a row
    per task and block, to be added."""
    sent = texts.sparkSession.sparkContext.broadcast(Model(model.code, levels(model.stretch), model.how))

    def run(batches):
        keep_memory()
        model = sent.value
        total, size = np.int64(0), 0
        joint = empty_joint(model.how)
        for batch in _slices(batches):
            for text in (texts := _texts(batch)):
                size += len(text) + 1
            model.add_joint(texts, joint, model.stretch)
            if size > 1 << 26:  # numbers stay within 32 bits
                total, size, joint = total + joint.astype(np.int64), 0, empty_joint(model.how)
        total = total + joint.astype(np.int64)
        if total.any():
            yield packed(range(_GATES), total.reshape(_GATES, -1))

    return texts.mapInArrow(run, _BLOCK)


def learned_start(texts: DataFrame, model: Model, *more: tuple[DataFrame, Model]) -> Start:
    """Start weights and map learned on all ``texts(text)``, which ``model``'s tables have
    not counted, and on ``more`` such pairs.  One pass counts the decisions by gate and
    levels; the steps need no more than these numbers, of a fixed size."""
    how, start = model.how, model.start
    blocks = joint_blocks(texts, model)
    for part, other in more:
        blocks = blocks.unionAll(joint_blocks(part, other))
    rows = added(blocks).collect()  # at most _GATES rows
    if not rows:
        return start
    joint = empty_joint(how).astype(np.int64).reshape(_GATES, -1)
    for r in rows:
        joint[r.block] = np.frombuffer(zlib.decompress(r.counts), "<i8")
    for _ in range(how.rounds):
        start = newton_step(start, *slopes_of(joint.reshape(-1), start, how), how)
    return start


def trained(training: DataFrame, code: Code, how: Mixer, n_texts: int) -> Model:
    """The model of ``training(text)``, ``n_texts`` rows: each half of it teaches the start
    through the other half's tables, both halves make the tables."""
    if not n_texts:
        return Model(code, np.zeros((len(how.orders), how.slots), np.int8), how)
    odd = F.xxhash64("text").bitwiseAND(1) == 1
    halves = [training.where(odd), training.where(~odd)]
    tables = [written(added(table_blocks(half, code, how)), "tables") for half in halves]
    one, other = (Model(code, stretch_of(t, how), how) for t in tables)
    start = learned_start(halves[0], other, (halves[1], one))
    model = Model(code, stretch_of(added(tables[0].unionAll(tables[1])), how), how, start)
    for t in tables:
        discard(t)
    return model


def score(docs: DataFrame, how: Mixer = Mixer()) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, held_out, n_tokens,
    n_known, train_tokens, base_score, score, bits_per_byte``."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", text_or_empty().alias("text"), held_out().alias("held_out"))
    training = docs.where("NOT held_out").select("text")
    counts = written(word_counts(training), "counts")
    is_byte = F.substring("word", 1, 1) == F.lit(BYTE_KEY)
    values = np.zeros((256 * _CLASSES, 256), np.int64)
    got = counts.where(is_byte).toArrow()  # 2 ** 21 rows at most
    values.reshape(-1)[[int.from_bytes(k[1:]) for k in got.column("word").to_pylist()]] = got.column("n")
    counts = counts.where(~is_byte)
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    rest = math.log10(total + distinct + 1)
    often = counts.where(F.col("n") * how.frequent > total).toArrow()  # fewer than how.frequent rows
    model = trained(training, Code(values), how.sized(int(values.sum())), int(values[:, END].sum()))
    known = {w: math.log10(n + 1) - rest for w, n in zip(often.column("word").to_pylist(), often.column("n").to_pylist())}
    sent = spark.sparkContext.broadcast((model, known))
    fields = "held_out boolean, n_tokens long, n_often long, often_score double, score double, n_bytes long, words array<binary>, times array<int>"
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *T.StructType.fromDDL(fields).fields])
    arrow = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int32())]

    def run(batches):
        keep_memory()
        model, known = sent.value
        for batch in _slices(batches):
            rows, texts = [], _texts(batch, 1)
            for text, log10 in zip(texts, model.log10s(texts)):
                words = [*words_of(text), b""]
                scores = list(map(known.get, words, repeat(0.0)))  # 0 for the rare alone
                rare = Counter(w for w, s in zip(words, scores) if not s)
                rows.append(
                    (
                        len(words),
                        len(words) - rare.total(),
                        math.fsum(scores),
                        log10,
                        len(text),
                        list(rare),
                        list(rare.values()),
                    )
                )
            made = [pa.array(c, t) for c, t in zip(zip(*rows), arrow)] if rows else [pa.array([], t) for t in arrow]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *made], names=schema.names)

    scored = written(docs.mapInArrow(run, schema).withColumn("rid", F.monotonically_increasing_id()), "scored")
    pairs = scored.select("rid", F.explode(F.arrays_zip("words", "times")).alias("p")).select("rid", F.col("p.words").alias("word"), F.col("p.times").alias("times"))
    scarce = counts.where(F.col("n") * how.frequent <= total)
    each = F.col("times") * (F.log10(F.coalesce("n", F.lit(0)) + 1) - F.lit(rest))
    found = F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)
    sums = pairs.join(scarce, "word", "left").groupBy("rid").agg(F.sum(each).alias("rare_score"), F.sum(found).alias("rare_known"))
    return scored.join(sums, "rid", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_often") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("often_score") + F.coalesce("rare_score", F.lit(0.0))).alias("base_score"),
        "score",
        (F.col("score") * F.lit(-1 / math.log10(2)) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )


def op5_context_mixing(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
