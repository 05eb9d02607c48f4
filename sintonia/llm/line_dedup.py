"""Reversible line dedup: sharded cuckoo filters over exact reference counts.

State: ``refs`` counts for every line key the documents it is in (exact), and one
cuckoo filter per shard holds the keys that ``min_docs`` documents share.  Inserting
or deleting documents adds or subtracts their counts; keys that cross ``min_docs``
go into or out of their shard's filter.  A shard whose filter is full is rebuilt
larger from the counts.

Rewriting asks the filters first.  They may say yes by mistake, to a rare key or to one
the state has never seen, so every yes is confirmed by the counts: the keys that are
shared, sorted, go with the filters.  Both are broadcast only if their measured size is
within ``broadcast_bytes``; otherwise lines meet the counts in a join with salted hot
keys.  Both ways give the same rows for any documents.

Defined results: a null or empty text is one empty line; keys shorter than
``min_chars`` code points are never dropped; every row counts as a document, also a
repeated one; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sintonia.llm.common import WHITE, table, written

SLOTS = 4
MAX_KICKS = 500


@dataclass(frozen=True)
class Rules:
    min_docs: int = 10
    min_chars: int = 1
    #: Fewest shards, and keys per shard that the number of shards grows by.
    shards: int = 256
    keys_per_shard: int = 32768
    broadcast_bytes: int = 64 << 20
    salts: int = 32


@dataclass(frozen=True)
class LineState:
    """``refs(hi, lo, n)`` exact counts, ``filters(shard, cells)``, number of shards."""

    refs: DataFrame
    filters: DataFrame
    shards: int
    rules: Rules


# ---- keys -------------------------------------------------------------------


def line_key(line: bytes) -> bytes:
    return line.strip(WHITE).lower()  # bytes.lower() changes A-Z only


def _digest(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _long_enough(key: bytes, min_chars: int) -> bool:
    return bool(key) and (min_chars <= 1 or len(key.decode("utf-8", "replace")) >= min_chars)


def _pairs(digests: bytes) -> np.ndarray:
    return np.frombuffer(digests, dtype="<i8").reshape(-1, 2)


def key_counts(docs: DataFrame, rules: Rules) -> DataFrame:
    """``hi, lo, n``: documents each key is in.  Counted per batch before the shuffle."""

    def run(batches):
        for batch in batches:
            seen: Counter[bytes] = Counter()
            for value in batch.column(0):
                keys = {line_key(x) for x in (value.as_py() or "").encode().split(b"\n")}
                seen.update(_digest(k) for k in keys if _long_enough(k, rules.min_chars))
            both = _pairs(b"".join(seen))
            yield pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(list(seen.values()), pa.int64())], names=["hi", "lo", "n"]
            )

    per_batch = docs.select("text").mapInArrow(run, "hi long, lo long, n long")
    return per_batch.groupBy("hi", "lo").agg(F.sum("n").alias("n"))


# ---- cuckoo filters ---------------------------------------------------------


class Cuckoo:
    """Buckets of four 16-bit fingerprints (0: empty), a power of two of them."""

    def __init__(self, cells: np.ndarray):
        self.cells = cells
        self.mask = len(cells) - 1

    @classmethod
    def sized(cls, keys: int) -> Cuckoo:
        buckets = 4
        while buckets * SLOTS * 0.8 < keys:
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995) & self.mask)

    def insert(self, hi: int) -> bool:
        mark, bucket = _mark(hi), hi & self.mask
        for at in (bucket, self._other(bucket, mark)):
            for slot in range(SLOTS):
                if not self.cells[at, slot]:
                    self.cells[at, slot] = mark
                    return True
        for kick in range(MAX_KICKS):
            slot = kick % SLOTS
            mark, self.cells[bucket, slot] = int(self.cells[bucket, slot]), mark
            bucket = self._other(bucket, mark)
            for slot in range(SLOTS):
                if not self.cells[bucket, slot]:
                    self.cells[bucket, slot] = mark
                    return True
        return False

    def delete(self, hi: int) -> bool:
        mark, bucket = _mark(hi), hi & self.mask
        for at in (bucket, self._other(bucket, mark)):
            for slot in range(SLOTS):
                if self.cells[at, slot] == mark:
                    self.cells[at, slot] = 0
                    return True
        return False


def _mark(hi: int) -> int:
    return ((hi >> 47) & 0xFFFF) or 1


def _filled(keys: list[int]) -> Cuckoo:
    size = len(keys)
    while True:
        made = Cuckoo.sized(size)
        if all(made.insert(k) for k in keys):
            return made
        size *= 2


class Probe:
    """All shards' filters side by side, asked for many keys at once."""

    def __init__(self, filters: list[tuple[int, bytes]], shards: int, shared: np.ndarray):
        self.start = np.zeros(shards, np.int64)
        self.mask = np.full(shards, -1, np.int64)
        cells, at = [], 0
        for shard, raw in filters:
            part = np.frombuffer(raw, np.uint16).reshape(-1, SLOTS)
            self.start[shard], self.mask[shard] = at, len(part) - 1
            cells.append(part)
            at += len(part)
        self.cells = np.concatenate(cells) if cells else np.zeros((1, SLOTS), np.uint16)
        order = np.lexsort((shared[:, 1], shared[:, 0]))
        self.hi, self.lo = shared[order, 0], shared[order, 1]
        #: Most keys with the same upper half.
        self.alike = int(np.unique(self.hi, return_counts=True)[1].max(initial=1))

    def maybe(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        shard = _shard_of(lo, len(self.start))
        mask, start = self.mask[shard], self.start[shard]
        there = mask >= 0
        mask = np.where(there, mask, 0)
        mark = (hi >> 47) & 0xFFFF
        mark[mark == 0] = 1
        first = hi & mask
        second = first ^ ((mark * 0x5BD1E995) & mask)
        same = lambda b: (self.cells[start + b] == mark[:, None].astype(np.uint16)).any(axis=1)
        return there & (same(first) | same(second))

    def hot(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Which keys the filters know and the counts confirm."""
        out = self.maybe(hi, lo)
        asked = np.flatnonzero(out)
        at, known = np.searchsorted(self.hi, hi[asked]), np.zeros(len(asked), bool)
        for k in range(self.alike):
            there = at + k < len(self.hi)
            place = np.where(there, at + k, 0)
            if len(self.hi):
                known |= there & (self.hi[place] == hi[asked]) & (self.lo[place] == lo[asked])
        out[asked] = known
        return out


def _shard_of(lo: np.ndarray, shards: int) -> np.ndarray:
    return lo % shards  # numpy's remainder is never negative


def _shard(shards: int) -> Column:
    return F.pmod("lo", F.lit(shards).cast("long"))


def _build(hot: DataFrame, shards: int) -> DataFrame:
    def run(t: pa.Table) -> pa.Table:
        made = _filled(t.column("hi").to_pylist())
        return pa.table({"shard": [t.column("shard")[0].as_py()], "cells": [made.cells.tobytes()]})

    keys = hot.select(_shard(shards).alias("shard"), "hi")
    return written(keys.groupBy("shard").applyInArrow(run, "shard long, cells binary"), "filters")


def _update(state: LineState, changes: DataFrame) -> DataFrame:
    """Filters after ``changes(hi, lo, step)``: step 1 inserts, -1 deletes."""

    def run(old: pa.Table, new: pa.Table) -> pa.Table:
        shard = (new if new.num_rows else old).column("shard")[0].as_py()
        if old.num_rows:
            made = Cuckoo(np.frombuffer(old.column("cells")[0].as_py(), np.uint16).reshape(-1, SLOTS).copy())
        else:
            made = Cuckoo.sized(new.num_rows)
        steps = list(zip(new.column("hi").to_pylist(), new.column("step").to_pylist()))
        whole = all([made.delete(hi) for hi, step in steps if step < 0]) and all(made.insert(hi) for hi, step in steps if step > 0)
        return pa.table({"shard": [shard], "cells": pa.array([made.cells.tobytes() if whole else None], pa.binary())})

    dealt = changes.select(_shard(state.shards).alias("shard"), "hi", "step")
    return written(
        state.filters.groupBy("shard").cogroup(dealt.groupBy("shard")).applyInArrow(run, "shard long, cells binary"), "filters"
    )


# ---- state ------------------------------------------------------------------


def _empty(spark: SparkSession, rules: Rules) -> LineState:
    return LineState(
        spark.createDataFrame([], "hi long, lo long, n long"), spark.createDataFrame([], "shard long, cells binary"), 0, rules
    )


def _rebuilt(refs: DataFrame, rules: Rules) -> LineState:
    hot = refs.where(F.col("n") >= rules.min_docs)
    shards = max(rules.shards, -(-hot.count() // rules.keys_per_shard))
    return LineState(refs, _build(hot, shards), shards, rules)


def _changed(state: LineState, docs: DataFrame, sign: int) -> LineState:
    rules = state.rules
    delta = key_counts(docs, rules).select("hi", "lo", F.lit(0).cast("long").alias("was"), (F.col("n") * sign).alias("step"))
    old = state.refs.select("hi", "lo", F.col("n").alias("was"), F.lit(0).cast("long").alias("step"))
    summed = old.unionAll(delta).groupBy("hi", "lo").agg(F.sum("was").alias("was"), (F.sum("was") + F.sum("step")).alias("n"))
    now = written(
        summed.withColumn("n", F.when(F.col("n") < 0, F.raise_error(F.lit("deleted documents were never inserted"))).otherwise(F.col("n"))),
        "refs",
    )
    refs = now.where("n > 0").select("hi", "lo", "n")
    floor = F.lit(rules.min_docs)
    step = (F.col("n") >= floor).cast("int") - (F.col("was") >= floor).cast("int")
    filters = _update(state, now.select("hi", "lo", step.alias("step")).where("step <> 0"))
    if filters.where("cells IS NULL").head(1):
        return _rebuilt(refs, rules)
    return replace(state, refs=refs, filters=filters)


def insert(state: LineState | None, docs: DataFrame, rules: Rules = Rules()) -> LineState:
    """The state with ``docs(text)`` added (``None``: a new one)."""
    if state is None:
        return _rebuilt(written(key_counts(docs, rules), "refs"), rules)
    return _changed(state, docs, 1)


def delete(state: LineState, docs: DataFrame) -> LineState:
    """The state as if ``docs`` had never been inserted."""
    return _changed(state, docs, -1)


# ---- rewriting --------------------------------------------------------------


def _probe(state: LineState) -> Probe | None:
    """The filters and the shared keys, or None if larger than the limit."""
    shared = state.refs.where(F.col("n") >= state.rules.min_docs).select("hi", "lo")
    size = state.filters.agg(F.coalesce(F.sum(F.length("cells")), F.lit(0))).first()[0] + 16 * shared.count()
    if size > state.rules.broadcast_bytes:
        return None
    keys = np.array([(r.hi, r.lo) for r in shared.toLocalIterator()], np.int64).reshape(-1, 2)
    return Probe([(r.shard, bytes(r.cells)) for r in state.filters.collect()], state.shards, keys)


_RESULT = "n_lines long, n_dropped long, text string"


def _rewritten(ids: pa.Array, texts: list[str], dropped, names: list[str]) -> pa.RecordBatch:
    """``dropped(keys)`` tells for the keys of all lines of the batch which go."""
    lines = [x.encode().split(b"\n") for x in texts]
    gone = dropped([line_key(x) for doc in lines for x in doc])
    kept, counts, at = [], [], 0
    for doc, text in zip(lines, texts):
        out = gone[at : at + len(doc)]
        at += len(doc)
        counts.append(int(out.sum()))
        kept.append(b"\n".join(x for x, g in zip(doc, out) if not g).decode() if counts[-1] else text)
    return pa.RecordBatch.from_arrays(
        [ids, pa.array([len(x) for x in lines], pa.int64()), pa.array(counts, pa.int64()), pa.array(kept, pa.string())], names=names
    )


def rewrite(state: LineState, docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_dropped, text`` of ``docs(doc_id, text)`` without the lines
    that ``min_docs`` documents of the state share."""
    rules, schema = state.rules, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {_RESULT}"
    names = ["doc_id", "n_lines", "n_dropped", "text"]
    docs = docs.select("doc_id", "text")
    probe = _probe(state)
    if probe is None:
        return _rewrite_by_join(state, docs, schema, names)
    sent = docs.sparkSession.sparkContext.broadcast(probe)

    def run(batches):
        def dropped(keys: list[bytes]) -> np.ndarray:
            both = _pairs(b"".join(map(_digest, keys))).astype(np.int64)
            found = sent.value.hot(both[:, 0], both[:, 1])
            short = np.fromiter((not _long_enough(k, rules.min_chars) for k in keys), bool, len(keys))
            return found & ~short

        for batch in batches:
            yield _rewritten(batch.column(0), [x or "" for x in batch.column(1).to_pylist()], dropped, names)

    return docs.mapInArrow(run, schema)


def _rewrite_by_join(state: LineState, docs: DataFrame, schema: str, names: list[str]) -> DataFrame:
    rules = state.rules
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def keys(batches):
        for batch in batches:
            rows, digests = [], []
            for k, value in enumerate(batch.column(1)):
                own = {line_key(x) for x in (value.as_py() or "").encode().split(b"\n")}
                own = {_digest(x) for x in own if _long_enough(x, rules.min_chars)}
                rows += [k] * len(own)
                digests += own
            both = _pairs(b"".join(digests))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(both[:, 0]), pa.array(both[:, 1])], names=["doc_id", "hi", "lo"]
            )

    lines = docs.mapInArrow(keys, f"doc_id {id_type}, hi long, lo long")
    lines = lines.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(rules.salts)).cast("int"))
    hot = state.refs.where(F.col("n") >= rules.min_docs).select("hi", "lo", F.explode(F.sequence(F.lit(0), F.lit(rules.salts - 1))).alias("salt"))
    found = lines.join(hot, ["hi", "lo", "salt"], "left_semi")
    drops = found.groupBy(F.col("doc_id").alias("of")).agg(F.collect_set(F.struct("hi", "lo")).alias("gone"))
    joined = docs.join(drops, docs["doc_id"].eqNullSafe(drops["of"]), "left").select(docs["doc_id"], "text", "gone")

    def run(batches):
        for batch in batches:
            gone = [{(g["hi"], g["lo"]) for g in x or ()} for x in batch.column(2).to_pylist()]
            texts = [x or "" for x in batch.column(1).to_pylist()]
            owner = [k for k, t in enumerate(texts) for _ in range(t.count("\n") + 1)]

            def dropped(keys: list[bytes]) -> np.ndarray:
                both = _pairs(b"".join(map(_digest, keys)))
                return np.fromiter(((int(h), int(l)) in gone[o] for (h, l), o in zip(both, owner)), bool, len(keys))

            yield _rewritten(batch.column(0), texts, dropped, names)

    return joined.mapInArrow(run, schema)


def op3_cuckoo_line_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents are inserted, delivered a second time, and the second delivery is
    deleted again: what is left must be what one insertion gives."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = rewrite(delete(insert(insert(None, docs), docs), docs), docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS i FROM split
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), hot AS (
  SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(hot.k) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE hot.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN hot USING (k)
GROUP BY doc_id
"""
