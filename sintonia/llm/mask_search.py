"""Ranked lexical search: the best documents of every query item, by presence masks.

Terms are runs of ASCII letters, digits and non-ASCII characters, A-Z lowered.  The
score of a document is an integer: over the item's terms, repeats included, the sum of
``w * ((10^9 tf) div (1000 tf + 12 m))`` with ``w = floor(1000 ln((2N+2) / (2df+1)))``
and ``m = 75 + (25 n N) div L``.

Items come in blocks of bounded size; each block is searched in all documents:

1. one pass reads the texts and keeps of each document its length and the block's terms
   in it; corpus numbers (N, L, df) are added up from that table;
2. a second pass goes through the table in chunks.  Every term has a bitmap of the
   chunk's documents that hold it.  For an item, the bitmaps of its terms turned
   sideways give each document's mask of matched terms, and documents are grouped by
   mask.  A mask's greatest score is the sum, over its terms, of the most that any
   document of the chunk gets from the term.  Masks are evaluated by descending
   greatest score, until it falls below the ``top``-th best score the task has found:
   no later document can enter, not even by a tie;
3. the tasks' best are ranked together.

Memory of a task: one chunk (``cells`` term x document places) and ``top`` documents
per item of the block.  What a task returns is at most ``top`` rows per item.

Defined results: null texts have no terms; an item without terms, or none that any
document holds, returns nothing; repeated documents are ranked each, a null doc_id
after all others of its score; repeated items return their documents each; an empty
table gives an empty result; further columns are ignored.  doc_id is an integer.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sintonia.llm.common import discard, scratch_path, table, written


@dataclass(frozen=True)
class Search:
    top: int = 20
    #: A block of items has so many items, and so many distinct terms unless it is one item.
    items: int = 2048
    terms: int = 1 << 15
    #: Term x document places of a chunk.
    cells: int = 1 << 23


#: Bytes of terms as they are (A-Z lowered), every other byte a space.
_TERM_BYTES = bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalnum() else 0x20 for b in range(256))
_PIECE = 1 << 20


def term_counts(text: bytes) -> tuple[int, Counter]:
    """Number of terms of a text, and the count of each; a megabyte at a time."""
    data, at, n, counts = text.translate(_TERM_BYTES), 0, 0, Counter()
    while at < len(data):
        end = at + _PIECE
        if end < len(data):
            end = data.find(b" ", end)
            end = len(data) if end < 0 else end
        words = data[at:end].split()
        n += len(words)
        counts.update(words)
        at = end
    return n, counts


# ---- items ----------------------------------------------------------------------


@dataclass
class Block:
    """Items with their terms as numbers of the block."""

    ids: list
    vocabulary: dict[bytes, int]
    terms: list[np.ndarray]
    repeats: list[np.ndarray]


def blocks(items: DataFrame, how: Search) -> Iterator[Block]:
    """Items in order of item_id, one block at a time on the driver."""
    made = Block([], {}, [], [])
    ordered = items.select("item_id", "text").orderBy(F.col("item_id").asc_nulls_last(), "text")
    for row in ordered.toLocalIterator():
        counts = term_counts((row.text or "").encode())[1]
        new = sum(t not in made.vocabulary for t in counts)
        if made.ids and (len(made.ids) >= how.items or len(made.vocabulary) + new > how.terms):
            yield made
            made = Block([], {}, [], [])
        number = made.vocabulary
        made.ids.append(row.item_id)
        made.terms.append(np.array([number.setdefault(t, len(number)) for t in counts], np.int64))
        made.repeats.append(np.array(list(counts.values()), np.int64))
    if made.ids:
        yield made


# ---- the block's terms in the documents ---------------------------------------------


def hits(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tfs``: of each document the number of its terms, and which
    of the block's terms it holds how often."""
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType), *T.StructType.fromDDL("n long, terms array<int>, tfs array<int>").fields]
    )

    def run(batches):
        for batch in batches:
            sizes, ns, terms, tfs = [0], [], [], []
            for text in batch.column(1).cast(pa.binary()):
                n, counts = term_counts(text.as_py() or b"")
                own = [(vocabulary[t], c) for t, c in counts.items() if t in vocabulary]
                ns.append(n)
                terms.extend([t for t, _ in own])
                tfs.extend([c for _, c in own])
                sizes.append(len(terms))
            offsets = pa.array(sizes, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(c, pa.int32())) for c in (terms, tfs)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ns, pa.int64()), *lists], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


# ---- masks ------------------------------------------------------------------------


def group_by_mask(present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns of ``present(term, document)`` as rows of booleans, and which of
    them each document has."""
    bits = np.packbits(present, axis=0)
    words = np.zeros((-(-len(bits) // 8) * 8, bits.shape[1]), np.uint8)
    words[: len(bits)] = bits
    words = np.ascontiguousarray(words.T).view(np.uint64)
    group = np.zeros(len(words), np.int64)
    for k in range(words.shape[1]):
        _, of = np.unique(words[:, k], return_inverse=True)
        # both numbers are below the number of documents
        _, group = np.unique(group * len(words) + of, return_inverse=True)
    _, first = np.unique(group, return_index=True)
    return present[:, first].T, group


class Best:
    """The best documents of one item so far."""

    def __init__(self, top: int):
        self.top = top
        self.score, self.no_id, self.doc = (np.empty(0, np.int64) for _ in range(3))

    @property
    def least(self) -> int:
        """What a document must reach."""
        return int(self.score[-1]) if len(self.score) == self.top else 1

    def add(self, score: np.ndarray, no_id: np.ndarray, doc: np.ndarray) -> None:
        good = score >= self.least
        if good.any():
            new = [np.concatenate([a, b[good]]) for a, b in ((self.score, score), (self.no_id, no_id), (self.doc, doc))]
            order = np.lexsort((new[2], new[1], -new[0]))[: self.top]
            self.score, self.no_id, self.doc = (a[order] for a in new)


def search_chunk(best: list[Best], block: Block, weights: np.ndarray, gains: np.ndarray, present: np.ndarray, no_id: np.ndarray, doc: np.ndarray) -> None:
    """Take a chunk's documents into ``best``.  ``gains(term, document)`` is what a
    document gets from a term before its weight."""
    most = gains.max(axis=1).astype(np.int64)
    for found, terms, repeats in zip(best, block.terms, block.repeats):
        weight = weights[terms] * repeats
        # no document of the chunk can enter
        if not len(terms) or int(weight @ most[terms]) < found.least:
            continue
        masks, group = group_by_mask(present[terms])
        greatest = (masks @ (weight * most[terms]))[group]
        order = np.argsort(-greatest, kind="stable")
        greatest, at, step = greatest[order], 0, 64
        while at < len(order) and greatest[at] >= found.least:
            some = order[at : at + step][greatest[at : at + step] >= found.least]
            found.add(weight @ gains[np.ix_(terms, some)], no_id[some], doc[some])
            at, step = at + step, step * 2


def _chunks(batches: Iterable[pa.RecordBatch], docs: int) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for at in range(0, batch.num_rows, docs):
            part = batch.slice(at, docs)
            if held and sum(b.num_rows for b in held) + part.num_rows > docs:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def _best_of_tasks(found: DataFrame, block: Block, first: int, weights: np.ndarray, n_docs: int, n_terms: int, how: Search, ids: dict) -> DataFrame:
    size = len(block.vocabulary)
    schema = T.StructType(
        [T.StructField("item", T.LongType()), T.StructField("item_id", ids["item_id"]), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]
    )

    def run(batches):
        best = [Best(how.top) for _ in block.ids]
        for rows in _chunks(batches, max(64, how.cells // max(1, size))):
            lengths = rows.column("n").to_numpy()
            doc = rows.column("doc_id").cast(pa.int64())
            no_id, doc = doc.is_null().to_numpy().astype(np.int64), doc.fill_null(0).to_numpy()
            terms = rows.column("terms").combine_chunks()
            of = np.repeat(np.arange(len(lengths)), terms.value_lengths().to_numpy())
            terms, tf = terms.flatten().to_numpy(), rows.column("tfs").combine_chunks().flatten().to_numpy().astype(np.int64)
            m = 100 - 25 + (25 * lengths * n_docs) // n_terms
            gains, present = np.zeros((size, len(lengths)), np.int32), np.zeros((size, len(lengths)), bool)
            gains[terms, of] = (1_000_000_000 * tf) // (1000 * tf + 12 * m[of])
            present[terms, of] = True
            search_chunk(best, block, weights, gains, present, no_id, doc)
        for k, b in enumerate(best):
            if len(b.score):
                own = [pa.array([first + k] * len(b.score), pa.int64()), pa.array([block.ids[k]] * len(b.score))]
                doc = pa.array(b.doc, mask=b.no_id.astype(bool))
                yield pa.RecordBatch.from_arrays([*own, doc, pa.array(b.score)], names=schema.names)

    return found.mapInArrow(run, schema)


# ---- search ---------------------------------------------------------------------------


def _weights(found: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """N, L and the weight of each term of the block."""
    corpus = found.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = np.zeros(size, np.int64)
    for r in found.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("n")).toLocalIterator():
        df[r.t] = r.n
    weights = [math.floor(1000 * math.log((2 * corpus.docs + 2) / (2 * n + 1))) for n in df.tolist()]
    return corpus.docs, corpus.terms, np.array(weights, np.int64)


def search(docs: DataFrame, items: DataFrame, how: Search = Search()) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best of ``docs(doc_id, text)`` for
    each of ``items(item_id, text)``, scores above 0 only."""
    spark, ids = docs.sparkSession, {"item_id": items.schema["item_id"].dataType}
    path, schema, first = scratch_path(spark, "best"), None, 0
    for block in blocks(items, how):
        found = written(hits(docs, block.vocabulary), "hits")
        n_docs, n_terms, weights = _weights(found, len(block.vocabulary))
        best = _best_of_tasks(found, block, first, weights, n_docs, n_terms, how, ids)
        best.write.mode("append").parquet(path)
        schema, first = best.schema, first + len(block.ids)
        discard(found)
    if schema is None:
        empty = T.StructType([T.StructField("item_id", ids["item_id"]), *T.StructType.fromDDL("rank int, doc_id long, score long").fields])
        return spark.createDataFrame([], empty)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = spark.read.schema(schema).parquet(path).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= how.top).select("item_id", "rank", "doc_id", "score")


def op13_mask_search(spark, sf_dir: str) -> DataFrame:
    documents, items = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return search(documents.select("doc_id", "text"), items.select("item_id", "text"))


OP13_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents
), asked AS (
  SELECT item_id, term, count(*) AS reps
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL
), corpus AS (
  SELECT count(*) FILTER (WHERE len(ts) > 0) AS nd, sum(len(ts))::BIGINT AS nt FROM words
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ts) AS term FROM words)
  SEMI JOIN asked USING (term) GROUP BY ALL
), df AS (
  SELECT term, count(*) AS df FROM tf GROUP BY term
), m AS (
  SELECT doc_id, 75 + (25 * len(ts) * nd) // nt AS m FROM words, corpus
), s AS (
  SELECT item_id, doc_id,
         sum(reps * floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)))::BIGINT
             * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN df USING (term) JOIN m USING (doc_id), corpus
  GROUP BY ALL
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
FROM s WHERE score > 0
QUALIFY rank <= 20
"""
