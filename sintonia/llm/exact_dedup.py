"""Exact dedup with a heavy-hitter split, in DataFrame operations only.

Texts are equal when identical after every run of ASCII white space becomes one
space.  A Misra-Gries pass over the digests finds the few that may be frequent; an
exact count verifies them.  The verified winners (fewer than ``counters``) are
broadcast: their rows are settled where they are read, and only digests of at most
``rows / counters`` rows go through the ordinary shuffle.

Defined results: a null text counts as empty; a null doc_id comes after all others;
of rows that repeat the same doc_id and text, exactly one is kept; an empty table
gives an empty result; further columns are ignored by ``groups`` and carried by
``drop_copies``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sintonia.llm.common import fresh, table, text_or_empty, written

#: Runs that are not already exactly one space.
_RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def digest(text: str = "text") -> Column:
    """SHA-256 of the normalised text, lower-case hex."""
    return F.sha2(F.regexp_replace(text_or_empty(text), _RUNS, " "), 256)


def _winners(rows: DataFrame, counters: int) -> DataFrame:
    """Verified frequent digests of ``rows(doc_id, digest, rid)`` with their group
    size and first row: fewer than ``counters`` rows, whatever the input."""
    key = F.xxhash64("digest")
    support = 1.0 / counters
    found = rows.select(key.alias("h")).stat.freqItems(["h"], support).select(F.explode("h_freqItems").alias("h"))
    total = rows.count()
    return written(
        rows.join(F.broadcast(found), key == F.col("h"), "left_semi")
        .groupBy("digest")
        .agg(F.count("*").alias("n"), F.min(_order()).alias("first"))
        .where(F.col("n") * counters > F.lit(total)),
        "winners",
    )


def _order() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), F.col("rid").alias("rid"))


def _digests(docs: DataFrame) -> DataFrame:
    return written(
        docs.select("doc_id", F.unhex(digest()).alias("digest"), F.monotonically_increasing_id().alias("rid")), "digests"
    )


def groups(docs: DataFrame, counters: int = 1024) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, keep_id, group_size, kept,
    text_sha256``.  The row with the smallest doc_id of each group is kept."""
    rows = _digests(docs)
    winners = _winners(rows, counters)
    hot = rows.join(F.broadcast(winners), "digest").select("doc_id", "rid", "digest", "n", "first")
    same = Window.partitionBy("digest")
    rest = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti").select(
        "doc_id", "rid", "digest", F.count("*").over(same).alias("n"), F.min(_order()).over(same).alias("first")
    )
    return hot.unionAll(rest).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("first.rid") == F.col("rid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, counters: int = 1024) -> DataFrame:
    """``docs`` without the copies, all columns.  Copies of a winner go where they are
    read; texts are shuffled once, by digest."""
    winners = _winners(_digests(docs.select("doc_id", "text")), counters)
    tag, rank = fresh(docs.columns, "digest"), fresh(docs.columns, "rank")
    keep = winners.select(F.lower(F.hex("digest")).alias("w_digest"), F.col("first.doc_id").alias("w_keep"))
    tagged = docs.withColumn(tag, digest())
    left = tagged.join(
        F.broadcast(keep), (tagged[tag] == keep["w_digest"]) & ~tagged["doc_id"].eqNullSafe(keep["w_keep"]), "left_anti"
    )
    order = Window.partitionBy(tag).orderBy(F.col("doc_id").asc_nulls_last())
    return left.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).select(*[left[c] for c in docs.columns])


def op8_heavy_hitter_dedup(spark, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)
"""
