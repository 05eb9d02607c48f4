"""Mixing sources to target weights by subset-sum budget fitting.

Every source gets a target number of words: its share of the total by weight, at most
``max_repeats`` times its own size, the excess shared again by weight.  Whole passes
over a source come first.  What is left of its budget is fitted on the histogram of
exact lengths: an equal share of every length, then a bounded-knapsack dynamic program
over the words still missing, which says how many documents of which length to add.
Documents are then picked by length count in the order of a seeded hash.

Texts are never gathered: the plan needs one row per (source, length), the pick works
on (source, length, hash bucket), so a source or a length that holds a third of all
rows is spread over ``buckets``.  The table of sources has one row per source, as the
weights do, and is ranked in one task.

Defined results: a null text has size 0 and takes 0 words; a null source is a source of
its own, last in order; a null doc_id counts as one more id; rows that repeat a doc_id
are documents of their own; the same input and seed give the same mix; further columns
are ignored by ``plan`` and carried by ``mix``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sintonia.llm.common import fresh, table, written


@dataclass(frozen=True)
class Mix:
    #: Weights of the sources in code-point order, repeating; null last.
    weights: tuple[float, ...] = (3.0, 1.0, 2.0)
    #: Words of the mix as a share of all words, and passes over a source at most.
    total: float = 1.5
    max_repeats: int = 2
    seed: int = 20240101
    buckets: int = 256
    #: Words that the dynamic program covers at least; more if documents are longer.
    reach: int = 1 << 14


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


# ---- targets ----------------------------------------------------------------


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """``source, source_size, target`` of ``sizes(source, size, ...)``.

    A source stops at its limit when the common level (words per weight) passes
    limit / weight.  With sources in that order, the level after the first k stopped is
    (total - their limits) / (weights of the rest); the first k whose level stops no
    further source is the answer."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in mix.weights]), (F.col("rank") % len(mix.weights) + 1).cast("int"))
    sources = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(by_name) - 1)
        .withColumn("weight", w)
        .withColumn("limit", F.col("source_size") * F.lit(float(mix.max_repeats)))
        .withColumn("turn", F.col("limit") / F.col("weight"))
    )
    order = Window.orderBy("turn", "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) * mix.total - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    leveled = sources.withColumn("level", level)
    # the first source not stopped at its level sets the level of all after it
    settled = leveled.withColumn(
        "level", F.first(F.when(F.col("turn") > F.col("level"), F.col("level")), ignorenulls=True).over(whole)
    )
    share = F.col("level") * F.col("weight")
    return settled.select("source", "source_size", F.coalesce(F.least("limit", share), F.col("limit")).alias("target"))


# ---- lengths ----------------------------------------------------------------


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int, reach: int = 1 << 14) -> np.ndarray:
    """How many documents of each length to take so that their words come as near
    below ``budget`` as a bounded knapsack over the last words gets.

    ``lengths`` are distinct, positive and ascending; at most ``counts`` of each."""
    taken = np.zeros(len(lengths), np.int64)
    whole = int((lengths * counts).sum())
    if budget >= whole:
        return counts.astype(np.int64)
    if budget <= 0 or not len(lengths):
        return taken
    # an equal share of every length keeps the source's mixture of lengths
    taken = np.array([int(c) * budget // whole for c in counts], np.int64)
    left = budget - int((taken * lengths).sum())
    room = counts - taken
    # single documents, longest first, until the dynamic program covers the rest
    cover = max(reach, 2 * int(lengths[0]))
    for k in range(len(lengths) - 1, -1, -1):
        if left <= cover:
            break
        more = int(min(room[k], (left - cover // 2) // lengths[k]))
        if more > 0:
            taken[k] += more
            room[k] -= more
            left -= more * int(lengths[k])
    taken += knapsack(lengths, room, left)
    return taken


def knapsack(lengths: np.ndarray, room: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack: counts per length whose total is the largest reachable one
    not above ``budget``.  ``budget`` is small (see ``fit``)."""
    out = np.zeros(len(lengths), np.int64)
    if budget <= 0:
        return out
    reached = np.zeros(budget + 1, bool)
    reached[0] = True
    by = np.full(budget + 1, -1, np.int64)  # the length that first reached a total
    used = np.zeros(budget + 1, np.int64)  # how many of it the total holds
    for k, size in enumerate(lengths.tolist()):
        most = min(int(room[k]), budget // size) if size <= budget else 0
        step = 1
        while most > 0 and not reached[budget]:  # 1, 2, 4, ... documents at a time
            many = min(step, most)
            jump = many * size
            now = np.flatnonzero(reached[: budget + 1 - jump])
            own = np.where(by[now] == k, used[now], 0)
            new = ~reached[now + jump]
            to = now[new] + jump
            reached[to], by[to], used[to] = True, k, own[new] + many
            most -= many
            step *= 2
        if reached[budget]:
            break
    total = int(np.flatnonzero(reached)[-1])
    while total:
        k = int(by[total])
        out[k] += used[total]
        total -= int(used[total] * lengths[k])
    return out


def _order() -> list[Column]:
    return [F.col("h"), F.col("doc_id").asc_nulls_last(), F.col("rid")]


def plan(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per row of ``docs(doc_id, text, source)``: ``doc_id, source, size,
    source_size, target, copies, taken``."""
    sizes = written(
        docs.select(
            "doc_id",
            "source",
            words().alias("size"),
            F.xxhash64(F.lit(mix.seed), F.col("doc_id")).alias("h"),
            F.monotonically_increasing_id().alias("rid"),
        ).withColumn("bucket", F.pmod("h", F.lit(mix.buckets)).cast("int")),
        "sizes",
    )
    aim = written(targets(sizes, mix), "targets")
    small = written(sizes.groupBy("source", "size", "bucket").agg(F.count("*").alias("n")), "histogram")
    counts = small.groupBy("source", "size").agg(F.sum("n").alias("n"))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    per_source = counts.join(aim, same(counts, aim)).select(counts["source"], "size", "n", "source_size", "target")

    def fitted(t: pa.Table) -> pa.Table:
        size, n = (t.column(c).to_numpy().astype(np.int64) for c in ("size", "n"))
        total, target = t.column("source_size")[0].as_py(), t.column("target")[0].as_py()
        passes = min(int(target // total), mix.max_repeats) if total else 0
        order = np.argsort(size)
        order = order[size[order] > 0]
        extra = np.zeros(len(size), np.int64)
        extra[order] = fit(size[order], n[order], int(target + 1e-6) - passes * total, mix.reach)
        return t.select(["source", "size", "source_size", "target"]).append_column("passes", pa.array([passes] * len(size), pa.int64())).append_column("extra", pa.array(extra))

    source = f"source {docs.schema['source'].dataType.simpleString()}"
    chosen = per_source.groupBy("source").applyInArrow(
        fitted, f"{source}, size long, source_size long, target double, passes long, extra long"
    )
    # how many of each hash bucket: buckets in order until the length's count is met
    up_to = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    share = small.withColumn("before", F.coalesce(F.sum("n").over(up_to), F.lit(0)))
    quota = written(
        share.join(chosen, share["source"].eqNullSafe(chosen["source"]) & (share["size"] == chosen["size"]))
        .select(
            share["source"].alias("q_source"),
            share["size"].alias("q_size"),
            F.col("bucket").alias("q_bucket"),
            "source_size",
            "target",
            "passes",
            F.greatest(F.lit(0), F.least("n", F.col("extra") - F.col("before"))).alias("quota"),
        ),
        "quota",
    )
    place = Window.partitionBy("source", "size", "bucket").orderBy(*_order())
    ranked = sizes.withColumn("place", F.row_number().over(place))
    found = ranked.join(
        quota, ranked["source"].eqNullSafe(quota["q_source"]) & (ranked["size"] == quota["q_size"]) & (ranked["bucket"] == quota["q_bucket"])
    )
    copies = F.col("passes") + (F.col("place") <= F.col("quota")).cast("long")
    return found.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies")).withColumn(
        "taken", F.col("copies") * F.col("size")
    )


def mix_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the plan takes it, all columns.

    Rows that share doc_id, source and size are numbered and get their decisions one
    by one."""
    nth, times, size = (fresh(docs.columns, c) for c in ("nth", "copies", "size"))
    picked = plan(docs.select("doc_id", "text", "source"), mix)
    picked = (
        picked.select(F.col("doc_id").alias("p_id"), F.col("source").alias("p_source"), F.col("size").alias("p_size"), "copies")
        .groupBy("p_id", "p_source", "p_size")
        .agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    )
    numbered = docs.withColumn(size, words())
    own = Window.partitionBy("doc_id", "source", size).orderBy(F.lit(1))
    numbered = numbered.withColumn(nth, F.row_number().over(own))
    joined = numbered.join(
        picked,
        numbered["doc_id"].eqNullSafe(picked["p_id"])
        & numbered["source"].eqNullSafe(picked["p_source"])
        & (numbered[size] == picked["p_size"]),
    )
    # the copies of equal rows, dealt out one by one
    each = F.floor(picked["copies"] / picked["rows"]) + (numbered[nth] <= picked["copies"] % picked["rows"]).cast("long")
    return (
        joined.select(*[numbered[c] for c in docs.columns], each.cast("int").alias(times))
        .where(F.col(times) > 0)
        .withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times))))
        .select(*docs.columns)
    )


def op1_budget_mix(spark, sf_dir: str) -> DataFrame:
    picked = plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return picked.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")
