"""MinHash near-dedup with an LSH forest.

Every text becomes the set of its five-word shingles; equal sets are one class.  Each
class has a signature of ``trees * start_values`` minima.  A tree is the order of all
classes by the signature rotated to the tree's start; classes that share the first
``least_depth`` values are neighbours in it.  A region (equal prefix) of more than
``region`` classes is split at greater depth, only there.

Within a region signatures are compared, and the classes that may reach the threshold
form clusters.  Links are confirmed on full shingle sets: a cluster of up to ``region``
classes in one task, a larger one region by region, each with the cluster's best
connected classes added as pivots.  Links never leave a task pair by pair: a task gives
each class the smallest one it is connected to, and those meet in connected components.

Depth parts classes that are alike, so what shares an overfull region (``region`` classes
agree in ``least_depth`` values: templates, common passages, large groups of copies) is
then compared without it.  A region whose classes are all connected by now is done.  In
the others, every class outside the region's largest component is compared on full
sets with every class of the region, in blocks of bounded size.  So a pair that shares
a prefix of ``least_depth`` values in any tree is found whatever else shares it.

A prefix that more than ``heavy`` classes share is dealt out by a longer prefix at once,
and then by class, so no task sorts a whole hot region.

Defined results: null or empty texts have the empty set and stand alone; a null doc_id
is never a group's smallest id (a group of null ids only has the component null);
repeated rows are in the component of their text; further columns are ignored by
``groups`` and carried by ``drop_near``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sintonia.llm.common import components, discard, fresh, runs, table, written


@dataclass(frozen=True)
class Forest:
    #: Links: 100 * intersection >= percent * union.
    percent: int = 80
    words: int = 5
    trees: int = 16
    start_values: int = 8
    least_depth: int = 4
    #: Values of a tree's order at most.
    deepest: int = 16
    region: int = 96
    pivots: int = 6
    #: Rows of one prefix that a task may sort.
    heavy: int = 4096
    #: Shingles on either side of a block of an overfull region.
    block: int = 200_000
    salts: int = 16
    seed: int = 7

    @property
    def values(self) -> int:
        return self.trees * self.start_values

    @property
    def floor(self) -> float:
        """Share of equal minima below which a pair at the threshold falls once in a
        million (5 standard deviations)."""
        t = self.percent / 100
        return t - 5 * (t * (1 - t) / self.values) ** 0.5


# ---- shingles ---------------------------------------------------------------

_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class _Words(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got


_WORDS = _Words()


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; a text of fewer words is
    one shingle."""
    if len(_WORDS) > 400_000:
        _WORDS.clear()
    out = []
    for text in texts:
        words = text.lower().split()  # bytes: A-Z and ASCII white space only
        n = len(words)
        if not n:
            out.append(np.zeros(0, np.uint64))
            continue
        h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, n)
        w = min(width, n)
        x = h[: n - w + 1] + np.uint64(n if n < width else 0)
        for k in range(1, w):
            x = x * _MUL + h[k : n - w + 1 + k]
        x = (x ^ (x >> np.uint64(31))) * _MIX
        out.append(np.unique(x ^ (x >> np.uint64(29))))
    return out


def set_hash(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def signatures(sets: list[np.ndarray], how: Forest) -> list[bytes | None]:
    """16 bits of each of the minima, as bytes; None for an empty set."""
    full = [k for k, s in enumerate(sets) if len(s)]
    out: list[bytes | None] = [None] * len(sets)
    if not full:
        return out
    rng = np.random.default_rng(how.seed)
    factors = rng.integers(1, 1 << 63, how.values, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for at in range(0, len(full), 64):
        own = full[at : at + 64]
        x = np.concatenate([sets[k] for k in own])
        starts = np.cumsum([0] + [len(sets[k]) for k in own[:-1]])
        low = np.empty((how.values, len(own)), np.uint64)
        for k, factor in enumerate(factors):
            low[k] = np.minimum.reduceat(x * factor, starts)
        low = ((low ^ (low >> np.uint64(32))) * _MIX) >> np.uint64(48)
        rows = low.T.astype("<u2")
        for k, row in zip(own, rows):
            out[k] = row.tobytes()
    return out


def _signed(docs: DataFrame, how: Forest) -> DataFrame:
    """``doc_id, n_shingles, set_hash, sig, rid`` of every row."""
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType), *T.StructType.fromDDL("n_shingles long, set_hash binary, sig binary").fields]
    )

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sets = shingle_sets([(t.as_py() or "").encode() for t in part.column(1)], how.words)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([set_hash(s) for s in sets], pa.binary()),
                        pa.array(signatures(sets, how), pa.binary()),
                    ],
                    names=schema.names,
                )

    rows = docs.select("doc_id", "text").mapInArrow(run, schema)
    return written(rows.withColumn("rid", F.monotonically_increasing_id()), "signatures")


# ---- forest -----------------------------------------------------------------


def split_regions(order: np.ndarray, depth: int, how: Forest) -> Iterator[tuple[int, np.ndarray]]:
    """(depth, rows) of the regions of classes whose first ``depth`` values are equal:
    ``order`` holds a row of values per class.  Overfull regions go deeper."""
    stack = [(depth, np.arange(len(order)))]
    while stack:
        depth, rows = stack.pop()
        if len(rows) < 2:
            continue
        if len(rows) <= how.region:
            yield depth, rows
        elif depth < order.shape[1]:
            values = order[rows, depth]
            by = np.argsort(values, kind="stable")
            cut = np.flatnonzero(np.diff(values[by])) + 1
            stack += [(depth + 1, part) for part in np.split(rows[by], cut)]
        else:  # all values equal: nearly the same sets; parts that share a member
            for at in range(1, len(rows), how.region - 1):
                yield depth + at, np.concatenate([rows[:1], rows[at : at + how.region - 1]])


def _prefix_key(depth: int) -> Column:
    return F.xxhash64("tree", F.lit(depth), F.expr(f"substring(prefix, 1, {2 * depth})"))


def _orders(base: DataFrame, how: Forest) -> DataFrame:
    """``cid, tree, prefix, key``: each class's values in the order of each tree, and the
    region of its first ``least_depth``."""
    size = 2 * how.start_values
    # the signature twice over, so that a tree's order may run past its end
    rows = base.select("cid", F.explode(F.sequence(F.lit(0), F.lit(how.trees - 1))).alias("tree"), F.concat("sig", "sig").alias("sig")).selectExpr(
        "cid", "tree", f"substring(sig, tree * {size} + 1, {2 * how.deepest}) AS prefix"
    )
    return written(rows.withColumn("key", _prefix_key(how.least_depth)), "orders")


def _crowded(orders: DataFrame, how: Forest) -> DataFrame:
    """``key, cid`` of the overfull regions."""
    sizes = written(orders.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > how.region), "overfull")
    return written(orders.join(sizes, "key").select("key", "cid", "n"), "crowded")


def _members(orders: DataFrame, crowded: DataFrame, how: Forest) -> DataFrame:
    """``region, cid``: the classes of each region of every tree."""
    plain = orders.withColumn("depth", F.lit(how.least_depth))
    heavy = crowded.where(F.col("n") > how.heavy).groupBy("key").agg(F.first("n").alias("n"))
    for depth in (2 * how.least_depth, how.deepest, None):
        heavy = written(heavy, "heavy")
        if not heavy.head(1):
            break
        longer = F.xxhash64("key", F.pmod(F.xxhash64("cid"), F.ceil(F.col("n") / how.heavy))) if depth is None else _prefix_key(depth)
        plain = plain.join(heavy, "key", "left").select(
            "cid",
            "tree",
            "prefix",
            F.when(F.col("n").isNotNull(), longer).otherwise(F.col("key")).alias("key"),
            F.when(F.col("n").isNotNull(), F.lit(depth or how.deepest)).otherwise(F.col("depth")).alias("depth"),
        )
        if depth is not None:
            dealt = plain.where(F.col("depth") == depth)
            heavy = dealt.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > how.heavy)

    def run(batches):
        for group in runs(_sharing(batches), "key"):
            by = np.argsort(group.column("cid").to_numpy())
            cids = group.column("cid").to_numpy()[by]
            order = np.frombuffer(b"".join(group.column("prefix").to_pylist()), "<u2").reshape(group.num_rows, -1)[by]
            start, seed = group.column("depth")[0].as_py(), group.column("key")[0].as_py() & (2**64 - 1)
            for depth, part in split_regions(order, start, how):
                part = np.sort(part)
                name = order[part[-1], : min(depth, how.deepest)].tobytes() + depth.to_bytes(8, "little")
                region = xxhash.xxh3_64_intdigest(name, seed) - 2**63
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), region)), pa.array(cids[part])], names=["region", "cid"])

    return written(plain.repartition("key").sortWithinPartitions("key").mapInArrow(run, "region long, cid long"), "regions")


def _sharing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Without rows whose key is unlike both neighbours' in the batch (the first and
    last row stay: their run may go on in the next batch)."""
    for batch in batches:
        keys = batch.column("key").to_numpy()
        if len(keys) < 3:
            yield batch
            continue
        same = keys[1:] == keys[:-1]
        keep = np.ones(len(keys), bool)
        keep[1:-1] = same[1:] | same[:-1]
        yield batch.filter(pa.array(keep))


def _stars_of(linked: np.ndarray, cids: np.ndarray) -> Iterator[tuple[int, int]]:
    """(smallest connected cid, cid) for each class with a link; ``linked`` is a
    symmetric matrix of one task's classes."""
    free = linked.any(axis=1)
    for k in np.argsort(cids):
        if not free[k]:
            continue
        reach = np.zeros(len(cids), bool)
        reach[k] = True
        edge = reach
        while edge.any():
            edge = linked[edge].any(axis=0) & ~reach
            reach |= edge
        free &= ~reach
        low = int(cids[reach].min())
        yield from ((low, int(c)) for c in cids[reach] if c != low)


def _clusters(base: DataFrame, members: DataFrame, how: Forest) -> DataFrame:
    """``a, b, degree`` per region: classes that similar signatures connect, and how
    many of the region each is similar to."""

    def run(batches):
        for group in runs(batches, "region"):
            sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), "<u2").reshape(group.num_rows, -1)
            cids = group.column("cid").to_numpy()
            near = np.zeros((len(sig), len(sig)), bool)
            for k in range(len(sig)):
                near[k] = (sig == sig[k]).mean(axis=1) >= how.floor
            np.fill_diagonal(near, False)
            degree = dict(zip(cids.tolist(), near.sum(axis=1).tolist()))
            pairs = list(_stars_of(near, cids))
            if pairs:
                a, b = zip(*pairs)
                lows = sorted(set(a))
                # a row with a = b carries the smallest one's own degree
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*a, *lows], pa.int64()), pa.array([*b, *lows], pa.int64()), pa.array([degree[x] for x in (*b, *lows)], pa.int64())],
                    names=["a", "b", "degree"],
                )

    sized = members.join(base, "cid").select("region", "cid", "sig")
    return written(sized.repartition("region").sortWithinPartitions("region").mapInArrow(run, "a long, b long, degree long"), "clusters")


# ---- links ------------------------------------------------------------------


def overlaps(sets: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Sizes of all pairs' intersections, by products of 0/1 matrices over the
    shingles that two sets or more have."""
    m = len(sets)
    if m == 2:
        n = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([[len(sets[0]), n], [n, len(sets[1])]], np.int64)
    whole = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, number, times = np.unique(whole, return_inverse=True, return_counts=True)
    shared = times[number] > 1
    owner, number = owner[shared], np.unique(number[shared], return_inverse=True)[1]
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    total = np.zeros((m, m), np.float64)
    for start in range(0, int(number[-1]) + 1 if len(number) else 0, columns):
        a, b = np.searchsorted(number, [start, start + columns])
        block = np.zeros((m, columns), np.float32)
        block[owner[a:b], number[a:b] - start] = 1
        total += block @ block.T
    return np.rint(total).astype(np.int64)


def linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    size = np.array([len(s) for s in sets], np.int64)
    both = overlaps(sets)
    out = 100 * both >= percent * (size[:, None] + size[None, :] - both)
    np.fill_diagonal(out, False)
    return out


def _units(clusters: DataFrame, members: DataFrame, how: Forest) -> DataFrame:
    """``unit, cid``: what is confirmed together in one task."""
    found = written(components(clusters.select("a", "b")), "found")  # node, root
    sizes = found.groupBy("root").agg(F.count("*").alias("n"))
    sized = written(found.join(sizes, "root"), "sized")
    small = sized.where(F.col("n") <= how.region).select(F.xxhash64(F.lit("cluster"), F.col("root")).alias("unit"), F.col("node").alias("cid"))
    large = sized.where(F.col("n") > how.region).select("root", F.col("node").alias("cid"))
    parts = written(
        members.join(large, "cid").select(F.xxhash64(F.lit("region"), F.col("region"), F.col("root")).alias("unit"), "root", "cid"), "parts"
    )
    # the best connected classes of each large cluster go with each of its regions
    degrees = clusters.groupBy(F.col("b").alias("cid")).agg(F.sum("degree").alias("degree")).join(large, "cid")
    pivots = degrees.withColumn("salt", F.pmod(F.xxhash64("cid"), F.lit(how.salts)))
    for keys in (("root", "salt"), ("root",)):  # the best of each salt first
        best = Window.partitionBy(*keys).orderBy(F.col("degree").desc(), "cid")
        pivots = pivots.withColumn("k", F.row_number().over(best)).where(F.col("k") <= how.pivots)
    pivots = written(pivots.select("root", F.col("cid").alias("pivot")), "pivots")
    added = parts.select("unit", "root").distinct().join(pivots, "root").select("unit", F.col("pivot").alias("cid"))
    return small.unionAll(parts.select("unit", "cid").unionAll(added).distinct())


def _sets(docs: DataFrame, signed: DataFrame, wanted: DataFrame, how: Forest) -> DataFrame:
    """``cid, shingles`` of the wanted classes, from the text of their first row."""
    source = signed.join(wanted, signed["rid"] == wanted["cid"]).select(F.col("doc_id").alias("of"), "set_hash", "cid")
    texts = docs.join(source, docs["doc_id"].eqNullSafe(source["of"])).select("text", "set_hash", "cid")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sets = shingle_sets([(t.as_py() or "").encode() for t in part.column(0)], how.words)
                # another text under the same doc_id is not the class
                own = [k for k, (s, h) in enumerate(zip(sets, part.column(1).to_pylist())) if set_hash(s) == h]
                yield pa.RecordBatch.from_arrays(
                    [part.column(2).take(pa.array(own, pa.int64())), pa.array([sets[k].tobytes() for k in own], pa.binary())], names=["cid", "shingles"]
                )

    return written(texts.mapInArrow(run, "cid long, shingles binary").dropDuplicates(["cid"]), "sets")


def _links(units: DataFrame, sets: DataFrame, how: Forest) -> DataFrame:
    def run(batches):
        for group in runs(batches, "unit"):
            cids = group.column("cid").to_numpy()
            if len(cids) < 2:
                continue
            own = [np.frombuffer(b, np.uint64) for b in group.column("shingles").to_pylist()]
            pairs = list(_stars_of(linked(own, how.percent), cids))
            if pairs:
                a, b = zip(*pairs)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    whole = units.join(sets, "cid").select("unit", "cid", "shingles")
    return whole.repartition("unit").sortWithinPartitions("unit").mapInArrow(run, "a long, b long")


def crossed(asked: list[np.ndarray], others: list[np.ndarray], percent: int, columns: int = 4096) -> np.ndarray:
    """Which of ``asked`` (rows) and ``others`` (columns) are linked: intersections by
    products of 0/1 matrices over the shingles that both sides have."""
    sides = [(np.concatenate(s), np.repeat(np.arange(len(s)), [len(x) for x in s]), np.array([len(x) for x in s], np.int64)) for s in (asked, others)]
    common = np.intersect1d(sides[0][0], sides[1][0])
    placed = []
    for flat, owner, _ in sides:
        at = np.searchsorted(common, flat)
        hit = at < len(common)
        hit[hit] = common[at[hit]] == flat[hit]
        order = np.argsort(at[hit], kind="stable")
        placed.append((at[hit][order], owner[hit][order]))
    both = np.zeros((len(asked), len(others)), np.float64)
    for start in range(0, len(common), columns):
        blocks = []
        for (at, owner), side in zip(placed, (asked, others)):
            a, b = np.searchsorted(at, [start, start + columns])
            blocks.append(np.zeros((len(side), columns), np.float32))
            blocks[-1][owner[a:b], at[a:b] - start] = 1
        both += blocks[0] @ blocks[1].T
    both = np.rint(both).astype(np.int64)
    return 100 * both >= percent * (sides[0][2][:, None] + sides[1][2][None, :] - both)


def _across(found: DataFrame, crowded: DataFrame, sets: DataFrame, how: Forest) -> DataFrame:
    """``node, root`` with the links that overfull regions hold between components.

    In a region, the classes outside its largest component are asked about all of its
    classes.  Both are dealt into blocks of about ``block`` shingles, and every pair of
    blocks is a unit of its own; with one component there is nothing to ask."""
    size = sets.select("cid", (F.length("shingles") / 8).cast("long").alias("shingled"))
    roots = found.select(F.col("node").alias("cid"), "root")
    placed = written(
        crowded.join(size, "cid").join(roots, "cid", "left").select("key", "cid", F.coalesce("root", "cid").alias("root"), "shingled"), "placed"
    )
    parts = placed.groupBy("key", "root").agg(F.sum("shingled").alias("s"))
    blocks = lambda s: F.ceil(s / F.lit(how.block))
    mixed = parts.groupBy("key").agg(F.sum("s").alias("s"), F.max(F.struct("s", "root")).alias("most"), F.count("*").alias("n")).where("n > 1")
    mixed = written(mixed.select("key", F.col("most.root").alias("main"), blocks(F.col("s") - F.col("most.s")).alias("rows"), blocks(F.col("s")).alias("cols")), "mixed")
    if not mixed.head(1):
        return found
    rows = placed.join(mixed, "key")
    mine = lambda n: F.pmod(F.xxhash64("cid"), F.col(n)).alias(n)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1)).alias(n)
    asked = rows.where("root <> main").select("key", mine("rows"), every("cols"), "cid", "root", F.lit(True).alias("asked"))
    others = rows.select("key", every("rows"), mine("cols"), "cid", "root", F.lit(False).alias("asked"))
    units = asked.unionAll(others).select(F.xxhash64("key", "rows", "cols").alias("unit"), "cid", "root", "asked")

    def run(batches):
        for group in runs(batches, "unit"):
            asks = group.column("asked").to_numpy().astype(bool)
            if not asks.any() or asks.all():
                continue
            own = [np.frombuffer(b, np.uint64) for b in group.column("shingles").to_pylist()]
            root = group.column("root").to_numpy()
            near = crossed([own[k] for k in np.flatnonzero(asks)], [own[k] for k in np.flatnonzero(~asks)], how.percent)
            a, b = (root[side][at] for side, at in zip((asks, ~asks), np.nonzero(near)))
            names, number = np.unique(np.concatenate([a, b]), return_inverse=True)
            joint = np.zeros((len(names), len(names)), bool)
            joint[number[: len(a)], number[len(a) :]] = joint[number[len(a) :], number[: len(a)]] = True
            np.fill_diagonal(joint, False)
            pairs = list(_stars_of(joint, names))
            if pairs:
                a, b = zip(*pairs)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    whole = units.join(sets, "cid").select("unit", "root", "asked", "shingles")
    links = whole.repartition("unit").sortWithinPartitions("unit").mapInArrow(run, "a long, b long")
    joined = written(components(links).select(F.col("node").alias("root"), F.col("root").alias("top")), "across")
    # a component of one class has no row yet
    alone = joined.join(found.select("root").distinct(), "root", "left_anti").select(F.col("root").alias("node"), F.col("top").alias("root"))
    return found.join(joined, "root", "left").select("node", F.coalesce("top", "root").alias("root")).unionAll(alone)


def groups(docs: DataFrame, how: Forest = Forest()) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, n_shingles, component_id``
    (smallest doc_id reachable), ``kept`` (whether that is its own)."""
    docs = docs.select("doc_id", "text")
    signed = _signed(docs, how)
    classes = written(
        signed.where("n_shingles > 0").groupBy("set_hash").agg(F.min("rid").alias("cid"), F.min("doc_id").alias("first"), F.count("*").alias("n")),
        "classes",
    )
    base = written(signed.join(classes, signed["rid"] == classes["cid"]).select("cid", "sig"), "base")
    orders = _orders(base, how)
    crowded = _crowded(orders, how)
    members = _members(orders, crowded, how)
    clusters = _clusters(base, members, how)
    units = written(_units(clusters, members, how), "units")
    sets = _sets(docs, signed, units.select("cid").unionAll(crowded.select("cid")).distinct(), how)
    near = written(components(_links(units, sets, how)), "components")
    found = written(_across(near, crowded, sets, how), "found")
    for done in (base, orders, crowded, members, clusters, units, sets):
        discard(done)
    named = found.join(classes, found["node"] == classes["cid"]).select("root", "set_hash", "first")
    least = written(named.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    inside = named.join(least, "root").select("set_hash", "component_id")
    copied = classes.where("n > 1").join(found, classes["cid"] == found["node"], "left_anti").select("set_hash", F.col("first").alias("component_id"))
    # classes of one row that nothing links to are not in this table
    joint = written(inside.unionAll(copied).withColumn("joint", F.lit(True)), "joint")
    rows = signed.select("doc_id", "n_shingles", "set_hash").join(joint, "set_hash", "left")
    component = F.when(F.col("joint"), F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near(docs: DataFrame, how: Forest = Forest()) -> DataFrame:
    """``docs`` with one document of each group, all columns.  A doc_id goes if none
    of its rows is kept."""
    gone = fresh(docs.columns, "gone")
    dropped = groups(docs, how).groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).where("NOT kept")
    dropped = written(dropped.select(F.col("doc_id").alias(gone)), "dropped")
    return docs.join(dropped, docs["doc_id"].eqNullSafe(dropped[gone]), "left_anti").select(*[docs[c] for c in docs.columns])


def op9_lsh_forest(spark, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents").select("doc_id", "text"), Forest(percent=85))
