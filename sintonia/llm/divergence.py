"""How far the sources of a language diverge, from each other and from the language.

Terms are runs of ASCII letters and non-ASCII characters, A-Z lowered.  A language keeps
the terms that ``least_docs`` of its documents hold.  A (lang, source) group and a whole
language give every kept term the smoothed share ``p = 1 + floor(scale * (count + 1) /
(N + V))``; against another share ``q`` it scores ``floor((p - q)^2 / q)``.

* Part ``term``: a group's terms over-represented against its language, the ``top``
  highest.  The score never falls with a higher group count, a lower language count or,
  among ties, an earlier term; so a term that ``top`` others dominate in these three is
  not among them.  Every partition of the terms retains the skyband, what fewer than
  ``top`` others dominate; the union of these is then scored and ranked exactly.
* Part ``pair``: every other source of the language by the sum of the scores over all
  kept terms.  A term that a source lacks has the source's constant share, so only the
  terms that both sources hold need their two counts together: they are added up in
  place, one number per pair of sources (the report itself has a row per pair).  The
  others come from how many terms of a source have each count.

Terms are counted per task first, and (lang, source, term) rows shuffled before
(lang, term) ones, so that neither a hot source nor a hot term gathers in a task.
The table of groups, one row per (lang, source), is sent to the tasks: the report has
the square of its rows.

Defined results: null lang, source and text count as empty; a group without terms is
audited with count 0 everywhere; a language that keeps no term gives pairs of value 0
and no terms; repeated rows count each; an empty table gives an empty result; further
columns are ignored.  Sums are exact while a language has under 9e15 kept occurrences
and 1e9 kept terms.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sintonia.llm.common import discard, table, written


@dataclass(frozen=True)
class Audit:
    least_docs: int = 3
    #: A third power: shares are divided out in three steps that stay within 64 bits.
    scale: int = 1_000_000_000
    top: int = 200

    @property
    def step(self) -> int:
        return round(self.scale ** (1 / 3))


# ---- terms --------------------------------------------------------------------

#: Bytes of terms as they are (A-Z lowered), every other byte a space.  All bytes of a
#: non-ASCII character are over 0x7F.
_TERM_BYTES = bytes(
    b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalpha() else 0x20 for b in range(256)
)
_PIECE = 1 << 20


def pieces(data: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, about a megabyte of it at a time."""
    data, at = data.translate(_TERM_BYTES), 0
    while at < len(data):
        end = at + _PIECE
        if end < len(data):
            end = data.find(b" ", end)
            end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _counts(docs: DataFrame, held_terms: int = 400_000) -> DataFrame:
    """``lang, source, term, n, df`` of ``docs(lang, source, text)``, combined within a
    task until it holds ``held_terms`` terms."""

    def emit(n: dict, df: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), own in n.items():
            seen, size = df[lang, source], len(own)
            # the bytes are whole characters of a string, so they are one
            terms = pa.array(list(own), pa.binary()).view(pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * size, pa.string()),
                    pa.array([source] * size, pa.string()),
                    terms,
                    pa.array(list(own.values()), pa.int64()),
                    pa.array([seen[t] for t in own], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "df"],
            )

    def run(batches):
        n, df = defaultdict(Counter), defaultdict(Counter)
        for batch in batches:
            groups = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for group, text in zip(groups, batch.column(2).cast(pa.binary())):
                distinct: set[bytes] = set()
                for words in pieces(text.as_py()):
                    n[group].update(words)
                    distinct.update(words)
                df[group].update(distinct)
            if sum(map(len, n.values())) > held_terms:
                yield from emit(n, df)
                n, df = defaultdict(Counter), defaultdict(Counter)
        yield from emit(n, df)

    return docs.mapInArrow(run, "lang string, source string, term string, n long, df long")


def _whole_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables cut between terms, from batches sorted by (lang, term)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if not held or sum(b.num_rows for b in held) < 50_000:
            held.append(batch)
            continue
        last, key = held[-1], ("lang", "term")
        ends = tuple(last.column(k)[-1].as_py() for k in key)
        same = pc.and_(*(pc.equal(batch.column(k), v) for k, v in zip(key, ends))).to_numpy(zero_copy_only=False)
        cut = int(np.argmin(same)) if not same.all() else len(same)
        held.append(batch.slice(0, cut))
        if cut < len(same):
            yield pa.Table.from_batches(held)
            held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def _starts(rows: pa.Table) -> np.ndarray:
    """Where each (lang, term) begins."""
    new = np.ones(rows.num_rows, bool)
    for k in ("lang", "term"):
        c = rows.column(k).combine_chunks()
        differs = pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
        new[1:] = differs if k == "lang" else new[1:] | differs
    return np.flatnonzero(new)


def kept_terms(docs: DataFrame, groups: DataFrame, how: Audit) -> DataFrame:
    """``lang, term, lang_n, sids, ns``: a row per kept term, with the number of each
    source that holds it and its count there."""
    flat = (
        _counts(docs)
        .join(groups, ["lang", "source"])
        .groupBy("lang", "sid", "term")
        .agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    )

    def fold(batches):
        for rows in _whole_terms(batches):
            at = _starts(rows)
            n, df = (rows.column(k).to_numpy() for k in ("n", "df"))
            kept = np.add.reduceat(df, at) >= how.least_docs
            sizes = np.diff(np.append(at, len(n)))
            mine = np.repeat(kept, sizes)
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes[kept])]), pa.int32())
            one = rows.take(pa.array(at[kept])).combine_chunks()
            if not one.num_rows:
                continue
            lists = [
                pa.ListArray.from_arrays(offsets, pa.array(rows.column("sid").to_numpy()[mine], pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(n[mine], pa.int64())),
            ]
            lang_n = pa.array(np.add.reduceat(n, at)[kept], pa.int64())
            flat_columns = [one.column(k).combine_chunks() for k in ("lang", "term")]
            yield pa.RecordBatch.from_arrays([*flat_columns, lang_n, *lists], names=["lang", "term", "lang_n", "sids", "ns"])

    ordered = flat.repartition("lang", "term").sortWithinPartitions("lang", "term")
    return ordered.mapInArrow(fold, "lang string, term string, lang_n long, sids array<int>, ns array<long>")


# ---- shares and scores ------------------------------------------------------------


def shares(count: np.ndarray, total: np.ndarray | int, step: int) -> np.ndarray:
    """``1 + floor(step^3 * (count + 1) / total)`` by long division in base ``step``."""
    rest, out = np.asarray(count, np.int64) + 1, np.int64(0)
    for _ in range(3):
        whole, rest = np.divmod(rest * step, total)
        out = out * step + whole
    return out + 1


def score(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _share_sql(count: str, total: str, step: int) -> str:
    """The same in SQL; a language without kept terms has total 0 and share 1."""
    a, b = f"({count} + 1)", f"nullif({total}, 0)"
    first = f"(({a} * {step}) div {b})"
    second = f"(((({a} * {step}) % {b}) * {step}) div {b})"
    third = f"(((((({a} * {step}) % {b}) * {step}) % {b}) * {step}) div {b})"
    return f"(1 + coalesce({first} * {step * step} + {second} * {step} + {third}, 0L))"


def _score_sql(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


def _stairs(n: np.ndarray, lang_n: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending language counts and, for each, the k-th largest ``n`` up to it."""
    order = np.argsort(lang_n, kind="stable")
    ordered = n[order].tolist()
    held = ordered[:k]
    heapq.heapify(held)
    least = [held[0]]
    for v in ordered[k:]:
        heapq.heappushpop(held, v)
        least.append(held[0])
    return lang_n[order[k - 1 :]], np.array(least, np.int64)


def skyband(n: np.ndarray, lang_n: np.ndarray, k: int, step: int = 2048) -> np.ndarray:
    """Places of the points that fewer than ``k`` earlier ones dominate, i.e. have at
    least their ``n`` and at most their ``lang_n``.  Points come in item order.  What is
    dropped has ``k`` dominators in the skyband itself, so only those are compared."""
    kept = np.empty(0, np.int64)
    for at in range(0, len(n), step):
        new = np.arange(at, min(at + step, len(n)))
        if len(kept) >= k:
            upto, least = _stairs(n[kept], lang_n[kept], k)
            place = np.searchsorted(upto, lang_n[new], "right") - 1
            new = new[(place < 0) | (n[new] > least[place])]
        if not len(new):
            continue
        rivals = np.concatenate([kept, new])
        above = (n[rivals][None, :] >= n[new][:, None]) & (lang_n[rivals][None, :] <= lang_n[new][:, None])
        above &= rivals[None, :] < new[:, None]
        kept = np.concatenate([kept, new[above.sum(axis=1) < k]])
    return kept


class _Skybands:
    """Skybands of the groups one task has met; merged as they grow."""

    def __init__(self, k: int, merge_at: int = 16384):
        self.k, self.merge_at = k, merge_at
        self.held: dict[tuple[str, int], list[pa.Table]] = defaultdict(list)

    def add(self, group: tuple[str, int], points: pa.Table) -> None:
        held = self.held[group]
        held.append(points)
        if sum(t.num_rows for t in held) > self.merge_at:
            self.held[group] = [self.merged(held)]
            # a skyband that stays this large is looked at less often
            self.merge_at = max(self.merge_at, 2 * self.held[group][0].num_rows)

    def merged(self, held: list[pa.Table]) -> pa.Table:
        points = pa.concat_tables(held)
        points = points.take(pc.sort_indices(points.column("term")))
        return points.take(pa.array(skyband(points.column("n").to_numpy(), points.column("lang_n").to_numpy(), self.k)))


class _Pairs:
    """Sums over the terms that two sources of a language share."""

    def __init__(self, totals: dict[str, tuple[np.ndarray, int]], step: int, cells: int = 1 << 21):
        self.totals, self.step, self.cells = totals, step, cells
        self.sums: dict[str, np.ndarray] = {}

    def add(self, lang: str, sizes: np.ndarray, sids: np.ndarray, ns: np.ndarray) -> None:
        own, kept = self.totals[lang]
        if lang not in self.sums:
            self.sums[lang] = np.zeros(len(own) ** 2, np.int64)
        total = own + kept
        p, absent = shares(ns, total[sids], self.step), shares(np.zeros(len(own)), total, self.step)
        starts = np.cumsum(sizes) - sizes
        for k in np.unique(sizes[sizes > 1]).tolist():
            mine = starts[sizes == k]
            rows = max(1, self.cells // (k * k))
            for at in range(0, len(mine), rows):
                place = mine[at : at + rows, None] + np.arange(k)
                self._add(self.sums[lang], len(own), sids[place].astype(np.int64), p[place], absent)

    @staticmethod
    def _add(sums: np.ndarray, width: int, sids: np.ndarray, p: np.ndarray, absent: np.ndarray) -> None:
        a, b = p[:, :, None], p[:, None, :]
        a0, b0 = absent[sids][:, :, None], absent[sids][:, None, :]
        # what the one-sided and constant sums, taken over all terms, get wrong here
        value = score(a, b) - score(a, b0) - score(a0, b) + score(a0, b0)
        np.add.at(sums, (sids[:, :, None] * width + sids[:, None, :]).ravel(), value.ravel())

    def cells_held(self) -> int:
        return sum(map(len, self.sums.values()))


_FOUND = "lang string, sid int, other int, term string, n long, lang_n long, value long"


def _found(terms: DataFrame, totals: dict[str, tuple[np.ndarray, int]], how: Audit) -> DataFrame:
    """Skyband rows (``term, n, lang_n``) and pair sums (``other, value``) of every
    partition of ``terms``."""
    names = ["lang", "sid", "other", "term", "n", "lang_n", "value"]
    types = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]

    def rows(size: int, **columns) -> pa.RecordBatch:
        made = []
        for name, kind in zip(names, types):
            c = columns.get(name)
            c = pa.nulls(size, kind) if c is None else pa.array([c] * size, kind) if isinstance(c, (str, int)) else pa.array(c, kind)
            made.append(c)
        return pa.RecordBatch.from_arrays(made, names=names)

    def pair_rows(pairs: _Pairs) -> Iterator[pa.RecordBatch]:
        for lang, sums in pairs.sums.items():
            width = len(totals[lang][0])
            full = np.flatnonzero(sums)
            yield rows(len(full), lang=lang, sid=full // width, other=full % width, value=sums[full])
        pairs.sums.clear()

    def run(batches):
        bands, pairs = _Skybands(how.top), _Pairs(totals, how.step)
        for block in _blocks(batches):
            langs = pc.dictionary_encode(block.column("lang")).combine_chunks()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                own = block.filter(pc.equal(langs.indices, code)).combine_chunks()
                sizes = pc.list_value_length(own.column("sids")).to_numpy().astype(np.int64)
                sids, ns = (pc.list_flatten(own.column(k)).to_numpy() for k in ("sids", "ns"))
                pairs.add(lang, sizes, sids, ns)
                term_of = np.repeat(np.arange(len(sizes)), sizes)
                order = np.argsort(sids, kind="stable")
                for part in np.split(order, np.flatnonzero(np.diff(sids[order])) + 1):
                    at = term_of[part]
                    taken = own.select(["term", "lang_n"]).take(pa.array(at))
                    bands.add((lang, int(sids[part[0]])), taken.append_column("n", pa.array(ns[part], pa.int64())))
            if pairs.cells_held() > 1 << 22:
                yield from pair_rows(pairs)
        yield from pair_rows(pairs)
        for (lang, sid), held in bands.held.items():
            band = bands.merged(held)
            yield rows(
                band.num_rows, lang=lang, sid=sid, **{k: band.column(k).combine_chunks() for k in ("term", "n", "lang_n")}
            )

    return terms.mapInArrow(run, _FOUND)


def _blocks(batches: Iterable[pa.RecordBatch], least: int = 65536) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= least:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


# ---- report -----------------------------------------------------------------------


def audit(docs: DataFrame, how: Audit = Audit()) -> DataFrame:
    """``lang, source, part, item, value, rank`` of ``docs(lang, source, text)``."""
    empty = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    texts = docs.select(*empty)
    by_name = Window.partitionBy("lang").orderBy("source")
    groups = written(
        texts.select("lang", "source").distinct().withColumn("sid", F.row_number().over(by_name) - 1), "groups"
    )
    terms = written(kept_terms(texts, groups, how), "terms")
    entries = terms.select("lang", F.inline(F.arrays_zip("sids", "ns"))).select("lang", F.col("sids").alias("sid"), F.col("ns").alias("n"))
    hist = written(entries.groupBy("lang", "sid", "n").agg(F.count("*").alias("terms")), "hist")
    own = hist.groupBy("lang", "sid").agg(F.sum(F.col("n") * F.col("terms")).alias("own_n"), F.sum("terms").alias("own_terms"))
    whole = terms.groupBy("lang").agg(F.sum("lang_n").alias("whole_n"), F.count("*").alias("kept"))
    zero = F.lit(0).cast("long")
    totals = written(
        groups.join(own, ["lang", "sid"], "left")
        .join(whole, "lang", "left")
        .select("lang", "source", "sid", *[F.coalesce(c, zero).alias(c) for c in ("own_n", "own_terms", "whole_n", "kept")])
        .withColumn("absent", F.expr(_share_sql("0L", "(own_n + kept)", how.step))),
        "totals",
    )
    sent: dict[str, tuple[list[int], int]] = {}
    for r in totals.orderBy("lang", "sid").toLocalIterator():
        sent.setdefault(r.lang, ([], r.kept))[0].append(r.own_n)
    found = written(_found(terms, {lang: (np.array(n, np.int64), kept) for lang, (n, kept) in sent.items()}, how), "found")
    discard(terms)
    return _pair_part(found, hist, totals, how).unionAll(_term_part(found, totals, how))


def _pair_part(found: DataFrame, hist: DataFrame, totals: DataFrame, how: Audit) -> DataFrame:
    other = totals.select("lang", F.col("sid").alias("other"), F.col("absent").alias("other_absent"), F.col("own_terms").alias("other_terms"))
    constant = totals.join(other, "lang").where("sid <> other").selectExpr(
        "lang", "sid", "other", f"(kept - own_terms - other_terms) * {_score_sql('absent', 'other_absent')} AS value"
    )
    # one side holds the term: both directions of the pair
    shared = hist.join(totals.select("lang", "sid", "own_n", "kept"), ["lang", "sid"]).select(
        "lang", "sid", "terms", F.expr(_share_sql("n", "(own_n + kept)", how.step)).alias("p")
    )
    sided = (
        shared.join(other, "lang")
        .where("sid <> other")
        .select(
            "lang",
            F.expr(
                f"inline(array(struct(sid, other, terms * {_score_sql('p', 'other_absent')} AS value),"
                f" struct(other AS sid, sid AS other, terms * {_score_sql('other_absent', 'p')} AS value)))"
            ),
        )
    )
    both = found.where("other IS NOT NULL AND sid <> other").select("lang", "sid", "other", "value")
    values = constant.unionAll(sided).unionAll(both).groupBy("lang", "sid", "other").agg(F.sum("value").alias("value"))
    names = totals.select("lang", "sid", "source")
    named = values.join(names, ["lang", "sid"]).join(
        names.select("lang", F.col("sid").alias("other"), F.col("source").alias("item")), ["lang", "other"]
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return named.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def _term_part(found: DataFrame, totals: DataFrame, how: Audit) -> DataFrame:
    scored = (
        found.where("term IS NOT NULL")
        .join(totals, ["lang", "sid"])
        .withColumn("p", F.expr(_share_sql("n", "(own_n + kept)", how.step)))
        .withColumn("q", F.expr(_share_sql("lang_n", "(whole_n + kept)", how.step)))
        .where("p > q")
        .selectExpr("lang", "source", "term AS item", f"{_score_sql('p', 'q')} AS value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= how.top)
    return ranked.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")


def op11_dominance_skyband(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), w AS (
  SELECT rid, lang, source, unnest(words) AS term FROM d
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS whole FROM w GROUP BY ALL HAVING count(DISTINCT rid) >= 3
), langs AS (
  SELECT lang, coalesce(sum(whole), 0)::HUGEINT AS n, count(term)::HUGEINT AS v
  FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept USING (lang) GROUP BY lang
), c AS (
  SELECT w.lang, w.source, w.term, count(*)::HUGEINT AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL
), g AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS n
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS c,
         1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (g.n + l.v) AS p,
         1 + (1000000000 * (k.whole + 1)) // (l.n + l.v) AS q
  FROM g JOIN langs l ON l.lang = g.lang JOIN kept k ON k.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM parts
QUALIFY part = 'pair' OR rank <= 200
"""
