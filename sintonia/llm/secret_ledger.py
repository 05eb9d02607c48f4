"""Secret scans over an incremental blob ledger.

Every version of every path is content-addressed (SHA-256 of its text).  The ledger is
an append-only table ``(blob, done, spans)``: which rule versions a blob was scanned
with, and what they found.  An update looks up, on content addresses alone, which wanted
rule versions the ledger lacks for which blobs; it takes one text of each such blob,
scans only those pairs and appends the result, or ends there if nothing is new;
``report`` joins findings back to all paths of a blob.  Copies never reach the scanner:
one row per blob and task leaves the read, and one per blob is scanned.

Defined results: a null text is the empty blob; repeated rows and paths each get their
blob's findings; further columns of the versions are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sintonia.llm.common import scratch_path, table, text_or_empty, written
from sintonia.sources.storage import path_exists


@dataclass(frozen=True)
class Rule:
    """``pattern`` over UTF-8 bytes; a match counts if its ``group`` has ``least``
    bytes.  ``hints``: a text (lower-cased) without any of them cannot match."""

    kind: str
    pattern: bytes
    least: int = 0
    group: int = 0
    hints: tuple[bytes, ...] = ()
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: The first three patterns are fixed values; the order of kinds breaks ties.
RULES = (
    Rule(
        "assign",
        rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        6,
        1,
        (b"passw", b"secret", b"token", b"api"),
    ),
    Rule("access", rb"AKIA[A-Z0-9]+", 20, 0, (b"akia",)),
    Rule("hex", rb"[0-9a-f]{24,}", 24),
    Rule("pem", rb"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0, 0, (b"-----begin",)),
    Rule("github", rb"gh[oprsu]_[A-Za-z0-9]{36,}", 0, 0, (b"gho_", b"ghp_", b"ghr_", b"ghs_", b"ghu_")),
    Rule("slack", rb"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0, (b"xox",)),
    Rule("jwt", rb"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0, (b"eyj",)),
)
BASE_KINDS = ("assign", "access", "hex")

_SPAN = "struct<start:long,rank:int,end:long,kind:string,version:int>"
_LEDGER = f"blob binary, done array<string>, spans array<{_SPAN}>"
_ARROW_SPAN = pa.struct(
    [("start", pa.int64()), ("rank", pa.int32()), ("end", pa.int64()), ("kind", pa.string()), ("version", pa.int32())]
)


def scan(text: bytes, rules: tuple[Rule, ...] | list[Rule], ranks: dict[str, int]) -> list[dict]:
    """Spans in code points, by start and then by the rules' order."""
    low = text.lower()
    found = []
    for rule in rules:
        if rule.hints and not any(h in low for h in rule.hints):
            continue
        for m in re.finditer(rule.pattern, text):
            if len(m.group(rule.group)) >= rule.least:
                found.append((m.start(), ranks[rule.kind], m.end(), rule))
    if not found:
        return []
    found.sort(key=lambda x: x[:2])
    points = (lambda b: b) if text.isascii() else (lambda b: len(text[:b].decode()))
    return [
        {"start": points(a), "rank": rank, "end": points(b), "kind": rule.kind, "version": rule.version}
        for a, rank, b, rule in found
    ]


def blob_id(text: str = "text") -> Column:
    return F.unhex(F.sha2(text_or_empty(text), 256))


class Ledger:
    """The scans recorded under ``root`` (Parquet, append-only)."""

    def __init__(self, spark: SparkSession, root: str, rules: tuple[Rule, ...] = RULES):
        self.spark, self.root, self.rules = spark, root, rules
        self.ranks = {r.kind: k for k, r in enumerate(rules)}

    def scans(self) -> DataFrame:
        if not path_exists(self.spark, self.root):
            return self.spark.createDataFrame([], _LEDGER)
        return self.spark.read.schema(_LEDGER).parquet(self.root)

    def missing(self, versions: DataFrame) -> DataFrame:
        """``blob, todo``: wanted rule versions that the ledger lacks."""
        wanted = F.array(*[F.lit(r.key) for r in self.rules])
        blobs = versions.select(blob_id().alias("blob")).distinct()
        seen = self.scans().select("blob", F.explode("done").alias("d")).groupBy("blob").agg(F.collect_set("d").alias("seen"))
        todo = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
        return blobs.join(seen, "blob", "left").select("blob", todo.alias("todo")).where(F.size("todo") > 0)

    def unseen(self, versions: DataFrame) -> DataFrame | None:
        """``blob, text, todo``: one row per blob with something to scan; None if the
        ledger has them all."""
        texts = versions.select(blob_id().alias("blob"), text_or_empty().alias("text"))
        if path_exists(self.spark, self.root):
            missing = written(self.missing(versions), "missing")
            if not missing.head(1):
                return None
            texts = texts.join(missing, "blob")
        else:
            texts = texts.withColumn("todo", F.array(*[F.lit(r.key) for r in self.rules]))
        one = Window.partitionBy("blob").orderBy("blob")
        return texts.withColumn("copy", F.row_number().over(one)).where("copy = 1").select("blob", "text", "todo")

    def update(self, versions: DataFrame) -> None:
        """Scan the unseen pairs of ``versions(text)`` and append them."""
        unseen = self.unseen(versions)
        if unseen is None:
            return
        by_key, ranks = {r.key: r for r in self.rules}, self.ranks

        def run(batches):
            for batch in batches:
                todo = batch.column(2).to_pylist()
                spans = [scan((t.as_py() or "").encode(), [by_key[k] for k in ks], ranks) for t, ks in zip(batch.column(1), todo)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(spans, pa.list_(_ARROW_SPAN))], names=["blob", "done", "spans"]
                )

        unseen.mapInArrow(run, _LEDGER).write.mode("append").parquet(self.root)

    def report(self, versions: DataFrame, path: str) -> DataFrame:
        """``path, spans, scans`` for every row of ``versions(path, text)``: spans of the
        current rule versions, sorted by start and then by the rules' order, and how
        often the blob was scanned."""
        current = F.array(*[F.lit(r.key) for r in self.rules])
        found = (
            self.scans()
            .groupBy("blob")
            .agg(F.flatten(F.collect_list("spans")).alias("spans"), F.count("*").alias("scans"))
            .select(
                "blob",
                "scans",
                F.array_sort(
                    F.filter("spans", lambda s: F.array_contains(current, F.concat_ws("@", s["kind"], s["version"].cast("string"))))
                ).alias("spans"),
            )
        )
        found = written(found, "findings")
        rows = versions.select(path, blob_id().alias("blob"))
        return rows.join(found, "blob", "left").select(
            path, F.coalesce("spans", F.array().cast(f"array<{_SPAN}>")).alias("spans"), F.coalesce("scans", F.lit(0).cast("long")).alias("scans")
        )


def _joined(spans: Column) -> Column:
    text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def op6_blob_ledger(spark, sf_dir: str) -> DataFrame:
    """Every text is delivered twice; the second time the ledger has all its blobs, so
    each is scanned once (``scans``)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    for _ in range(2):
        ledger.update(docs)
    spans = F.col("spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return ledger.report(docs, "doc_id").select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(_joined(F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
        "scans",
    )
