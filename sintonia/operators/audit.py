"""Audit: partition inventory, logical content digests and run comparison.

Digests prove that two runs wrote the same *logical* content (never file bytes)
and leave the audit column out.  A row's text is its values joined by chr(1), each
with a mark that tells NULL from text, so ``(a, NULL)`` and ``(NULL, a)`` differ; its
md5 is cut into four numbers of 32 bits, and the digest is the md5 of the row count
and the four sums.  Sums do not depend on order, combine in every task and can be
recomputed by any SQL engine; no sort and no whole partition in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sintonia import schemas as S
from sintonia.sources.layers import footer_counts
from sintonia.sources.storage import partition_folder, path_exists

_SLICES = 4
_LISTING = "path string, modificationTime timestamp, length long, content binary"


def content_columns(df: DataFrame, exclude: Sequence[str] = S.AUDIT_COLUMNS) -> list[str]:
    cols = [c for c in df.columns if c not in set(exclude)]
    if not cols:
        raise ValueError("a digest needs at least one column that is not an audit column")
    return sorted(cols)


def row_text(cols: Sequence[str]) -> Column:
    """The row's values as text (``1`` and the value, or ``0`` for NULL), joined by
    chr(1) in column order."""
    marked = [F.coalesce(F.concat(F.lit("1"), F.col(c).cast("string")), F.lit("0")) for c in cols]
    return F.concat_ws("\x01", *marked)


def _slice_sums(h: Column) -> list[Column]:
    return [F.sum(F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("long")).alias(f"_s{i}") for i in range(_SLICES)]


def _digest_of(count: Column, sums: list[Column]) -> Column:
    return F.md5(F.concat_ws(":", count.cast("string"), *[c.cast("string") for c in sums]).cast("binary"))


def partition_digests(
    df: DataFrame, partitions: Sequence[str] = S.GOLD_PARTITIONS, exclude: Sequence[str] = S.AUDIT_COLUMNS
) -> DataFrame:
    """One row per partition: ``n_rows`` and ``digest``."""
    cols = content_columns(df, exclude)
    hashed = df.select(*partitions, F.md5(row_text(cols).cast("binary")).alias("_h"))
    agg = hashed.groupBy(*partitions).agg(F.count(F.lit(1)).alias("n_rows"), *_slice_sums(F.col("_h")))
    sums = [F.col(f"_s{i}") for i in range(_SLICES)]
    return agg.select(*partitions, "n_rows", _digest_of(F.col("n_rows"), sums).alias("digest"))


def layer_digest(df: DataFrame, exclude: Sequence[str] = S.AUDIT_COLUMNS) -> DataFrame:
    """One row: ``n_rows`` and ``digest`` of the whole table."""
    cols = content_columns(df, exclude)
    agg = df.select(F.md5(row_text(cols).cast("binary")).alias("_h")).agg(F.count(F.lit(1)).alias("n_rows"), *_slice_sums(F.col("_h")))
    sums = [F.coalesce(F.col(f"_s{i}"), F.lit(0)) for i in range(_SLICES)]
    return agg.select("n_rows", _digest_of(F.col("n_rows"), sums).alias("digest"))


def compare(a: DataFrame, b: DataFrame, keys: Sequence[str] = S.GOLD_PARTITIONS) -> DataFrame:
    """Full outer join of two partition-digest tables: every partition with both
    digests and ``same`` (False also when a side is missing)."""
    left = a.select(*keys, F.col("n_rows").alias("n_rows_a"), F.col("digest").alias("digest_a"))
    right = b.select(*keys, F.col("n_rows").alias("n_rows_b"), F.col("digest").alias("digest_b"))
    joined = left.join(right, list(keys), "full_outer")
    return joined.withColumn("same", F.coalesce(F.col("digest_a") == F.col("digest_b"), F.lit(False)))


def differences(a: DataFrame, b: DataFrame, keys: Sequence[str] = S.GOLD_PARTITIONS) -> DataFrame:
    return compare(a, b, keys).filter(~F.col("same"))


def differing_rows(
    spark: SparkSession,
    root_a: str,
    root_b: str,
    schema: T.StructType = S.SILVER,
    partitions: Sequence[str] = S.SILVER_PARTITIONS,
    key: str = S.HOGAR,
    buckets: int = 1024,
) -> DataFrame:
    """The rows in which two written layers differ, with how often each has them
    (``n_a``, ``n_b``): by digests of partitions, then of buckets of ``key`` within the
    partitions that differ, then of rows within the buckets that differ.

    Only folders of differing partitions (one row each, collected) are read after the
    first step, and only rows of differing buckets are shuffled whole."""
    layer = {root: spark.read.schema(schema).parquet(root) for root in (root_a, root_b)}
    texts = F.array(*[F.col(p).cast("string") for p in partitions]).alias("p")
    found = differences(*[partition_digests(layer[r], partitions) for r in (root_a, root_b)], partitions).select(texts).collect()
    cols = [c for c in schema.names if c not in S.AUDIT_COLUMNS]
    if not found:
        return layer[root_a].select(*cols, F.lit(0).cast("long").alias("n_a"), F.lit(0).cast("long").alias("n_b")).limit(0)
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).alias("_bucket")
    sides = []
    for root in (root_a, root_b):
        folders = [f for f in (partition_folder(root, partitions, r.p) for r in found) if path_exists(spark, f)]
        chosen = spark.read.schema(schema).option("basePath", root).parquet(*folders) if folders else layer[root].limit(0)
        sides.append(chosen.select(*cols, bucket))
    keys = [*partitions, "_bucket"]
    parted = differences(*[partition_digests(side, keys, exclude=("_bucket",)) for side in sides], keys).select(*keys)
    tagged = [
        side.select(*keys, *[c for c in cols if c not in partitions], F.lit(a).alias("n_a"), F.lit(1 - a).alias("n_b"))
        for side, a in zip(sides, (1, 0))
    ]
    same_null = [F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}")) for k in keys]
    rows = tagged[0].unionAll(tagged[1]).alias("x").join(parted.alias("y"), same_null, "left_semi")
    sums = [F.sum(n).cast("long").alias(n) for n in ("n_a", "n_b")]
    return rows.groupBy(*cols).agg(*sums).filter("n_a <> n_b")


def inventory(
    spark: SparkSession, root: str, schema: T.StructType, partitions: Sequence[str] = S.GOLD_PARTITIONS
) -> DataFrame:
    """Files, bytes and rows per partition of a written layer (proves that a rerun
    replaced files instead of adding them).  Files and bytes come from the listing, rows
    from the footers: no row is read."""
    keys = [schema[p] for p in partitions]
    sizes = [T.StructField(n, T.LongType()) for n in ("n_files", "n_bytes", "n_rows")]
    if not path_exists(spark, root):
        return spark.createDataFrame([], T.StructType([*keys, *sizes]))
    listed = T.StructType([*T.StructType.fromDDL(_LISTING).fields, *keys])
    files = (
        spark.read.format("binaryFile")
        .schema(listed)
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .groupBy(*partitions)
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))
    )
    return files.join(footer_counts(spark, root, schema, partitions), list(partitions))


def row_count(df: DataFrame) -> int:
    return df.count()
