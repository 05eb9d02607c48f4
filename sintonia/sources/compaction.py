"""Compaction: fewer, larger files where many small writes have left small ones.

The listing gives each partition's files and bytes; a partition with more files than its
bytes need at the target size is read and written again, rows dealt evenly over that
many files.  Dynamic partition overwrite stages the new files and swaps partitions at
commit, so a lost executor or a failed run leaves the old files in place.  Other
partitions are neither read nor written."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sintonia import schemas as S
from sintonia.operators.audit import inventory
from sintonia.sources.sinks import replace_partitions
from sintonia.sources.storage import partition_folder

TARGET_BYTES = 256 << 20
_FILES = "_files"


def crowded(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    partitions: Sequence[str],
    target_bytes: int = TARGET_BYTES,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """Partitions (of dates [start, end], or all) with more files than they need, and how
    many they need."""
    held = inventory(spark, root, schema, partitions)
    if start is not None:
        held = held.filter(F.col(S.FECHA).between(F.lit(start), F.lit(end or start)))
    needed = F.ceil(F.col("n_bytes") / F.lit(target_bytes)).cast("long")
    return held.withColumn(_FILES, F.greatest(needed, F.lit(1))).filter(F.col("n_files") > F.col(_FILES)).select(*partitions, _FILES)


def compact(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    partitions: Sequence[str],
    *,
    target_bytes: int = TARGET_BYTES,
    start: date | None = None,
    end: date | None = None,
) -> int:
    """Rewrite the crowded partitions; returns how many there were.

    The list of crowded partitions (one row each) is collected, to read exactly their
    folders.  A row's file is dealt by its place in its old file: evenly, whatever keys
    repeat, and the same when a task is run again."""
    chosen = crowded(spark, root, schema, partitions, target_bytes, start, end).collect()
    if not chosen:
        return 0
    text = spark.createDataFrame(chosen, T.StructType([*[schema[p] for p in partitions], T.StructField(_FILES, T.LongType())]))
    listed = text.select(F.array(*[F.col(p).cast("string") for p in partitions]).alias("p")).collect()
    folders = [partition_folder(root, partitions, r.p) for r in listed]
    rows = spark.read.schema(schema).option("basePath", root).parquet(*folders)
    place = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    dealt = rows.withColumn("_place", place).join(text, list(partitions))
    files = sum(r[_FILES] for r in chosen)
    made = dealt.repartition(files, *partitions, F.pmod("_place", F.col(_FILES))).select(*schema.names)
    replace_partitions(made, root, tuple(partitions))
    return len(chosen)
