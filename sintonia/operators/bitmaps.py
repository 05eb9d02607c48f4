"""Audiences as stored bitmaps of households, exact and mergeable.

A dictionary gives every household a number once and for all.  The households of a
(date, hour band, channel) are then bitmaps, one per 32,768 numbers, beside the largest
universe.  A channel's audience is the bits set; the band's is the bits set in the union
over channels.  Bitmaps are a partition per (date, channel): when one channel is
processed again, only its silver is read and only its bitmaps are replaced, and the
denominators of the whole band still come out exactly.

Numbers are dealt without a global order: a household falls into one of ``DEAL`` hash
classes and gets the next place of its class, so classes are numbered in parallel and
numbers stay dense.  A number never changes; the dictionary only grows (one run at a
time may add to it).
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sintonia import schemas as S
from sintonia.functions.columns import event_date, hour_band
from sintonia.sources.layers import read_layer
from sintonia.sources.sinks import replace_partitions
from sintonia.sources.storage import path_exists

#: Hash classes of households; fixed, since numbers are made from it.
DEAL = 1024

DICTIONARY = T.StructType(
    [T.StructField(S.HOGAR, T.StringType()), T.StructField("clase", T.LongType()), T.StructField("numero", T.LongType())]
)
BITMAPS = T.StructType(
    [
        T.StructField(S.FRANJA, T.LongType()),
        T.StructField("cubo", T.LongType()),
        T.StructField("hogares", T.BinaryType()),
        T.StructField(S.UNIVERSO, T.LongType()),
        T.StructField(S.FECHA, T.DateType()),
        T.StructField(S.CANAL, T.StringType()),
    ]
)


def _dictionary_root(root: str) -> str:
    return f"{root.rstrip('/')}/hogares"


def _bitmap_root(root: str) -> str:
    return f"{root.rstrip('/')}/bitmaps"


def read_dictionary(spark: SparkSession, root: str) -> DataFrame:
    path = _dictionary_root(root)
    if not path_exists(spark, path):
        return spark.createDataFrame([], DICTIONARY)
    return spark.read.schema(DICTIONARY).parquet(path)


def new_households(silver: DataFrame, known: DataFrame) -> DataFrame:
    """Dictionary entries of the households of ``silver`` that ``known`` lacks."""
    homes = silver.select(S.HOGAR).distinct().join(known, S.HOGAR, "left_anti")
    homes = homes.withColumn("clase", F.pmod(F.xxhash64(S.HOGAR), F.lit(DEAL)).cast("long"))
    full = known.groupBy("clase").agg(F.max("numero").alias("last"))
    place = F.row_number().over(Window.partitionBy("clase").orderBy(S.HOGAR))
    # numbers of a class: 1 + class, then every DEAL-th
    after = F.coalesce(F.col("last"), F.col("clase") + 1 - DEAL)
    return homes.join(full, "clase", "left").select(S.HOGAR, "clase", (after + place * DEAL).cast("long").alias("numero"))


def band_bitmaps(silver: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``BITMAPS`` of silver rows.  The minutes of a household fold to one row per band
    and channel before its number is looked up; a bitmap's size is fixed."""
    folded = silver.groupBy(
        event_date(S.TIMESTAMP).alias(S.FECHA), hour_band(S.TIMESTAMP).alias(S.FRANJA), S.CANAL, S.HOGAR
    ).agg(F.max(S.UNIVERSO).alias(S.UNIVERSO))
    numbered = folded.join(dictionary.select(S.HOGAR, "numero"), S.HOGAR)
    return (
        numbered.groupBy(S.FECHA, S.FRANJA, S.CANAL, F.bitmap_bucket_number("numero").alias("cubo"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("numero")).alias("hogares"), F.max(S.UNIVERSO).alias(S.UNIVERSO))
        .select(*BITMAPS.names)
    )


def counts(bitmaps: DataFrame) -> DataFrame:
    """What ``metrics.band_counts`` gives, from bitmaps: audience and universe per band
    (``es_franja``) and per channel of a band."""
    size = F.bitmap_count("hogares")
    channels = bitmaps.groupBy(S.FECHA, S.FRANJA, S.CANAL).agg(F.sum(size).alias("audiencia"), F.max(S.UNIVERSO).alias("universo"))
    united = bitmaps.groupBy(S.FECHA, S.FRANJA, "cubo").agg(F.bitmap_or_agg("hogares").alias("hogares"), F.max(S.UNIVERSO).alias(S.UNIVERSO))
    bands = united.groupBy(S.FECHA, S.FRANJA).agg(F.sum(size).alias("audiencia"), F.max(S.UNIVERSO).alias("universo"))
    none = F.lit(None).cast("string").alias(S.CANAL)
    m = F.struct("audiencia", "universo").alias("m")
    return channels.select(S.FECHA, S.FRANJA, F.lit(False).alias("es_franja"), S.CANAL, m).unionAll(
        bands.select(S.FECHA, S.FRANJA, F.lit(True).alias("es_franja"), none, m)
    )


def refresh(spark: SparkSession, silver: DataFrame, root: str) -> None:
    """Number the new households of ``silver`` and replace the bitmaps of its (date,
    channel) partitions.  Give it the partitions that changed, whole."""
    new = new_households(silver, read_dictionary(spark, root))
    new.write.mode("append").parquet(_dictionary_root(root))
    made = band_bitmaps(silver, read_dictionary(spark, root)).hint("rebalance", S.FECHA, S.CANAL)
    replace_partitions(made, _bitmap_root(root), S.SILVER_PARTITIONS)


def read_bitmaps(spark: SparkSession, root: str, *, start=None, end=None, dates: Iterable[date] = ()) -> DataFrame:
    """The bitmaps of all channels for dates [start, end] and ``dates``."""
    return read_layer(spark, _bitmap_root(root), BITMAPS, start=start, end=end, dates=dates)
