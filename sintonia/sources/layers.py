"""Reads of the bronze, silver and gold layers.

Always with the layer's explicit schema (partition values keep their text: channel
``07`` stays ``"07"``).  With a date range, one shallow listing finds the ``fecha=``
folders in it and only those are given to the reader: no other folder is listed or
read.  The channel is a partition predicate (``PartitionFilters`` in the plan).
A layer that does not exist yet is an empty table.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sintonia import schemas as S
from sintonia.sources.storage import date_folders, path_exists


def read_layer(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    *,
    start: date | str | None = None,
    end: date | str | None = None,
    dates: Iterable[date] = (),
    canal: str | None = None,
    fail_if_missing: bool = False,
) -> DataFrame:
    """A layer, or its dates in [start, end] and those of ``dates``."""
    columns = [f.name for f in schema.fields]
    if not path_exists(spark, root):
        if fail_if_missing:
            raise FileNotFoundError(root)
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    if start is None:
        df = reader.parquet(root)
    else:
        folders = dict(date_folders(spark, root, start, end))
        for d in set(dates) - set(folders):
            folders.update(date_folders(spark, root, d))
        if not folders:
            return spark.createDataFrame([], schema)
        folders = [folders[d] for d in sorted(folders)]
        df = reader.option("basePath", root).parquet(*folders)
    if canal is not None:
        if S.CANAL not in columns:
            raise ValueError("layer has no canal column")
        df = df.filter(F.col(S.CANAL) == F.lit(canal))
    return df.select(*columns)


def outcome_root(root: str, outcome: str) -> str:
    return f"{root.rstrip('/')}/{S.RESULTADO}={outcome}"


def read_bronze(spark: SparkSession, root: str, **kw) -> DataFrame:
    """The valid rows of bronze."""
    return read_layer(spark, outcome_root(root, S.ACEPTADO), S.BRONZE, **kw)


def read_rejects(spark: SparkSession, root: str, **kw) -> DataFrame:
    """The invalid lines of bronze, by landing date."""
    return read_layer(spark, outcome_root(root, S.RECHAZADO), S.REJECTS, **kw)


def manifest_root(root: str) -> str:
    return f"{root.rstrip('/')}/_manifest"


def read_manifest(spark: SparkSession, root: str, start: date | str, end: date | str) -> DataFrame:
    """What the landing folders of [start, end] brought to bronze (``schemas.MANIFEST``)."""
    top = manifest_root(root)
    folders = [path for _, path in date_folders(spark, top, start, end, S.FECHA_LANDING)]
    if not folders:
        return spark.createDataFrame([], S.MANIFEST)
    return spark.read.schema(S.MANIFEST).option("basePath", top).parquet(*folders)


_V1_SOURCES = "spark.sql.sources.useV1SourceList"


def footer_counts(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    partitions: Sequence[str],
    *,
    folders: Sequence[str] | None = None,
    not_null: Sequence[str] = (),
) -> DataFrame:
    """Rows per partition (``n_rows``) and, for the columns ``not_null``, how many have a
    value (``n_<column>``), from the files' footers: the aggregate is pushed into the
    scan, which reads no row group.  Only Spark's newer Parquet source does that, so it
    is chosen while the table is resolved; ``partitions`` must be all of the layer's."""
    if not path_exists(spark, root) or (folders is not None and not folders):
        counts = [T.StructField(n, T.LongType()) for n in ("n_rows", *(f"n_{c}" for c in not_null))]
        return spark.createDataFrame([], T.StructType([*[schema[p] for p in partitions], *counts]))
    before = spark.conf.get(_V1_SOURCES)
    spark.conf.set(_V1_SOURCES, ",".join(x for x in before.split(",") if x.strip() != "parquet"))
    try:
        layer = spark.read.schema(schema).option("basePath", root).parquet(*(folders or [root]))
    finally:
        spark.conf.set(_V1_SOURCES, before)
    return layer.groupBy(*partitions).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(f"n_{c}") for c in not_null]
    )


def read_silver(spark: SparkSession, root: str, **kw) -> DataFrame:
    return read_layer(spark, root, S.SILVER, **kw)


def read_gold(spark: SparkSession, root: str, **kw) -> DataFrame:
    return read_layer(spark, root, S.GOLD, **kw)


def gold_view(spark: SparkSession, root: str, view: str = "gold", **kw) -> DataFrame:
    """Gold over a date range (and optionally one channel) as temp view ``gold``."""
    df = read_gold(spark, root, **kw)
    df.createOrReplaceTempView(view)
    return df


def gold_table(spark: SparkSession, root: str, name: str = "gold_layer") -> DataFrame:
    """Gold as a partitioned catalog table over ``root``: its partitions are recovered
    once, and a query's range and channel then pick them in the catalog, with no listing
    of the other folders.  Register it again after a run has made new partitions."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.GOLD.fields)
    keys = ", ".join(S.GOLD_PARTITIONS)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({keys}) LOCATION '{root}'")
    spark.catalog.recoverPartitions(name)
    return spark.table(name).select(*S.GOLD_COLUMNS)
