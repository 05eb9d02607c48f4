"""Silver: drop incomplete rows and collapse each natural key to one row.

The winner of a key (household, channel, exact timestamp) keeps the largest
universe, a rule that depends only on the data, never on read order.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sintonia import schemas as S
from sintonia.functions.columns import audit_time


def _incomplete() -> Column:
    return F.col(S.TIMESTAMP).isNull() | F.col(S.CANAL).isNull() | F.col(S.HOGAR).isNull() | F.col(S.UNIVERSO).isNull()


def incomplete_rows(bronze: DataFrame) -> DataFrame:
    """Bronze rows that silver leaves out, of every channel."""
    return bronze.filter(_incomplete())


def clean(
    bronze: DataFrame,
    *,
    canal_filter: str | None = None,
    procesado_en: datetime | str | None = None,
    cluster_for_write: bool = False,
) -> DataFrame:
    """Bronze rows -> silver rows (``SILVER_COLUMNS``).

    One shuffle on the key with map-side partial ``max``: copies of a key collapse
    inside each map task before the shuffle, so even a key copied into a third of
    all rows reaches its reducer as at most one row per map task.  ``canal_filter``
    keeps a single channel; since ``canal`` is a grouping key Catalyst pushes the
    filter below the aggregate and into the Parquet scan.

    ``cluster_for_write`` lays the de-duplicated rows out for a partitioned write
    with a rebalance on (fecha, canal): each task then holds few partitions, so the
    write makes few files per partition, and AQE splits a partition that is too
    large (a hot channel or date) over several tasks and merges small ones.
    """
    rows = bronze.filter(~_incomplete())
    if canal_filter is not None:
        rows = rows.filter(F.col(S.CANAL) == F.lit(canal_filter))
    rows = rows.select(S.HOGAR, S.CANAL, S.TIMESTAMP, S.UNIVERSO, F.col(S.TIMESTAMP).cast("date").alias(S.FECHA))
    deduped = rows.groupBy(S.FECHA, S.CANAL, S.HOGAR, S.TIMESTAMP).agg(F.max(S.UNIVERSO).alias(S.UNIVERSO))
    if cluster_for_write:
        deduped = deduped.hint("rebalance", S.FECHA, S.CANAL)
    audit = audit_time(procesado_en)
    return deduped.select(S.HOGAR, S.CANAL, S.TIMESTAMP, S.UNIVERSO, audit.alias(S.PROCESADO_EN), S.FECHA)


def clean_summary(bronze: DataFrame, canal_filter: str | None = None) -> DataFrame:
    """``output_rows``, ``excluded_null_rows`` (all channels, before the channel
    filter) and the sorted channel list of what ``clean`` makes of ``bronze``, as one
    row, from one scan.

    Complete rows fold to their natural keys, incomplete ones to a single key (map-side
    combine before the shuffle); the keys are then counted.  The channel set is
    bounded by the channel dimension."""
    keys = (S.HOGAR, S.CANAL, S.TIMESTAMP)
    kept = ~_incomplete()
    rows = bronze.select(*[F.when(kept, F.col(c)).alias(c) for c in keys], kept.alias("_kept"))
    if canal_filter is not None:
        rows = rows.filter(~F.col("_kept") | (F.col(S.CANAL) == F.lit(canal_filter)))
    folded = rows.groupBy("_kept", *keys).agg(F.count(F.lit(1)).alias("n"))
    return folded.agg(
        F.count_if("_kept").alias("output_rows"),
        F.coalesce(F.sum(F.when(~F.col("_kept"), F.col("n"))), F.lit(0)).alias("excluded_null_rows"),
        F.sort_array(F.collect_set(S.CANAL)).alias("canales"),
    )
