"""Layer writers.  Every write replaces exactly the (fecha[, canal]) partitions
present in the data (dynamic partition overwrite) and leaves the others untouched,
so a rerun never duplicates rows and a one-channel reprocess keeps every other
channel (``Canal1`` and ``Canal10`` are different partitions).  An empty DataFrame
replaces nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sintonia import schemas as S


def replace_partitions(df: DataFrame, root: str, partitions: tuple[str, ...]) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(root)
    )


def write_outcomes(outcomes: DataFrame, root: str) -> None:
    """Both outcomes of validation (``validate.outcomes``) by one write, committed
    together.  No shuffle: each task writes the dates of its scan split, so there are
    about as many files as splits."""
    replace_partitions(outcomes, root, S.OUTCOME_PARTITIONS)


def write_bronze(bronze: DataFrame, root: str) -> None:
    """Valid rows alone, as ``write_outcomes`` lays them out.  Rows without a landing
    date count as landed on their own date."""
    if S.FECHA_LANDING not in bronze.columns:
        bronze = bronze.withColumn(S.FECHA_LANDING, F.col(S.FECHA))
    replace_partitions(bronze.select(*S.BRONZE_COLUMNS), f"{root.rstrip('/')}/{S.RESULTADO}={S.ACEPTADO}", S.BRONZE_PARTITIONS)


def write_silver(silver: DataFrame, root: str) -> None:
    """Expects ``clean(..., cluster_for_write=True)``: its rebalance already groups
    rows by (fecha, canal), so this writes few files per partition, with hot
    partitions split over several tasks by AQE."""
    replace_partitions(silver.select(*S.SILVER_COLUMNS), root, S.SILVER_PARTITIONS)


def write_gold(gold: DataFrame, root: str) -> None:
    """Gold is 24 rows per (fecha, canal): one small shuffle on the partition keys
    gives one file each.  The task count is fixed to the shuffle partitions so AQE
    does not merge these few bytes into one task that would then create every
    partition's file in sequence (the cost here is per file, not per byte)."""
    n = int(gold.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    replace_partitions(gold.select(*S.GOLD_COLUMNS).repartition(n, S.FECHA, S.CANAL), root, S.GOLD_PARTITIONS)


def write_manifest(manifest: DataFrame, root: str) -> None:
    """What the landing folders of a run brought, replacing what they brought before;
    one small file each."""
    one = manifest.repartition(S.FECHA_LANDING).select(*[f.name for f in S.MANIFEST.fields])
    replace_partitions(one, root, (S.FECHA_LANDING,))
