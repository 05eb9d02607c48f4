from __future__ import annotations

from datetime import datetime

from sintonia import schemas as S

SILVER_DDL = "id_hogar_panelista string, canal string, timestamp timestamp_ntz, universo_total long"
BRONZE_DDL = "timestamp timestamp_ntz, canal string, id_hogar_panelista string, universo_total long"


def silver_df(spark, rows):
    """rows: (household, channel, datetime, universe)."""
    return spark.createDataFrame(rows, SILVER_DDL)


def bronze_df(spark, rows):
    """rows: (datetime, channel, household, universe)."""
    return spark.createDataFrame(rows, BRONZE_DDL)


def two_channel_silver(spark, universo=100_000):
    d = lambda h, m: datetime(2026, 8, 1, h, m)
    return silver_df(
        spark,
        [
            ("hogar-0001", "Canal1", d(10, 5), universo),
            ("hogar-0002", "Canal1", d(10, 30), universo),
            ("hogar-0001", "Canal1", d(9, 5), universo),
            ("hogar-0003", "Canal2", d(10, 45), universo),
        ],
    )


def by_band(gold, canal):
    return {r[S.FRANJA]: r for r in gold.filter(gold.canal == canal).collect()}
