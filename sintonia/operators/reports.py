"""Report queries over the gold layer: presets, free SQL, the preset catalogue.

Presets are SQL texts; they and free SQL run against a temp view named ``gold``, with
named parameters (``:canal``) bound by Spark, never interpolated.  Rounding to two
places uses the scaled form; leader ties are broken by channel name.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sintonia import schemas as S
#: Rounding to two places on the scaled double, as ``functions.round2``.
_ROUND2 = "round({} * 100D, 0) / 100D"

#: Preset reports as SQL over the view ``gold``: what ``catalogue`` lists is what runs, to
#: be copied and edited as free SQL.
PRESETS: dict[str, str] = {
    # rating and share of every channel in every band
    "rating_share": "SELECT fecha, franja_horaria, canal, rating_pct, share_pct FROM gold ORDER BY 1, 2, 3",
    # mean rating, mean share and added audience of each channel and day, best first
    "resumen_canal": f"""SELECT fecha, canal, {_ROUND2.format("avg(rating_pct)")} AS rating_prom,
       {_ROUND2.format("avg(share_pct)")} AS share_prom, sum(audiencia_canal) AS audiencia_acumulada_dia
FROM gold GROUP BY fecha, canal ORDER BY fecha, rating_prom DESC, canal""",
    # the leader of each band: every task hands on one candidate per band, the least of
    # (negated rating, channel)
    "top_franja": """SELECT fecha, franja_horaria, first_place.canal, first_place.rating_pct, first_place.share_pct
FROM (SELECT fecha, franja_horaria,
             min(named_struct('below', -rating_pct, 'canal', canal, 'rating_pct', rating_pct, 'share_pct', share_pct)) AS first_place
      FROM gold GROUP BY fecha, franja_horaria)
ORDER BY fecha, franja_horaria""",
    # the bands nobody watched
    "cobertura": """SELECT * FROM (SELECT fecha, franja_horaria, sum(audiencia_total_franja) AS audiencia_total
               FROM gold GROUP BY fecha, franja_horaria)
WHERE audiencia_total = 0 ORDER BY fecha, franja_horaria""",
    # sum of the shares of each band (over 100 where households changed channel)
    "share_check": f"""SELECT fecha, franja_horaria, {_ROUND2.format("sum(share_pct)")} AS suma_share_pct
FROM gold GROUP BY fecha, franja_horaria ORDER BY fecha, franja_horaria""",
}

DEFAULT_PRESET = "rating_share"
DISPLAY_ROWS = 200
GOLD_VIEW = "gold"


def preset(gold: DataFrame, name: str = DEFAULT_PRESET) -> DataFrame:
    """Run one preset report over ``gold``."""
    if name not in PRESETS:
        raise KeyError(f"unknown preset {name!r}; known: {sorted(PRESETS)}")
    return query(gold.sparkSession, PRESETS[name].replace("FROM gold", "FROM {gold}"), gold=gold)


def catalogue(spark: SparkSession) -> DataFrame:
    """The preset catalogue as a (name, sql) DataFrame, sorted by name."""
    return spark.createDataFrame(sorted(PRESETS.items()), "name string, sql string")


def register_gold(gold: DataFrame, view: str = GOLD_VIEW) -> None:
    gold.createOrReplaceTempView(view)


def query(spark: SparkSession, sql: str, args: Mapping[str, Any] | None = None, **frames: DataFrame) -> DataFrame:
    """Free SQL over the registered ``gold`` view (or over DataFrames passed as
    ``{name}`` keywords); ``args`` are bound as named parameters."""
    if frames:
        return spark.sql(sql, args=dict(args) if args else None, **frames)
    return spark.sql(sql, args=dict(args) if args else None)


def run_report(
    spark: SparkSession,
    gold_root: str,
    start,
    end=None,
    *,
    canal: str | None = None,
    name: str = DEFAULT_PRESET,
    sql: str | None = None,
    args: Mapping[str, Any] | None = None,
) -> DataFrame | None:
    """A report over the gold layer for dates [start, end] (end defaults to start),
    optionally one channel: the ``gold`` view is registered with partition
    predicates (only those folders are read), then ``sql`` runs if given, else
    the preset ``name``.  Returns None when the range holds no gold rows."""
    from sintonia.sources.layers import gold_view

    gold = gold_view(spark, gold_root, start=start, end=end, canal=canal)
    if gold.isEmpty():
        return None
    return query(spark, sql, args) if sql else preset(gold, name)


def max_rating_by_channel(gold: DataFrame) -> DataFrame:
    """The documented custom query: highest Rating% of each channel."""
    return gold.groupBy(S.CANAL).agg(F.max("rating_pct").alias("max_rating_pct"))


def show(df: DataFrame, rows: int = DISPLAY_ROWS) -> None:
    """Print at most ``rows`` rows (presentation cap only)."""
    df.show(rows, truncate=False)
