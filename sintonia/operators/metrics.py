"""Gold: hourly Rating% and Share% per channel, with explicit zero rows.

Definitions (per date ``fecha`` and hour band ``franja_horaria``):

* ``audiencia_canal``: distinct households on the channel in the band;
* ``audiencia_total_franja``: distinct households on *any* channel in the band (a
  household on two channels counts once, so shares can add up to more than 100);
* ``universo_total``: largest universe seen in the band, over all channels;
* Rating% = audiencia_canal * 100 / universo_total (0.0 when the universe is 0);
* Share% = audiencia_canal * 100 / audiencia_total_franja (NULL for a dark band).

Every (date, channel) of the report has its 24 bands.  Channels listed by the
caller define the report rows; channels present in the data but not listed still
count in the band denominators; ``canal_filter`` narrows the rows only.

Plan: the only event-scale work is one aggregation to household-hour rows, per
channel and for the whole band (map-side combine folds the minutes of a household
before the shuffle).  Everything after it is bounded by dates x channels x 24 rows.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sintonia import schemas as S
from sintonia.functions.columns import audit_time, event_date, hour_band, rating_pct, share_pct, unique

_BAND = "es_franja"  # True: the whole band; False: one channel in the band
_LEVEL = "nivel"
_WHO = "quien"
_M = "m"


def band_counts(silver: DataFrame) -> DataFrame:
    """Audience counts per band and per (band, channel) from one scan.

    The first aggregate folds the minutes of a household to one row per (band,
    channel, household); it is the only one at event scale, and its map-side combine
    comes before the shuffle.  Each folded row then stands once for its channel
    (without the household, so channel counts combine to a few rows per task) and
    once for its band (with the household, to count it once over all channels).
    Output: ``fecha, franja_horaria, es_franja, canal, m`` with ``m`` a struct of
    ``audiencia`` and ``universo``.  Select levels by ``es_franja``, never by a NULL
    channel.  Only hash aggregates on primitive keys.
    """
    folded = silver.groupBy(
        event_date(S.TIMESTAMP).alias(S.FECHA), hour_band(S.TIMESTAMP).alias(S.FRANJA), F.col(S.CANAL), F.col(S.HOGAR)
    ).agg(F.max(S.UNIVERSO).alias(S.UNIVERSO))
    none = F.lit(None).cast("string")
    channel = F.struct(F.lit(False).alias(_BAND), F.col(S.CANAL).alias(_LEVEL), none.alias(_WHO))
    band = F.struct(F.lit(True).alias(_BAND), none.alias(_LEVEL), F.col(S.HOGAR).alias(_WHO))
    # a NULL channel is no channel: its rows stand for their band only
    levels = F.when(F.col(S.CANAL).isNull(), F.array(band)).otherwise(F.array(channel, band))
    rows = folded.select(S.FECHA, S.FRANJA, S.UNIVERSO, F.inline(levels))
    households = rows.groupBy(S.FECHA, S.FRANJA, _BAND, _LEVEL, _WHO).agg(
        F.count(F.lit(1)).alias("n"), F.max(S.UNIVERSO).alias(S.UNIVERSO)
    )
    audience = F.sum(F.when(F.col(_BAND), F.lit(1)).otherwise(F.col("n"))).cast("long")
    return households.groupBy(S.FECHA, S.FRANJA, _BAND, F.col(_LEVEL).alias(S.CANAL)).agg(
        F.struct(audience.alias("audiencia"), F.max(S.UNIVERSO).alias("universo")).alias(_M)
    )


def band_universe(counts: DataFrame) -> DataFrame:
    """A2: ``MAX(universo_total)`` per (fecha, franja) over all channels."""
    return counts.filter(F.col(_BAND)).select(S.FECHA, S.FRANJA, F.col(f"{_M}.universo").alias(S.UNIVERSO))


def band_audience(counts: DataFrame) -> DataFrame:
    """A3: distinct households per (fecha, franja), any channel."""
    return counts.filter(F.col(_BAND)).select(
        S.FECHA, S.FRANJA, F.col(f"{_M}.audiencia").alias("audiencia_total_franja")
    )


def channel_audience(counts: DataFrame) -> DataFrame:
    """A4: distinct households per (fecha, canal, franja)."""
    return counts.filter(~F.col(_BAND)).select(
        S.FECHA, S.CANAL, S.FRANJA, F.col(f"{_M}.audiencia").alias("audiencia_canal")
    )


def gold_metrics(
    silver: DataFrame,
    *,
    canales: Sequence[str] | DataFrame | None = None,
    canal_filter: str | None = None,
    procesado_en: datetime | str | None = None,
) -> DataFrame:
    """Silver rows -> gold rows (``GOLD_COLUMNS``), 24 per (fecha, canal).

    ``canales`` is the definitive channel list (a listed channel without events
    still gets 24 zero rows; repeated names count once).  When omitted, each date
    reports the channels present in its own data.  Dates are those present in the
    data.  A DataFrame of ``canal, fecha`` (see ``calendar``) lists channels date by date.
    """
    return gold_from_counts(band_counts(silver), canales=canales, canal_filter=canal_filter, procesado_en=procesado_en)


def calendar(channels: DataFrame, start: date, end: date) -> DataFrame:
    """The channel dimension ``canal, desde, hasta`` (first and last date on the air,
    both inclusive, null: open) as ``canal, fecha`` for dates [start, end]."""
    first = F.greatest(F.coalesce("desde", F.lit(start)), F.lit(start))
    last = F.least(F.coalesce("hasta", F.lit(end)), F.lit(end))
    days = channels.select(S.CANAL, first.alias("_a"), last.alias("_z")).filter("_a <= _z")
    return days.select(S.CANAL, F.explode(F.sequence("_a", "_z")).alias(S.FECHA)).distinct()


def gold_from_counts(
    counts: DataFrame,
    *,
    canales: Sequence[str] | DataFrame | None = None,
    canal_filter: str | None = None,
    procesado_en: datetime | str | None = None,
) -> DataFrame:
    """Gold rows from ``band_counts`` in one linear plan (no second branch, no
    join, nothing cached), on data bounded by dates x (channels + 1):

    1. fold each level's counts into an hour -> counts map (at most 24 entries);
    2. a generator lets each date's band row also emit the rows of the listed
       channels (the report grid; never a cross join);
    3. a window by date hands the band map to every channel row of the date;
    4. one aggregate per (fecha, canal) merges a listed row with the channel's
       own counts (the window's partitioning by date already satisfies it);
    5. ``explode(sequence(0, 23))`` gives the 24 bands.

    Channels listed by a DataFrame join as rows of their date before the window; those of
    dates without data get no band map and fall out.
    """
    listed = None
    table = canales if isinstance(canales, DataFrame) else None
    if table is not None:
        canales = [None]
    elif canales is not None:
        listed = unique(canales)
        if canal_filter is not None:
            listed = [c for c in listed if c == canal_filter]
        if not listed:
            return _empty_gold(counts)

    maps = counts.groupBy(S.FECHA, _BAND, S.CANAL).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(S.FRANJA), F.col(_M)))).alias("horas")
    )
    # One constant array of names, whatever their number: the plan does not grow.
    names = F.from_json(F.lit(json.dumps([None, *(listed or [])])), "array<string>")
    entries = F.when(F.col(_BAND), names).otherwise(F.array(S.CANAL))
    rows = maps.select(S.FECHA, _BAND, "horas", F.posexplode(entries).alias("pos", S.CANAL))
    tipo = F.when(~F.col(_BAND), F.lit("canal")).when(F.col("pos") == 0, F.lit("franja")).otherwise(F.lit("lista"))
    rows = rows.select(S.FECHA, S.CANAL, tipo.alias("tipo"), "horas")
    rows = rows.withColumn("horas", F.when(F.col("tipo") != "lista", F.col("horas")))
    if table is not None:
        none = F.lit(None).cast(rows.schema["horas"].dataType).alias("horas")
        rows = rows.unionAll(table.select(S.FECHA, S.CANAL, F.lit("lista").alias("tipo"), none))
    by_date = Window.partitionBy(S.FECHA)
    rows = rows.withColumn(
        "bandas", F.first(F.when(F.col("tipo") == "franja", F.col("horas")), ignorenulls=True).over(by_date)
    ).filter((F.col("tipo") != "franja") & F.col("bandas").isNotNull())
    keys = rows.groupBy(S.FECHA, S.CANAL).agg(
        F.first(F.when(F.col("tipo") == "canal", F.col("horas")), ignorenulls=True).alias("horas"),
        F.first("bandas").alias("bandas"),
        F.max(F.col("tipo") == ("lista" if canales is not None else "canal")).alias("_en_informe"),
    )
    keys = keys.filter(F.col("_en_informe"))
    if canal_filter is not None:
        keys = keys.filter(F.col(S.CANAL) == F.lit(canal_filter))

    hours = keys.select(
        S.FECHA, S.CANAL, "bandas", "horas", F.explode(F.sequence(F.lit(0), F.lit(S.FRANJAS_POR_DIA - 1))).alias("_h")
    )
    band = F.element_at(F.col("bandas"), F.col("_h").cast("long"))
    ac = F.coalesce(F.element_at(F.col("horas"), F.col("_h").cast("long")).getField("audiencia"), F.lit(0).cast("long"))
    atf = F.coalesce(band.getField("audiencia"), F.lit(0).cast("long"))
    uf = F.coalesce(band.getField("universo"), F.lit(0).cast("long"))
    audit = audit_time(procesado_en)
    return hours.select(
        S.FECHA,
        S.CANAL,
        F.col("_h").cast("long").alias(S.FRANJA),
        ac.alias("audiencia_canal"),
        atf.alias("audiencia_total_franja"),
        uf.alias(S.UNIVERSO),
        rating_pct(ac, uf).alias("rating_pct"),
        share_pct(ac, atf).alias("share_pct"),
        audit.alias(S.PROCESADO_EN),
    )


def _empty_gold(like: DataFrame) -> DataFrame:
    return like.sparkSession.createDataFrame([], S.GOLD)


def metrics_summary(gold: DataFrame) -> DataFrame:
    """A15: ``output_rows`` and the sorted list of channels written."""
    return gold.agg(
        F.count(F.lit(1)).alias("output_rows"), F.sort_array(F.collect_set(S.CANAL)).alias("canales")
    )
