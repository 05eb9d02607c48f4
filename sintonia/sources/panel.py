"""Adapters from the supplied ``events`` table to panel-event shapes.

``events(event_id, ts, user_id, event_type, value, props)`` becomes tuning events:
the event type is the channel, the user is the household, the event time (to the
minute) is the tuning minute.  Every adapter keeps every input row; the dirty and
nullable variants only rewrite some values (chosen by ``event_id``) so that the
validation, null and de-duplication rules see real work at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sintonia import schemas as S

EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").select(*EVENT_COLUMNS)


def _panel_columns(events: DataFrame) -> list[Column]:
    user = F.col("user_id")
    return [
        F.col("event_id"),
        F.date_trunc("minute", F.col("ts")).cast("timestamp_ntz").alias(S.TIMESTAMP),
        F.concat(F.lit("Canal_"), F.col("event_type")).alias(S.CANAL),
        F.concat(F.lit("hogar-"), F.when(user < 1_000_000, F.lpad(user.cast("string"), 6, "0")).otherwise(user.cast("string"))).alias(S.HOGAR),
        (F.lit(100000) + (F.col("event_id") % 7) * 1000).cast("long").alias(S.UNIVERSO),
    ]


def clean_panel(events: DataFrame) -> DataFrame:
    """Typed panel rows: ``event_id, timestamp, canal, id_hogar_panelista, universo_total``."""
    return events.select(*_panel_columns(events))


def sparse_panel(events: DataFrame) -> DataFrame:
    """Clean panel with hours 2 and 3 moved two hours later, so every date has two
    dark bands while no row is lost."""
    p = clean_panel(events)
    shifted = F.when(
        F.hour(S.TIMESTAMP).isin(2, 3), F.col(S.TIMESTAMP) + F.expr("INTERVAL 2 HOURS")
    ).otherwise(F.col(S.TIMESTAMP))
    return p.withColumn(S.TIMESTAMP, shifted)


def nullable_panel(events: DataFrame) -> DataFrame:
    """Clean panel with NULL channels (``event_id % 53 = 0``) and NULL universes
    (``event_id % 59 = 0``): bronze-shaped input for the silver not-null rule."""
    p = clean_panel(events)
    eid = F.col("event_id")
    return p.select(
        "event_id",
        S.TIMESTAMP,
        F.when(eid % 53 != 0, F.col(S.CANAL)).alias(S.CANAL),
        S.HOGAR,
        F.when(eid % 59 != 0, F.col(S.UNIVERSO)).alias(S.UNIVERSO),
    )


def as_bronze(panel: DataFrame) -> DataFrame:
    """Typed panel rows in the bronze schema (no audit time)."""
    return panel.select(
        S.TIMESTAMP,
        S.CANAL,
        S.HOGAR,
        S.UNIVERSO,
        F.lit(None).cast("timestamp_ntz").alias(S.PROCESADO_EN),
        F.col(S.TIMESTAMP).cast("date").alias(S.FECHA),
    )


_ISO = "yyyy-MM-dd'T'HH:mm:ss"


def dirty_lines(events: DataFrame) -> DataFrame:
    """Landing-shaped JSON lines (``value``) with their landing date (``fecha``, the
    event's own), their order (``orden``) and every class of invalid record mixed in.

    By ``event_id``: ``% 97`` = 0 / 1 / 2: timestamp null / ``"not-a-date"`` / a number;
    ``% 41`` = 0: timestamp with offset -05:00; ``% 89`` = 0 / 1: channel of blanks /
    null; ``% 83`` = 0 / 1: empty household / household of blanks; ``% 79`` = 0 to 5:
    universe ``"0"`` / ``"abc"`` / null / 1.5 / true / 0.5; ``% 73`` = 0: the line is cut
    before its end.  Rows with ``event_id % 50 = 0`` also get a clean copy whose
    universe (as JSON text) is 500 higher: a conflicting duplicate for silver.  Keys
    are written sorted, as the landing writer does.
    """
    p = clean_panel(events)
    eid = F.col("event_id")
    quoted = lambda text: F.concat(F.lit('"'), text, F.lit('"'))
    # the two fields whose JSON type varies are written as JSON text
    stamp, clean_universe = quoted(F.date_format(S.TIMESTAMP, _ISO)), F.col(S.UNIVERSO).cast("string")
    dirty = F.struct(
        F.when(eid % 89 == 0, F.lit("   ")).when(eid % 89 == 1, F.lit(None)).otherwise(F.col(S.CANAL)).alias(S.CANAL),
        F.when(eid % 83 == 0, F.lit("")).when(eid % 83 == 1, F.lit(" \t")).otherwise(F.col(S.HOGAR)).alias(S.HOGAR),
        F.when(eid % 97 == 0, F.lit("null"))
        .when(eid % 97 == 1, F.lit('"not-a-date"'))
        .when(eid % 97 == 2, F.lit("20240101"))
        .when(eid % 41 == 0, F.concat(F.substring(stamp, 1, 20), F.lit('-05:00"')))
        .otherwise(stamp)
        .alias(S.TIMESTAMP),
        F.when(eid % 79 == 0, F.lit('"0"'))
        .when(eid % 79 == 1, F.lit('"abc"'))
        .when(eid % 79 == 2, F.lit("null"))
        .when(eid % 79 == 3, F.lit("1.5"))
        .when(eid % 79 == 4, F.lit("true"))
        .when(eid % 79 == 5, F.lit("0.5"))
        .otherwise(clean_universe)
        .alias(S.UNIVERSO),
        (eid % 73 == 0).alias("cut"),
        (eid * 2).alias("orden"),
    )
    copy = F.struct(
        F.col(S.CANAL).alias(S.CANAL),
        F.col(S.HOGAR).alias(S.HOGAR),
        stamp.alias(S.TIMESTAMP),
        quoted((F.col(S.UNIVERSO) + 500).cast("string")).alias(S.UNIVERSO),
        F.lit(False).alias("cut"),
        (eid * 2 + 1).alias("orden"),
    )
    # one pass over the events: each yields its (possibly dirty) record, plus the
    # conflicting copy when chosen
    records = F.when(eid % 50 == 0, F.array(dirty, copy)).otherwise(F.array(dirty))
    rows = p.select(F.col(S.TIMESTAMP).cast("date").alias(S.FECHA), F.inline(records))
    texts = F.to_json(F.struct(F.col(S.CANAL), F.col(S.HOGAR)), {"ignoreNullFields": "false"})
    line = F.concat(
        F.rtrim(texts, F.lit("}")),
        F.lit(f',"{S.TIMESTAMP}":'), F.col(S.TIMESTAMP), F.lit(f',"{S.UNIVERSO}":'), F.col(S.UNIVERSO), F.lit("}"),
    )
    return rows.select(F.when(F.col("cut"), F.substring(line, 1, 20)).otherwise(line).alias("value"), S.FECHA, "orden")
