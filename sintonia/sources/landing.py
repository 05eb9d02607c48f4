"""Landing zone: JSON lines under ``<root>/fecha=YYYY-MM-DD/``.

``landing_scan`` reads the lines as text (no schema inference, no second scan);
validation parses each line once (``operators.validate.judge``).  ``export_landing``
writes events back as JSON lines with sorted keys, one folder per date.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sintonia import schemas as S
from sintonia.functions.columns import is_blank
from sintonia.sources.storage import date_folders, path_exists

LANDING_DATE = S.FECHA_LANDING
_LANDING_SCHEMA = T.StructType([T.StructField("value", T.StringType()), T.StructField(S.FECHA, T.DateType())])
_SCANNED = f"value string, {S.ARCHIVO} string, {S.BLOQUE} long, {S.LINEA} long, {LANDING_DATE} date"


def landing_scan(
    spark: SparkSession,
    root: str,
    start: date | str | None = None,
    end: date | str | None = None,
    *,
    fail_if_missing: bool = False,
) -> DataFrame:
    """Non-blank lines of the landing folders in [start, end] (``end`` defaults to
    ``start``) as ``value``, their position (``schemas.POSITION``) and the folder's date
    as ``fecha_landing``.  Only the folders in range are given to the reader, so no other is listed; a missing root
    (or range) is an empty input unless ``fail_if_missing``.  No shuffle follows the
    scan: its splits decide the parallelism."""
    folders = [path for _, path in date_folders(spark, root, start, end)]
    if not folders:
        if fail_if_missing and not path_exists(spark, root):
            raise FileNotFoundError(root)
        return spark.createDataFrame([], _SCANNED)
    lines = spark.read.schema(_LANDING_SCHEMA).option("basePath", root).text(folders)
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias(S.ARCHIVO),
        F.col("_metadata.file_block_start").alias(S.BLOQUE),
        # the lower 33 bits count the rows of a task
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias(S.LINEA),
        F.col(S.FECHA).alias(LANDING_DATE),
    ).filter(~is_blank("value"))


def iso_text(ts: str | Column) -> Column:
    """ISO-8601 text of a TIMESTAMP_NTZ: seconds always, microseconds only when
    not zero (the form of Python's ``isoformat``)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    base = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(c, "SSSSSS")
    return F.when(micros == F.lit("000000"), base).otherwise(F.concat(base, F.lit("."), micros))


def export_landing(events: DataFrame, root: str) -> None:
    """Write raw events (``timestamp`` NTZ, ``canal``, ``id_hogar_panelista``,
    ``universo_total``) as JSON lines with sorted keys under ``fecha=`` folders,
    replacing only the dates present."""
    fields = sorted([S.CANAL, S.HOGAR, S.TIMESTAMP, S.UNIVERSO])
    cols = [iso_text(S.TIMESTAMP).alias(S.TIMESTAMP) if f == S.TIMESTAMP else F.col(f) for f in fields]
    export_lines(events.select(F.col(S.TIMESTAMP).cast("date").alias(S.FECHA), F.to_json(F.struct(*cols)).alias("value")), root)


def export_lines(lines: DataFrame, root: str) -> None:
    """Write ready lines (``value``, ``fecha``) into their landing folders, replacing
    only the dates present."""
    (
        lines.select(S.FECHA, "value")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(S.FECHA)
        .text(root)
    )
