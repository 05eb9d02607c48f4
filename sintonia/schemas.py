"""Column names, layer schemas and rejection reasons.

The column names are a public contract of the data product (Spanish names kept on
purpose): ``canal`` channel, ``id_hogar_panelista`` panel household,
``universo_total`` reference population, ``fecha`` date, ``franja_horaria`` hour
band 0-23, ``procesado_en`` audit time.  Every read uses one of these schemas; no
read infers types (a channel called ``07`` must stay the string ``"07"``).
"""

from __future__ import annotations

from pyspark.sql import types as T

TIMESTAMP = "timestamp"
CANAL = "canal"
HOGAR = "id_hogar_panelista"
UNIVERSO = "universo_total"
FECHA = "fecha"
FECHA_LANDING = "fecha_landing"
FRANJA = "franja_horaria"
PROCESADO_EN = "procesado_en"
REASON = "reason"

# Where a landing line stands: its file, the block of the file a task read, and the
# line's place within that task's input, blank lines counted.  Sorting by these three
# gives the order of input.
ARCHIVO, BLOQUE, LINEA = POSITION = ("archivo", "bloque", "linea")

# Bronze keeps both outcomes of validation, committed by one write.
RESULTADO = "resultado"
ACEPTADO, RECHAZADO = "aceptado", "rechazado"

AUDIT_COLUMNS = (PROCESADO_EN,)
NATURAL_KEY = (HOGAR, CANAL, TIMESTAMP)
FRANJAS_POR_DIA = 24

# Raw fields in the order the validator checks them for presence.
RAW_FIELDS = (TIMESTAMP, CANAL, HOGAR, UNIVERSO)

BRONZE = T.StructType(
    [
        T.StructField(TIMESTAMP, T.TimestampNTZType()),
        T.StructField(CANAL, T.StringType()),
        T.StructField(HOGAR, T.StringType()),
        T.StructField(UNIVERSO, T.LongType()),
        T.StructField(PROCESADO_EN, T.TimestampNTZType()),
        T.StructField(FECHA, T.DateType()),
        T.StructField(FECHA_LANDING, T.DateType()),
    ]
)

SILVER = T.StructType(
    [
        T.StructField(HOGAR, T.StringType()),
        T.StructField(CANAL, T.StringType()),
        T.StructField(TIMESTAMP, T.TimestampNTZType()),
        T.StructField(UNIVERSO, T.LongType()),
        T.StructField(PROCESADO_EN, T.TimestampNTZType()),
        T.StructField(FECHA, T.DateType()),
    ]
)

GOLD = T.StructType(
    [
        T.StructField(FECHA, T.DateType()),
        T.StructField(CANAL, T.StringType()),
        T.StructField(FRANJA, T.LongType()),
        T.StructField("audiencia_canal", T.LongType()),
        T.StructField("audiencia_total_franja", T.LongType()),
        T.StructField(UNIVERSO, T.LongType()),
        T.StructField("rating_pct", T.DoubleType()),
        T.StructField("share_pct", T.DoubleType()),
        T.StructField(PROCESADO_EN, T.TimestampNTZType()),
    ]
)

OUTCOMES = T.StructType([*BRONZE.fields, T.StructField(RESULTADO, T.StringType())])

REJECTS = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField(REASON, T.StringType()),
        T.StructField(ARCHIVO, T.StringType()),
        T.StructField(BLOQUE, T.LongType()),
        T.StructField(LINEA, T.LongType()),
        T.StructField(PROCESADO_EN, T.TimestampNTZType()),
        T.StructField(FECHA, T.DateType()),
        T.StructField(FECHA_LANDING, T.DateType()),
    ]
)

# What each landing folder brought: rows per outcome and date (0: brought by an earlier
# run of the folder, not by the last).
MANIFEST = T.StructType(
    [
        T.StructField(RESULTADO, T.StringType()),
        T.StructField(FECHA, T.DateType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField(FECHA_LANDING, T.DateType()),
    ]
)

# Column order of each layer as stored (partition columns are also data columns).
BRONZE_COLUMNS = [TIMESTAMP, CANAL, HOGAR, UNIVERSO, PROCESADO_EN, FECHA, FECHA_LANDING]
SILVER_COLUMNS = [HOGAR, CANAL, TIMESTAMP, UNIVERSO, PROCESADO_EN, FECHA]
GOLD_COLUMNS = [f.name for f in GOLD.fields]

# A landing folder replaces only the rows it brought, also those of other dates.
BRONZE_PARTITIONS = (FECHA, FECHA_LANDING)
OUTCOME_PARTITIONS = (RESULTADO, FECHA, FECHA_LANDING)
SILVER_PARTITIONS = (FECHA, CANAL)
GOLD_PARTITIONS = (FECHA, CANAL)

# --- Fixed values: rejection reasons (must equal the upstream wording) ----------
REASON_MISSING = "missing required field: {field}"
REASON_CANAL = "canal must be a non-empty string"
REASON_HOGAR = "id_hogar_panelista must be a non-empty string"
REASON_UNIVERSO_INT = "universo_total must be an integer"
REASON_UNIVERSO_POS = "universo_total must be a positive integer"
REASON_TS_PARSE = "timestamp is not a parseable ISO-8601 datetime"
REASON_TS_TYPE = "timestamp must be a datetime or ISO-8601 string"
# --- end of fixed values ---------------------------------------------------------

# Our own reason for a landing line that is not one JSON object (upstream aborts
# the whole batch on such a line; here it is one more rejected row).
REASON_NOT_JSON_OBJECT = "line is not a JSON object"

ALL_REASONS = (
    REASON_NOT_JSON_OBJECT,
    *(REASON_MISSING.format(field=f) for f in RAW_FIELDS),
    REASON_CANAL,
    REASON_HOGAR,
    REASON_UNIVERSO_INT,
    REASON_UNIVERSO_POS,
    REASON_TS_PARSE,
    REASON_TS_TYPE,
)
