"""Bronze: record validation and the accept/reject split.

A raw record is one JSON object.  It is parsed once into a ``VARIANT`` (which keeps
the JSON types: a universe of ``true`` or ``1.5`` must be told apart from ``"1.5"``)
and every rule becomes a Column expression; the first failing rule names the
reason.  Nothing here shuffles: validation is a narrow map over the landing files.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sintonia import schemas as S
from sintonia.functions.columns import (
    audit_time,
    INTEGER_EDGE_WS_PATTERN,
    INTEGER_TEXT_PATTERN,
    iso_utc,
    is_blank,
)

_INTEGER_KINDS = ("TINYINT", "SMALLINT", "INT", "BIGINT")
_LONG_LIMIT = 9.2233720368547758e18


_BARE_NUMBER_WORD = rf'("{S.UNIVERSO}"\s*:\s*)(NaN|-?Infinity)\b'
_RAW_STRUCT = "struct<" + ", ".join(f"{f}: variant" for f in S.RAW_FIELDS) + ">"


def _kind(sub: Column) -> Column:
    return F.schema_of_variant(sub)


def _text(sub: Column) -> Column:
    return F.try_variant_get(sub, "$", "string")


def _missing(kind: Column, text: Column) -> Column:
    """Absent key or JSON null (no kind / VOID) or the empty string."""
    return kind.isNull() | (kind == "VOID") | ((kind == "STRING") & (text == F.lit("")))


def _nonblank_string(kind: Column, text: Column) -> Column:
    return (kind == "STRING") & ~is_blank(text)


def universe_parts(kind: Column, text: Column) -> tuple[Column, Column]:
    """The universe from its JSON type and text: its exact BIGINT value, or the DOUBLE
    of a fractional number; both NULL when it is not an integer.  Values beyond BIGINT
    are not integers here (they cannot be stored)."""
    as_double = text.try_cast("double")
    fractional = kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")
    digits = F.regexp_replace(F.regexp_replace(text, INTEGER_EDGE_WS_PATTERN, ""), "_", "")
    exact = (
        F.when(kind.isin(*_INTEGER_KINDS), text.try_cast("long"))
        .when(kind == "BOOLEAN", (text == F.lit("true")).cast("long"))
        .when((kind == "STRING") & text.rlike(INTEGER_TEXT_PATTERN), digits.try_cast("long"))
    )
    return exact, F.when(fractional & (F.abs(as_double) < F.lit(_LONG_LIMIT)), as_double)


def judge(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Add ``reason`` (NULL when the record is valid) and the typed bronze columns.

    ``raw`` holds one JSON text per row in ``value_col`` (the landing scan or any
    DataFrame of lines).  Rules, first failure wins: JSON object; required fields
    present (timestamp, canal, household, universe); canal and household non-blank
    strings (kept verbatim, not trimmed); universe an integer, then positive;
    timestamp an ISO-8601 text.

    Variant work is kept to one parse, one extraction of the four fields and, per
    field, its JSON type and its text; all rules then run on plain strings.
    """
    keep = [F.col(c) for c in raw.columns]
    # NaN and Infinity are no JSON, but writers emit them: as a universe they are text
    # that is no integer.  Only a line that does not parse is looked at again.
    line = F.col(value_col)
    mended = F.regexp_replace(line, _BARE_NUMBER_WORD, '$1"$2"')
    parsed = raw.select(*keep, F.coalesce(F.try_parse_json(line), F.try_parse_json(mended)).alias("_v"))
    # Only a JSON object extracts to the struct (absent keys become NULL fields),
    # so a NULL struct marks a line that is not an object.
    fields = parsed.select(*keep, F.try_variant_get(F.col("_v"), "$", _RAW_STRUCT).alias("_r"))
    # The (type, text) pairs come out of a one-row generator: a filter on the
    # verdict (``accepted``) is then evaluated on plain strings and never pushed
    # below this point, so the variant work stays once per row.
    pairs = F.struct(
        F.col("_r").isNotNull().alias("_obj"),
        *[
            c
            for i, f in enumerate(S.RAW_FIELDS)
            for c in (
                _kind(F.col("_r").getField(f)).alias(f"_k{i}"),
                _text(F.col("_r").getField(f)).alias(f"_t{i}"),
            )
        ],
    )
    typed = fields.select(*keep, F.inline(F.array(pairs)))
    (kt, tt), (kc, tc), (kh, th), (ku, tu) = ((F.col(f"_k{i}"), F.col(f"_t{i}")) for i in range(4))
    # Likewise the values that both the verdict and the row need: parsed once.
    exact, fraction = universe_parts(ku, tu)
    ts = F.when(kt == "STRING", iso_utc(tt))
    typed = typed.select("*", F.inline(F.array(F.struct(exact.alias("_u"), fraction.alias("_f"), ts.alias("_ts")))))
    ts_value = F.col("_ts")
    # the check truncates (``int(1.9) == 1``); the store rounds half to even, like a
    # double-to-bigint SQL cast
    checked_u = F.coalesce(F.col("_u"), F.col("_f").try_cast("long"))
    stored_u = F.coalesce(F.col("_u"), F.rint("_f").try_cast("long"))
    reason = F.when(~F.col("_obj"), F.lit(S.REASON_NOT_JSON_OBJECT))
    for name, (k, t) in zip(S.RAW_FIELDS, ((kt, tt), (kc, tc), (kh, th), (ku, tu))):
        reason = reason.when(_missing(k, t), F.lit(S.REASON_MISSING.format(field=name)))
    reason = (
        reason.when(~_nonblank_string(kc, tc), F.lit(S.REASON_CANAL))
        .when(~_nonblank_string(kh, th), F.lit(S.REASON_HOGAR))
        .when(checked_u.isNull(), F.lit(S.REASON_UNIVERSO_INT))
        .when(checked_u <= 0, F.lit(S.REASON_UNIVERSO_POS))
        .when(kt != "STRING", F.lit(S.REASON_TS_TYPE))
        .when(ts_value.isNull(), F.lit(S.REASON_TS_PARSE))
    )
    return typed.select(
        *keep,
        reason.alias(S.REASON),
        ts_value.alias(S.TIMESTAMP),
        tc.alias(S.CANAL),
        th.alias(S.HOGAR),
        stored_u.alias(S.UNIVERSO),
        ts_value.cast("date").alias(S.FECHA),
    )


def accepted(judged: DataFrame, procesado_en: datetime | str | None = None) -> DataFrame:
    """Valid rows in the bronze schema; ``procesado_en`` is the caller's run time.
    Lines without a landing folder count as landed on their own date."""
    audit = audit_time(procesado_en)
    landed = F.col(S.FECHA_LANDING) if S.FECHA_LANDING in judged.columns else F.col(S.FECHA)
    return judged.filter(F.col(S.REASON).isNull()).select(
        S.TIMESTAMP, S.CANAL, S.HOGAR, S.UNIVERSO, audit.alias(S.PROCESADO_EN), S.FECHA, landed.alias(S.FECHA_LANDING)
    )


def rejected(judged: DataFrame, value_col: str = "value") -> DataFrame:
    """Quarantine: the raw text of every invalid record, its reason and, for lines of a
    landing scan, its position."""
    position = [c for c in S.POSITION if c in judged.columns]
    return judged.filter(F.col(S.REASON).isNotNull()).select(value_col, S.REASON, *position)


def in_input_order(rejects: DataFrame) -> DataFrame:
    """Rejects in the order of their lines, landing folder by landing folder."""
    return rejects.orderBy(F.col(S.FECHA_LANDING), *S.POSITION)


def outcomes(judged: DataFrame, procesado_en: datetime | str | None = None) -> DataFrame:
    """Every line of a landing scan for one write of both outcomes (``resultado``): valid
    rows with the bronze columns, under their own date; invalid ones with their text,
    reason and position, under the landing date."""
    ok = F.col(S.REASON).isNull()
    return judged.select(
        *[F.when(ok, F.col(c)).alias(c) for c in (S.TIMESTAMP, S.CANAL, S.HOGAR, S.UNIVERSO)],
        *[F.when(~ok, F.col(c)).alias(c) for c in ("value", S.REASON, *S.POSITION)],
        audit_time(procesado_en).alias(S.PROCESADO_EN),
        F.when(ok, F.lit(S.ACEPTADO)).otherwise(F.lit(S.RECHAZADO)).alias(S.RESULTADO),
        F.when(ok, F.col(S.FECHA)).otherwise(F.col(S.FECHA_LANDING)).alias(S.FECHA),
        S.FECHA_LANDING,
    )


def ingest_summary(judged: DataFrame) -> DataFrame:
    """One row per outcome: ``reason`` (NULL = accepted) and its count.  A tiny
    aggregate (partial counts per task, one small shuffle)."""
    return judged.groupBy(S.REASON).agg(F.count(F.lit(1)).alias("n"))


def records_to_lines(records: DataFrame) -> DataFrame:
    """Typed in-memory records (any subset of the raw fields) -> JSON lines, so the
    same validator serves API input and landing files."""
    return records.select(F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"}).alias("value"))
