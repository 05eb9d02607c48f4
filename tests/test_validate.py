from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sintonia import schemas as S
from sintonia.operators import validate

GOOD = {"timestamp": "2026-08-01T10:00:00", "canal": "Canal1", "id_hogar_panelista": "hogar-0001", "universo_total": 100000}


def _reasons(spark, lines, records):
    j = validate.judge(lines(records))
    return [r[S.REASON] for r in j.select(S.REASON).collect()]


def _with(**kw):
    r = dict(GOOD)
    for k, v in kw.items():
        if v is ...:
            r.pop(k)
        else:
            r[k] = v
    return r


def test_one_bad_field_each_leaves_the_rest_of_the_batch(spark, lines):
    spoiled = [_with(**{f: None}) for f in S.RAW_FIELDS] + [_with(universo_total=-3), _with(canal="\u2003")]
    j = validate.judge(lines([r for bad in spoiled for r in (bad, _with(id_hogar_panelista=f"beside {id(bad)}"))]))
    assert validate.accepted(j).count() == validate.rejected(j).count() == len(spoiled)


def test_every_row_goes_to_exactly_one_outcome(spark, lines):
    records = [_with(timestamp=f"2027-03-{d:02d}T{h:02d}:59:30", canal="x" * (d % 3)) for d in (1, 15, 31) for h in (0, 23)] + ["[]", "nope"]
    j = validate.judge(lines(records)).selectExpr("*", "date'2027-04-01' AS fecha_landing", "'f' AS archivo", "0L AS bloque", "1L AS linea")
    out = validate.outcomes(j).collect()
    assert len(out) == len(records)
    for r in out:
        ok = r.resultado == S.ACEPTADO
        assert ok == (r.reason is None) == (r.value is None) == (r.timestamp is not None)
        # valid rows under their own date, rejects under that of their folder
        assert str(r.fecha) == (str(r.timestamp)[:10] if ok else "2027-04-01")
    assert sum(r.resultado == S.ACEPTADO for r in out) == 4  # the 15th has an empty channel


def test_empty_batch(spark, lines):
    j = validate.judge(spark.createDataFrame([], "value string"))
    assert validate.accepted(j).count() == 0 and validate.rejected(j).count() == 0


@pytest.mark.parametrize(
    "universo, reason, stored",
    [
        (100, None, 100),
        ("1_000", None, 1000),
        (" 100 ", None, 100),
        ("\t7\n", None, 7),
        ("\u00a0100", S.REASON_UNIVERSO_INT, None),
        (True, None, 1),
        (1.5, None, 2),
        (2.5, None, 2),
        (0.6, S.REASON_UNIVERSO_POS, None),
        (-1, S.REASON_UNIVERSO_POS, None),
        (0, S.REASON_UNIVERSO_POS, None),
        (False, S.REASON_UNIVERSO_POS, None),
        ("100.5", S.REASON_UNIVERSO_INT, None),
        ("abc", S.REASON_UNIVERSO_INT, None),
        ([1], S.REASON_UNIVERSO_INT, None),
        ({"a": 1}, S.REASON_UNIVERSO_INT, None),
        (12345678901234567890, S.REASON_UNIVERSO_INT, None),
        ("", "missing required field: universo_total", None),
        (None, "missing required field: universo_total", None),
        (..., "missing required field: universo_total", None),
    ],
)
def test_universe_rules(spark, lines, universo, reason, stored):
    j = validate.judge(lines([_with(universo_total=universo)])).collect()[0]
    assert j[S.REASON] == reason
    if reason is None:
        assert j[S.UNIVERSO] == stored


def test_universe_overflowing_double_is_rejected(spark, lines):
    line = '{"timestamp": "2026-08-01T10:00:00", "canal": "C", "id_hogar_panelista": "h", "universo_total": 1e400}'
    assert _reasons(spark, lines, [line]) == [S.REASON_UNIVERSO_INT]


@pytest.mark.parametrize(
    "ts, reason, expected",
    [
        ("2026-08-01T10:00:00", None, datetime(2026, 8, 1, 10, 0)),
        ("2026-08-01 10:00", None, datetime(2026, 8, 1, 10, 0)),
        ("2026-08-01", None, datetime(2026, 8, 1)),
        ("2026-08-01T10:05Z", None, datetime(2026, 8, 1, 10, 5)),
        ("2026-08-01 10:00:00 +01", None, datetime(2026, 8, 1, 9, 0)),
        ("2026-08-01T10:00:00.1234567", None, datetime(2026, 8, 1, 10, 0, 0, 123456)),
        ("2026-08-01T10", S.REASON_TS_PARSE, None),
        ("2026-08-01T10+02:00", S.REASON_TS_PARSE, None),
        ("2026-08-01T10:00:00,5", S.REASON_TS_PARSE, None),
        ("2026-08-01t10:00:00", S.REASON_TS_PARSE, None),
        ("2026-02-30T10:00", S.REASON_TS_PARSE, None),
        ("2026-08-01T10:00:00.5", None, datetime(2026, 8, 1, 10, 0, 0, 500000)),
        ("2026-08-01T10:00:00+02:00", None, datetime(2026, 8, 1, 8, 0)),
        ("2026-08-01T23:30:00-05:00", None, datetime(2026, 8, 2, 4, 30)),
        ("0000-01-01T00:00:00", S.REASON_TS_PARSE, None),
        ("0001-01-01T00:00:00+05:00", S.REASON_TS_PARSE, None),
        ("10:00", S.REASON_TS_PARSE, None),
        ("2026", S.REASON_TS_PARSE, None),
        ("2026-13-01", S.REASON_TS_PARSE, None),
        ("20260801T1000", S.REASON_TS_PARSE, None),
        ("2026-W31-6", S.REASON_TS_PARSE, None),
        ("not-a-date", S.REASON_TS_PARSE, None),
        (1722506400, S.REASON_TS_TYPE, None),
        (True, S.REASON_TS_TYPE, None),
        ("", "missing required field: timestamp", None),
    ],
)
def test_timestamp_rules(spark, lines, ts, reason, expected):
    j = validate.judge(lines([_with(timestamp=ts)])).collect()[0]
    assert j[S.REASON] == reason
    if reason is None:
        assert j[S.TIMESTAMP] == expected


@pytest.mark.parametrize(
    "field, value, reason",
    [
        ("canal", "   ", S.REASON_CANAL),
        ("canal", " ", S.REASON_CANAL),
        ("canal", " \t", S.REASON_CANAL),
        ("canal", 7, S.REASON_CANAL),
        ("canal", " C ", None),
        ("canal", "07", None),
        ("id_hogar_panelista", " ", S.REASON_HOGAR),
        ("id_hogar_panelista", 12, S.REASON_HOGAR),
        ("id_hogar_panelista", ..., "missing required field: id_hogar_panelista"),
    ],
)
def test_text_field_rules(spark, lines, field, value, reason):
    j = validate.judge(lines([_with(**{field: value})])).collect()[0]
    assert j[S.REASON] == reason
    if reason is None:
        assert j[field] == value  # kept verbatim, not trimmed


def test_first_failing_rule_wins(spark, lines):
    rec = {"timestamp": "bad", "canal": " ", "id_hogar_panelista": "", "universo_total": "x"}
    assert _reasons(spark, lines, [rec]) == ["missing required field: id_hogar_panelista"]
    rec = {"timestamp": "bad", "canal": " ", "id_hogar_panelista": "h", "universo_total": "x"}
    assert _reasons(spark, lines, [rec]) == [S.REASON_CANAL]


@pytest.mark.parametrize("line", ["{bad", "5", "[1]", '"text"', "null"])
def test_lines_that_are_not_json_objects_are_rejected(spark, lines, line):
    assert _reasons(spark, lines, [line]) == [S.REASON_NOT_JSON_OBJECT]


def test_summary_counts_outcomes(spark, lines):
    j = validate.judge(lines([GOOD, GOOD, _with(canal=""), "{bad"]))
    got = {r[S.REASON]: r["n"] for r in validate.ingest_summary(j).collect()}
    assert got == {None: 2, "missing required field: canal": 1, S.REASON_NOT_JSON_OBJECT: 1}


def test_typed_records_validate_through_the_same_path(spark):
    df = spark.createDataFrame(
        [(datetime(2026, 8, 1, 10), "Canal1", "h1", 5), (datetime(2026, 8, 1, 11), "", "h2", 5)],
        "timestamp timestamp_ntz, canal string, id_hogar_panelista string, universo_total long",
    )
    j = validate.judge(validate.records_to_lines(df))
    assert sorted((r[S.REASON] or "") for r in j.collect()) == ["", "missing required field: canal"]
    assert validate.accepted(j).select(F.col(S.TIMESTAMP)).collect()[0][0] == datetime(2026, 8, 1, 10)


def test_repeated_key_keeps_the_last_value(spark, lines):
    line = '{"timestamp": "2026-08-01T10:00:00", "canal": "", "canal": "C2", "id_hogar_panelista": "h", "universo_total": 5}'
    r = validate.judge(lines([line])).collect()[0]
    assert r[S.REASON] is None and r[S.CANAL] == "C2"


@pytest.mark.parametrize("word", ["NaN", "Infinity", "-Infinity"])
def test_number_words_as_universe_are_no_integers(spark, lines, word):
    text = json.dumps({**GOOD, S.UNIVERSO: 7}).replace("7}", word + "}")
    row = validate.judge(lines([text])).collect()[0]
    assert word in text and row[S.REASON] == S.REASON_UNIVERSO_INT
    # elsewhere they leave a line that is not JSON
    other = json.dumps({**GOOD, S.CANAL: 7}).replace("7,", word + ",", 1)
    assert validate.judge(lines([other])).collect()[0][S.REASON] == S.REASON_NOT_JSON_OBJECT
