from __future__ import annotations

from datetime import datetime

import pytest

from sintonia.operators import metrics, reports
from tests.helpers import silver_df, two_channel_silver


@pytest.fixture
def gold(spark):
    return metrics.gold_metrics(two_channel_silver(spark), canales=["Canal1", "Canal2"])


def test_rating_share_preset(gold):
    rows = reports.preset(gold, "rating_share").collect()
    assert len(rows) == 48 and rows[0].franja_horaria == 0 and rows[0].canal == "Canal1"
    assert rows[0].__fields__ == ["fecha", "franja_horaria", "canal", "rating_pct", "share_pct"]


def test_resumen_canal(gold):
    rows = reports.preset(gold, "resumen_canal").collect()
    assert [r.canal for r in rows] == ["Canal1", "Canal2"]
    assert rows[0].audiencia_acumulada_dia == 3 and rows[1].audiencia_acumulada_dia == 1
    assert rows[0].share_prom == pytest.approx(round((200 / 3 + 100) / 2, 2))


def test_top_franja_breaks_ties_by_channel(gold):
    rows = {r.franja_horaria: r.canal for r in reports.preset(gold, "top_franja").collect()}
    assert rows[10] == "Canal1" and rows[11] == "Canal1" and len(rows) == 24


def test_cobertura_lists_dark_bands(gold):
    rows = reports.preset(gold, "cobertura").collect()
    assert sorted(r.franja_horaria for r in rows) == [h for h in range(24) if h not in (9, 10)]
    assert all(r.audiencia_total == 0 for r in rows)


def test_share_check_null_for_dark_band(gold):
    rows = {r.franja_horaria: r.suma_share_pct for r in reports.preset(gold, "share_check").collect()}
    assert rows[10] == 100.0 and rows[9] == 100.0 and rows[11] is None


def test_round_half_matches_scaled_double_rounding(spark):
    # 1.005 is stored below 1.005, so two-place rounding gives 1.0
    from pyspark.sql import functions as F

    from sintonia.functions import round2

    got = spark.range(1).select(round2(F.lit(1.005)).alias("a"), round2(F.lit(2.675)).alias("b"), round2(F.lit(0.125)).alias("c")).collect()[0]
    assert (got.a, got.b, got.c) == (1.0, 2.68, 0.13)


def test_free_sql_with_parameters(spark, gold):
    reports.register_gold(gold)
    rows = reports.query(spark, "SELECT canal, MAX(rating_pct) AS m FROM gold WHERE canal = :c GROUP BY canal", {"c": "Canal2"}).collect()
    assert [(r.canal, r.m) for r in rows] == [("Canal2", pytest.approx(0.001))]


def test_catalogue_and_unknown_preset(spark, gold):
    listed = reports.catalogue(spark).collect()
    assert [r.name for r in listed] == sorted(reports.PRESETS)
    with pytest.raises(KeyError):
        reports.preset(gold, "nope")


def test_max_rating_by_channel(spark):
    s = silver_df(spark, [("h1", "A", datetime(2026, 8, 1, 1), 100), ("h2", "A", datetime(2026, 8, 1, 1), 100)])
    g = metrics.gold_metrics(s, canales=["A", "B"])
    got = {r.canal: r.max_rating_pct for r in reports.max_rating_by_channel(g).collect()}
    assert got == {"A": 2.0, "B": 0.0}


def test_channel_list_parsing(spark):
    from pyspark.sql import functions as F

    from sintonia.functions import channel_list, parse_channel_list

    assert parse_channel_list("Canal1, Canal2,, Canal1 ,") == ["Canal1", "Canal2"]
    assert parse_channel_list(None) is None
    got = spark.createDataFrame([("A, B,, A ,",)], "s string").select(channel_list(F.col("s")).alias("c")).collect()[0].c
    assert got == ["A", "B"]


def test_run_report_over_a_written_layer(spark, tmp_path, gold):
    from sintonia.sources import sinks

    root = str(tmp_path / "gold")
    sinks.write_gold(gold, root)
    rows = reports.run_report(spark, root, "2026-08-01", name="resumen_canal").collect()
    assert [r.canal for r in rows] == ["Canal1", "Canal2"]
    one = reports.run_report(spark, root, "2026-08-01", canal="Canal2", sql="SELECT COUNT(*) AS n FROM gold").collect()
    assert one[0].n == 24
    assert reports.run_report(spark, root, "2026-08-02") is None
    assert reports.run_report(spark, str(tmp_path / "missing"), "2026-08-01") is None
