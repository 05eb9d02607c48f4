from __future__ import annotations

from datetime import date, datetime

import pytest

from sintonia import schemas as S
from sintonia.operators import metrics
from tests.helpers import by_band, silver_df, two_channel_silver

U = 100_000


@pytest.fixture
def gold(spark):
    return metrics.gold_metrics(two_channel_silver(spark), canales=["Canal1", "Canal2"], procesado_en="2026-08-06 12:00:00")


def test_rating_and_share_for_a_band_with_audience(gold):
    c1, c2 = by_band(gold, "Canal1")[10], by_band(gold, "Canal2")[10]
    assert (c1.audiencia_canal, c1.audiencia_total_franja, c1.universo_total) == (2, 3, U)
    assert c1.rating_pct == pytest.approx(2 * 100 / U) and c1.share_pct == pytest.approx(200 / 3)
    assert (c2.audiencia_canal, c2.rating_pct) == (1, pytest.approx(100 / U))
    assert c2.share_pct == pytest.approx(100 / 3)
    assert c1.share_pct + c2.share_pct == pytest.approx(100.0)


def test_dark_band_has_zero_rating_and_null_share(gold):
    r = by_band(gold, "Canal1")[11]
    assert (r.audiencia_canal, r.audiencia_total_franja, r.rating_pct, r.share_pct) == (0, 0, 0.0, None)


def test_channel_without_audience_in_a_lit_band_has_zero_share(gold):
    r = by_band(gold, "Canal2")[9]
    assert (r.audiencia_canal, r.rating_pct, r.share_pct) == (0, 0.0, 0.0)


def test_all_24_bands_per_channel_and_schema(gold):
    assert sorted(by_band(gold, "Canal1")) == list(range(24))
    assert gold.count() == 48
    assert [f.name for f in gold.schema.fields] == S.GOLD_COLUMNS
    assert {f.name: f.dataType.simpleString() for f in gold.schema.fields}[S.FRANJA] == "bigint"
    assert gold.collect()[0][S.PROCESADO_EN] == datetime(2026, 8, 6, 12)


def test_channel_filter_scopes_rows_not_denominators(spark):
    g = metrics.gold_metrics(two_channel_silver(spark), canales=["Canal1", "Canal2"], canal_filter="Canal1")
    assert {r.canal for r in g.collect()} == {"Canal1"}
    assert by_band(g, "Canal1")[10].audiencia_total_franja == 3


def test_listed_channel_without_events_gets_24_zero_rows(spark):
    g = metrics.gold_metrics(two_channel_silver(spark), canales=["Canal1", "Canal2", "Dark"])
    dark = by_band(g, "Dark")
    assert len(dark) == 24 and all(r.audiencia_canal == 0 and r.rating_pct == 0.0 for r in dark.values())
    assert dark[10].share_pct == 0.0 and dark[11].share_pct is None


def test_unlisted_channel_still_counts_in_denominators(spark):
    g = metrics.gold_metrics(two_channel_silver(spark), canales=["Canal1"])
    assert by_band(g, "Canal1")[10].audiencia_total_franja == 3
    assert g.count() == 24


def test_repeated_channel_names_count_once(spark):
    g = metrics.gold_metrics(two_channel_silver(spark), canales=["Canal1", "Canal1", "Canal2"])
    assert g.count() == 48


def test_default_channels_are_those_present_each_date(spark):
    s = silver_df(spark, [("h1", "A", datetime(2026, 8, 1, 1), 10), ("h1", "B", datetime(2026, 8, 2, 1), 10)])
    g = metrics.gold_metrics(s)
    assert sorted({(str(r.fecha), r.canal) for r in g.collect()}) == [("2026-08-01", "A"), ("2026-08-02", "B")]


def test_household_on_two_channels_counts_once_in_the_band(spark):
    s = silver_df(
        spark,
        [("h1", "A", datetime(2026, 8, 1, 10, 0), 10), ("h1", "B", datetime(2026, 8, 1, 10, 30), 10), ("h2", "A", datetime(2026, 8, 1, 10, 1), 10)],
    )
    g = metrics.gold_metrics(s, canales=["A", "B"])
    a, b = by_band(g, "A")[10], by_band(g, "B")[10]
    assert (a.audiencia_canal, b.audiencia_canal, a.audiencia_total_franja) == (2, 1, 2)
    assert a.share_pct + b.share_pct == pytest.approx(150.0)  # shares may exceed 100


def test_universe_is_band_maximum_over_all_channels(spark):
    s = silver_df(spark, [("h1", "A", datetime(2026, 8, 1, 10), 10), ("h2", "B", datetime(2026, 8, 1, 10, 5), 40)])
    g = metrics.gold_metrics(s, canales=["A"])
    r = by_band(g, "A")[10]
    assert (r.universo_total, r.rating_pct) == (40, pytest.approx(2.5))


def test_empty_silver_gives_no_rows(spark):
    assert metrics.gold_metrics(silver_df(spark, []), canales=["A"]).count() == 0


def test_band_counts_match_distinct_counts(spark):
    import random

    rnd = random.Random(3)
    rows = [
        (f"h{rnd.randrange(30)}", f"C{rnd.randrange(4)}", datetime(2026, 8, 1 + rnd.randrange(2), rnd.randrange(24), rnd.randrange(60)), rnd.choice([5, 7, 9]))
        for _ in range(2000)
    ]
    counts = metrics.band_counts(silver_df(spark, rows))
    band = {(str(r.fecha), r.franja_horaria): r.audiencia_total_franja for r in metrics.band_audience(counts).collect()}
    chan = {(str(r.fecha), r.canal, r.franja_horaria): r.audiencia_canal for r in metrics.channel_audience(counts).collect()}
    uni = {(str(r.fecha), r.franja_horaria): r.universo_total for r in metrics.band_universe(counts).collect()}
    exp_band, exp_chan, exp_uni = {}, {}, {}
    for h, c, t, u in rows:
        k = (str(t.date()), t.hour)
        exp_band.setdefault(k, set()).add(h)
        exp_chan.setdefault((k[0], c, k[1]), set()).add(h)
        exp_uni[k] = max(exp_uni.get(k, 0), u)
    assert band == {k: len(v) for k, v in exp_band.items()}
    assert chan == {k: len(v) for k, v in exp_chan.items()}
    assert uni == exp_uni


def test_channels_on_the_air_by_date(spark):
    d = lambda day: datetime(2027, 3, day, 10)
    silver = silver_df(spark, [("h1", "A", d(1), 10), ("h1", "A", d(2), 10), ("h2", "B", d(2), 10), ("h3", "A", d(4), 10)])
    table = spark.createDataFrame(
        [("A", None, date(2027, 3, 2)), ("A", date(2027, 3, 2), date(2027, 3, 2)), ("B", date(2027, 3, 4), None), ("Z", date(2027, 3, 3), date(2027, 3, 3)), ("Y", date(2027, 3, 9), date(2027, 3, 1))],
        "canal string, desde date, hasta date",
    )
    gold = metrics.gold_metrics(silver, canales=metrics.calendar(table, date(2027, 3, 1), date(2027, 3, 31)))
    rows = {(r.fecha.day, r.canal): r for r in gold.filter("franja_horaria = 10").collect()}
    # B not yet on the air on the 2nd still counts in the denominator; no data on the 3rd
    assert set(rows) == {(1, "A"), (2, "A"), (4, "B")} and gold.count() == 3 * 24
    assert rows[2, "A"].audiencia_total_franja == 2 and rows[4, "B"].audiencia_canal == 0 and rows[4, "B"].audiencia_total_franja == 1
    plan = gold._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    only = metrics.gold_metrics(silver, canales=metrics.calendar(table, date(2027, 3, 1), date(2027, 3, 31)), canal_filter="A")
    assert only.count() == 2 * 24
