from __future__ import annotations

import dataclasses
from datetime import date, datetime

from pyspark.sql import functions as F

from sintonia import schemas as S
from sintonia.operators import audit, bitmaps, clean, metrics
from sintonia.plans import runner
from sintonia.sources import layers, sinks
from tests.helpers import SILVER_DDL, silver_df

D = lambda day, h, m=0: datetime(2027, 3, day, h, m)


def _counts(df):
    return {(r.fecha, r.franja_horaria, r.es_franja, r.canal): (r.m.audiencia, r.m.universo) for r in df.collect()}


def _silver(spark, n=400):
    rows = [(f"h{i % 97}", f"C{i % 4}", D(1 + i % 3, i % 24, i % 60), 10 + i % 7) for i in range(n)]
    return silver_df(spark, sorted(set(rows)))


def test_counts_equal_those_from_silver(spark, tmp_path):
    silver = _silver(spark)
    bitmaps.refresh(spark, silver, str(tmp_path))
    stored = bitmaps.read_bitmaps(spark, str(tmp_path))
    assert _counts(bitmaps.counts(stored)) == _counts(metrics.band_counts(silver))
    plan = bitmaps.counts(stored)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan


def test_numbers_are_dense_unique_and_never_change(spark, tmp_path):
    root = str(tmp_path)
    home = lambda a, b: spark.range(a, b).select(F.concat(F.lit("h"), "id").alias(S.HOGAR))
    rows = lambda a, b: home(a, b).selectExpr("id_hogar_panelista", "'C' AS canal", "TIMESTAMP_NTZ'2027-03-01 10:00:00' AS timestamp", "5L AS universo_total")
    bitmaps.refresh(spark, rows(0, 50_000), root)
    first = {r[S.HOGAR]: r.numero for r in bitmaps.read_dictionary(spark, root).collect()}
    assert len(first) == len(set(first.values())) == 50_000 and min(first.values()) >= 1
    assert max(first.values()) < 2 * 50_000  # a class is at most somewhat fuller than another
    bitmaps.refresh(spark, rows(20_000, 80_000), root)
    second = {r[S.HOGAR]: r.numero for r in bitmaps.read_dictionary(spark, root).collect()}
    assert len(second) == len(set(second.values())) == 80_000
    assert all(second[h] == n for h, n in first.items())
    # several bitmaps a band; the second delivery replaced the channel's partition
    stored = bitmaps.read_bitmaps(spark, root)
    assert stored.count() > 1 and _counts(bitmaps.counts(stored))[date(2027, 3, 1), 10, True, None] == (60_000, 5)


def test_rerun_of_a_channel_reads_only_its_silver(spark, tmp_path):
    silver_root, root = str(tmp_path / "silver"), str(tmp_path / "maps")
    as_bronze = lambda df: df.select(S.TIMESTAMP, S.CANAL, S.HOGAR, S.UNIVERSO)
    silver = _silver(spark)
    sinks.write_silver(clean.clean(as_bronze(silver), cluster_for_write=True), silver_root)
    bitmaps.refresh(spark, layers.read_silver(spark, silver_root), root)
    changed = silver_df(spark, [("new", "C1", D(1, 5), 99), ("h1", "C1", D(2, 5), 1), ("h2", "C1", D(3, 5), 1)])
    sinks.write_silver(clean.clean(as_bronze(changed), cluster_for_write=True), silver_root)
    only = layers.read_silver(spark, silver_root, canal="C1")
    plan = bitmaps.band_bitmaps(only, bitmaps.read_dictionary(spark, root))._jdf.queryExecution().executedPlan().toString()
    assert "(canal" in plan.split("PartitionFilters: ")[1].split("]")[0]
    bitmaps.refresh(spark, only, root)
    whole = layers.read_silver(spark, silver_root)
    assert whole.filter("canal = 'C1'").count() == 3
    assert _counts(bitmaps.counts(bitmaps.read_bitmaps(spark, root))) == _counts(metrics.band_counts(whole))


def test_pipeline_with_bitmaps_equals_without(spark, tmp_path):
    silver_root = str(tmp_path / "silver")
    rows = _silver(spark).select(S.TIMESTAMP, S.CANAL, S.HOGAR, S.UNIVERSO)
    sinks.write_silver(clean.clean(rows, cluster_for_write=True), silver_root)
    cfg = runner.PipelineConfig(
        landing_root=str(tmp_path / "raw"), bronze_root=str(tmp_path / "bronze"), silver_root=silver_root, gold_root=str(tmp_path / "a"),
        start=date(2027, 3, 1), end=date(2027, 3, 3), procesado_en=datetime(2027, 4, 1), canales=["C0", "C1", "Z"], start_stage="gold",
    )
    with_maps = dataclasses.replace(cfg, gold_root=str(tmp_path / "b"), bitmap_root=str(tmp_path / "maps"))
    assert runner.run_pipeline(spark, cfg).gold == runner.run_pipeline(spark, with_maps).gold
    digest = lambda c: audit.layer_digest(layers.read_gold(spark, c.gold_root)).collect()
    assert digest(cfg) == digest(with_maps)
    # one channel again: its rows come from the other channels' stored bitmaps
    for c in (cfg, with_maps):
        runner.run_pipeline(spark, dataclasses.replace(c, canal="C1"))
    assert digest(cfg) == digest(with_maps)


def test_empty_silver(spark, tmp_path):
    bitmaps.refresh(spark, spark.createDataFrame([], SILVER_DDL), str(tmp_path))
    assert bitmaps.read_bitmaps(spark, str(tmp_path)).count() == 0 and bitmaps.read_dictionary(spark, str(tmp_path)).count() == 0
