from __future__ import annotations

import dataclasses
import json
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sintonia import schemas as S
from sintonia.operators import audit, metrics, validate
from sintonia.plans.runner import (
    PipelineConfig,
    affected_dates,
    layer_summary,
    out_of_range,
    rejects,
    run_bronze,
    run_pipeline,
    run_summary,
)
from sintonia.sources import landing, layers, sinks
from tests.helpers import silver_df, two_channel_silver


def _files(root: Path, pattern: str = "*.parquet") -> list[Path]:
    return sorted(root.rglob(pattern))


def test_gold_write_layout_one_file_per_partition(spark, tmp_path):
    g = metrics.gold_metrics(two_channel_silver(spark), canales=["Canal1", "Canal2"])
    sinks.write_gold(g, str(tmp_path / "gold"))
    assert (tmp_path / "gold" / "fecha=2026-08-01" / "canal=Canal1").is_dir()
    inv = {(r.canal, r.n_files, r.n_rows) for r in audit.inventory(spark, str(tmp_path / "gold"), S.GOLD).collect()}
    assert inv == {("Canal1", 1, 24), ("Canal2", 1, 24)}
    back = layers.read_gold(spark, str(tmp_path / "gold"))
    assert back.columns == S.GOLD_COLUMNS and back.count() == 48


def test_rewrite_replaces_only_present_partitions_and_exact_channel(spark, tmp_path):
    root = str(tmp_path / "gold")
    d = datetime(2026, 8, 1, 10)
    s = silver_df(spark, [("h1", "Canal1", d, 10), ("h2", "Canal10", d, 10)])
    sinks.write_gold(metrics.gold_metrics(s, canales=["Canal1", "Canal10"]), root)
    before = {(r.canal, r.n_rows) for r in audit.inventory(spark, root, S.GOLD).collect()}
    # reprocess Canal1 only: Canal10 must survive (no prefix match)
    s2 = silver_df(spark, [("h1", "Canal1", d, 10), ("h3", "Canal1", d, 10), ("h2", "Canal10", d, 10)])
    sinks.write_gold(metrics.gold_metrics(s2, canales=["Canal1", "Canal10"], canal_filter="Canal1"), root)
    after = {r.canal: r.n_files for r in audit.inventory(spark, root, S.GOLD).collect()}
    assert before == {("Canal1", 24), ("Canal10", 24)} and after == {"Canal1": 1, "Canal10": 1}
    c1 = layers.read_gold(spark, root, canal="Canal1").filter("franja_horaria = 10").collect()[0]
    assert c1.audiencia_canal == 2
    # an empty frame replaces nothing
    sinks.write_gold(spark.createDataFrame([], S.GOLD), root)
    assert layers.read_gold(spark, root).count() == 48


def test_partition_values_keep_their_text(spark, tmp_path):
    root = str(tmp_path / "silver")
    s = silver_df(spark, [("h1", "07", datetime(2026, 8, 1, 10), 10)])
    from sintonia.operators import clean

    bronze = s.select(S.TIMESTAMP, S.CANAL, S.HOGAR, S.UNIVERSO)
    sinks.write_silver(clean.clean(bronze, cluster_for_write=True), root)
    assert [r.canal for r in layers.read_silver(spark, root).collect()] == ["07"]


def test_missing_layer_is_empty_or_fails_on_request(spark, tmp_path):
    assert layers.read_gold(spark, str(tmp_path / "nope")).count() == 0
    with pytest.raises(FileNotFoundError):
        layers.read_gold(spark, str(tmp_path / "nope"), fail_if_missing=True)


def test_range_and_channel_become_partition_filters(spark, tmp_path):
    root = str(tmp_path / "gold")
    s = silver_df(spark, [("h1", "A", datetime(2026, 8, d, 10), 10) for d in (1, 2, 3)])
    sinks.write_gold(metrics.gold_metrics(s, canales=["A", "B"]), root)
    df = layers.read_gold(spark, root, start="2026-08-02", end="2026-08-03", canal="A")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "canal" in plan.split("PartitionFilters")[1]
    assert sorted({str(r.fecha) for r in df.collect()}) == ["2026-08-02", "2026-08-03"]
    assert df.count() == 48


def test_digests_ignore_audit_column_and_order_but_see_nulls(spark):
    a = spark.createDataFrame([("x", None, 1), (None, "x", 2)], "fecha string, canal string, procesado_en int")
    b = spark.createDataFrame([(None, "x", 9), ("x", None, 8)], "fecha string, canal string, procesado_en int")
    c = spark.createDataFrame([("x", None, 1), ("x", None, 2)], "fecha string, canal string, procesado_en int")
    da, db, dc = (audit.layer_digest(d).collect()[0] for d in (a, b, c))
    assert da == db and da.digest != dc.digest
    with pytest.raises(ValueError):
        audit.content_columns(a.select("procesado_en"))


def test_compare_reports_changed_and_missing_partitions(spark):
    g1 = metrics.gold_metrics(two_channel_silver(spark), canales=["Canal1", "Canal2"])
    g2 = metrics.gold_metrics(two_channel_silver(spark, universo=200_000), canales=["Canal1"])
    d1, d1b, d2 = (audit.partition_digests(g) for g in (g1, g1, g2))
    assert audit.differences(d1, d1b).count() == 0
    diff = {r.canal: (r.digest_a is not None, r.digest_b is not None) for r in audit.differences(d1, d2).collect()}
    assert diff == {"Canal1": (True, True), "Canal2": (True, False)}


def _write_landing(spark, root, events):
    lines = validate.records_to_lines(
        spark.createDataFrame(events, "timestamp timestamp_ntz, canal string, id_hogar_panelista string, universo_total long")
    )
    j = validate.judge(lines)
    landing.export_landing(validate.accepted(j), root)


def test_landing_export_and_scan_roundtrip(spark, tmp_path):
    root = str(tmp_path / "raw")
    ev = [(datetime(2026, 8, 1, 10, 0), "C1", "h1", 5), (datetime(2026, 8, 2, 0, 1, 0, 250000), "C2", "h2", 6)]
    _write_landing(spark, root, ev)
    files = _files(tmp_path / "raw", "*.txt")
    first = json.loads(next(iter(open(files[0]))))
    assert list(first) == sorted(first) and first["timestamp"] == "2026-08-01T10:00:00"
    scanned = landing.landing_scan(spark, root, date(2026, 8, 2))
    acc = validate.accepted(validate.judge(scanned)).collect()
    assert [(r.timestamp, r.canal) for r in acc] == [(datetime(2026, 8, 2, 0, 1, 0, 250000), "C2")]
    assert landing.landing_scan(spark, str(tmp_path / "none")).count() == 0


def _cfg(tmp_path, **kw):
    base = dict(
        landing_root=str(tmp_path / "raw"),
        bronze_root=str(tmp_path / "bronze"),
        silver_root=str(tmp_path / "silver"),
        gold_root=str(tmp_path / "gold"),
        start=date(2026, 8, 1),
        procesado_en=datetime(2026, 8, 6, 12),
        canales=["C1", "C2", "C3"],
    )
    base.update(kw)
    return PipelineConfig(**base)


def _layer_state(spark, cfg):
    out = {}
    for name, root, schema, parts in (
        ("bronze", layers.outcome_root(cfg.bronze_root, S.ACEPTADO), S.BRONZE, S.BRONZE_PARTITIONS),
        ("silver", cfg.silver_root, S.SILVER, S.SILVER_PARTITIONS),
        ("gold", cfg.gold_root, S.GOLD, S.GOLD_PARTITIONS),
    ):
        df = layers.read_layer(spark, root, schema)
        out[name] = (audit.layer_digest(df).collect()[0].digest, df.count())
    return out


def _landing_events():
    return [
        (datetime(2026, 8, 1, 10, 0), "C1", "h1", 100_000),
        (datetime(2026, 8, 1, 10, 0), "C1", "h1", 150_000),
        (datetime(2026, 8, 1, 10, 5), "C2", "h2", 100_000),
        (datetime(2026, 8, 1, 11, 0), "C1", "h3", 100_000),
    ]


def test_pipeline_runs_reruns_and_resumes(spark, tmp_path):
    _write_landing(spark, str(tmp_path / "raw"), _landing_events())
    cfg = _cfg(tmp_path)
    r1 = run_pipeline(spark, cfg)
    assert r1.bronze["accepted"] == 4 and r1.silver["output_rows"] == 3 and r1.gold["output_rows"] == 72
    assert r1.silver["n_canales"] == 2 and r1.gold["n_canales"] == 3
    s1 = _layer_state(spark, cfg)
    r2 = run_pipeline(spark, cfg)
    assert _layer_state(spark, cfg) == s1 and r2.gold == r1.gold
    files_before = len(_files(tmp_path / "gold"))
    r3 = run_pipeline(spark, dataclasses.replace(cfg, start_stage="gold"))
    assert r3.bronze == {} and r3.silver == {} and len(_files(tmp_path / "gold")) == files_before
    assert _layer_state(spark, cfg) == s1
    winner = layers.read_silver(spark, cfg.silver_root).filter("id_hogar_panelista = 'h1'").collect()
    assert [r.universo_total for r in winner] == [150_000]


def test_pipeline_channel_reprocess_keeps_other_channels(spark, tmp_path):
    _write_landing(spark, str(tmp_path / "raw"), _landing_events())
    cfg = _cfg(tmp_path)
    run_pipeline(spark, cfg)
    r = run_pipeline(spark, dataclasses.replace(cfg, canal="C2", start_stage="silver"))
    assert r.silver == {"output_rows": 1, "n_canales": 1, "excluded_null_rows": 0} and r.gold["output_rows"] == 24
    inv = {r.canal for r in audit.inventory(spark, cfg.gold_root, S.GOLD).collect()}
    assert inv == {"C1", "C2", "C3"}
    c2 = layers.read_gold(spark, cfg.gold_root, canal="C2").filter("franja_horaria = 10").collect()[0]
    assert c2.audiencia_total_franja == 2  # denominators kept every channel


def test_stragglers_are_published_and_survive_reruns(spark, tmp_path):
    ev = _landing_events()
    _write_landing(spark, str(tmp_path / "raw"), ev + [(datetime(2026, 8, 2, 9, 0), "C1", "h9", 100_000)])
    day1, day2 = _cfg(tmp_path), _cfg(tmp_path, start=date(2026, 8, 2))
    r = run_pipeline(spark, day1)
    assert r.bronze["accepted"] == 4 and r.bronze["out_of_range"] == 0
    assert not (tmp_path / "bronze" / "resultado=aceptado" / "fecha=2026-08-02").exists()
    # a straggler inside the landing folder of 08-01 but dated 08-02
    straggler = tmp_path / "raw" / "fecha=2026-08-01" / "late.txt"
    straggler.write_text(json.dumps({"canal": "C1", "id_hogar_panelista": "h8", "timestamp": "2026-08-02T00:10:00", "universo_total": 1}) + "\n\n")
    r = run_pipeline(spark, day1)
    assert r.bronze["accepted"] == 5 and r.bronze["out_of_range"] == 1
    assert [x.id_hogar_panelista for x in out_of_range(spark, day1).collect()] == ["h8"]
    # its own date is rebuilt by the same run
    assert affected_dates(spark, day1) == [date(2026, 8, 2)]
    late = layers.read_gold(spark, day1.gold_root, start="2026-08-02", canal="C1").filter("franja_horaria = 0").collect()
    assert [(x.audiencia_canal, x.universo_total) for x in late] == [(1, 1)]
    # day 2, run alone and again, keeps it: its own folder replaces its own rows only
    for _ in range(2):
        assert run_pipeline(spark, day2).bronze["accepted"] == 1
        homes = {x.id_hogar_panelista for x in layers.read_silver(spark, day2.silver_root, start="2026-08-02").collect()}
        assert homes == {"h8", "h9"}
    summary = {(x.layer, str(x.fecha)): (x.n_partitions, x.n_rows) for x in layer_summary(spark, day1).collect()}
    assert summary == {("bronze", "2026-08-01"): (1, 4), ("silver", "2026-08-01"): (2, 3), ("gold", "2026-08-01"): (3, 72)}
    counts = [tuple(x)[1:] for x in run_summary(spark, dataclasses.replace(day1, end=date(2026, 8, 2))).orderBy("fecha").collect()]
    assert counts == [(5, 0, 0, 3, 72), (1, 0, 0, 2, 72)]


def test_a_day_is_read_from_its_own_folder_only(spark, tmp_path):
    root = str(tmp_path / "gold")
    s = silver_df(spark, [("h1", "A", datetime(2026, 8, d, 10), 10) for d in range(1, 31)])
    sinks.write_gold(metrics.gold_metrics(s, canales=["A"]), root)
    files = layers.read_gold(spark, root, start="2026-08-07").inputFiles()
    assert len(files) == 1 and "fecha=2026-08-07" in files[0]
    raw = str(tmp_path / "raw")
    landing.export_landing(s.select("timestamp", "canal", "id_hogar_panelista", "universo_total"), raw)
    assert {f.split("/")[-2] for f in landing.landing_scan(spark, raw, date(2026, 8, 7)).inputFiles()} == {"fecha=2026-08-07"}


def test_bronze_is_written_in_scan_order_without_shuffle(spark, tmp_path):
    raw = str(tmp_path / "raw")
    s = silver_df(spark, [(f"h{k}", "A", datetime(2026, 8, 1 + k % 3, 10, k % 60), 10) for k in range(500)])
    landing.export_landing(s.select("timestamp", "canal", "id_hogar_panelista", "universo_total").repartition(5), raw)
    lines = landing.landing_scan(spark, raw)
    plan = validate.accepted(validate.judge(lines))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    sinks.write_bronze(validate.accepted(validate.judge(lines)), str(tmp_path / "bronze"))
    # no finer than the landing files it was read from
    assert len(_files(tmp_path / "bronze")) <= len(_files(tmp_path / "raw", "*.txt"))


def test_missing_input_fails_on_request(spark, tmp_path):
    for stage in ("bronze", "silver", "gold"):
        with pytest.raises(FileNotFoundError):
            run_pipeline(spark, _cfg(tmp_path, start_stage=stage, fail_if_missing=True))


def test_households_of_seven_digits_stay_apart(spark):
    from sintonia.operators import clean
    from sintonia.sources import panel

    rows = [(k, datetime(2026, 8, 1, 10), 1_234_567 + k, "x") for k in range(2)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string")
    silver = clean.clean(panel.as_bronze(panel.clean_panel(events)))
    assert silver.count() == 2
    assert [r.audiencia_canal for r in metrics.channel_audience(metrics.band_counts(silver)).collect()] == [2]


GOOD = {"canal": "C1", "id_hogar_panelista": "h1", "timestamp": "2026-08-01T10:00:00", "universo_total": 5}


def _land(tmp_path, day, name, lines):
    folder = tmp_path / "raw" / f"fecha={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines))


def test_rejects_are_committed_with_the_accepted_rows_and_keep_their_order(spark, tmp_path):
    _land(tmp_path, "2026-08-01", "a.jsonl", [GOOD, {**GOOD, "canal": ""}, "", "{broken", GOOD])
    _land(tmp_path, "2026-08-01", "b.jsonl", ["  ", {**GOOD, "universo_total": "x"}, {**GOOD, "canal": ""}])
    cfg = _cfg(tmp_path)
    r = run_pipeline(spark, cfg)
    assert r.bronze["accepted"] == 2 and r.bronze["rejected"] == 4 and r.bronze["out_of_range"] == 0
    canal, broken, universe = "missing required field: canal", S.REASON_NOT_JSON_OBJECT, S.REASON_UNIVERSO_INT
    assert r.bronze["rejected_reasons"] == {broken: 1, canal: 2, universe: 1}
    got = rejects(spark, cfg).collect()
    assert [x.reason for x in got] == [canal, broken, universe, canal]
    assert [x.archivo.rsplit("/")[-1] for x in got] == ["a.jsonl"] * 2 + ["b.jsonl"] * 2 and got[1].value == "{broken"


def test_line_order_survives_blocks_and_tasks(spark, tmp_path):
    for f in ("p", "q"):
        _land(tmp_path, "2026-08-01", f"{f}.jsonl", [f"bad {f} {k:04d} " + "x" * (k % 37) for k in range(3000)])
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        cfg = _cfg(tmp_path)
        run_bronze(spark, cfg)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", saved)
    got = rejects(spark, cfg).collect()
    assert [x.value.split()[1:3] for x in got] == [[f, f"{k:04d}"] for f in ("p", "q") for k in range(3000)]
    assert len({(x.archivo, x.bloque) for x in got}) > 4


def test_bronze_reads_the_landing_once(spark, tmp_path):
    _land(tmp_path, "2026-08-01", "a.jsonl", [GOOD, "{broken"])
    out = validate.outcomes(validate.judge(landing.landing_scan(spark, str(tmp_path / "raw"), "2026-08-01")))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "Exchange" not in plan


def test_a_rerun_drops_what_its_folder_no_longer_brings(spark, tmp_path):
    late = {**GOOD, "timestamp": "2026-07-20T10:00:00", "id_hogar_panelista": "late"}
    _land(tmp_path, "2026-08-01", "a.jsonl", [GOOD, late, "{broken"])
    _land(tmp_path, "2026-07-20", "a.jsonl", [{**late, "id_hogar_panelista": "early"}])
    cfg = _cfg(tmp_path)
    run_pipeline(spark, _cfg(tmp_path, start=date(2026, 7, 20)))
    run_pipeline(spark, cfg)
    july = lambda: layers.read_gold(spark, cfg.gold_root, start="2026-07-20", canal="C1").filter("franja_horaria = 10").collect()[0]
    assert july().audiencia_canal == 2
    _land(tmp_path, "2026-08-01", "a.jsonl", [GOOD])
    r = run_pipeline(spark, cfg)
    assert r.bronze == {"accepted": 1, "rejected": 0, "out_of_range": 0, "rejected_reasons": {}}
    assert july().audiencia_canal == 1 and out_of_range(spark, cfg).count() == 0
    assert [x.id_hogar_panelista for x in layers.read_bronze(spark, cfg.bronze_root, start="2026-07-20").collect()] == ["early"]


def test_stragglers_can_be_left_to_their_own_run(spark, tmp_path):
    _land(tmp_path, "2026-08-01", "a.jsonl", [GOOD, {**GOOD, "timestamp": "2026-08-03T01:00:00"}])
    cfg = _cfg(tmp_path, rebuild_stragglers=False)
    assert run_pipeline(spark, cfg).bronze["out_of_range"] == 1
    assert layers.read_gold(spark, cfg.gold_root, start="2026-08-03").count() == 0
    assert run_pipeline(spark, _cfg(tmp_path, start=date(2026, 8, 3))).silver["output_rows"] == 1


def test_counts_come_from_footers(spark, tmp_path):
    root = str(tmp_path / "gold")
    s = silver_df(spark, [("h1", f"C{d % 3}", datetime(2026, 8, d, 10), 10) for d in range(1, 10)])
    sinks.write_gold(metrics.gold_metrics(s), root)
    counts = layers.footer_counts(spark, root, S.GOLD, S.GOLD_PARTITIONS, not_null=["share_pct", "rating_pct"])
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(share_pct), COUNT(rating_pct)]" in plan
    assert {(r.n_rows, r.n_share_pct, r.n_rating_pct) for r in counts.collect()} == {(24, 1, 24)}
    inv = audit.inventory(spark, root, S.GOLD)
    plan = inv._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "ReadSchema: struct<length:bigint>" in plan
    sizes = {p: sum(f.stat().st_size for f in p.glob("*.parquet")) for p in (tmp_path / "gold").glob("*/*") if p.is_dir()}
    assert sorted(r.n_bytes for r in inv.collect()) == sorted(sizes.values()) and {(r.n_files, r.n_rows) for r in inv.collect()} == {(1, 24)}
    # the choice of reader is not left behind
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
    assert audit.inventory(spark, str(tmp_path / "none"), S.GOLD).collect() == []


def test_channel_names_with_path_characters_round_trip(spark, tmp_path):
    root = str(tmp_path / "gold")
    s = silver_df(spark, [("h1", "A/B", datetime(2026, 8, 1, 10), 10), ("h2", "C=D", datetime(2026, 8, 1, 10), 10)])
    sinks.write_gold(metrics.gold_metrics(s), root)
    assert sorted({r.canal for r in layers.read_gold(spark, root).collect()}) == ["A/B", "C=D"]
    assert layers.read_gold(spark, root, canal="A/B").count() == 24


def test_reprocess_counts_incomplete_rows_of_every_channel(spark, tmp_path):
    bronze_root = str(tmp_path / "bronze")
    d = datetime(2026, 8, 1, 10)
    b = spark.createDataFrame(
        [(d, "C1", "h1", 5), (d, "C2", "h2", 5), (d, "C1", None, 5), (d, None, "h3", 5)],
        "timestamp timestamp_ntz, canal string, id_hogar_panelista string, universo_total long",
    ).selectExpr("*", "CAST(NULL AS TIMESTAMP_NTZ) AS procesado_en", "CAST(timestamp AS DATE) AS fecha")
    sinks.write_bronze(b, bronze_root)
    from sintonia.plans.runner import run_silver

    cfg = _cfg(tmp_path, canal="C2", start_stage="silver")
    summary = run_silver(spark, cfg)
    assert summary == {"output_rows": 1, "n_canales": 1, "excluded_null_rows": 2}


def test_pipeline_on_a_range_without_landing_data_writes_nothing(spark, tmp_path):
    r = run_pipeline(spark, _cfg(tmp_path))
    assert r.bronze["accepted"] == 0 and r.silver["output_rows"] == 0 and r.gold["output_rows"] == 0
    assert not (tmp_path / "gold").exists() or not _files(tmp_path / "gold")


def test_differing_rows_of_two_runs(spark, tmp_path):
    day = lambda d, h, m=0: datetime(2026, 8, d, h, m)
    same = [(f"h{k}", f"C{k % 3}", day(1 + k % 4, k % 24, k % 60), 10) for k in range(200)]
    a = [*same, ("only-a", "C1", day(2, 5), 10), ("other", "C1", day(2, 6), 10), ("gone", "OLD", day(3, 1), 10)]
    b = [*same, ("other", "C1", day(2, 6), 11), ("only-b", "C0", day(4, 5), 10)]
    roots = [str(tmp_path / n) for n in "ab"]
    for rows, root in zip((a, b), roots):
        df = silver_df(spark, rows).withColumn("procesado_en", F.current_timestamp().cast("timestamp_ntz")).withColumn("fecha", F.to_date("timestamp"))
        sinks.write_silver(df.repartition(3), root)
    found = audit.differing_rows(spark, *roots, buckets=8)
    got = {(r.id_hogar_panelista, r.canal, r.universo_total, r.n_a, r.n_b) for r in found.collect()}
    assert got == {("only-a", "C1", 10, 1, 0), ("other", "C1", 10, 1, 0), ("other", "C1", 11, 0, 1), ("only-b", "C0", 10, 0, 1), ("gone", "OLD", 10, 1, 0)}
    # equal partitions are not read again
    read = {tuple(f.split("/")[-3:-1]) for f in found.inputFiles()}
    assert read == {("fecha=2026-08-02", "canal=C1"), ("fecha=2026-08-04", "canal=C0"), ("fecha=2026-08-03", "canal=OLD")}
    assert audit.differing_rows(spark, roots[0], roots[0]).collect() == []


def test_catalog_table_picks_partitions_without_listing(spark, tmp_path):
    root = str(tmp_path / "gold")
    s = silver_df(spark, [("h1", c, datetime(2026, 8, d, 10), 10) for d in range(1, 9) for c in ("A", "07")])
    sinks.write_gold(metrics.gold_metrics(s), root)
    gold = layers.gold_table(spark, root, "gold_prueba")
    try:
        chosen = gold.filter("fecha BETWEEN '2026-08-03' AND '2026-08-04' AND canal = '07'")
        plan = chosen._jdf.queryExecution().executedPlan().toString()
        assert "InMemoryFileIndex(2 paths)" in plan and "PartitionFilters" in plan
        assert chosen.count() == 48 and {r.canal for r in chosen.collect()} == {"07"}
        assert spark.sql("SELECT count(*) AS n FROM gold_prueba WHERE canal = 'A'").first().n == 8 * 24
    finally:
        spark.sql("DROP TABLE gold_prueba")
    assert layers.read_gold(spark, root).count() == 16 * 24  # the files stay
