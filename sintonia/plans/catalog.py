"""Registered queries over the supplied tables and their DuckDB oracles.

Every query reads the whole ``events`` table through a panel adapter
(``sources.panel``) and runs the engine's operators on it; ``oracle_sql`` gives,
for the same name, an independent SQL formulation over the raw table (validation
rules, de-duplication and metrics written out by hand) for the correctness gate.
Column names are aliased identically on both sides.
"""

from __future__ import annotations

import dataclasses
import functools
import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sintonia import schemas as S
from sintonia.operators import clean as silver_ops
from sintonia.operators import audit, bitmaps, metrics, reports, validate
from sintonia.plans.runner import PipelineConfig, layer_roots, run_bronze, run_pipeline, run_summary
from sintonia.session import ensure_checkpoint_dir
from sintonia.sources import landing, layers, panel, sinks
from sintonia.sources.compaction import compact
from sintonia.sources.storage import date_folders, delete_path

CHANNELS = ["Canal_click", "Canal_error", "Canal_purchase", "Canal_signup", "Canal_view"]
LISTED = CHANNELS + ["Canal_dark"]
UNLISTED = "Canal_view"
FILTERED = "Canal_click"

QueryFn = Callable[[SparkSession, str], DataFrame]

# ---------------------------------------------------------------- Spark side


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.read_events(spark, sf_dir)


def dirty_judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.judge(panel.dirty_lines(_events(spark, sf_dir)).select("value"))


def dirty_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.accepted(dirty_judged(spark, sf_dir))


def dirty_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_ops.clean(dirty_bronze(spark, sf_dir))


def sparse_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_ops.clean(panel.as_bronze(panel.sparse_panel(_events(spark, sf_dir))))


def dirty_gold(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return metrics.gold_metrics(dirty_silver(spark, sf_dir), **{"canales": LISTED, **kw})


def sparse_gold(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return metrics.gold_metrics(sparse_silver(spark, sf_dir), **{"canales": LISTED, **kw})


_GOLD_OUT = [c for c in S.GOLD_COLUMNS if c != S.PROCESADO_EN]
_GOLD_AUDIT = [*_GOLD_OUT, S.PROCESADO_EN]
AUDIT_TIME = datetime(2026, 8, 6, 12)
_SILVER_OUT = [S.HOGAR, S.CANAL, S.TIMESTAMP, S.UNIVERSO, S.FECHA]
_BRONZE_OUT = [S.TIMESTAMP, S.CANAL, S.HOGAR, S.UNIVERSO, S.FECHA]


def q_validate_reasons(spark, sf_dir):
    s = validate.ingest_summary(dirty_judged(spark, sf_dir))
    return s.select(F.coalesce(F.col(S.REASON), F.lit("accepted")).alias("outcome"), F.col("n"))


def q_bronze_accepted(spark, sf_dir):
    return dirty_bronze(spark, sf_dir).select(*_BRONZE_OUT)


def q_bronze_rejected(spark, sf_dir):
    return validate.rejected(dirty_judged(spark, sf_dir))


def q_bronze_by_date(spark, sf_dir):
    return dirty_bronze(spark, sf_dir).groupBy(S.FECHA).agg(F.count(F.lit(1)).alias("n_rows"))


def q_silver_dedup(spark, sf_dir):
    return dirty_silver(spark, sf_dir).select(*_SILVER_OUT)


def q_silver_conflict_keys(spark, sf_dir):
    b = dirty_bronze(spark, sf_dir)
    return (
        b.groupBy(S.HOGAR, S.CANAL, S.TIMESTAMP)
        .agg(F.count_distinct(S.UNIVERSO).alias("n_versions"), F.max(S.UNIVERSO).alias(S.UNIVERSO))
        .filter(F.col("n_versions") > 1)
    )


def q_silver_channel_filter(spark, sf_dir):
    return silver_ops.clean(dirty_bronze(spark, sf_dir), canal_filter=FILTERED).select(*_SILVER_OUT)


def q_silver_summary(spark, sf_dir):
    bronze = panel.as_bronze(panel.nullable_panel(_events(spark, sf_dir)))
    s = silver_ops.clean_summary(bronze)
    return s.select("output_rows", "excluded_null_rows", F.array_join("canales", ",").alias("canales"))


def q_band_universe(spark, sf_dir):
    return metrics.band_universe(metrics.band_counts(dirty_silver(spark, sf_dir)))


def q_band_audience(spark, sf_dir):
    return metrics.band_audience(metrics.band_counts(dirty_silver(spark, sf_dir)))


def q_channel_audience(spark, sf_dir):
    return metrics.channel_audience(metrics.band_counts(dirty_silver(spark, sf_dir)))


def q_report_grid(spark, sf_dir):
    return sparse_gold(spark, sf_dir).select(S.FECHA, S.CANAL, S.FRANJA)


def q_gold_rating_share(spark, sf_dir):
    return dirty_gold(spark, sf_dir).select(*_GOLD_OUT)


def q_gold_dark_channel(spark, sf_dir):
    return sparse_gold(spark, sf_dir, canal_filter="Canal_dark").select(*_GOLD_OUT)


def q_gold_unlisted_channel(spark, sf_dir):
    listed = [c for c in CHANNELS if c != UNLISTED]
    return sparse_gold(spark, sf_dir, canales=listed).select(*_GOLD_OUT)


def q_gold_channel_filter(spark, sf_dir):
    return sparse_gold(spark, sf_dir, canal_filter=FILTERED).select(*_GOLD_OUT)


def q_gold_default_channels(spark, sf_dir):
    return sparse_gold(spark, sf_dir, canales=None).select(*_GOLD_OUT)


def q_gold_summary(spark, sf_dir):
    s = metrics.metrics_summary(sparse_gold(spark, sf_dir))
    return s.select("output_rows", F.array_join("canales", ",").alias("canales"))


def q_report_rating_share(spark, sf_dir):
    return reports.preset(dirty_gold(spark, sf_dir), "rating_share")


def q_report_resumen_canal(spark, sf_dir):
    return reports.preset(dirty_gold(spark, sf_dir), "resumen_canal")


def q_report_top_franja(spark, sf_dir):
    return reports.preset(sparse_gold(spark, sf_dir), "top_franja")


def q_report_cobertura(spark, sf_dir):
    return reports.preset(sparse_gold(spark, sf_dir), "cobertura")


def q_report_share_check(spark, sf_dir):
    return reports.preset(sparse_gold(spark, sf_dir), "share_check")


def q_report_max_rating(spark, sf_dir):
    gold = dirty_gold(spark, sf_dir)
    return reports.query(
        spark, "SELECT canal, MAX(rating_pct) AS max_rating_pct FROM {gold} GROUP BY canal", gold=gold
    )


def q_report_bound_parameter(spark, sf_dir):
    """Free SQL with a bound parameter over the ``gold`` view of a written layer."""
    root = _scratch(spark, "gold")
    _write_sparse_gold(spark, sf_dir, root)
    sql = "SELECT fecha, franja_horaria, rating_pct FROM gold WHERE canal = :c AND audiencia_canal > :n"
    return _kept(reports.run_report(spark, root, *_span(spark, root), sql=sql, args={"c": FILTERED, "n": 1}), root)


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/sintonia-scratch/{name}-{uuid.uuid4().hex}"


def _kept(result: DataFrame, *roots: str) -> DataFrame:
    """``result`` as a written table of its own, after which the layers it was read
    from are deleted."""
    spark = result.sparkSession
    path = _scratch(spark, "result")
    result.write.parquet(path)
    for root in roots:
        delete_path(spark, root)
    return spark.read.schema(result.schema).parquet(path)


def _span(spark: SparkSession, root: str) -> tuple[date, date]:
    """First and last date folder of a layer."""
    days = [d for d, _ in date_folders(spark, root)]
    return days[0], days[-1]


RANGE = ("2024-01-10", "2024-01-12")


def q_layer_counts(spark, sf_dir):
    """Rows of each layer that a run over dirty lines committed, from file footers."""
    cfg = _config(spark, _dirty_landing(spark, sf_dir))
    run_pipeline(spark, cfg)
    one = [
        layers.footer_counts(spark, root, schema, keys).agg(F.sum("n_rows").alias("n_rows")).select(F.lit(name).alias("layer"), "n_rows")
        for name, root, schema, keys in layer_roots(cfg)
    ]
    return _kept(functools.reduce(DataFrame.unionAll, one), *_roots(cfg))


def _write_sparse_gold(spark: SparkSession, sf_dir: str, root: str, **kw) -> None:
    sinks.write_gold(sparse_gold(spark, sf_dir, **kw), root)


def q_range_prune(spark, sf_dir):
    root = _scratch(spark, "gold")
    _write_sparse_gold(spark, sf_dir, root)
    return _kept(layers.read_gold(spark, root, start=RANGE[0], end=RANGE[1], canal=FILTERED).select(*_GOLD_OUT), root)


def _doubled(silver: DataFrame) -> DataFrame:
    """Silver with twice the universe: what a second delivery may bring."""
    return silver.withColumn(S.UNIVERSO, F.col(S.UNIVERSO) * 2)


def q_rewrite_replaces_partition(spark, sf_dir):
    """One channel is written again with other universes; all rows are returned."""
    root = _scratch(spark, "gold")
    _write_sparse_gold(spark, sf_dir, root)
    again = metrics.gold_metrics(
        _doubled(sparse_silver(spark, sf_dir)), canales=LISTED, canal_filter=FILTERED, procesado_en=AUDIT_TIME
    )
    sinks.write_gold(again, root)
    files = audit.inventory(spark, root, S.GOLD).select(S.FECHA, S.CANAL, "n_files")
    return _kept(layers.read_gold(spark, root).join(files, [S.FECHA, S.CANAL]).select(*_GOLD_AUDIT, "n_files"), root)


def q_content_digest(spark, sf_dir):
    return audit.partition_digests(dirty_silver(spark, sf_dir).select(*_SILVER_OUT), S.SILVER_PARTITIONS)


def q_two_run_compare(spark, sf_dir):
    """Two runs, the second with other universes for one channel and without another
    channel's events."""
    silver = silver_ops.clean(dirty_bronze(spark, sf_dir), cluster_for_write=True)
    second = _doubled(silver.filter(F.col(S.CANAL) == FILTERED)).unionByName(
        silver.filter(~F.col(S.CANAL).isin(FILTERED, UNLISTED))
    )
    roots = []
    for run in (silver, second):
        roots.append(_scratch(spark, "silver"))
        sinks.write_silver(run, roots[-1])
    a, b = (audit.partition_digests(layers.read_silver(spark, r), S.SILVER_PARTITIONS) for r in roots)
    compared = audit.compare(a, b, S.SILVER_PARTITIONS).select(*S.SILVER_PARTITIONS, "n_rows_a", "n_rows_b", "same")
    return _kept(compared, *roots)


def _landing_from_panel(spark, sf_dir) -> str:
    root = _scratch(spark, "raw")
    landing.export_landing(panel.clean_panel(_events(spark, sf_dir)).drop("event_id"), root)
    return root


def q_landing_roundtrip(spark, sf_dir):
    root = _landing_from_panel(spark, sf_dir)
    judged = validate.judge(landing.landing_scan(spark, root))
    return _kept(validate.accepted(judged).select(*_BRONZE_OUT), root)


def _config(spark: SparkSession, raw: str, **kw) -> PipelineConfig:
    """A run over all dates of the landing folder ``raw``."""
    base = _scratch(spark, "pipeline")
    start, end = _span(spark, raw)
    cfg = PipelineConfig(
        landing_root=raw,
        bronze_root=f"{base}/bronze",
        silver_root=f"{base}/silver",
        gold_root=f"{base}/gold",
        start=start,
        end=end,
        procesado_en=AUDIT_TIME,
        canales=LISTED,
    )
    return dataclasses.replace(cfg, **kw)


def _roots(cfg: PipelineConfig) -> tuple[str, ...]:
    return cfg.landing_root, cfg.bronze_root, cfg.silver_root, cfg.gold_root


def q_resume_from_silver(spark, sf_dir):
    """A run without the dark channel; then landing changes, which a run resumed at
    silver must not see, and one channel more is listed, which it must."""
    cfg = _config(spark, _landing_from_panel(spark, sf_dir), canales=CHANNELS)
    run_pipeline(spark, cfg)
    landing.export_lines(
        panel.dirty_lines(_events(spark, sf_dir)).select(S.FECHA, F.lit("changed").alias("value")), cfg.landing_root
    )
    delete_path(spark, cfg.silver_root)
    run_pipeline(spark, dataclasses.replace(cfg, start_stage="silver", canales=LISTED, fail_if_missing=True))
    return _kept(layers.read_gold(spark, cfg.gold_root).select(*_GOLD_OUT), *_roots(cfg))


def q_run_summary(spark, sf_dir):
    """Counts per date of a whole run over dirty landing lines.  A line dated late in
    the day with an offset lands on its own date and is published under the next."""
    cfg = _config(spark, _dirty_landing(spark, sf_dir))
    run_pipeline(spark, cfg)
    return _kept(run_summary(spark, cfg), *_roots(cfg))


def _dirty_landing(spark, sf_dir) -> str:
    """Dirty lines in landing folders, files and lines in the order of the table."""
    raw = _scratch(spark, "raw")
    lines = panel.dirty_lines(_events(spark, sf_dir))
    landing.export_lines(lines.repartitionByRange(S.FECHA, "orden").sortWithinPartitions(S.FECHA, "orden"), raw)
    return raw


def q_rejects_in_order(spark, sf_dir):
    """Rejected lines of a bronze run, with the place of each among those of its folder."""
    cfg = _config(spark, _dirty_landing(spark, sf_dir))
    run_bronze(spark, cfg)
    place = F.row_number().over(Window.partitionBy(S.FECHA_LANDING).orderBy(*S.POSITION))
    lines = layers.read_rejects(spark, cfg.bronze_root, start=cfg.start, end=cfg.last)
    return _kept(lines.select(S.FECHA_LANDING, place.alias("place"), "value", S.REASON), *_roots(cfg))


def q_straggler_rebuild(spark, sf_dir):
    """A third of the households arrive late: all their events, of every date, land in the
    folder after the last date.  The run of that folder alone must bring the gold of
    every date up to date."""
    events = panel.clean_panel(_events(spark, sf_dir))
    late = F.substring(S.HOGAR, -1, 1).isin("0", "3", "6", "9")
    raw = _scratch(spark, "raw")
    landing.export_landing(events.filter(~late).drop("event_id"), raw)
    cfg = _config(spark, raw)
    run_pipeline(spark, cfg)
    after = cfg.last + timedelta(days=1)
    lines = validate.records_to_lines(events.filter(late).select(S.TIMESTAMP, S.CANAL, S.HOGAR, S.UNIVERSO))
    landing.export_lines(lines.select(F.lit(after).alias(S.FECHA), "value"), raw)
    run_pipeline(spark, dataclasses.replace(cfg, start=after, end=after))
    return _kept(layers.read_gold(spark, cfg.gold_root).select(*_GOLD_OUT), *_roots(cfg))


def q_absent_layer(spark, sf_dir):
    """Silver rows per date beside those of a gold layer that was never written."""
    gold = layers.read_gold(spark, _scratch(spark, "gold"), start=RANGE[0], end=RANGE[1])
    n = lambda df, name: df.groupBy(S.FECHA).agg(F.count(F.lit(1)).alias(name))
    both = n(dirty_silver(spark, sf_dir), "n_silver").join(n(gold, "n_gold"), S.FECHA, "left")
    return both.select(S.FECHA, "n_silver", F.coalesce("n_gold", F.lit(0)).cast("long").alias("n_gold"))


def q_memory_batch(spark, sf_dir):
    """Typed records of a caller (nulls among them) through the same validator."""
    records = panel.nullable_panel(_events(spark, sf_dir)).drop("event_id")
    s = validate.ingest_summary(validate.judge(validate.records_to_lines(records)))
    return s.select(F.coalesce(F.col(S.REASON), F.lit("accepted")).alias("outcome"), F.col("n"))


def q_preset_catalogue(spark, sf_dir):
    """Every preset of the catalogue with the rows its listed SQL gives."""
    gold = sparse_gold(spark, sf_dir)
    counts = [
        reports.preset(gold, name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("name"), "n_rows")
        for name in sorted(reports.PRESETS)
    ]
    return reports.catalogue(spark).join(functools.reduce(DataFrame.unionAll, counts), "name")


def _bitmap_gold(spark: SparkSession, root: str) -> DataFrame:
    return metrics.gold_from_counts(bitmaps.counts(bitmaps.read_bitmaps(spark, root)), canales=LISTED)


def q_bitmap_audience(spark, sf_dir):
    """Gold of all channels from stored household bitmaps."""
    root = _scratch(spark, "bitmaps")
    bitmaps.refresh(spark, dirty_silver(spark, sf_dir), root)
    return _kept(_bitmap_gold(spark, root).select(*_GOLD_OUT), root)


def q_bitmap_channel_rerun(spark, sf_dir):
    """One channel's silver is replaced: it also gets another channel's events, with twice
    the universe.  Only its partitions are read again; the gold of all channels follows
    from the merged bitmaps."""
    silver_root, root = _scratch(spark, "silver"), _scratch(spark, "bitmaps")
    sinks.write_silver(silver_ops.clean(dirty_bronze(spark, sf_dir), cluster_for_write=True), silver_root)
    bitmaps.refresh(spark, layers.read_silver(spark, silver_root), root)
    more = layers.read_silver(spark, silver_root).filter(F.col(S.CANAL).isin(FILTERED, UNLISTED)).withColumn(S.CANAL, F.lit(FILTERED))
    sinks.write_silver(silver_ops.clean(_doubled(more), cluster_for_write=True), silver_root)
    bitmaps.refresh(spark, layers.read_silver(spark, silver_root, canal=FILTERED), root)
    return _kept(_bitmap_gold(spark, root).select(*_GOLD_OUT), silver_root, root)


def q_gold_channel_calendar(spark, sf_dir):
    """Gold for channels that begin and end: each is on the air from some days after its
    first event to some days before its last; one has no events and no end."""
    panel_rows = panel.sparse_panel(_events(spark, sf_dir))
    days = F.length(S.CANAL)
    day = F.col(S.TIMESTAMP).cast("date")
    aired = panel_rows.groupBy(S.CANAL).agg(F.min(day).alias("a"), F.max(day).alias("z")).select(
        S.CANAL, F.date_add("a", days - 8).alias("desde"), F.date_sub("z", days - 8).alias("hasta")
    )
    span = panel_rows.agg(F.min(day).alias("a"), F.max(day).alias("z")).first()
    dark = spark.createDataFrame([("Canal_dark", span.a + timedelta(days=5), None)], aired.schema)
    listed = metrics.calendar(aired.unionAll(dark), span.a, span.z)
    return metrics.gold_metrics(sparse_silver(spark, sf_dir), canales=listed).select(*_GOLD_OUT)


def q_compacted_bronze(spark, sf_dir):
    """Bronze after many small deliveries (landing files by the dozen) and a compaction:
    files and rows of every partition."""
    raw = _scratch(spark, "raw")
    landing.export_lines(panel.dirty_lines(_events(spark, sf_dir)).repartition(24, "orden"), raw)
    cfg = _config(spark, raw)
    run_bronze(spark, cfg)
    root = layers.outcome_root(cfg.bronze_root, S.ACEPTADO)
    compact(spark, root, S.BRONZE, S.BRONZE_PARTITIONS)
    held = audit.inventory(spark, root, S.BRONZE, S.BRONZE_PARTITIONS).select(*S.BRONZE_PARTITIONS, "n_files")
    rows = layers.read_bronze(spark, cfg.bronze_root).groupBy(*S.BRONZE_PARTITIONS).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(S.UNIVERSO).alias("suma_universo")
    )
    return _kept(held.join(rows, list(S.BRONZE_PARTITIONS)), *_roots(cfg))


def q_run_row_differences(spark, sf_dir):
    """The rows in which two runs differ: the second has other universes for one channel
    on some dates and lacks another channel's first week."""
    silver = silver_ops.clean(dirty_bronze(spark, sf_dir), cluster_for_write=True)
    early = F.dayofmonth(S.FECHA) <= 7
    changed = (F.col(S.CANAL) == FILTERED) & (F.dayofmonth(S.FECHA) % 5 == 0)
    second = silver.filter(~((F.col(S.CANAL) == UNLISTED) & early)).withColumn(
        S.UNIVERSO, F.when(changed & (F.col(S.UNIVERSO) % 2000 == 0), F.col(S.UNIVERSO) + 1).otherwise(F.col(S.UNIVERSO))
    )
    roots = []
    for run in (silver, second):
        roots.append(_scratch(spark, "silver"))
        sinks.write_silver(run, roots[-1])
    return _kept(audit.differing_rows(spark, *roots).select(*_SILVER_OUT, "n_a", "n_b"), *roots)


def q_catalog_range(spark, sf_dir):
    """A range and channel of the gold layer read through the catalog's partitions."""
    root, name = _scratch(spark, "gold"), f"gold_{uuid.uuid4().hex}"
    _write_sparse_gold(spark, sf_dir, root)
    gold = layers.gold_table(spark, root, name)
    chosen = gold.filter(F.col(S.FECHA).between(*RANGE) & (F.col(S.CANAL) == FILTERED)).select(*_GOLD_OUT)
    result = _kept(chosen, root)
    spark.sql(f"DROP TABLE {name}")
    return result


def q_report_order(spark, sf_dir):
    """The daily summary with the place at which each row comes out."""
    report = reports.preset(dirty_gold(spark, sf_dir), "resumen_canal").withColumn("at", F.monotonically_increasing_id())
    return report.select(S.FECHA, S.CANAL, F.row_number().over(Window.orderBy("at")).alias("place"))


QUERIES: dict[str, QueryFn] = {
    "validate_reasons": q_validate_reasons,
    "bronze_accepted": q_bronze_accepted,
    "bronze_rejected": q_bronze_rejected,
    "bronze_by_date": q_bronze_by_date,
    "silver_dedup": q_silver_dedup,
    "silver_conflict_keys": q_silver_conflict_keys,
    "silver_channel_filter": q_silver_channel_filter,
    "silver_summary": q_silver_summary,
    "band_universe": q_band_universe,
    "band_audience": q_band_audience,
    "channel_audience": q_channel_audience,
    "report_grid": q_report_grid,
    "gold_rating_share": q_gold_rating_share,
    "gold_dark_channel": q_gold_dark_channel,
    "gold_unlisted_channel": q_gold_unlisted_channel,
    "gold_channel_filter": q_gold_channel_filter,
    "gold_default_channels": q_gold_default_channels,
    "gold_summary": q_gold_summary,
    "report_rating_share": q_report_rating_share,
    "report_resumen_canal": q_report_resumen_canal,
    "report_top_franja": q_report_top_franja,
    "report_cobertura": q_report_cobertura,
    "report_share_check": q_report_share_check,
    "report_max_rating": q_report_max_rating,
    "report_bound_parameter": q_report_bound_parameter,
    "layer_counts": q_layer_counts,
    "range_prune": q_range_prune,
    "rewrite_replaces_partition": q_rewrite_replaces_partition,
    "content_digest": q_content_digest,
    "two_run_compare": q_two_run_compare,
    "landing_roundtrip": q_landing_roundtrip,
    "resume_from_silver": q_resume_from_silver,
    "run_summary": q_run_summary,
    "rejects_in_order": q_rejects_in_order,
    "straggler_rebuild": q_straggler_rebuild,
    "absent_layer": q_absent_layer,
    "memory_batch": q_memory_batch,
    "preset_catalogue": q_preset_catalogue,
    "report_order": q_report_order,
    "gold_channel_calendar": q_gold_channel_calendar,
    "compacted_bronze": q_compacted_bronze,
    "run_row_differences": q_run_row_differences,
    "catalog_range": q_catalog_range,
    "bitmap_audience": q_bitmap_audience,
    "bitmap_channel_rerun": q_bitmap_channel_rerun,
}

# ---------------------------------------------------------------- DuckDB side
#
# Written from the definitions, over the raw table: households of a band first, both
# levels from one grouping, the report's frame from dates, hours and names, one join.


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_PANEL = """
panel AS (
    SELECT event_id, date_trunc('minute', ts)::TIMESTAMP AS t, 'Canal_' || event_type AS c,
           printf('hogar-%06d', user_id) AS h, (100000 + event_id % 7 * 1000)::BIGINT AS u
    FROM events
)"""

# One row per landing line: its text parts as JSON, the values a valid line stands for.
_DIRTY = (
    _PANEL
    + """,
texts AS (SELECT *, strftime(t, '%Y-%m-%dT%H:%M:%S') AS iso FROM panel),
lines AS (
    SELECT t::DATE AS landed, event_id % 73 = 0 AS cut,
           CASE event_id % 89 WHEN 0 THEN '   ' WHEN 1 THEN NULL ELSE c END AS c,
           CASE event_id % 83 WHEN 0 THEN '' WHEN 1 THEN ' ' || chr(9) ELSE h END AS h,
           CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 97 = 1 THEN '"not-a-date"'
                WHEN event_id % 97 = 2 THEN '20240101' WHEN event_id % 41 = 0 THEN '"' || iso || '-05:00"'
                ELSE '"' || iso || '"' END AS tj,
           t + CASE WHEN event_id % 41 = 0 THEN INTERVAL 5 HOUR ELSE INTERVAL 0 HOUR END AS utc,
           CASE event_id % 79 WHEN 0 THEN '"0"' WHEN 1 THEN '"abc"' WHEN 2 THEN NULL WHEN 3 THEN '1.5'
                WHEN 4 THEN 'true' WHEN 5 THEN '0.5' ELSE u::VARCHAR END AS uj,
           CASE event_id % 79 WHEN 0 THEN 0 WHEN 3 THEN 2 WHEN 4 THEN 1 WHEN 5 THEN 0 WHEN 1 THEN NULL ELSE u END AS u,
           event_id * 2 AS orden
    FROM texts
    UNION ALL
    SELECT t::DATE, FALSE, c, h, '"' || iso || '"', t, '"' || (u + 500)::VARCHAR || '"', u + 500, event_id * 2 + 1
    FROM texts WHERE event_id % 50 = 0
),
judged AS (
    SELECT *, CASE
        WHEN cut THEN 'line is not a JSON object'
        WHEN tj IS NULL THEN 'missing required field: timestamp'
        WHEN c IS NULL THEN 'missing required field: canal'
        WHEN h = '' THEN 'missing required field: id_hogar_panelista'
        WHEN uj IS NULL THEN 'missing required field: universo_total'
        WHEN c = '   ' THEN 'canal must be a non-empty string'
        WHEN h = ' ' || chr(9) THEN 'id_hogar_panelista must be a non-empty string'
        WHEN u IS NULL THEN 'universo_total must be an integer'
        WHEN u <= 0 THEN 'universo_total must be a positive integer'
        WHEN tj[1] <> '"' THEN 'timestamp must be a datetime or ISO-8601 string'
        WHEN tj = '"not-a-date"' THEN 'timestamp is not a parseable ISO-8601 datetime' END AS reason
    FROM lines
),
bronze AS (SELECT utc AS t, c, h, u, landed FROM judged WHERE reason IS NULL)"""
)

_SPARSE = (
    _PANEL
    + """,
bronze AS (
    SELECT t + CASE WHEN hour(t) BETWEEN 2 AND 3 THEN INTERVAL 2 HOUR ELSE INTERVAL 0 HOUR END AS t, c, h, u FROM panel
)"""
)
_CLEAN = _PANEL + ",\nbronze AS (SELECT t, c, h, u FROM panel)"
_NULLABLE = (
    _PANEL
    + """,
bronze AS (
    SELECT t, CASE WHEN event_id % 53 <> 0 THEN c END AS c, h, CASE WHEN event_id % 59 <> 0 THEN u END AS u FROM panel
)"""
)

_SILVER = """,
silver AS (SELECT DISTINCT ON (h, c, t) h, c, t, u FROM bronze WHERE c IS NOT NULL AND u IS NOT NULL ORDER BY h, c, t, u DESC)"""
_SILVER_ROWS = 'SELECT h AS id_hogar_panelista, c AS canal, t AS "timestamp", u AS universo_total, t::DATE AS fecha FROM silver'

# Audience of a channel in a band, and of the whole band (``every``), from one grouping.
_LEVELS = """,
watched AS (SELECT t::DATE AS d, hour(t) AS hr, c, h, max(u) AS u FROM silver GROUP BY ALL),
levels AS (
    SELECT d, hr, c, grouping(c) = 1 AS every, count(DISTINCT h) AS homes, max(u) AS u
    FROM watched GROUP BY GROUPING SETS ((d, hr, c), (d, hr))
)"""


def _gold(channels: list[str] | None, only: str | None = None, factor: int = 1) -> str:
    """The report: every hour of every date for each name, with the audience of the
    name and of the band beside it."""
    if channels is None:
        names = "SELECT DISTINCT d, c AS name FROM watched"
    else:
        names = f"SELECT DISTINCT d, unnest({_list(channels)}) AS name FROM watched"
    chosen = f"WHERE name = '{only}'" if only else ""
    return f"""{_LEVELS},
frame AS (SELECT d, name, unnest(range(24)) AS hr FROM ({names}) {chosen}),
met AS (
    SELECT f.d, f.name, f.hr, coalesce(max(l.homes) FILTER (WHERE NOT l.every), 0) AS own,
           coalesce(max(l.homes) FILTER (WHERE l.every), 0) AS everyone,
           coalesce(max(l.u) FILTER (WHERE l.every), 0) * {factor} AS u
    FROM frame f LEFT JOIN levels l ON l.d = f.d AND l.hr = f.hr AND (l.every OR l.c = f.name)
    GROUP BY ALL
),
gold AS (
    SELECT d AS fecha, name AS canal, hr AS franja_horaria, own AS audiencia_canal,
           everyone AS audiencia_total_franja, u AS universo_total,
           if(u > 0, own::DOUBLE * 100 / u, 0) AS rating_pct,
           if(everyone > 0, own::DOUBLE * 100 / everyone, NULL) AS share_pct
    FROM met
)"""


_GOLD_COLS = "fecha, canal, franja_horaria, audiencia_canal, audiencia_total_franja, universo_total, rating_pct, share_pct"


def _with(*parts: str) -> str:
    return "WITH " + "".join(parts).lstrip(",\n ") + "\n"


_GOLD_DIRTY = _with(_DIRTY, _SILVER, _gold(LISTED))
_GOLD_SPARSE = _with(_SPARSE, _SILVER, _gold(LISTED))
_SLICES = ", ".join(f"sum(CAST('0x' || substr(m, {8 * i + 1}, 8) AS BIGINT))::VARCHAR" for i in range(4))

_REJECTED = (
    _with(_DIRTY)
    + """, rejected AS (
    SELECT landed, orden, if(cut, substr(v, 1, 20), v) AS value, reason
    FROM (SELECT *, '{"canal":' || coalesce(to_json(c)::VARCHAR, 'null') || ',"id_hogar_panelista":' || to_json(h)
                 || ',"timestamp":' || coalesce(tj, 'null') || ',"universo_total":' || coalesce(uj, 'null') || '}' AS v FROM judged)
    WHERE reason IS NOT NULL
)
"""
)
_SQL_TEXTS = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in sorted(reports.PRESETS.items()))

ORACLE: dict[str, str] = {
    "validate_reasons": _with(_DIRTY) + "SELECT coalesce(reason, 'accepted') AS outcome, count(*) AS n FROM judged GROUP BY 1",
    "bronze_accepted": _with(_DIRTY)
    + 'SELECT t AS "timestamp", c AS canal, h AS id_hogar_panelista, u AS universo_total, t::DATE AS fecha FROM bronze',
    "bronze_rejected": _REJECTED + "SELECT value, reason FROM rejected",
    "bronze_by_date": q_bronze_by_date,
    "silver_dedup": q_silver_dedup,
    "silver_conflict_keys": q_silver_conflict_keys,
    "silver_channel_filter": q_silver_channel_filter,
    "silver_summary": q_silver_summary,
    "band_universe": q_band_universe,
    "band_audience": q_band_audience,
    "channel_audience": q_channel_audience,
    "report_grid": q_report_grid,
    "gold_rating_share": q_gold_rating_share,
    "gold_dark_channel": q_gold_dark_channel,
    "gold_unlisted_channel": q_gold_unlisted_channel,
    "gold_channel_filter": q_gold_channel_filter,
    "gold_default_channels": q_gold_default_channels,
    "gold_summary": q_gold_summary,
    "report_rating_share": q_report_rating_share,
    "report_resumen_canal": q_report_resumen_canal,
    "report_top_franja": q_report_top_franja,
    "report_cobertura": q_report_cobertura,
    "report_share_check": q_report_share_check,
    "report_max_rating": q_report_max_rating,
    "report_bound_parameter": q_report_bound_parameter,
    "layer_counts": q_layer_counts,
    "range_prune": q_range_prune,
    "rewrite_replaces_partition": q_rewrite_replaces_partition,
    "content_digest": q_content_digest,
    "two_run_compare": q_two_run_compare,
    "landing_roundtrip": q_landing_roundtrip,
    "resume_from_silver": q_resume_from_silver,
    "run_summary": q_run_summary,
    "rejects_in_order": q_rejects_in_order,
    "straggler_rebuild": q_straggler_rebuild,
    "absent_layer": q_absent_layer,
    "memory_batch": q_memory_batch,
    "preset_catalogue": q_preset_catalogue,
    "report_order": q_report_order,
    "gold_channel_calendar": q_gold_channel_calendar,
    "compacted_bronze": q_compacted_bronze,
    "run_row_differences": q_run_row_differences,
    "catalog_range": q_catalog_range,
    "bitmap_audience": q_bitmap_audience,
    "bitmap_channel_rerun": q_bitmap_channel_rerun,
}

# ---------------------------------------------------------------- DuckDB side
#
# Written from the definitions, over the raw table: households of a band first, both
# levels from one grouping, the report's frame from dates, hours and names, one join.


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_PANEL = """
panel AS (
    SELECT event_id, date_trunc('minute', ts)::TIMESTAMP AS t, 'Canal_' || event_type AS c,
           printf('hogar-%06d', user_id) AS h, (100000 + event_id % 7 * 1000)::BIGINT AS u
    FROM events
)"""

# One row per landing line: its text parts as JSON, the values a valid line stands for.
_DIRTY = (
    _PANEL
    + """,
texts AS (SELECT *, strftime(t, '%Y-%m-%dT%H:%M:%S') AS iso FROM panel),
lines AS (
    SELECT t::DATE AS landed, event_id % 73 = 0 AS cut,
           CASE event_id % 89 WHEN 0 THEN '   ' WHEN 1 THEN NULL ELSE c END AS c,
           CASE event_id % 83 WHEN 0 THEN '' WHEN 1 THEN ' ' || chr(9) ELSE h END AS h,
           CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 97 = 1 THEN '"not-a-date"'
                WHEN event_id % 97 = 2 THEN '20240101' WHEN event_id % 41 = 0 THEN '"' || iso || '-05:00"'
                ELSE '"' || iso || '"' END AS tj,
           t + CASE WHEN event_id % 41 = 0 THEN INTERVAL 5 HOUR ELSE INTERVAL 0 HOUR END AS utc,
           CASE event_id % 79 WHEN 0 THEN '"0"' WHEN 1 THEN '"abc"' WHEN 2 THEN NULL WHEN 3 THEN '1.5'
                WHEN 4 THEN 'true' WHEN 5 THEN '0.5' ELSE u::VARCHAR END AS uj,
           CASE event_id % 79 WHEN 0 THEN 0 WHEN 3 THEN 2 WHEN 4 THEN 1 WHEN 5 THEN 0 WHEN 1 THEN NULL ELSE u END AS u,
           event_id * 2 AS orden
    FROM texts
    UNION ALL
    SELECT t::DATE, FALSE, c, h, '"' || iso || '"', t, '"' || (u + 500)::VARCHAR || '"', u + 500, event_id * 2 + 1
    FROM texts WHERE event_id % 50 = 0
),
judged AS (
    SELECT *, CASE
        WHEN cut THEN 'line is not a JSON object'
        WHEN tj IS NULL THEN 'missing required field: timestamp'
        WHEN c IS NULL THEN 'missing required field: canal'
        WHEN h = '' THEN 'missing required field: id_hogar_panelista'
        WHEN uj IS NULL THEN 'missing required field: universo_total'
        WHEN c = '   ' THEN 'canal must be a non-empty string'
        WHEN h = ' ' || chr(9) THEN 'id_hogar_panelista must be a non-empty string'
        WHEN u IS NULL THEN 'universo_total must be an integer'
        WHEN u <= 0 THEN 'universo_total must be a positive integer'
        WHEN tj[1] <> '"' THEN 'timestamp must be a datetime or ISO-8601 string'
        WHEN tj = '"not-a-date"' THEN 'timestamp is not a parseable ISO-8601 datetime' END AS reason
    FROM lines
),
bronze AS (SELECT utc AS t, c, h, u, landed FROM judged WHERE reason IS NULL)"""
)

_SPARSE = (
    _PANEL
    + """,
bronze AS (
    SELECT t + CASE WHEN hour(t) BETWEEN 2 AND 3 THEN INTERVAL 2 HOUR ELSE INTERVAL 0 HOUR END AS t, c, h, u FROM panel
)"""
)
_CLEAN = _PANEL + ",\nbronze AS (SELECT t, c, h, u FROM panel)"
_NULLABLE = (
    _PANEL
    + """,
bronze AS (
    SELECT t, CASE WHEN event_id % 53 <> 0 THEN c END AS c, h, CASE WHEN event_id % 59 <> 0 THEN u END AS u FROM panel
)"""
)

_SILVER = """,
silver AS (SELECT DISTINCT ON (h, c, t) h, c, t, u FROM bronze WHERE c IS NOT NULL AND u IS NOT NULL ORDER BY h, c, t, u DESC)"""
_SILVER_ROWS = 'SELECT h AS id_hogar_panelista, c AS canal, t AS "timestamp", u AS universo_total, t::DATE AS fecha FROM silver'

# Audience of a channel in a band, and of the whole band (``every``), from one grouping.
_LEVELS = """,
watched AS (SELECT t::DATE AS d, hour(t) AS hr, c, h, max(u) AS u FROM silver GROUP BY ALL),
levels AS (
    SELECT d, hr, c, grouping(c) = 1 AS every, count(DISTINCT h) AS homes, max(u) AS u
    FROM watched GROUP BY GROUPING SETS ((d, hr, c), (d, hr))
)"""


def _gold(channels: list[str] | None, only: str | None = None, factor: int = 1) -> str:
    """The report: every hour of every date for each name, with the audience of the
    name and of the band beside it."""
    if channels is None:
        names = "SELECT DISTINCT d, c AS name FROM watched"
    else:
        names = f"SELECT DISTINCT d, unnest({_list(channels)}) AS name FROM watched"
    chosen = f"WHERE name = '{only}'" if only else ""
    return f"""{_LEVELS},
frame AS (SELECT d, name, unnest(range(24)) AS hr FROM ({names}) {chosen}),
met AS (
    SELECT f.d, f.name, f.hr, coalesce(max(l.homes) FILTER (WHERE NOT l.every), 0) AS own,
           coalesce(max(l.homes) FILTER (WHERE l.every), 0) AS everyone,
           coalesce(max(l.u) FILTER (WHERE l.every), 0) * {factor} AS u
    FROM frame f LEFT JOIN levels l ON l.d = f.d AND l.hr = f.hr AND (l.every OR l.c = f.name)
    GROUP BY ALL
),
gold AS (
    SELECT d AS fecha, name AS canal, hr AS franja_horaria, own AS audiencia_canal,
           everyone AS audiencia_total_franja, u AS universo_total,
           if(u > 0, own::DOUBLE * 100 / u, 0) AS rating_pct,
           if(everyone > 0, own::DOUBLE * 100 / everyone, NULL) AS share_pct
    FROM met
)"""


_GOLD_COLS = "fecha, canal, franja_horaria, audiencia_canal, audiencia_total_franja, universo_total, rating_pct, share_pct"


def _with(*parts: str) -> str:
    return "WITH " + "".join(parts).lstrip(",\n ") + "\n"


_GOLD_DIRTY = _with(_DIRTY, _SILVER, _gold(LISTED))
_GOLD_SPARSE = _with(_SPARSE, _SILVER, _gold(LISTED))
_SLICES = ", ".join(f"sum(CAST('0x' || substr(m, {8 * i + 1}, 8) AS BIGINT))::VARCHAR" for i in range(4))

ORACLE: dict[str, str] = {
    "validate_reasons": _with(_DIRTY) + "SELECT coalesce(reason, 'accepted') AS outcome, count(*) AS n FROM judged GROUP BY 1",
    "bronze_accepted": _with(_DIRTY)
    + 'SELECT t AS "timestamp", c AS canal, h AS id_hogar_panelista, u AS universo_total, t::DATE AS fecha FROM bronze',
    "bronze_rejected": _with(_DIRTY)
    + """
SELECT if(cut, substr(v, 1, 20), v) AS value, reason
FROM (SELECT *, '{"canal":' || coalesce(to_json(c)::VARCHAR, 'null') || ',"id_hogar_panelista":' || to_json(h)
             || ',"timestamp":' || coalesce(tj, 'null') || ',"universo_total":' || coalesce(uj, 'null') || '}' AS v FROM judged)
WHERE reason IS NOT NULL""",
    "bronze_by_date": _with(_DIRTY) + "SELECT t::DATE AS fecha, count(*) AS n_rows FROM bronze GROUP BY 1",
    "silver_dedup": _with(_DIRTY, _SILVER) + _SILVER_ROWS,
    "silver_conflict_keys": _with(_DIRTY)
    + """
SELECT h AS id_hogar_panelista, c AS canal, t AS "timestamp", len(us) AS n_versions, us[-1] AS universo_total
FROM (SELECT h, c, t, list_sort(list(DISTINCT u)) AS us FROM bronze GROUP BY ALL) WHERE len(us) > 1""",
    "silver_channel_filter": _with(_DIRTY, _SILVER) + f"{_SILVER_ROWS} WHERE c = '{FILTERED}'",
    "silver_summary": _with(_NULLABLE, _SILVER)
    + """
SELECT count(*) AS output_rows, (SELECT count(*) FROM bronze WHERE c IS NULL OR u IS NULL) AS excluded_null_rows,
       array_to_string(list_sort(list(DISTINCT c)), ',') AS canales
FROM silver""",
    "band_universe": _with(_DIRTY, _SILVER, _LEVELS) + "SELECT d AS fecha, hr AS franja_horaria, u AS universo_total FROM levels WHERE every",
    "band_audience": _with(_DIRTY, _SILVER, _LEVELS)
    + "SELECT d AS fecha, hr AS franja_horaria, homes AS audiencia_total_franja FROM levels WHERE every",
    "channel_audience": _with(_DIRTY, _SILVER, _LEVELS)
    + "SELECT d AS fecha, c AS canal, hr AS franja_horaria, homes AS audiencia_canal FROM levels WHERE NOT every",
    "report_grid": _GOLD_SPARSE + "SELECT d AS fecha, name AS canal, hr AS franja_horaria FROM frame",
    "gold_rating_share": _GOLD_DIRTY + f"SELECT {_GOLD_COLS} FROM gold",
    "gold_dark_channel": _with(_SPARSE, _SILVER, _gold(LISTED, "Canal_dark")) + f"SELECT {_GOLD_COLS} FROM gold",
    "gold_unlisted_channel": _with(_SPARSE, _SILVER, _gold([c for c in CHANNELS if c != UNLISTED]))
    + f"SELECT {_GOLD_COLS} FROM gold",
    "gold_channel_filter": _with(_SPARSE, _SILVER, _gold(LISTED, FILTERED)) + f"SELECT {_GOLD_COLS} FROM gold",
    "gold_default_channels": _with(_SPARSE, _SILVER, _gold(None)) + f"SELECT {_GOLD_COLS} FROM gold",
    "gold_summary": _GOLD_SPARSE + "SELECT count(*) AS output_rows, array_to_string(list_sort(list(DISTINCT canal)), ',') AS canales FROM gold",
    "report_rating_share": _GOLD_DIRTY + "SELECT fecha, franja_horaria, canal, rating_pct, share_pct FROM gold",
    "report_resumen_canal": _GOLD_DIRTY
    + """
SELECT d AS fecha, name AS canal, round(sum(if(u > 0, own * 100.0::DOUBLE / u, 0)) / 24, 2) AS rating_prom,
       round(avg(own * 100.0::DOUBLE / nullif(everyone, 0)), 2) AS share_prom, sum(own)::BIGINT AS audiencia_acumulada_dia
FROM met GROUP BY ALL""",
    "report_top_franja": _GOLD_SPARSE
    + "SELECT DISTINCT ON (fecha, franja_horaria) fecha, franja_horaria, canal, rating_pct, share_pct FROM gold "
    "ORDER BY fecha, franja_horaria, rating_pct DESC, canal",
    "report_cobertura": _GOLD_SPARSE
    + "SELECT DISTINCT d AS fecha, hr AS franja_horaria, 0::BIGINT AS audiencia_total FROM frame "
    "ANTI JOIN watched USING (d, hr)",
    "report_share_check": _GOLD_SPARSE
    + f"""
SELECT f.d AS fecha, f.hr AS franja_horaria,
       round(sum(l.homes) FILTER (WHERE NOT l.every) * 100.0::DOUBLE / max(l.homes) FILTER (WHERE l.every), 2) AS suma_share_pct
FROM (SELECT DISTINCT d, hr FROM frame) f LEFT JOIN levels l ON l.d = f.d AND l.hr = f.hr AND (l.every OR l.c IN {tuple(LISTED)})
GROUP BY ALL""",
    "report_max_rating": _GOLD_DIRTY + "SELECT canal, max(rating_pct) AS max_rating_pct FROM gold GROUP BY canal",
    "report_bound_parameter": _GOLD_SPARSE
    + f"SELECT d AS fecha, hr AS franja_horaria, own::DOUBLE * 100 / u AS rating_pct FROM met WHERE name = '{FILTERED}' AND own > 1",
    "layer_counts": _GOLD_DIRTY
    + """
SELECT 'bronze' AS layer, count(*) AS n_rows FROM bronze
UNION ALL SELECT 'silver', count(*) FROM silver UNION ALL SELECT 'gold', count(*) FROM gold""",
    "range_prune": _GOLD_SPARSE
    + f"SELECT {_GOLD_COLS} FROM gold WHERE fecha >= '{RANGE[0]}' AND fecha <= '{RANGE[1]}' AND canal = '{FILTERED}'",
    "rewrite_replaces_partition": _with(_SPARSE, _SILVER, _gold(LISTED))
    + f"""
SELECT fecha, canal, franja_horaria, audiencia_canal, audiencia_total_franja,
       universo_total * if(canal = '{FILTERED}', 2, 1) AS universo_total,
       rating_pct / if(canal = '{FILTERED}', 2, 1) AS rating_pct, share_pct,
       if(canal = '{FILTERED}', TIMESTAMP '2026-08-06 12:00:00', NULL) AS procesado_en, 1::BIGINT AS n_files
FROM gold""",
    "content_digest": _with(_DIRTY, _SILVER)
    + f"""
SELECT fecha, canal, count(*) AS n_rows, md5(concat_ws(':', count(*)::VARCHAR, {_SLICES})) AS digest
FROM (SELECT t::DATE AS fecha, c AS canal,
             md5(concat_ws(chr(1), '1' || c, '1' || t::DATE::VARCHAR, '1' || h, '1' || t::VARCHAR, '1' || u::VARCHAR)) AS m FROM silver)
GROUP BY ALL""",
    "two_run_compare": _with(_DIRTY, _SILVER)
    + f"""
SELECT t::DATE AS fecha, c AS canal, count(*) AS n_rows_a, if(c = '{UNLISTED}', NULL, count(*)) AS n_rows_b,
       c NOT IN ('{FILTERED}', '{UNLISTED}') AS same
FROM silver GROUP BY t::DATE, c""",
    "landing_roundtrip": _with(_PANEL)
    + 'SELECT t AS "timestamp", c AS canal, h AS id_hogar_panelista, u AS universo_total, t::DATE AS fecha FROM panel',
    "resume_from_silver": _with(_CLEAN, _SILVER, _gold(LISTED)) + f"SELECT {_GOLD_COLS} FROM gold",
    "rejects_in_order": _REJECTED
    + """
SELECT landed AS fecha_landing, row_number() OVER (PARTITION BY landed ORDER BY orden)::INT AS place, value, reason FROM rejected""",
    "straggler_rebuild": _with(_CLEAN, _SILVER, _gold(LISTED)) + f"SELECT {_GOLD_COLS} FROM gold",
    "absent_layer": _with(_DIRTY, _SILVER) + "SELECT t::DATE AS fecha, count(*) AS n_silver, 0::BIGINT AS n_gold FROM silver GROUP BY 1",
    "memory_batch": _with(_NULLABLE)
    + """
SELECT CASE WHEN c IS NULL THEN 'missing required field: canal' WHEN u IS NULL THEN 'missing required field: universo_total'
       ELSE 'accepted' END AS outcome, count(*) AS n
FROM bronze GROUP BY 1""",
    "preset_catalogue": _GOLD_SPARSE
    + f"""
SELECT name, sql, CASE name
         WHEN 'rating_share' THEN (SELECT count(*) FROM gold)
         WHEN 'resumen_canal' THEN (SELECT count(*) FROM (SELECT DISTINCT fecha, canal FROM gold))
         WHEN 'cobertura' THEN (SELECT count(*) FROM (SELECT DISTINCT d, hr FROM frame ANTI JOIN watched USING (d, hr)))
         ELSE (SELECT count(*) FROM (SELECT DISTINCT fecha, franja_horaria FROM gold)) END AS n_rows
FROM (VALUES {_SQL_TEXTS}) texts(name, sql)""",
    "report_order": _GOLD_DIRTY
    + """
SELECT d AS fecha, name AS canal,
       row_number() OVER (ORDER BY d, round(sum(if(u > 0, own * 100.0::DOUBLE / u, 0)) / 24, 2) DESC, name)::INT AS place
FROM met GROUP BY d, name""",
    "gold_channel_calendar": _with(_SPARSE, _SILVER, _gold([*CHANNELS, "Canal_dark"]))
    + f""", aired AS (
    SELECT c, min(t)::DATE + (length(c) - 8)::INT AS first, max(t)::DATE - (length(c) - 8)::INT AS last FROM bronze GROUP BY c
    UNION ALL SELECT 'Canal_dark', min(t)::DATE + 5, max(t)::DATE FROM bronze
)
SELECT {_GOLD_COLS} FROM gold SEMI JOIN aired ON canal = c AND fecha >= first AND fecha <= last""",
    "compacted_bronze": _with(_DIRTY)
    + """
SELECT t::DATE AS fecha, landed AS fecha_landing, 1::BIGINT AS n_files, count(*) AS n_rows, sum(u)::BIGINT AS suma_universo
FROM bronze GROUP BY ALL""",
    "run_row_differences": _with(_DIRTY, _SILVER)
    + f""", rows AS (
    SELECT h AS id_hogar_panelista, c AS canal, t AS "timestamp", u AS universo_total, t::DATE AS fecha,
           c = '{FILTERED}' AND day(t) % 5 = 0 AND u % 2000 = 0 AS up FROM silver
)
SELECT * EXCLUDE up, 1::BIGINT AS n_a, 0::BIGINT AS n_b FROM rows WHERE up OR (canal = '{UNLISTED}' AND day(fecha) <= 7)
UNION ALL SELECT * EXCLUDE up REPLACE (universo_total + 1 AS universo_total), 0, 1 FROM rows WHERE up""",
    "catalog_range": _GOLD_SPARSE
    + f"SELECT {_GOLD_COLS} FROM gold WHERE canal = '{FILTERED}' AND fecha BETWEEN '{RANGE[0]}' AND '{RANGE[1]}'",
    "bitmap_audience": _GOLD_DIRTY + f"SELECT {_GOLD_COLS} FROM gold",
    "bitmap_channel_rerun": _with(_DIRTY, _SILVER.replace("silver AS", "first AS"))
    + f""", silver AS (
    SELECT * FROM first WHERE c <> '{FILTERED}'
    UNION ALL SELECT DISTINCT ON (h, t) h, '{FILTERED}', t, 2 * u FROM first WHERE c IN ('{FILTERED}', '{UNLISTED}') ORDER BY h, t, u DESC
)"""
    + _gold(LISTED)
    + f"\nSELECT {_GOLD_COLS} FROM gold",
    "run_summary": _with(_DIRTY, _SILVER)
    + f"""
, days AS (SELECT DISTINCT landed AS fecha FROM lines)
SELECT fecha, (SELECT count(*) FROM judged WHERE landed = fecha AND reason IS NULL) AS accepted,
       (SELECT count(*) FROM judged WHERE landed = fecha AND reason IS NOT NULL) AS rejected,
       0::BIGINT AS excluded_null_rows, (SELECT count(*) FROM silver WHERE t::DATE = fecha) AS silver_rows,
       if((SELECT count(*) FROM silver WHERE t::DATE = fecha) > 0, {24 * len(LISTED)}, 0)::BIGINT AS gold_rows
FROM days""",
}
