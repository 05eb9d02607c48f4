"""Stage runner: landing -> bronze -> silver -> gold over a date range.

Each stage is one Spark job for the whole range (not a loop over dates) and ends
in a written layer, which also cuts lineage for the next stage.  ``start_stage``
resumes from a later stage.

Bronze is one pass over the landing lines: accepted rows and rejects, with their
positions, are committed by one write.  A manifest keeps what each landing folder
brought.  Silver and gold rebuild the dates of the range and every other date that its
landing folders brought rows of (stragglers), or used to.

A run's counts come from the footers of the files it committed, and reasons from the
committed rejects, so they are exact whatever was run again.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date, datetime
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sintonia import schemas as S
from sintonia.operators import clean as silver_ops
from sintonia.operators import audit, bitmaps, metrics, validate
from sintonia.sources import landing, layers, sinks
from sintonia.sources.storage import date_folders, delete_path
from sintonia.functions.columns import unique

STAGES = ("bronze", "silver", "gold")


@dataclass(frozen=True)
class PipelineConfig:
    landing_root: str
    bronze_root: str
    silver_root: str
    gold_root: str
    start: date
    procesado_en: datetime  # audit time, captured once by the caller
    end: date | None = None
    #: The channels to report: names, or a table ``canal, desde, hasta`` of the dates each
    #: is on the air (``metrics.calendar``).
    canales: list[str] | DataFrame | None = None
    canal: str | None = None
    start_stage: str = "bronze"
    #: Keep household bitmaps here, and make gold from them: a run for one channel then
    #: reads that channel's silver only, not the other channels' for the denominators.
    bitmap_root: str | None = None
    #: Also rebuild dates outside the range that its landing folders brought rows of.
    rebuild_stragglers: bool = True
    #: Fail when the layer (or landing) that the first stage reads does not exist.
    fail_if_missing: bool = False

    @property
    def last(self) -> date:
        return self.end or self.start


@dataclass
class PipelineResult:
    bronze: dict[str, Any] = field(default_factory=dict)
    silver: dict[str, Any] = field(default_factory=dict)
    gold: dict[str, Any] = field(default_factory=dict)


def _in_range(cfg: PipelineConfig):
    return F.col(S.FECHA).between(F.lit(cfg.start), F.lit(cfg.last))


#: (outcome, date, landing date): a partition of bronze.
Place = tuple[str, date, date]


def _folder(cfg: PipelineConfig, place: Place) -> str:
    outcome, day, landed = place
    return f"{layers.outcome_root(cfg.bronze_root, outcome)}/{S.FECHA}={day}/{S.FECHA_LANDING}={landed}"


def _manifest(spark: SparkSession, cfg: PipelineConfig) -> dict[Place, int]:
    """Rows of every partition that the landing folders of the range brought."""
    rows = layers.read_manifest(spark, cfg.bronze_root, cfg.start, cfg.last).collect()
    return {(r[S.RESULTADO], r[S.FECHA], r[S.FECHA_LANDING]): r.n_rows for r in rows}


def _published(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """Bronze rows that the landing folders of the range brought, whatever their date."""
    folders = [_folder(cfg, p) for p, n in sorted(_manifest(spark, cfg).items()) if n and p[0] == S.ACEPTADO]
    if not folders:
        return spark.createDataFrame([], S.BRONZE)
    root = layers.outcome_root(cfg.bronze_root, S.ACEPTADO)
    return spark.read.schema(S.BRONZE).option("basePath", root).parquet(*folders)


def _count(spark: SparkSession, cfg: PipelineConfig, places: Iterable[Place]) -> dict[Place, int]:
    """Rows of partitions of bronze, from the footers of their files."""
    folders = [_folder(cfg, p) for p in sorted(places)]
    counts = layers.footer_counts(spark, cfg.bronze_root, S.OUTCOMES, S.OUTCOME_PARTITIONS, folders=folders)
    return {(r[S.RESULTADO], r[S.FECHA], r[S.FECHA_LANDING]): r.n_rows for r in counts.collect()}


def run_bronze(spark: SparkSession, cfg: PipelineConfig) -> dict[str, Any]:
    lines = landing.landing_scan(
        spark, cfg.landing_root, cfg.start, cfg.last, fail_if_missing=cfg.fail_if_missing and cfg.start_stage == "bronze"
    )
    before = _manifest(spark, cfg)
    # Which partitions the write makes: a set, so tasks that run twice change nothing.
    made = Observation("bronze")
    places = F.collect_set(F.struct(*S.OUTCOME_PARTITIONS)).alias("places")
    # A landing folder replaces its own rows only: rows of another date (stragglers)
    # are published under that date, beside what that date's own folder brought.
    sinks.write_outcomes(validate.outcomes(validate.judge(lines), cfg.procesado_en).observe(made, places), cfg.bronze_root)
    now = {tuple(p) for p in made.get["places"]}
    gone = {p for p in before if p not in now}
    for p in gone:  # what the folders no longer bring
        delete_path(spark, _folder(cfg, p))
    counts = _count(spark, cfg, now)
    rows = [(p[0], p[1], n, p[2]) for p, n in {**dict.fromkeys(gone, 0), **counts}.items()]
    if rows:
        sinks.write_manifest(spark.createDataFrame(rows, S.MANIFEST), layers.manifest_root(cfg.bronze_root))
    of = lambda outcome, outside=False: sum(
        n for (o, day, _), n in counts.items() if o == outcome and (not outside or not cfg.start <= day <= cfg.last)
    )
    rejects = layers.read_rejects(spark, cfg.bronze_root, start=cfg.start, end=cfg.last)
    return {
        "accepted": of(S.ACEPTADO),
        "rejected": of(S.RECHAZADO),
        "out_of_range": of(S.ACEPTADO, outside=True),
        "rejected_reasons": {r[S.REASON]: r.n for r in validate.ingest_summary(rejects).collect()},
    }


def affected_dates(spark: SparkSession, cfg: PipelineConfig) -> list[date]:
    """Dates outside the range that its landing folders brought rows of, or used to."""
    if not cfg.rebuild_stragglers:
        return []
    return sorted({day for (o, day, _) in _manifest(spark, cfg) if o == S.ACEPTADO and not cfg.start <= day <= cfg.last})


def _dates(spark: SparkSession, cfg: PipelineConfig) -> dict[str, Any]:
    return {"start": cfg.start, "end": cfg.last, "dates": affected_dates(spark, cfg)}


def _written(spark: SparkSession, cfg: PipelineConfig, days: dict[str, Any], root: str, schema, partitions) -> dict[str, Any]:
    """Rows and channels of the layer's dates of this run, from file footers."""
    folders = [path for d in days["dates"] for _, path in date_folders(spark, root, d)]
    folders += [path for _, path in date_folders(spark, root, cfg.start, cfg.last)]
    layer = layers.footer_counts(spark, root, schema, partitions, folders=folders)
    if cfg.canal is not None:
        layer = layer.filter(F.col(S.CANAL) == F.lit(cfg.canal))
    n = layer.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("rows"), F.count_distinct(S.CANAL).alias("channels")).first()
    return {"output_rows": n.rows, "n_canales": n.channels}


def _excluded(spark: SparkSession, cfg: PipelineConfig, days: dict[str, Any]) -> int:
    """Incomplete bronze rows of every channel.  Footers say which partitions have a
    missing value at all; only those are read."""
    root = layers.outcome_root(cfg.bronze_root, S.ACEPTADO)
    folders = [path for _, path in date_folders(spark, root, cfg.start, cfg.last)]
    folders += [path for d in days["dates"] for _, path in date_folders(spark, root, d)]
    needed = (S.TIMESTAMP, S.CANAL, S.HOGAR, S.UNIVERSO)
    counts = layers.footer_counts(spark, root, S.BRONZE, S.BRONZE_PARTITIONS, folders=folders, not_null=needed)
    full = functools.reduce(lambda a, b: a & b, [F.col(f"n_{c}") == F.col("n_rows") for c in needed])
    lacking = [_folder(cfg, (S.ACEPTADO, r[S.FECHA], r[S.FECHA_LANDING])) for r in counts.filter(~full).collect()]
    if not lacking:
        return 0
    return silver_ops.incomplete_rows(spark.read.schema(S.BRONZE).option("basePath", root).parquet(*lacking)).count()


def run_silver(spark: SparkSession, cfg: PipelineConfig) -> dict[str, Any]:
    days = _dates(spark, cfg)
    bronze = layers.read_bronze(
        spark, cfg.bronze_root, **days, fail_if_missing=cfg.fail_if_missing and cfg.start_stage == "silver"
    )
    silver = silver_ops.clean(bronze, canal_filter=cfg.canal, procesado_en=cfg.procesado_en, cluster_for_write=True)
    sinks.write_silver(silver, cfg.silver_root)
    written = _written(spark, cfg, days, cfg.silver_root, S.SILVER, S.SILVER_PARTITIONS)
    return {**written, "excluded_null_rows": _excluded(spark, cfg, days)}


def _channels(cfg: PipelineConfig, dates: list[date]) -> list[str] | DataFrame | None:
    if isinstance(cfg.canales, DataFrame):
        return metrics.calendar(cfg.canales, min([cfg.start, *dates]), max([cfg.last, *dates]))
    return cfg.canales if cfg.canales is None else unique(cfg.canales)


def run_gold(spark: SparkSession, cfg: PipelineConfig) -> dict[str, Any]:
    days = _dates(spark, cfg)
    # Denominators need every channel of the date: the channel choice narrows the
    # report rows only, never this read, unless bitmaps hold the other channels.
    silver = layers.read_silver(
        spark,
        cfg.silver_root,
        **days,
        canal=cfg.canal if cfg.bitmap_root else None,
        fail_if_missing=cfg.fail_if_missing and cfg.start_stage == "gold",
    )
    if cfg.bitmap_root:
        bitmaps.refresh(spark, silver, cfg.bitmap_root)
        counts = bitmaps.counts(bitmaps.read_bitmaps(spark, cfg.bitmap_root, **days))
    else:
        counts = metrics.band_counts(silver)
    gold = metrics.gold_from_counts(
        counts,
        canales=_channels(cfg, days["dates"]),
        canal_filter=cfg.canal,
        procesado_en=cfg.procesado_en,
    )
    sinks.write_gold(gold, cfg.gold_root)
    return _written(spark, cfg, days, cfg.gold_root, S.GOLD, S.GOLD_PARTITIONS)


def out_of_range(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """Published records of the range's landing folders whose own date lies outside
    the range."""
    return _published(spark, cfg).filter(~_in_range(cfg))


def rejects(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """The rejected lines of the range's landing folders, in input order, with text,
    reason and position."""
    return validate.in_input_order(layers.read_rejects(spark, cfg.bronze_root, start=cfg.start, end=cfg.last))


def run_summary(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """Exact counts per date of the range: ``accepted`` and ``rejected`` by landing date,
    from the manifest; ``silver_rows`` and ``gold_rows`` by the records' date, from file
    footers; ``excluded_null_rows`` read from bronze."""
    counted = ("accepted", "rejected", "excluded_null_rows", "silver_rows", "gold_rows")
    zero = F.lit(0).cast("long")

    def count(df: DataFrame, day: str, name: str, n) -> DataFrame:
        return df.select(F.col(day).alias(S.FECHA), *[(n if c == name else zero).alias(c) for c in counted])

    manifest = layers.read_manifest(spark, cfg.bronze_root, cfg.start, cfg.last).filter("n_rows > 0")
    bronze = layers.read_bronze(spark, cfg.bronze_root, start=cfg.start, end=cfg.last)
    parts = [
        count(manifest.filter(F.col(S.RESULTADO) == outcome), S.FECHA_LANDING, name, F.col("n_rows"))
        for outcome, name in ((S.ACEPTADO, "accepted"), (S.RECHAZADO, "rejected"))
    ]
    parts.append(count(silver_ops.incomplete_rows(bronze), S.FECHA, "excluded_null_rows", F.lit(1).cast("long")))
    for root, schema, keys, name in (
        (cfg.silver_root, S.SILVER, S.SILVER_PARTITIONS, "silver_rows"),
        (cfg.gold_root, S.GOLD, S.GOLD_PARTITIONS, "gold_rows"),
    ):
        folders = [path for _, path in date_folders(spark, root, cfg.start, cfg.last)]
        layer = layers.footer_counts(spark, root, schema, keys, folders=folders)
        parts.append(count(layer, S.FECHA, name, F.col("n_rows")))
    rows = functools.reduce(DataFrame.unionAll, parts)
    return rows.groupBy(S.FECHA).agg(*[F.sum(c).alias(c) for c in counted])


def layer_summary(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """Per layer and date of the range: partitions, files and rows written (the
    per-date report of a run, from listings and footers of the layers)."""
    parts = []
    for name, root, schema, keys in layer_roots(cfg):
        inv = audit.inventory(spark, root, schema, keys).filter(_in_range(cfg))
        parts.append(
            inv.groupBy(S.FECHA).agg(
                F.count(F.lit(1)).alias("n_partitions"),
                F.sum("n_files").alias("n_files"),
                F.sum("n_rows").alias("n_rows"),
            ).select(F.lit(name).alias("layer"), S.FECHA, "n_partitions", "n_files", "n_rows")
        )
    return functools.reduce(DataFrame.unionByName, parts)


def layer_roots(cfg: PipelineConfig):
    """(name, folder, schema, partition columns) of the three layers."""
    return (
        ("bronze", layers.outcome_root(cfg.bronze_root, S.ACEPTADO), S.BRONZE, S.BRONZE_PARTITIONS),
        ("silver", cfg.silver_root, S.SILVER, S.SILVER_PARTITIONS),
        ("gold", cfg.gold_root, S.GOLD, S.GOLD_PARTITIONS),
    )


def run_pipeline(spark: SparkSession, cfg: PipelineConfig) -> PipelineResult:
    if cfg.start_stage not in STAGES:
        raise ValueError(f"start_stage must be one of {STAGES}")
    result = PipelineResult()
    first = STAGES.index(cfg.start_stage)
    if first <= 0:
        result.bronze = run_bronze(spark, cfg)
    if first <= 1:
        result.silver = run_silver(spark, cfg)
    result.gold = run_gold(spark, cfg)
    return result
