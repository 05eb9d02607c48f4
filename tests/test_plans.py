"""Plan properties that keep the engine fit for large inputs."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sintonia.operators import clean, metrics, validate
from sintonia.plans import catalog
from sintonia.sources import layers, sinks
from tests.helpers import bronze_df, silver_df

SF = "/root/testdata/sf0.001"
WRITING = {
    "range_prune",
    "rewrite_replaces_partition",
    "two_run_compare",
    "landing_roundtrip",
    "resume_from_silver",
    "run_summary",
    "report_bound_parameter",
    "layer_counts",
    "rejects_in_order",
    "straggler_rebuild",
    "bitmap_audience",
    "bitmap_channel_rerun",
    "compacted_bronze",
    "run_row_differences",
    "catalog_range",
}
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF")


def _physical(df) -> str:
    """Prepared physical plan (exchanges included), before any execution."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - WRITING))
def test_no_python_udf_no_cross_product(spark, name):
    plan = _physical(catalog.QUERIES[name](spark, SF))
    assert not [f for f in FORBIDDEN if f in plan], plan


def test_validation_adds_no_shuffle(spark, lines):
    plan = _physical(validate.accepted(validate.judge(lines(['{"a": 1}']))))
    assert "Exchange" not in plan


def test_validation_stage_is_small_enough_to_be_compiled(spark, lines):
    """HotSpot compiles no method of over 8000 bytes of bytecode."""
    df = validate.accepted(validate.judge(lines([])))
    codegen = spark._jvm.org.apache.spark.sql.execution.debug.package
    text = codegen.codegenString(df._jdf.queryExecution().executedPlan())
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


def test_gold_reads_silver_once_with_pruning(spark, tmp_path):
    rows = [(f"h{i % 9}", f"C{i % 3}", datetime(2026, 8, 1 + i % 4, i % 24, i % 60), 10) for i in range(400)]
    s = silver_df(spark, rows)
    root = str(tmp_path / "silver")
    sinks.write_silver(clean.clean(s.select("timestamp", "canal", "id_hogar_panelista", "universo_total"), cluster_for_write=True), root)
    counts = metrics.band_counts(layers.read_silver(spark, root, start="2026-08-02", end="2026-08-03"))
    plan = _physical(counts)
    assert plan.count("FileScan") == 1
    read_schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "procesado_en" not in read_schema and "universo_total" in read_schema
    assert plan.count("Exchange") == 3  # fold to household hours, the two levels, the tiny count
    assert "lambdafunction" not in plan
    assert "partial_max" in plan  # map-side combine before the big shuffle


@pytest.mark.parametrize("kw", [dict(canales=["C0", "Dark"]), dict(canales=None), dict(canales=None, canal_filter="C1")])
def test_gold_is_one_linear_plan(spark, tmp_path, kw):
    rows = [(f"h{i % 9}", f"C{i % 3}", datetime(2026, 8, 1 + i % 4, i % 24, i % 60), 10) for i in range(400)]
    root = str(tmp_path / "silver")
    sinks.write_silver(
        clean.clean(silver_df(spark, rows).select("timestamp", "canal", "id_hogar_panelista", "universo_total"), cluster_for_write=True),
        root,
    )
    plan = _physical(metrics.gold_metrics(layers.read_silver(spark, root), **kw))
    assert plan.count("FileScan") == 1 and "Join" not in plan and "InMemoryRelation" not in plan
    assert plan.count("Exchange") == 5  # household hours, levels, band counts, hour maps, window by date


def test_gold_plan_does_not_grow_with_the_channel_list(spark):
    from tests.helpers import two_channel_silver

    silver = two_channel_silver(spark)
    nodes = lambda n: len(metrics.gold_metrics(silver, canales=[f"C{k}" for k in range(n)])._jdf.queryExecution().optimizedPlan().toString().splitlines())
    assert nodes(10) == nodes(1500)
    assert metrics.gold_metrics(silver, canales=[f"C{k}" for k in range(1500)]).count() == 1500 * 24


def test_hot_channel_is_cut_across_tasks(spark):
    """A channel with most rows is split by AQE over several write tasks.  Small
    advisory and minimum sizes stand in for a partition far above the target."""
    base = datetime(2026, 8, 1)
    rows = [(base + timedelta(minutes=i % 1440), "HOT" if i % 3 else f"C{i % 7}", f"h{i % 500}", 10) for i in range(6000)]
    df = clean.clean(bronze_df(spark, rows), cluster_for_write=True)
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    saved = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set(keys[0], "2k")
    spark.conf.set(keys[1], "1k")
    try:
        got = df.select(F.spark_partition_id().alias("p"), "*").collect()  # whole rows, as a write sees them
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    per_task = {}
    for r in got:
        if r.canal == "HOT":
            per_task[r.p] = per_task.get(r.p, 0) + 1
    assert len(per_task) >= 4 and max(per_task.values()) < 4000 * 0.5
