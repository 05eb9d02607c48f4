from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from sintonia import schemas as S
from sintonia.operators import audit, metrics
from sintonia.sources import layers, sinks
from sintonia.sources.compaction import compact, crowded
from tests.helpers import silver_df


def _bronze(spark, n, splits, days):
    rows = spark.range(0, n, numPartitions=splits).select(
        F.expr(f"timestampadd(MINUTE, id % 1440, TIMESTAMP_NTZ'2027-03-01 00:00:00') + make_interval(0, 0, 0, id % {days})").alias(S.TIMESTAMP),
        F.lit("C").alias(S.CANAL),
        # a third of the rows are copies of one
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.sha2(F.col("id").cast("string"), 256)).alias(S.HOGAR),
        F.lit(5).cast("long").alias(S.UNIVERSO),
        F.lit(None).cast("timestamp_ntz").alias(S.PROCESADO_EN),
    )
    return rows.withColumn(S.FECHA, F.col(S.TIMESTAMP).cast("date"))


def _state(spark, root):
    inv = {r.fecha: (r.n_files, r.n_rows) for r in audit.inventory(spark, root, S.BRONZE, S.BRONZE_PARTITIONS).collect()}
    return inv, audit.layer_digest(layers.read_layer(spark, root, S.BRONZE)).collect()


def test_many_splits_become_one_file_a_partition(spark, tmp_path):
    bronze_root = str(tmp_path)
    sinks.write_bronze(_bronze(spark, 20_000, 200, 30), bronze_root)
    root = layers.outcome_root(bronze_root, S.ACEPTADO)
    before, digest = _state(spark, root)
    assert len(before) == 30 and all(files > 20 for files, _ in before.values())
    assert compact(spark, root, S.BRONZE, S.BRONZE_PARTITIONS, start=date(2027, 3, 4)) == 1
    after, _ = _state(spark, root)
    # the others keep their files
    assert after[date(2027, 3, 4)][0] == 1 and [k for k in after if after[k] != before[k]] == [date(2027, 3, 4)]
    assert compact(spark, root, S.BRONZE, S.BRONZE_PARTITIONS) == 29
    after, same = _state(spark, root)
    assert same == digest and {files for files, _ in after.values()} == {1}
    assert {k: n for k, (_, n) in after.items()} == {k: n for k, (_, n) in before.items()}
    assert compact(spark, root, S.BRONZE, S.BRONZE_PARTITIONS) == 0


def test_a_partition_over_the_target_keeps_several_even_files(spark, tmp_path):
    sinks.write_bronze(_bronze(spark, 30_000, 40, 1), str(tmp_path))
    root = layers.outcome_root(str(tmp_path), S.ACEPTADO)
    size = audit.inventory(spark, root, S.BRONZE, S.BRONZE_PARTITIONS).first().n_bytes
    assert crowded(spark, root, S.BRONZE, S.BRONZE_PARTITIONS, size // 4).first()["_files"] in (4, 5)
    compact(spark, root, S.BRONZE, S.BRONZE_PARTITIONS, target_bytes=size // 4)
    files = layers.read_layer(spark, root, S.BRONZE).groupBy(F.input_file_name()).count().collect()
    assert 2 <= len(files) <= 5 and sum(r["count"] for r in files) == 30_000
    # a row that repeats in a third of the partition is dealt like any other
    assert max(r["count"] for r in files) < 0.7 * 30_000


def test_channel_folders_with_escaped_names(spark, tmp_path):
    root, d = str(tmp_path / "gold"), datetime(2027, 3, 1, 10)
    gold = metrics.gold_metrics(silver_df(spark, [("h", "A/B: 50%", d, 10), ("h", "C=D", d, 10)]))
    gold.select(*S.GOLD_COLUMNS).repartition(5).write.partitionBy(*S.GOLD_PARTITIONS).parquet(root)
    assert compact(spark, root, S.GOLD, S.GOLD_PARTITIONS) == 2
    assert {(r.canal, r.n_files, r.n_rows) for r in audit.inventory(spark, root, S.GOLD).collect()} == {("A/B: 50%", 1, 24), ("C=D", 1, 24)}
    assert compact(spark, str(tmp_path / "none"), S.GOLD, S.GOLD_PARTITIONS) == 0
