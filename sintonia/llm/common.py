"""Helpers shared by the operators: table reads, tables in the shared scratch
folder, byte-level text helpers and connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sintonia.session import ensure_checkpoint_dir

#: ASCII white space; ``bytes.split()`` and ``bytes.strip()`` use exactly this set.
WHITE = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder all executors share (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the shared scratch folder and read again: cuts the
    lineage with files that outlive the executors, and fixes row ids."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a ``written`` table that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh(taken: Iterable[str], name: str) -> str:
    """``name``, lengthened until no column has it (names compare without case)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected edge list of longs: (``node``, ``root``)
    with ``root`` the smallest node reachable, for every node that has an edge.

    Alternating large-star and small-star rounds; each round is a group-by and a join
    on written tables, so a lost executor repeats one round at most, and a node with
    very many neighbours is never gathered: only its minimum is.
    """
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    cur = written(links, "edges")
    while not _stars(cur):
        # large-star: every larger neighbour of a node links to the node's minimum
        both = cur.unionAll(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "low")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large")
        # small-star: a node and its smaller neighbours link to the smallest of them
        low2 = written(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        to_least = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))
        small = large.join(low2, "u").select(to_least.alias("e")).select("e.*").where("u <> v").distinct()
        nxt = written(small, "edges")
        for old in (cur, low, large, low2):
            discard(old)
        cur = nxt
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)


def _stars(links: DataFrame) -> bool:
    """Whether every node has one link, to a node that has none."""
    rows, nodes = links.agg(F.count("*"), F.count_distinct("u")).first()
    return rows == nodes and not links.join(links.select(F.col("v").alias("u")), "u", "left_semi").head(1)


def runs(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of equal ``key`` from batches that are sorted by it.  Holds one run at a
    time, so the longest run bounds the memory."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for start, end in zip(edges, edges[1:]):
            if held and held[0].column(key)[0].as_py() != values[start]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)
