"""Filesystem helpers through Hadoop's FileSystem API (works for HDFS, object
stores and local paths alike, from the driver only: existence and one shallow
listing)."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date

from pyspark.sql import SparkSession

from sintonia import schemas as S

def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    hpath, fs = _filesystem(spark, path)
    return bool(fs.exists(hpath))


def delete_path(spark: SparkSession, path: str) -> None:
    hpath, fs = _filesystem(spark, path)
    fs.delete(hpath, True)


#: Fixed value: characters that are escaped in the names of partition folders.
_ESCAPED = "\"#%'*/:=?\\\x7f{[]^"


def partition_folder(root: str, partitions: Sequence[str], values: Sequence[str]) -> str:
    """Path of a partition by the texts of its values."""
    escape = lambda v: "".join(f"%{ord(c):02X}" if c in _ESCAPED or ord(c) < 0x20 else c for c in v)
    return "/".join([root.rstrip("/"), *[f"{k}={escape(v)}" for k, v in zip(partitions, values)]])


def date_folders(
    spark: SparkSession, root: str, start: date | str | None = None, end: date | str | None = None, column: str = S.FECHA
) -> list[tuple[date, str]]:
    """(date, path) of the ``fecha=`` folders right under ``root``, in date order,
    those in [start, end] only (``end`` defaults to ``start``; no start: all).  Lists
    one level, never what the folders hold."""
    hpath, fs = _filesystem(spark, root)
    if not fs.exists(hpath):
        return []
    low, high = (str(d) if d is not None else None for d in (start, end if end is not None else start))
    found = []
    for status in fs.listStatus(hpath):
        m = re.fullmatch(rf"{column}=(\d{{4}}-\d{{2}}-\d{{2}})", status.getPath().getName())
        if m and (low is None or low <= m[1] <= high):
            found.append((date.fromisoformat(m[1]), status.getPath().toString()))
    return sorted(found)
