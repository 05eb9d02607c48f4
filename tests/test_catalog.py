"""Every registered query against its DuckDB oracle on the smallest supplied
tables (row count, column names, order-insensitive values)."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from sintonia.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = ["events"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry_module.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    if name not in catalog.ORACLE:
        assert len(got) > 0
        return
    res = con.execute(catalog.ORACLE[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, got) == _rows(ocols, res.fetchall())


def test_entry_runs(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    assert "rating_pct" in df.columns
