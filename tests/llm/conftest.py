from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) tuples, with further
    columns whose names clash with those the operators make."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for name in ("kept", "size", "digest", "rank", "copies", "bucket", "n", "h", "rid", "length", "piece", "set_hash", "node"):
            df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make


@pytest.fixture
def sample(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
