from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sintonia.session import local_session  # noqa: E402

PROCESADO_EN = "2026-08-06 12:00:00"
UNIVERSO = 100_000


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="sintonia-tests")
    yield s


@pytest.fixture
def lines(spark):
    """DataFrame of JSON lines from Python dicts/strings (an in-memory batch)."""
    import json

    def make(records):
        rows = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
        return spark.createDataFrame(rows, "value string")

    return make
