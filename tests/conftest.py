from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from doclake.schema import CAPTURE_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="doclake-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def column(spark):
    """Values of one expression over a one-column table of strings or bytes."""

    def values(expression, rows, kind="string"):
        frame = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {kind}")
        return [r[0] for r in frame.orderBy("i").select(expression).collect()]

    return values


@pytest.fixture
def capture(spark):
    """Captures from short dicts; everything not given has a plain value."""

    def build(*rows):
        plain = {
            "body": "Tribunal",
            "identifier": "T-1",
            "title": "T-1",
            "description": "Parties",
            "date": "2024-01-30",
            "document_url": "https://example.test/t-1.html",
            "source_url": "https://example.test/t-1.html",
            "partition_date": "2024-01-01",
            "partition": "2024-01-01/2024-02-01",
            "status": 200,
            "content_type": "text/html; charset=utf-8",
            "payload": b"<html>decision</html>",
        }
        names = CAPTURE_SCHEMA.names
        filled = [{**plain, "fetch_seq": i, **row} for i, row in enumerate(rows)]
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in filled], CAPTURE_SCHEMA)

    return build
