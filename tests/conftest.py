from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pitlake.session import SETTINGS  # noqa: E402
from pitlake.sources.datasets import DATASETS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[8]").appName("tests")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = (
        builder.config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """``make(dataset, rows, columns)``: a typed table; columns not named are NULL."""

    def build(name, rows, columns=None):
        schema = DATASETS[name].schema
        named = [dict(zip(columns or schema.fieldNames(), row, strict=True)) for row in rows]
        full = [tuple(row.get(field) for field in schema.fieldNames()) for row in named]
        return spark.createDataFrame(full, schema)

    return build


def values(frame, columns=None):
    """Rows as plain tuples, in the frame's own order."""
    return [tuple(row) for row in (frame.select(*columns.split()) if columns else frame).collect()]
