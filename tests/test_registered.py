"""Every registered query of the library against its SQL oracle; those of training data have their own tests."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from workload.oracle import ORACLE
from workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in ("region", "nation", "customer", "orders", "events"):
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        return "nan" if isinstance(value, float) and math.isnan(value) else value

    return [columns[i] for i in order], sorted(
        (tuple(plain(row[i]) for i in order) for row in rows), key=repr
    )


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    frame = QUERIES[name](spark, SF_DIR)
    expected = oracle.execute(ORACLE[name])
    columns = [column[0] for column in expected.description]
    assert _rows(frame.columns, frame.collect()) == _rows(columns, expected.fetchall())
