"""Order of day and code over equi-depth ranges: heavy days, missing days, later rows, equal code heads, NULLs."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from pitlake.operators import ordered as module
from pitlake.operators.ordered import numbered, ordered
from tests.test_physical_plans import plan_of

SCHEMA = "trade_date date, ts_code string, value int"
START = date(2024, 1, 1)


@pytest.fixture(autouse=True)
def small_ranges(monkeypatch):
    monkeypatch.setattr(module, "LEAST_ROWS", 10)
    monkeypatch.setattr(module, "SMALL_BYTES", 0)


def rows_of(name):
    rng = random.Random(name)
    codes = [f"{n:06d}.{rng.choice(['SZ', 'SH'])}" for n in range(400)]
    if name == "even":
        return [(START + timedelta(d), c, d) for d in range(20) for c in rng.sample(codes, 20)]
    if name == "one heavy day":
        few = [(START + timedelta(d), c, d) for d in (0, 1, 30, 31) for c in rng.sample(codes, 5)]
        return few + [(START + timedelta(9), c, 9) for c in codes]
    if name == "equal heads":
        return [(START, f"the same head {n:04d}", 0) for n in range(300)]
    if name == "nulls":
        return [(None, "b", 1), (None, "a", 2), (START, None, 3)] + [(START, c, 4) for c in codes]
    return []


def key(row):
    return (row[0] is not None, row[0] or START, row[1] is not None, row[1] or "")


@pytest.mark.parametrize("partitions", [1, 7, 64])
@pytest.mark.parametrize("name", ["even", "one heavy day", "equal heads", "nulls", "empty"])
def test_order(spark, name, partitions):
    rows = rows_of(name)
    random.Random(1).shuffle(rows)
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = ordered(table, table, partitions)
    assert [tuple(r) for r in found.collect()] == sorted(rows, key=key)
    assert [r.position for r in numbered(found).orderBy("position").collect()] == list(range(1, len(rows) + 1))
    assert {tuple(r)[:3] + (i,) for i, r in enumerate(sorted(rows, key=key), 1)} == {tuple(r) for r in numbered(found).collect()}


def test_ranges_are_of_equal_weight(spark):
    for name in ("even", "one heavy day"):
        table = spark.createDataFrame(rows_of(name), SCHEMA)
        sizes = [r["count"] for r in ordered(table, table, 8).groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and max(sizes) <= 1.5 * sum(sizes) / 8


def test_rows_that_came_after_the_count_are_in_order(spark):
    counted = spark.createDataFrame(rows_of("even"), SCHEMA)
    late = [(START - timedelta(5), "z", 0), (START + timedelta(90), "a", 0), (START + timedelta(3), "zz", 0)]
    rows = rows_of("even") + late
    found = ordered(spark.createDataFrame(rows, SCHEMA), counted, 8).collect()
    assert [tuple(r) for r in found] == sorted(rows, key=key)


def test_nothing_is_sampled(spark):
    table = spark.createDataFrame(rows_of("one heavy day"), SCHEMA)
    plan = plan_of(ordered(table, table, 8))
    assert "rangepartitioning" not in plan and "shufflepartitionidpassthrough" in plan


def test_small_results_are_not_counted(spark, monkeypatch):
    monkeypatch.setattr(module, "SMALL_BYTES", 32 << 20)
    monkeypatch.setattr(module, "range_id", None)
    days = "date_add(date'2024-01-01', cast(id * 7 % 31 as int)) as trade_date"
    table = spark.range(300).selectExpr(days, "cast(id as string) as ts_code", "cast(id as int) as value")
    found = [tuple(r) for r in ordered(table, table, 8).collect()]
    assert found == sorted(found, key=key) and len(found) == 300
