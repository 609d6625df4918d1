"""What a sync reads and leaves: one look at the landing, staged rows, folders freed, the month of a snapshot."""

from __future__ import annotations

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from pitlake import SyncFailed
from pitlake.sources.datasets import DATASETS
from tests.conftest import values
from tests.test_physical_plans import plan_of
from tests.test_sync import D1, D2, D3, Landing, lake


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


def executions(spark):
    found = spark._jsparkSession.sharedState().statusStore().executionsList()
    return {found.apply(i).executionId(): found.apply(i).physicalPlanDescription() for i in range(found.size())}


def looks_at(spark, before, folder):
    """Plans run since that read files of a folder."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return [text for n, text in executions(spark).items() if n not in before and f"{folder}]" in text]


def put(spark, landing, name, rows, columns, folders):
    dataset = DATASETS[name]
    named = [*columns, *folders]
    full = [tuple(dict(zip(named, row, strict=True)).get(c) for c in [*dataset.columns, *folders]) for row in rows]
    text = ", ".join(f"`{c}` string" for c in [*dataset.columns, *folders])
    spark.createDataFrame(full, text).write.partitionBy(*folders).parquet(f"{landing.path}/{name}")


def test_plain_days_are_read_once(spark, landing):
    for day in (D1, D2, D3):
        landing.day("index_daily", day, [("I", "1"), ("J", "2")])
    market, before = lake(spark, landing), set(executions(spark))
    market.sync("index_daily", start=D1, end=D3)
    assert len(looks_at(spark, before, f"{landing.path}/index_daily")) == 1
    assert market.table("index_daily").count() == 6


def test_pages_with_exact_copies_are_read_once(spark, landing):
    """A copy that crosses a page's edge is one row; pages that begin alike are different; a page sent twice is none."""
    landing.calendar()
    rows = []
    for day, pages in ((D2, ["BA", "AC"]), (D3, ["AB", "BA"])):
        for page, codes in enumerate(pages):
            rows += [(code, f"{day:%Y%m%d}", "S", f"trade_date={day}", str(page)) for code in codes]
    put(spark, landing, "suspend_d", rows, ["ts_code", "trade_date", "suspend_type"], ["partition_id", "page"])
    listed = [(f"trade_date={day}", page, 2 * page, True) for day in (D2, D3) for page in range(3)]
    spark.createDataFrame(listed, "partition_id string, page int, page_offset long, has_columns boolean").write.parquet(
        f"{landing.path}/_pages/suspend_d"
    )
    market, before = lake(spark, landing), set(executions(spark))
    with pytest.raises(SyncFailed, match="pages") as failed:
        market.sync("suspend_d", start=D1, end=D3)
    assert values(failed.value.report.results, "partition_id status") == [(f"trade_date={D2}", "SUCCESS"), (f"trade_date={D3}", "FAILED")]
    assert values(market.table("suspend_d").orderBy("ts_code"), "ts_code") == [("A",), ("B",), ("C",)]
    assert values(market.status("suspend_d"), "row_count") == [(3,)]
    assert len(looks_at(spark, before, f"{landing.path}/suspend_d")) == 1


def test_variants_are_read_once(spark, landing):
    rows = [("A", "full", "L"), ("B", "full", "D"), (None, "full", "P")]
    put(spark, landing, "stock_basic", rows, ["ts_code"], ["partition_id", "variant"])
    market, before = lake(spark, landing), set(executions(spark))
    assert market.sync("stock_basic").completed == 1
    assert len(looks_at(spark, before, f"{landing.path}/stock_basic")) == 1
    assert values(market.table("stock_basic").orderBy("ts_code"), "ts_code") == [("A",), ("B",)]


def run_folders(market, name):
    return sorted(d for d, _, _ in os.walk(f"{market.lake.root}/tables/{name}") if "run_id=" in d)


def test_cleaning_leaves_what_is_in_force(spark, landing):
    landing.day("index_daily", D2, [("I", "1")])
    market = lake(spark, landing)
    market.sync("index_daily", start=D2)
    first = run_folders(market, "index_daily")
    landing.generation += 1
    landing.day("index_daily", D2, [("I", "2")])
    landing.day("index_daily", D3, [("I", "x")])
    market = lake(spark, landing)
    with pytest.raises(SyncFailed):
        market.sync("index_daily", start=D2, end=D3, refresh=True)
    assert len(run_folders(market, "index_daily")) == 3
    assert market.clean() >= 2
    left = run_folders(market, "index_daily")
    assert len(left) == 1 and left != first
    assert values(lake(spark, landing).index_bars(), "ts_code close") == [("I", 2.0)]
    assert market.clean() == 0
    assert not [d for d, _, files in os.walk(f"{market.lake.root}/meta/verdicts") if files]


def test_snapshot_reads_the_month_that_holds_it(spark, landing):
    columns = ["index_code", "con_code", "trade_date", "weight"]
    days = {"2023-12": ["20231229"], "2024-01": ["20240105", "20240131"], "2024-02": ["20240229"]}
    for month, found in days.items():
        landing.put("index_weight", f"index_code=I/month={month}", [("I", "A", d, "1.5") for d in found], columns)
    market = lake(spark, landing)
    market.sync("index_weight", start=date(2023, 12, 1), end=date(2024, 3, 31), index_codes=["I"])
    for day, expected, month in [
        (date(2024, 1, 20), date(2024, 1, 5), "2024-01"), (date(2024, 1, 31), date(2024, 1, 31), "2024-01"),
        (date(2024, 2, 10), date(2024, 1, 31), "2024-01"), (date(2024, 1, 2), date(2023, 12, 29), "2023-12"),
        (date(2024, 3, 15), date(2024, 2, 29), "2024-02"),
    ]:
        members = market.members("I", day)
        assert values(members, "con_code snapshot_date") == [("A", expected)]
        reads = [line for line in plan_of(members).splitlines() if "PartitionFilters" in line and "month" in line]
        assert reads and all(month in line for line in reads)
    assert values(market.members("I", date(2023, 11, 1))) == [] and values(market.members("J", D1)) == []
    assert market.members("I", D3).where(F.lit(True)).columns == ["index_code", "con_code", "snapshot_date", "weight"]
