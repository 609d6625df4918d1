"""What the plans read and move: pushed filters, read columns, pruned folders, exchanges."""

from __future__ import annotations

import contextlib
import io
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from pitlake import MarketLake
from pitlake.operators import panels, prices, tradability
from pitlake.sources.datasets import DATASETS
from pitlake.sources.lake import Lake

DAY = date(2024, 1, 15)


def plan_of(frame) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain("formatted")
    return text.getvalue()


def scans(plan: str) -> list[str]:
    """The details of each file scan."""
    return re.findall(r"\(\d+\) Scan parquet.*?(?=\n\n)", plan, flags=re.S)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    for name, dataset in DATASETS.items():
        row = [
            {"string": "'a'", "date": "date'2024-01-15'", "double": "1d", "tinyint": "1Y"}[
                field.dataType.simpleString()
            ] + f" as `{field.name}`"
            for field in dataset.schema
        ]
        spark.range(1).selectExpr(*row).write.parquet(f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in DATASETS}


@pytest.fixture
def shuffled(spark):
    """Broadcasting switched off, so that plans look as they do for large tables."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_filters_above_the_constraints_reach_every_scan(tables):
    rows = tradability.trade_constraints(tables["stk_limit"], tables["suspend_d"], tables["daily"])
    found = scans(plan_of(rows.where((F.col("trade_date") == DAY) & (F.col("ts_code") == "a"))))
    assert len(found) == 4
    for scan in found:
        assert "EqualTo(trade_date,2024-01-15)" in scan and "EqualTo(ts_code,a)" in scan


def test_one_day_of_stock_constraints_reads_one_day(spark, tables):
    plan = plan_of(MarketLake(spark, tables=tables).tradeability(DAY, symbols=["a"]))
    for scan in scans(plan):
        assert "ts_code" in re.search(r"PushedFilters: (.*)", scan)[1]
        if "trade_date" in scan:
            assert "EqualTo(trade_date,2024-01-15)" in scan


def test_bars_read_only_what_is_selected(spark, tables):
    market = MarketLake(spark, tables=tables)
    plan = plan_of(market.bars(["a"], start=DAY, end=DAY, adjust="hfq").select("ts_code", "close"))
    schemas = [re.search(r"ReadSchema: (.*)", scan)[1] for scan in scans(plan)]
    assert sorted(schemas) == [
        "struct<ts_code:string,trade_date:date,adj_factor:double>",
        "struct<ts_code:string,trade_date:date,close:double>",
    ]
    assert all("trade_date" in re.search(r"PushedFilters: (.*)", s)[1] for s in scans(plan))


def test_anchor_sees_the_whole_history(spark, tables):
    plan = plan_of(MarketLake(spark, tables=tables).bars(start=DAY, adjust="qfq"))
    factor_scans = [scan for scan in scans(plan) if "adj_factor:double" in scan]
    unbounded = [scan for scan in factor_scans if "GreaterThanOrEqual" not in scan]
    assert len(factor_scans) == 2 and len(unbounded) == 1


def exchanges(plan: str) -> list[str]:
    """Partitioning columns of each exchange of the plan."""
    found = re.findall(r"hashpartitioning\(([^)]*?), \d+\)", plan)
    return [re.sub(r"#\d+L?", "", columns) for columns in found]


def test_panel_shuffles_each_table_once(shuffled, tables):
    bars = prices.daily_bar(tables["daily"], tables["adj_factor"])
    assert exchanges(plan_of(panels.daily_panel(bars, tables["daily_basic"]))) == [
        "ts_code, trade_date"
    ] * 3


def test_constraints_deal_every_table_once(shuffled, tables):
    rows = tradability.trade_constraints(tables["stk_limit"], tables["suspend_d"], tables["daily"])
    plan = plan_of(rows)
    # Limits, bars and event days together, and the times; events combine by key before (named twice).
    assert sorted(exchanges(plan)) == ["timed_code, timed_year", "ts_code, _year", "ts_code, trade_date", "ts_code, trade_date"]
    assert plan.count("SortMergeJoin") <= 2 and "FullOuter" not in plan
    limit_scans = [scan for scan in scans(plan) if "up_limit" in scan]
    assert len(limit_scans) == 1


def test_stock_constraints_move_facts_once(shuffled, tables):
    """Masters of any size meet the constraints where those already are."""
    constraints = tradability.trade_constraints(
        tables["stk_limit"], tables["suspend_d"], tables["daily"], bucketed=True
    )
    rows = tradability.stock_trade_constraints(constraints, tables["stock_basic"], tables["namechange"])
    before, after = exchanges(plan_of(constraints)), exchanges(plan_of(rows))
    for each in before:
        after.remove(each)
    # Listings and name spans come to the facts; names were gathered by security first.
    assert sorted(after) == ["ts_code", "ts_code, _year", "ts_code, _year"]


def test_health_reads_every_dataset_once(shuffled, spark, tables):
    plan = plan_of(MarketLake(spark, tables=tables).health(start=DAY, end=DAY))
    assert len(scans(plan)) == len(DATASETS)
    assert "LeftAnti" not in plan and "Join" not in plan


def test_committed_reads_prune_folders(spark, tables, tmp_path):
    lake = Lake(spark, str(tmp_path))
    for name in ("daily", "adj_factor"):
        tables[name].withColumn("run_id", F.lit("r")).write.partitionBy(
            "trade_date", "run_id"
        ).parquet(lake.path("tables", name))
    spark.createDataFrame(
        [(f"tushare.{n}", "trade_date=2024-01-15", "{}", 1, "r", None) for n in ("daily", "adj_factor")],
        lake.ledger().schema,
    ).write.parquet(lake.path("meta", "ledger"))
    market = MarketLake(spark, str(tmp_path))
    plan = plan_of(market.bars(["a"], start=DAY, end=DAY))
    data = [scan for scan in scans(plan) if "run_id" in scan and "dataset_id" not in scan]
    assert data
    for scan in data:
        folders = re.search(r"PartitionFilters: (.*)", scan)[1]
        assert "trade_date" in folders and "dynamicpruning" in folders
        assert "In(ts_code, [a])" in scan or "EqualTo(ts_code,a)" in scan


def test_filters_above_the_panel_reach_every_scan(spark, tables):
    market = MarketLake(spark, tables=tables)
    rows = market.sql(
        "select * from market.daily_panel where trade_date = :d and ts_code = 'a'", d=DAY
    )
    found = scans(plan_of(rows))
    assert len(found) == 3
    for scan in found:
        assert "EqualTo(trade_date,2024-01-15)" in scan and "EqualTo(ts_code,a)" in scan


def test_table_function_argument_is_pushed_down(spark, tables):
    market = MarketLake(spark, tables=tables)
    rows = market.sql("select * from market.stock_trade_constraints_asof(:d)", d=DAY)
    dated = [scan for scan in scans(plan_of(rows)) if "trade_date" in scan]
    assert len(dated) == 4
    assert all("EqualTo(trade_date,2024-01-15)" in scan for scan in dated)


def test_anchors_are_never_broadcast_by_force(shuffled, spark, tables):
    """Not for listed codes either: a list has no bound, only a measured size decides."""
    market = MarketLake(spark, tables=tables)
    assert "BroadcastHashJoin" not in plan_of(market.bars(["a"], adjust="qfq"))
    assert "BroadcastHashJoin" not in plan_of(market.bars(adjust="qfq"))


def test_ordered_queries_sample_nothing(spark, tables):
    market = MarketLake(spark, tables=tables)
    for rows in (market.bars(adjust="qfq"), market.panel(), market.index_bars(), market.index_panel()):
        assert "rangepartitioning" not in plan_of(rows)
