"""Properties that hold for any data, on the tables derived from the smallest test data."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from pitlake import MarketLake
from pitlake.operators import tradability
from workload.derived import Derived

DAY = date(2024, 1, 15)


@pytest.fixture(scope="module")
def market(spark):
    return MarketLake(spark, tables=Derived(spark, "/root/testdata/sf0.001").tables)


def test_backward_prices_are_forward_prices_times_the_anchor(market):
    key = ["ts_code", "trade_date"]
    hfq = market.bars(adjust="hfq").select(*key, F.col("close").alias("hfq"))
    both = market.bars(adjust="qfq").join(hfq, key)
    off = F.abs(F.col("hfq") - F.col("close") * F.col("anchor_adj_factor")) > 1e-9
    assert both.count() == market.table("daily").count()
    assert both.where(off | (F.col("hfq").isNull() != F.col("close").isNull())).count() == 0


def test_asof_today_equals_latest(market):
    latest = market.bars(adjust="qfq")
    asof = market.bars(adjust="qfq", as_of="2024-12-31")
    assert latest.exceptAll(asof).count() == asof.exceptAll(latest).count() == 0


def test_asof_sees_no_later_bars(market):
    assert market.bars(adjust="qfq", as_of=DAY).where(F.col("trade_date") > DAY).count() == 0


def test_stock_constraints_have_one_row_per_security_day(market):
    t = market.table
    rows = tradability.stock_trade_constraints(
        tradability.trade_constraints(t("stk_limit"), t("suspend_d"), t("daily")),
        t("stock_basic"), t("namechange"),
    )
    assert rows.count() == rows.select("ts_code", "trade_date").distinct().count()
    one_day = rows.where(F.col("trade_date") == DAY)
    asked = market.tradeability(DAY)
    assert asked.exceptAll(one_day).count() == one_day.exceptAll(asked).count() == 0


def test_exclusions_shrink_the_universe(market):
    everyone = market.universe(DAY).select("ts_code")
    strict = market.universe(DAY, exclude_st=True, exclude_delisting=True).select("ts_code")
    members = market.universe(DAY, index_code="click").select("ts_code")
    assert strict.exceptAll(everyone).count() == 0
    assert members.exceptAll(everyone).count() == 0
    assert 0 < strict.count() < everyone.count()


def test_panel_keeps_every_bar(market):
    assert market.panel(adjust="qfq").count() == market.bars().count()
    assert market.index_panel().count() == market.index_bars().count()


def test_audit_never_misses_a_negative_number_of_days(market):
    rows = market.health(start="2024-01-01", end="2024-02-15").collect()
    assert len(rows) == 14
    assert all(row.missing_days >= 0 for row in rows)
