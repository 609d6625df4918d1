"""Research queries on a small invented market; expectations are worked out by hand."""

from __future__ import annotations

from datetime import date, timedelta

import pytest

from pitlake import MarketLake
from pitlake.operators import prices, securities, tradability
from tests.conftest import values

# One week of May 2022. K1 splits three for two on Friday; K2's factor is lost after Wednesday; K3 has none at all.
WED, THU, FRI = date(2022, 5, 4), date(2022, 5, 5), date(2022, 5, 6)


def bar(code, day, low, close, high, volume=50.0):
    """A bar that opens at its low; change and percentage don't matter here."""
    return (code, day, low, high, low, close, low, close - low, 0.0, volume, volume * close)


@pytest.fixture(scope="module")
def bars(make):
    return {
        "daily": make(
            "daily",
            [
                bar("K1", WED, 28.5, 30.0, 31.5), bar("K1", THU, 30.0, 33.0, 36.0), bar("K1", FRI, 22.0, 24.0, 25.0, 75.0),
                bar("K2", WED, 7.5, 8.0, 8.5), bar("K2", THU, 8.0, 9.0, 9.5),
                bar("K3", FRI, 100.0, 101.0, 102.0),
            ],
        ),
        "adj_factor": make(
            "adj_factor", [("K1", WED, 3.0), ("K1", THU, 3.0), ("K1", FRI, 4.5), ("K2", WED, 0.5), ("K2", THU, None)]
        ),
        "daily_basic": make(
            "daily_basic", [("K1", THU, -1.0, 2.5, 14.0), ("K1", FRI, -1.0, 3.5, 15.0), ("K2", THU, -1.0, 0.25, None)],
            ["ts_code", "trade_date", "close", "turnover_rate", "pe"],
        ),
    }


@pytest.fixture(scope="module")
def market(spark, bars):
    return MarketLake(spark, tables=bars)


def test_backward_adjustment_scales_prices_alone(market):
    assert values(market.bars("K1", adjust="hfq"), "trade_date low close high vol adj_factor") == [
        (WED, 85.5, 90.0, 94.5, 50.0, 3.0), (THU, 90.0, 99.0, 108.0, 50.0, 3.0), (FRI, 99.0, 108.0, 112.5, 75.0, 4.5),
    ]
    assert values(market.bars("K1", adjust="hfq"), "amount") == values(market.bars("K1"), "amount")


def test_forward_adjustment_ends_at_the_traded_price(market):
    assert values(market.bars("K1", adjust="qfq"), "trade_date low close anchor_adj_factor") == [
        (WED, 19.0, 20.0, 4.5), (THU, 20.0, 22.0, 4.5), (FRI, 22.0, 24.0, 4.5),
    ]


def test_unadjusted_bars_carry_their_factor(market):
    assert values(market.bars(["K1", "K2"], end=THU), "trade_date ts_code close adj_factor") == [
        (WED, "K1", 30.0, 3.0), (WED, "K2", 8.0, 0.5), (THU, "K1", 33.0, 3.0), (THU, "K2", 9.0, None),
    ]


def test_latest_factor_is_the_last_known_one(bars):
    found = prices.latest_adj_factor(bars["adj_factor"]).orderBy("ts_code")
    assert values(found) == [("K1", FRI, 4.5), ("K2", WED, 0.5)]
    assert values(prices.latest_adj_factor(bars["adj_factor"], THU).where("ts_code = 'K1'")) == [("K1", THU, 3.0)]


def test_anchor_day_hides_what_came_later(market):
    seen = market.bars("K1", start=WED, end=FRI + timedelta(days=30), adjust="qfq", as_of=THU)
    assert values(seen, "trade_date close anchor_adj_factor") == [(WED, 30.0, 3.0), (THU, 33.0, 3.0)]


def test_a_narrow_range_keeps_the_anchor_of_the_whole_history(market):
    assert values(market.bars("K1", start=THU, end=THU, adjust="qfq"), "close anchor_adj_factor") == [(22.0, 4.5)]


def test_unknown_factors_give_unknown_prices(market):
    assert values(market.bars("K2", adjust="qfq"), "trade_date close adj_factor anchor_adj_factor") == [
        (WED, 8.0, 0.5, 0.5), (THU, None, None, 0.5),
    ]
    assert values(market.bars("K3"), "close adj_factor") == [(101.0, None)]
    assert values(market.bars("K3", adjust="hfq"), "close vol") == [(None, 50.0)]
    assert values(market.bars("K3", adjust="qfq"), "close anchor_adj_factor") == [(None, None)]


def test_zero_anchor_gives_unknown_price(make, bars):
    zero = make("adj_factor", [("K2", WED, 0.5), ("K2", THU, 0.0)])
    adjusted = prices.daily_bar_qfq_latest(bars["daily"], zero).where("ts_code = 'K2'")
    assert values(adjusted.orderBy("trade_date"), "close anchor_adj_factor") == [(None, 0.0)] * 2


def test_code_and_day_filters(market):
    assert values(market.bars(["K3", "K1"], start="2022-05-06"), "ts_code") == [("K1",), ("K3",)]
    assert values(market.bars(["K2"], start=FRI)) == []
    assert values(market.bars([])) == []
    assert len(values(market.bars())) == 6


def test_panel_joins_metrics_to_the_bar(market):
    columns = "trade_date close anchor_adj_factor turnover_rate pe"
    assert values(market.panel("K1", adjust="qfq"), columns) == [
        (WED, 20.0, 4.5, None, None), (THU, 22.0, 4.5, 2.5, 14.0), (FRI, 24.0, 4.5, 3.5, 15.0),
    ]
    assert values(market.panel("K1", start=THU, adjust="qfq", as_of=THU), columns) == [(THU, 33.0, 3.0, 2.5, 14.0)]
    assert values(market.panel("K1", start=FRI, adjust="hfq"), columns) == [(FRI, 108.0, None, 3.5, 15.0)]
    assert values(market.panel("K2", start=THU), columns) == [(THU, 9.0, None, 0.25, None)]


def test_column_sets(market):
    assert [len(market.bars(adjust=a).columns) for a in ("none", "hfq", "qfq")] == [12, 12, 13]
    assert {len(market.panel(adjust=a).columns) for a in ("none", "hfq", "qfq")} == {28}
    assert len(market.index_bars().columns) == 11
    assert len(market.index_panel().columns) == 21
    assert len(market.universe(WED).columns) == 15
    assert len(market.tradeability(WED).columns) == 30
    assert len(tradability.CONSTRAINTS) == 19
    assert len(market.health(start=WED, end=THU).columns) == 10


def test_arguments(market):
    for bad in (
        lambda: market.bars(adjust="split"),
        lambda: market.bars(as_of=WED),
        lambda: market.panel(start=FRI, end=WED),
        lambda: market.bars(["K1", None]),
        lambda: market.index_panel([""]),
        lambda: market.universe(WED, index_code=""),
        lambda: market.universe(WED, index_code=["BLUE"]),
        lambda: market.tradeability(WED, symbols=["K1", ""]),
        lambda: market.health(start=FRI, end=THU),
    ):
        with pytest.raises(ValueError):
            bad()
    with pytest.raises(KeyError):
        market.status("weather")


# A second market around Wednesday, 2021-09-15.
DAY = date(2021, 9, 15)
BEFORE = DAY - timedelta(days=1)
BLUE, GREEN = "BLUE", "GREEN"


@pytest.fixture(scope="module")
def point_in_time(make):
    return {
        "stock_basic": make(
            "stock_basic",
            [
                ("s1", "s-1", "Harbour", date(2005, 6, 30), None),
                ("s2", "s-2", "Quarry", date(2015, 2, 2), date(2021, 9, 16)),
                ("s3", "s-3", "Orchard", date(2021, 9, 15), None),
                ("s4", "s-4", "Foundry", date(2000, 1, 4), DAY),
                ("s5", "s-5", "Kiln", DAY + timedelta(days=1), None),
                ("s6", "s-6", "Unlisted", None, None),
            ],
            ["ts_code", "symbol", "name", "list_date", "delist_date"],
        ),
        "namechange": make(
            "namechange",
            [
                ("s1", "Harbour", date(2005, 6, 30), date(2018, 3, 1), date(2005, 6, 1), "listing"),
                ("s1", "*ST Harbour", date(2018, 3, 2), date(2019, 11, 10), date(2018, 2, 20), "*ST"),
                ("s1", "Harbour", date(2019, 11, 11), None, date(2019, 11, 1), "end of *ST"),
                ("s2", "ST Quarry", date(2020, 5, 6), None, date(2020, 4, 30), "ST"),
            ],
        ),
        "index_weight": make(
            "index_weight",
            [
                (BLUE, "s1", date(2021, 7, 30), 40.0), (BLUE, "s4", date(2021, 7, 30), 60.0),
                (BLUE, "s1", date(2021, 8, 31), 55.0), (BLUE, "s2", date(2021, 8, 31), 30.0), (BLUE, "s3", date(2021, 8, 31), 15.0),
                (BLUE, "s3", date(2021, 9, 30), 100.0), (GREEN, "s1", date(2021, 9, 10), 100.0),
            ],
        ),
        "index_member_all": make(
            "index_member_all",
            [
                ("T", "trade", "T1", "ports", "T1a", "sea ports", "s1", "Harbour", date(2016, 4, 1), DAY, "N"),
                ("T", "trade", "T2", "ships", "T2a", "ferries", "s1", "Harbour", DAY + timedelta(days=1), None, "Y"),
            ],
        ),
        "daily": make(
            "daily",
            [
                ("s1", DAY, 18.0, 18.4, 18.0, 18.2, 20.0, -1.8, -9.0, 5.0, 91.0),  # opens at its lower limit, then trades above
                ("s3", DAY, 44.0, 44.0, 44.0, 44.0, 40.0, 4.0, 10.0, 2.0, 88.0),  # stays at its upper limit
                ("fund", DAY, 1.5, 1.5, 1.5, 1.5, 1.5, 0.0, 0.0, 8.0, 12.0),
            ],
        ),
        "stk_limit": make(
            "stk_limit",
            [
                (date(2018, 6, 8), "s1", 7.0, 7.35, 6.65), (BEFORE, "s4", 3.0, 3.3, 2.7),
                (DAY, "s1", 20.0, 22.0, 18.0), (DAY, "s3", 40.0, 44.0, 36.0), (DAY, "s4", 2.7, 2.97, 2.43), (DAY, "fund", 1.5, 1.65, 1.35),
            ],
        ),
        "suspend_d": make("suspend_d", [("s2", DAY, "09:30-10:30", "S"), ("s3", DAY, None, "R")]),
    }


@pytest.fixture(scope="module")
def pit(spark, point_in_time):
    return MarketLake(spark, tables=point_in_time)


def test_name_in_force(point_in_time):
    for day, name, special in (
        (date(2018, 3, 1), "Harbour", False), (date(2018, 3, 2), "*ST Harbour", True),
        (date(2019, 11, 10), "*ST Harbour", True), (DAY, "Harbour", False),
    ):
        status = securities.security_status_asof(point_in_time["stock_basic"], point_in_time["namechange"], day)
        assert values(status.where("ts_code = 's1'"), "historical_name is_st is_delisting is_listed") == [
            (name, special, False, True)
        ]


def test_listing_starts_on_its_day_and_ends_before_the_last(point_in_time):
    status = securities.security_status_asof(point_in_time["stock_basic"], point_in_time["namechange"], DAY)
    assert values(status.orderBy("ts_code"), "ts_code is_listed has_name_history is_st") == [
        ("s1", True, True, False), ("s2", True, True, True), ("s3", True, False, None),
        ("s4", False, False, None), ("s5", False, False, None), ("s6", None, False, None),
    ]


def test_newest_snapshot_not_after_the_day(point_in_time):
    def members(code, day):
        found = securities.index_members_asof(point_in_time["index_weight"], code, day)
        return values(found.orderBy("con_code"), "con_code snapshot_date weight")

    august = date(2021, 8, 31)
    assert members(BLUE, DAY) == [("s1", august, 55.0), ("s2", august, 30.0), ("s3", august, 15.0)]
    assert members(BLUE, august) == members(BLUE, DAY)
    assert members(BLUE, august - timedelta(days=1)) == [("s1", date(2021, 7, 30), 40.0), ("s4", date(2021, 7, 30), 60.0)]
    assert members(GREEN, date(2021, 9, 9)) == []


def test_industry_changes_hands_over_night(point_in_time):
    def industry(day):
        return values(securities.stock_industry_asof(point_in_time["index_member_all"], day), "l2_name l3_name out_date")

    assert industry(DAY) == [("ports", "sea ports", DAY)]
    assert industry(DAY + timedelta(days=1)) == [("ships", "ferries", None)]
    assert industry(date(2016, 3, 31)) == []


def test_industry_ties(make):
    entered = date(2020, 1, 1)
    def row(code, l3, out):
        return ("L", "l", "M", "m", l3, l3, code, code, entered, out, "Y")
    table = make(
        "index_member_all",
        [
            row("a", "2", date(2025, 1, 1)), row("a", "3", None), row("a", "4", None),
            row("b", "2", date(2024, 6, 1)), row("b", "3", date(2025, 1, 1)),
        ],
    )
    chosen = securities.stock_industry_asof(table, date(2024, 1, 1)).orderBy("ts_code")
    assert values(chosen, "ts_code l3_code") == [("a", "3"), ("b", "3")]


def constraints(tables):
    return tradability.trade_constraints(tables["stk_limit"], tables["suspend_d"], tables["daily"])


def test_limits_and_halts_decide_what_can_trade(point_in_time):
    rows = constraints(point_in_time).where(f"trade_date = date'{DAY}'").orderBy("ts_code")
    assert values(rows, "ts_code suspend_type is_suspended is_resumed can_buy_at_open can_sell_at_open") == [
        ("fund", None, False, False, True, True),
        ("s1", None, False, False, True, False),
        ("s2", "S", True, False, False, False),
        ("s3", "R", False, True, False, True),
        ("s4", None, False, False, None, None),
    ]
    assert values(rows, "ts_code open_at_up_limit open_at_down_limit locked_up_limit locked_down_limit") == [
        ("fund", False, False, False, False),
        ("s1", False, True, False, False),
        ("s2", None, None, None, None),
        ("s3", True, False, True, False),
        ("s4", None, None, None, None),
    ]


def test_suspension_times_and_other_types(make):
    day = date(2024, 1, 2)
    rolled = tradability.suspension_daily(
        make(
            "suspend_d",
            [
                ("a", day, "10:00", "S"), ("a", day, "09:30", "S"), ("a", day, "10:00", "S"),
                ("b", day, None, "X"), ("c", day, "", "R"), ("d", day, None, "R"), ("d", day, None, "S"),
            ],
        )
    ).orderBy("ts_code")
    assert values(rolled, "ts_code suspend_timing suspend_type is_suspended is_resumed") == [
        ("a", "09:30;10:00", "S", True, False),
        ("b", None, None, False, False),
        ("c", "", "R", False, True),
        ("d", None, "S,R", True, True),
    ]


def test_stock_constraints_follow_the_listing(point_in_time):
    rows = tradability.stock_trade_constraints(
        constraints(point_in_time), point_in_time["stock_basic"], point_in_time["namechange"]
    ).orderBy("trade_date", "ts_code")
    assert values(rows, "trade_date ts_code suspend_type historical_name is_st") == [
        (date(2018, 6, 8), "s1", None, "*ST Harbour", True),
        (BEFORE, "s4", None, None, None),
        (DAY, "s1", None, "Harbour", False),
        (DAY, "s2", "S", "ST Quarry", True),
        (DAY, "s3", "R", None, None),
    ]


def test_tradeability(pit):
    assert values(pit.tradeability(DAY), "ts_code is_suspended can_buy_at_open can_sell_at_open") == [
        ("s1", False, True, False), ("s2", True, False, False), ("s3", False, False, True),
    ]
    assert values(pit.tradeability(DAY, symbols=["s3", "fund"]), "ts_code") == [("s3",)]
    assert values(pit.tradeability(BEFORE), "ts_code") == [("s4",)]
    assert values(pit.tradeability(DAY, symbols=[])) == []


def test_universe(pit):
    assert values(pit.universe(DAY), "ts_code historical_name is_st index_code") == [
        ("s1", "Harbour", False, None), ("s2", "ST Quarry", True, None), ("s3", None, None, None),
    ]
    assert values(pit.universe(DAY, index_code=BLUE), "ts_code snapshot_date weight") == [
        ("s1", date(2021, 8, 31), 55.0), ("s2", date(2021, 8, 31), 30.0), ("s3", date(2021, 8, 31), 15.0),
    ]
    # A security without names isn't known to be free of special treatment.
    assert values(pit.universe(DAY, exclude_st=True), "ts_code") == [("s1",)]
    assert values(pit.universe(DAY, index_code=GREEN, exclude_delisting=True), "ts_code weight") == [("s1", 100.0)]


def test_index_panel_keeps_bars_without_metrics(spark, make):
    market = MarketLake(
        spark,
        tables={
            "index_basic": make("index_basic", [(BLUE, "Blue", "the large ones"), (GREEN, "Green", None)], ["ts_code", "name", "desc"]),
            "index_daily": make(
                "index_daily", [(GREEN, WED, 810.5), (BLUE, THU, 2040.0), (BLUE, WED, 2010.0)], ["ts_code", "trade_date", "close"]
            ),
            "index_dailybasic": make(
                "index_dailybasic", [(BLUE, THU, 9e11, 17.5), (BLUE, FRI, 9e11, 17.0)], ["ts_code", "trade_date", "total_mv", "pe"]
            ),
        },
    )
    assert values(market.sql("select ts_code, description from indices_basic order by 1")) == [
        (BLUE, "the large ones"), (GREEN, None),
    ]
    assert values(market.index_bars(BLUE, end=WED), "ts_code trade_date close") == [(BLUE, WED, 2010.0)]
    assert values(market.index_bars([])) == []
    assert values(market.index_panel([BLUE, GREEN]), "trade_date ts_code close total_mv pe") == [
        (WED, BLUE, 2010.0, None, None), (WED, GREEN, 810.5, None, None), (THU, BLUE, 2040.0, 9e11, 17.5),
    ]


def test_sql_names(spark, pit, market):
    day = f"date'{DAY}'"
    assert values(pit.sql(f"select ts_code from market_stock_trade_constraints_asof({day}) order by 1")) == [
        ("s1",), ("s2",), ("s3",),
    ]
    assert values(pit.sql("select con_code from indices_members_asof('BLUE', :d) order by 1", d=DAY)) == [
        ("s1",), ("s2",), ("s3",),
    ]
    assert values(pit.sql(f"select ts_code, l3_code from indices_stock_industry_asof({day})")) == [("s1", "T1a")]
    assert values(pit.sql(f"select is_listed from market_security_status_asof({day}) where ts_code = 's4'")) == [(False,)]
    assert values(
        market.sql("select close, anchor_adj_factor from market_daily_bar_qfq_asof(:d) where ts_code = 'K1' order by trade_date", d=THU)
    ) == [(30.0, 3.0), (33.0, 3.0)]
    assert values(market.sql("select count(*) from tushare_daily")) == [(6,)]


def test_every_sql_name_resolves(spark, pit):
    from pitlake import catalog

    catalog.register(pit)
    for name in catalog.VIEWS:
        assert spark.table(name).columns


def test_two_part_names(market, pit):
    assert values(market.sql("SELECT max(b.close) FROM market.daily_bar AS b WHERE b.ts_code = 'K1'")) == [(33.0,)]
    rows = pit.sql(
        f"select ts_code, 'market.daily_bar' as text from market.stock_trade_constraints_asof(date'{DAY}') where ts_code > 's1' order by 1"
    )
    assert values(rows) == [("s2", "market.daily_bar"), ("s3", "market.daily_bar")]
    assert values(pit.sql("select count(*) from meta.partitions where dataset_id = 'tushare.daily'")) == [(0,)]
