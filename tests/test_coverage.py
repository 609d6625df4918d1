"""The coverage audit over a weekend: Thursday, Friday and Monday are open."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest

from pitlake import MarketLake
from pitlake.plans.ledger import LEDGER
from tests.conftest import values

THU, FRI, SAT, SUN, MON, TUE = (date(2019, 3, 7) + timedelta(days=n) for n in range(6))
COLUMNS = (
    "dataset_id status expected_days available_days missing_days unmatched_daily_rows row_count"
)


@pytest.fixture(scope="module")
def tables(make):
    calendar = [("SSE", day, 0 if day in (SAT, SUN) else 1) for day in (THU, FRI, SAT, SUN, MON)]
    return {
        "stock_basic": make("stock_basic", [("P", date(1999, 1, 4)), ("R", None)], ["ts_code", "list_date"]),
        "trade_cal": make("trade_cal", [*calendar, ("SZSE", TUE, 1)], ["exchange", "cal_date", "is_open"]),
        "daily": make(
            "daily", [("P", THU, 2.0), ("P", FRI, 2.5), ("P", MON, 2.25), ("R", THU, 60.0), ("R", MON, 61.0)],
            ["ts_code", "trade_date", "close"],
        ),
        "adj_factor": make("adj_factor", [("P", THU, 1.5), ("P", FRI, 1.5), ("P", MON, 1.5), ("R", THU, 1.0)]),
        "daily_basic": make(
            "daily_basic", [("P", THU, 8.0), ("P", MON, 8.5), ("R", MON, 30.0)], ["ts_code", "trade_date", "pe"]
        ),
        "stk_limit": make(
            "stk_limit", [("P", THU, 2.2), ("R", FRI, 66.0), ("P", SAT, 2.75), ("P", MON, 2.75)],
            ["ts_code", "trade_date", "up_limit"],
        ),
        "suspend_d": make("suspend_d", [("R", FRI, None, "S")]),
        "index_daily": make(
            "index_daily", [("BLUE", THU, 900.0), ("BLUE", FRI, 905.0), ("GULF", SUN, 77.0)], ["ts_code", "trade_date", "close"]
        ),
    }


def test_days_and_bars_that_lack_their_match(spark, tables):
    report = MarketLake(spark, tables=tables).health(start=THU, end=MON)
    empty = ("EMPTY", None, None, 0, None, 0)
    assert values(report, COLUMNS) == [
        ("tushare.stock_basic", "HEALTHY", None, None, 0, None, 2),
        ("tushare.namechange", *empty),
        ("tushare.index_basic", *empty),
        ("tushare.index_classify", *empty),
        ("tushare.index_member_all", *empty),
        ("tushare.trade_cal", "HEALTHY", 5, 5, 0, None, 5),
        ("tushare.daily", "HEALTHY", 3, 3, 0, None, 5),
        ("tushare.adj_factor", "INCOMPLETE", 3, 3, 0, 1, 4),
        ("tushare.daily_basic", "INCOMPLETE", 3, 2, 1, 2, 3),
        ("tushare.index_daily", "INCOMPLETE", 5, 3, 2, None, 3),
        ("tushare.index_dailybasic", "INCOMPLETE", 3, 0, 3, None, 0),
        ("tushare.suspend_d", "INCOMPLETE", 3, 1, 2, None, 1),
        ("tushare.stk_limit", "HEALTHY", 3, 3, 0, None, 4),
        ("tushare.index_weight", *empty),
    ]


def test_a_day_the_calendar_lacks_is_not_held_against_index_bars(spark, tables):
    report = MarketLake(spark, tables=tables).health(start=THU, end=TUE)
    status = dict(values(report, "dataset_id status"))
    assert status["tushare.trade_cal"] == "INCOMPLETE"
    assert {status[f"tushare.{name}"] for name in ("daily", "adj_factor", "daily_basic", "stk_limit", "suspend_d")} == {
        "CALENDAR_INCOMPLETE"
    }
    assert status["tushare.index_daily"] == "INCOMPLETE"
    assert status["tushare.stock_basic"] == "HEALTHY"
    assert status["tushare.index_basic"] == "EMPTY"


def test_committed_empty_days_count_for_event_tables(spark, tables):
    evening = datetime(2019, 3, 11, 20)

    def commit(name, day, hour):
        values_of = '{"trade_date":"%s"}' % day
        return (f"tushare.{name}", f"trade_date={day}", values_of, 0, "run", evening + timedelta(hours=hour))

    commits = [
        commit("suspend_d", THU, 0), commit("suspend_d", SAT, 2), commit("suspend_d", MON, 1), commit("suspend_d", "soon", 0),
        commit("index_daily", SAT, 0), commit("index_daily", MON, 3), commit("daily_basic", FRI, 0),
    ]
    ledger = spark.createDataFrame(commits, LEDGER)
    rows = values(
        MarketLake(spark, tables=tables, ledger=ledger).health(start=THU, end=MON),
        "dataset_id status available_days row_count first_date last_committed_at",
    )
    found = {row[0]: row[1:] for row in rows}
    assert found["tushare.suspend_d"] == ("HEALTHY", 3, 1, FRI, evening + timedelta(hours=2))
    assert found["tushare.index_daily"] == ("HEALTHY", 5, 3, THU, evening + timedelta(hours=3))
    assert found["tushare.daily_basic"] == ("INCOMPLETE", 2, 3, THU, evening)


def test_rows_on_closed_days_count_as_rows_only(spark, make, tables):
    holiday = [("SSE", day, 1 if day in (THU, MON) else 0) for day in (THU, FRI, SAT, SUN, MON)]
    closed = {**tables, "trade_cal": make("trade_cal", holiday, ["exchange", "cal_date", "is_open"])}
    report = values(MarketLake(spark, tables=closed).health(start=THU, end=MON), COLUMNS)
    assert ("tushare.daily", "HEALTHY", 2, 2, 0, None, 5) in report
    assert ("tushare.suspend_d", "INCOMPLETE", 2, 0, 2, None, 1) in report
