"""Operators against plain SQL on random tables full of gaps, ties, overlaps and NULLs."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import duckdb
import pyarrow as pa
import pytest

from pitlake import MarketLake
from pitlake.operators import panels, prices, securities, tradability
from pitlake.plans.ledger import LEDGER
from pitlake.sources.datasets import DATASETS
from workload import oracle

FIRST = date(2024, 1, 1)
CODES = [f"s{i}" for i in range(12)]
DAYS = [FIRST + timedelta(days=i) for i in range(30)]
ARROW = {"string": pa.string(), "date": pa.date32(), "double": pa.float64(), "tinyint": pa.int8(),
         "bigint": pa.int64(), "timestamp": pa.timestamp("us")}


def _maybe(rng, value, chance=0.15):
    return None if rng.random() < chance else value


def _price(rng):
    return _maybe(rng, float(rng.randrange(8, 14)))


def _daily_rows(rng, columns, keep=0.7):
    for code in CODES:
        for day in DAYS:
            if rng.random() < keep:
                yield {"ts_code": code, "trade_date": day, **{c: _price(rng) for c in columns}}


def _interval(rng):
    start = rng.randrange(-10, 30)
    end = None if rng.random() < 0.3 else FIRST + timedelta(days=start + rng.randrange(-1, 20))
    return FIRST + timedelta(days=start), end


def _random_tables(seed):
    rng = random.Random(seed)
    rows = {name: [] for name in DATASETS}
    for name in ("daily", "adj_factor", "daily_basic", "stk_limit", "index_daily", "index_dailybasic"):
        measures = [c for c in DATASETS[name].columns if c not in ("ts_code", "trade_date")]
        rows[name] = list(_daily_rows(rng, measures))
    for row in rows["adj_factor"]:
        row["adj_factor"] = rng.choice([None, 0.0, 1.0, 1.5, 2.0])
    for _ in range(200):
        rows["suspend_d"].append({
            "ts_code": rng.choice([*CODES, "fund"]), "trade_date": rng.choice(DAYS),
            "suspend_timing": rng.choice([None, "", "09:30", "10:00"]),
            "suspend_type": rng.choice(["S", "R", "X"]),
        })
    for code in CODES[:-2]:
        listed, gone = _interval(rng)
        rows["stock_basic"].append({
            "ts_code": code, "symbol": code, "name": code,
            "list_date": _maybe(rng, listed), "delist_date": gone,
        })
    for code in CODES:
        for start in rng.sample(range(-10, 30), rng.randrange(0, 6)):
            end = rng.choice([None, start - 1, start, start + 3, start + 15])
            rows["namechange"].append({
                "ts_code": code,
                "name": rng.choice([None, "best", "*ST x", "退x", "plain"]),
                "start_date": FIRST + timedelta(days=start),
                "end_date": None if end is None else FIRST + timedelta(days=end),
                "ann_date": _maybe(rng, FIRST), "change_reason": "r",
            })
        for l3_code in rng.sample(["a", "b", "c", "d"], rng.randrange(0, 4)):
            entered, left = _interval(rng)
            rows["index_member_all"].append({
                "ts_code": code, "l3_code": l3_code, "in_date": entered, "out_date": left,
            })
        for index_code in ("i", "j"):
            for day in rng.sample(DAYS, 2):
                rows["index_weight"].append({
                    "index_code": index_code, "con_code": code, "trade_date": day, "weight": 1.0,
                })
    for day in DAYS:
        if rng.random() < 0.95:
            rows["trade_cal"].append({
                "exchange": "SSE", "cal_date": day, "is_open": rng.choice([0, 1, 1]),
            })
        rows["trade_cal"].append({"exchange": "SZSE", "cal_date": day, "is_open": 1})
    commits = [
        {
            "dataset_id": f"tushare.{rng.choice(['index_daily', 'suspend_d', 'daily'])}",
            "partition_id": f"trade_date={day}", "partition_values": '{"trade_date":"%s"}' % day,
            "row_count": i, "run_id": f"r{i}", "committed_at": datetime(2024, 2, 1) + timedelta(hours=i),
        }
        for i, day in enumerate(rng.choices(DAYS, k=40))
    ]
    return rows, commits


def _arrow(schema, rows):
    return pa.table({
        field.name: pa.array([r.get(field.name) for r in rows], ARROW[field.dataType.simpleString()])
        for field in schema
    })


@pytest.fixture(scope="module", params=[1, 2, 3])
def both(request, spark):
    rows, commits = _random_tables(request.param)
    connection = duckdb.connect()
    tables = {}
    for name, dataset in DATASETS.items():
        connection.register(name, _arrow(dataset.schema, rows[name]))
        tuples = [tuple(row.get(c) for c in dataset.columns) for row in rows[name]]
        tables[name] = spark.createDataFrame(tuples, dataset.schema)
    connection.register("commits", _arrow(LEDGER, commits))
    tuples = [tuple(row[c] for c in LEDGER.fieldNames()) for row in commits]
    return tables, spark.createDataFrame(tuples, LEDGER), connection


def _same(frame, connection, body):
    found = connection.execute(f"with first as (select 1){body}")
    names = [column[0] for column in found.description]
    assert sorted(frame.columns) == sorted(names)
    expected = sorted(map(repr, found.fetchall()))
    assert sorted(repr(tuple(row)) for row in frame.select(*names).collect()) == expected
    assert expected


def test_adjusted_bars(both):
    t, _, sql = both
    bars = prices.daily_bar(t["daily"], t["adj_factor"])
    raw, anchors = oracle._factor_bars(), oracle._anchors()
    scaled = f"select {oracle._scaled(oracle.QFQ, oracle.ANCHOR)} {oracle.FROM_ANCHORED}"
    _same(prices.daily_bar_qfq_latest(t["daily"], t["adj_factor"]), sql, f"{raw}{anchors} {scaled}")
    _same(prices.daily_bar_hfq(bars), sql, f"{raw} select {oracle._scaled(oracle.HFQ)} from bars b")
    asof = prices.daily_bar_qfq_asof(t["daily"], t["adj_factor"], date(2024, 1, 20))
    _same(asof, sql, f"{oracle._asof} {scaled}")
    _same(
        panels.daily_panel(bars, t["daily_basic"]), sql,
        f"{raw} select {oracle._scaled(oracle.RAW)}{oracle.METRICS} from bars b {oracle.WITH_METRICS}",
    )


def test_status_and_universe(both):
    t, ledger, sql = both
    status = securities.security_status_asof(t["stock_basic"], t["namechange"], date(2024, 1, 15))
    _same(status, sql, f"{oracle._status('2024-01-15')} select * from status")
    members = securities.index_members_asof(t["index_weight"], "i", date(2024, 1, 20))
    _same(members, sql, f"{oracle._members('i', '2024-01-20')} select * from members")
    industry = securities.stock_industry_asof(t["index_member_all"], date(2024, 1, 10))
    _same(industry, sql, oracle._industry)


def test_constraints(both):
    t, _, sql = both
    _same(tradability.suspension_daily(t["suspend_d"]), sql, f"{oracle.ROLLUP} select * from rollup_day")
    rows = tradability.trade_constraints(t["stk_limit"], t["suspend_d"], t["daily"])
    _same(rows, sql, f"{oracle.CONSTRAINTS} select * from constraints_day")
    stocks = tradability.stock_trade_constraints(rows, t["stock_basic"], t["namechange"])
    _same(stocks, sql, f"{oracle.STOCKS} select * from stock_days")
    one = tradability.stock_trade_constraints_asof(
        *[t[n] for n in ("stk_limit", "suspend_d", "daily", "stock_basic", "namechange")],
        date(2024, 1, 15),
    )
    _same(one, sql, f"{oracle.STOCKS} select * from stock_days where trade_date = date '2024-01-15'")


def test_health(both, spark):
    from pitlake.plans.ledger import latest_commits

    t, ledger, sql = both
    for end in (date(2024, 1, 30), date(2024, 2, 2)):
        report = MarketLake(spark, tables=t, ledger=latest_commits(ledger)).health(
            start=FIRST, end=end
        )
        _same(report, sql, oracle._health(str(end)))
