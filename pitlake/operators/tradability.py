"""Suspensions, price limits and what could be traded at the open."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.functions.predicates import listed_on
from pitlake.operators.prices import KEY
from pitlake.operators.securities import (
    NAME_COLUMNS,
    name_spans,
    names_asof,
    with_names,
)

BAR = ["open", "high", "low", "close"]
LIMITS = ["pre_close", "up_limit", "down_limit"]
# Facts are dealt by security and year; no market data is older.
BUCKET, FIRST_YEAR = "_year", 1990
FLAGS = [
    "open_at_up_limit", "open_at_down_limit", "locked_up_limit", "locked_down_limit",
    "can_buy_at_open", "can_sell_at_open",
]
CONSTRAINTS = [
    *KEY, "pre_close", "up_limit", "down_limit", "suspend_timing", "suspend_type",
    "is_suspended", "is_resumed", *BAR, *FLAGS,
]
STOCK_CONSTRAINTS = [
    *KEY, "symbol", *NAME_COLUMNS, "list_date", "delist_date", *CONSTRAINTS[2:],
]


def suspension_daily(suspend_d: DataFrame) -> DataFrame:
    """The events of a security on a day as one row; distinct times are kept on the map side."""
    times = F.sort_array(F.collect_set("suspend_timing"))
    suspended = F.coalesce(F.bool_or(F.col("suspend_type") == "S"), F.lit(False))
    resumed = F.coalesce(F.bool_or(F.col("suspend_type") == "R"), F.lit(False))
    return suspend_d.groupBy(*KEY).agg(
        times.alias("_times"), suspended.alias("is_suspended"), resumed.alias("is_resumed")
    ).select(
        *KEY,
        F.when(F.size("_times") > 0, F.array_join("_times", ";")).alias("suspend_timing"),
        F.when(F.col("is_suspended") & F.col("is_resumed"), "S,R")
        .when(F.col("is_suspended"), "S")
        .when(F.col("is_resumed"), "R")
        .alias("suspend_type"),
        "is_suspended",
        "is_resumed",
    )


def _year_of(day: str) -> str:
    """The year a fact or a span of time is dealt by; what lies before or after the known years is in the outer ones."""
    return f"least(greatest(year({day}), {FIRST_YEAR}), {date.today().year})"


def _years_of(start: str, stop: str) -> str:
    """Every year a span touches; an open span reaches the last one."""
    last = f"if({stop} is null, {date.today().year}, {_year_of(stop)})"
    return f"explode(sequence({_year_of(start)}, {last}))"


def trade_constraints(
    stk_limit: DataFrame, suspend_d: DataFrame, daily: DataFrame, bucketed: bool = False
) -> DataFrame:
    """Every security-day with a price limit or a suspension event, and its bar if there is one.

    Limits, events and bars are one union of narrow rows, dealt once by security and year and brought together by one
    aggregate on the key, which is unique in limits and bars; security-days with a bar alone are dropped. A filter
    on code or day reaches every scan. ``bucketed`` keeps the year, by which joins with spans
    of time find the rows already dealt. One text, so that the plan is analysed once.
    """
    # Events of a day combine before they are moved: any number of them may be of one security.
    keyed = suspend_d.where(F.col("ts_code").isNotNull() & F.col("trade_date").isNotNull())
    kinds = dict.fromkeys([*LIMITS, *BAR], "double") | {
        "is_suspended": "boolean", "is_resumed": "boolean", "_wanted": "boolean",
    }

    def tagged(table: str, given: list[str], wanted: bool) -> str:
        known = {name: name for name in given} | ({"_wanted": "true"} if wanted else {})
        values = [f"{known.get(name, f'cast(null as {kind})')} as {name}" for name, kind in kinds.items()]
        return f"select ts_code, trade_date, {_year_of('trade_date')} as {BUCKET}, {', '.join(values)} from {{{table}}}"

    union = " union all ".join([
        tagged("limits", LIMITS, True), tagged("events", ["is_suspended", "is_resumed"], True),
        tagged("bars", BAR, False),
    ])
    together = ", ".join(f"max({name}) as {name}" for name in kinds)
    kept = [*CONSTRAINTS, *([BUCKET] if bucketed else [])]
    # Numbers and flags alone are aggregated, by hash. Times are text and join afterwards, on a key
    # that begins as the rows are dealt; few event days have any.
    text = f"""
        with dealt as (select /*+ repartition(ts_code, {BUCKET}) */ * from ({union})),
        merged as (
          select ts_code, {BUCKET}, trade_date, {together} from dealt group by ts_code, {BUCKET}, trade_date),
        known as (
          select * except (is_suspended, is_resumed),
                 coalesce(is_suspended, false) as is_suspended, coalesce(is_resumed, false) as is_resumed
          from merged where _wanted),
        times as (
          select /*+ repartition(timed_code, timed_year) */ * from (
          select ts_code as timed_code, {_year_of("trade_date")} as timed_year, trade_date as timed_day, suspend_timing
          from {{events}} where suspend_timing is not null)),
        timed as (
          select known.*, suspend_timing from known
          left join times on ts_code = timed_code and {BUCKET} = timed_year and trade_date = timed_day),
        flagged as (
          select *,
                 case when is_suspended and is_resumed then 'S,R' when is_suspended then 'S' when is_resumed then 'R' end
                   as suspend_type,
                 open >= up_limit as open_at_up_limit, open <= down_limit as open_at_down_limit,
                 low >= up_limit as locked_up_limit, high <= down_limit as locked_down_limit,
                 if(is_suspended, false, open < up_limit) as can_buy_at_open,
                 if(is_suspended, false, open > down_limit) as can_sell_at_open
          from timed)
        select {", ".join(kept)} from flagged"""
    return daily.sparkSession.sql(text, limits=stk_limit, events=suspension_daily(keyed), bars=daily)


def stock_trade_constraints(
    constraints: DataFrame, stock_basic: DataFrame, namechange: DataFrame
) -> DataFrame:
    """Constraints of stocks while listed, with the name of that day.

    Spans of time are spread over the years they touch and join on security and year, as bucketed
    constraints are dealt; so no fact moves again, however large the masters are.
    """
    bucketed = BUCKET in constraints.columns
    year = f"facts.{BUCKET}" if bucketed else _year_of("facts.trade_date")
    stocks = ["symbol", "list_date", "delist_date"]
    shown = [
        "named.historical_name is not null as has_name_history" if name == "has_name_history"
        else f"named.{name}" if name in NAME_COLUMNS else f"stock.{name}" if name in stocks else f"facts.{name}"
        for name in STOCK_CONSTRAINTS
    ]
    text = f"""
        with stock as (
          select ts_code, {", ".join(stocks)}, {_years_of("list_date", "delist_date")} as {BUCKET}
          from {{stock_basic}} where list_date is not null),
        named as (
          select *, {_years_of("span_start", "span_stop")} as {BUCKET} from {{spans}} where span_start is not null)
        select {", ".join(shown)} from {{facts}} as facts
        join stock on stock.ts_code = facts.ts_code and stock.{BUCKET} = {year}
          and stock.list_date <= facts.trade_date
          and (stock.delist_date is null or facts.trade_date < stock.delist_date)
        left join named on named.ts_code = facts.ts_code and named.{BUCKET} = {year}
          and facts.trade_date >= named.span_start
          and (named.span_stop is null or facts.trade_date < named.span_stop)"""
    return constraints.sparkSession.sql(text, stock_basic=stock_basic, spans=name_spans(namechange), facts=constraints)


def stock_trade_constraints_asof(
    stk_limit: DataFrame,
    suspend_d: DataFrame,
    daily: DataFrame,
    stock_basic: DataFrame,
    namechange: DataFrame,
    as_of: date,
    codes: list[str] | None = None,
) -> DataFrame:
    """One day of ``stock_trade_constraints``.

    The day and the codes are applied to every input; the master tables are cut to that day, so their
    joins are plain equi-joins.
    """
    on_day = F.col("trade_date") == F.lit(as_of)

    def cut(rows: DataFrame) -> DataFrame:
        return rows if codes is None else rows.where(F.col("ts_code").isin(codes))

    constraints = trade_constraints(
        cut(stk_limit).where(on_day), cut(suspend_d).where(on_day), cut(daily).where(on_day)
    )
    listed = cut(stock_basic).where(
        listed_on(F.col("list_date"), F.col("delist_date"), as_of)
    ).select("ts_code", "symbol", "list_date", "delist_date")
    names = names_asof(cut(namechange), as_of)
    rows = constraints.join(listed, "ts_code").join(names, "ts_code", "left")
    return with_names(rows).select(*STOCK_CONSTRAINTS)
