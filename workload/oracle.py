"""The same queries in DuckDB SQL, written independently of the Spark code."""

from __future__ import annotations

from pitlake.sources.datasets import DATASETS
from workload.derived import ctes
from workload.queries import SOME_CODES

ORACLE: dict[str, str] = {}


def oracle(name: str, tables: str, body: str) -> None:
    ORACLE[name] = f"{ctes(*tables.split())}{body}" if tables else body


for _name in DATASETS:
    _columns = ", ".join(f'"{column}"' for column in DATASETS[_name].columns)
    oracle(f"scan_{_name}", _name, f"\nselect {_columns} from {_name}")

CODES = ", ".join(f"'{code}'" for code in SOME_CODES)
PRICES = ["open", "high", "low", "close", "pre_close", "change"]


def _factor_bars(where: str = "true") -> str:
    return f""", bars as (
  select d.*, f.adj_factor from daily d left join adj_factor f
    on f.ts_code = d.ts_code and f.trade_date = d.trade_date where {where})"""


def _anchors(where: str = "true") -> str:
    return f""", anchors as (
  select ts_code, adj_factor as anchor_adj_factor from adj_factor
  where {where} and adj_factor is not null
  qualify row_number() over (partition by ts_code order by trade_date desc) = 1)"""


def _scaled(expression: str, extra: str = "") -> str:
    prices = ", ".join(f"{expression.format(p=f'b.{p}')} as {p}" for p in PRICES)
    return f"b.ts_code, b.trade_date, {prices}, b.pct_chg, b.vol, b.amount, b.adj_factor{extra}"


QFQ = "{p} * b.adj_factor / nullif(a.anchor_adj_factor, 0)"
HFQ = "{p} * b.adj_factor"
RAW = "{p}"
ANCHOR = ", a.anchor_adj_factor"
NO_ANCHOR = ", cast(null as double) as anchor_adj_factor"
METRICS = ", " + ", ".join(f"m.{c}" for c in DATASETS["daily_basic"].columns[3:])
FROM_ANCHORED = "from bars b left join anchors a on a.ts_code = b.ts_code"
WITH_METRICS = "left join daily_basic m on m.ts_code = b.ts_code and m.trade_date = b.trade_date"
BARS = "daily adj_factor"
PANEL = "daily adj_factor daily_basic"

oracle("bars_raw", BARS, f"{_factor_bars()} select {_scaled(RAW)} from bars b")
oracle("bars_hfq", BARS, f"{_factor_bars()} select {_scaled(HFQ)} from bars b")
oracle(
    "bars_qfq_latest", BARS,
    f"{_factor_bars()}{_anchors()} select {_scaled(QFQ, ANCHOR)} {FROM_ANCHORED}",
)
_POSITION = "row_number() over (order by b.trade_date, b.ts_code) as position, b.trade_date, b.ts_code"
oracle(
    "bars_qfq_numbered", BARS,
    f"{_factor_bars()}{_anchors()} select {_POSITION}, {QFQ.format(p='b.close')} as close {FROM_ANCHORED}",
)
oracle("panel_numbered", PANEL, f"{_factor_bars()} select {_POSITION}, b.close, m.pe from bars b {WITH_METRICS}")
oracle(
    "bars_numbered_few_days", BARS,
    _factor_bars("d.trade_date between date '2024-01-08' and date '2024-01-09'")
    + f" select {_POSITION}, b.close * b.adj_factor as close from bars b",
)
_asof = _factor_bars("d.trade_date <= date '2024-01-20'") + _anchors(
    "trade_date <= date '2024-01-20'"
)
oracle("bars_qfq_asof", BARS, f"{_asof} select {_scaled(QFQ, ANCHOR)} {FROM_ANCHORED}")
oracle("sql_qfq_asof", BARS, f"{_asof} select {_scaled(QFQ, ANCHOR)} {FROM_ANCHORED}")
oracle(
    "bars_symbols_range", BARS,
    f"""{_factor_bars()}{_anchors()} select {_scaled(QFQ, ANCHOR)} {FROM_ANCHORED}
    where b.ts_code in ({CODES}) and b.trade_date between date '2024-01-05' and date '2024-01-25'""",
)
oracle(
    "latest_adj_factor", "adj_factor",
    """ select ts_code, trade_date, adj_factor from adj_factor f where adj_factor is not null
    and trade_date = (select max(g.trade_date) from adj_factor g
                      where g.ts_code = f.ts_code and g.adj_factor is not null)""",
)
oracle("daily_metrics", "daily_basic", " select * from daily_basic")
oracle(
    "daily_panel", PANEL,
    f"{_factor_bars()} select {_scaled(RAW)}{METRICS} from bars b {WITH_METRICS}",
)
oracle(
    "panel_none", PANEL,
    f"{_factor_bars()} select {_scaled(RAW, NO_ANCHOR)}{METRICS} from bars b {WITH_METRICS}",
)
oracle(
    "panel_hfq", PANEL,
    f"{_factor_bars()} select {_scaled(HFQ, NO_ANCHOR)}{METRICS} from bars b {WITH_METRICS}",
)
oracle(
    "panel_qfq", PANEL,
    f"{_factor_bars()}{_anchors()} select {_scaled(QFQ, ANCHOR)}{METRICS} {FROM_ANCHORED} "
    f"{WITH_METRICS}",
)
oracle(
    "panel_qfq_asof", PANEL,
    f"{_asof} select {_scaled(QFQ, ANCHOR)}{METRICS} {FROM_ANCHORED} {WITH_METRICS}",
)
oracle(
    "index_basic", "index_basic",
    ' select * exclude ("desc"), "desc" as description from index_basic',
)
oracle(
    "index_bars", "index_daily", " select * from index_daily"
)
oracle("index_metrics", "index_dailybasic", " select * from index_dailybasic")
oracle(
    "index_panel", "index_daily index_dailybasic",
    """ select b.*, m.* exclude (ts_code, trade_date) from index_daily b
    left join index_dailybasic m on m.ts_code = b.ts_code and m.trade_date = b.trade_date""",
)
oracle("industry_classification", "index_classify", " select * from index_classify")

# Securities on a day

HISTORY = """, history as (
  select *, upper(name) like '%ST%' as is_st, name like '%退%' as is_delisting from namechange)"""


def _status(day: str) -> str:
    return HISTORY + f""", named as (
  select * from history
  where start_date <= date '{day}' and coalesce(end_date, date '{day}') >= date '{day}'
  qualify row_number() over (
    partition by ts_code order by start_date desc, ann_date desc nulls last) = 1),
status as (
  select s.ts_code, s.symbol, s.name as current_name, n.name as historical_name,
         n.start_date as name_start_date, n.end_date as name_end_date,
         n.ann_date as name_ann_date, n.change_reason, n.name is not null as has_name_history,
         n.is_st, n.is_delisting, s.list_date, s.delist_date,
         s.list_date <= date '{day}' and (s.delist_date is null or s.delist_date > date '{day}')
           as is_listed
  from stock_basic s left join named n on n.ts_code = s.ts_code)"""


def _members(code: str, day: str) -> str:
    return f""", members as (
  select index_code, con_code, trade_date as snapshot_date, weight from index_weight
  where index_code = '{code}' and trade_date <= date '{day}'
  qualify trade_date = max(trade_date) over ())"""


UNIVERSE = "select s.* exclude (current_name, is_listed)"
NO_INDEX = """, cast(null as varchar) as index_code, cast(null as date) as snapshot_date,
  cast(null as double) as weight"""
MASTERS = "stock_basic namechange"

oracle("name_history", "namechange", f"{HISTORY} select * from history")
oracle("security_status_asof", MASTERS, f"{_status('2024-01-15')} select * from status")
oracle("sql_status_asof", MASTERS, f"{_status('2024-01-15')} select * from status")
oracle("index_members_asof", "index_weight", f"{_members('click', '2024-01-25')} select * from members")
oracle("sql_members_asof", "index_weight", f"{_members('click', '2024-01-25')} select * from members")
_industry = """ select * from index_member_all
  where in_date <= date '2024-01-10' and coalesce(out_date, date '2024-01-10') >= date '2024-01-10'
  qualify row_number() over (partition by ts_code
    order by in_date desc, out_date desc nulls first, l3_code) = 1"""
oracle("stock_industry_asof", "index_member_all", _industry)
oracle("sql_industry_asof", "index_member_all", _industry)
oracle(
    "universe_all", MASTERS,
    f"{_status('2024-01-15')} {UNIVERSE}{NO_INDEX} from status s where s.is_listed",
)
oracle(
    "universe_exclude_st", MASTERS,
    f"{_status('2024-01-15')} {UNIVERSE}{NO_INDEX} from status s "
    "where s.is_listed and s.is_st = false and s.is_delisting = false",
)
oracle(
    "universe_index", f"{MASTERS} index_weight",
    f"{_status('2024-01-25')}{_members('click', '2024-01-25')} {UNIVERSE}, m.index_code, "
    "m.snapshot_date, m.weight from status s join members m on m.con_code = s.ts_code "
    "where s.is_listed",
)

# Suspensions, limits, tradability

ROLLUP = """, rollup_day as (
  select ts_code, trade_date,
         string_agg(distinct suspend_timing, ';' order by suspend_timing) as suspend_timing,
         nullif(concat_ws(',', max(case when suspend_type = 'S' then 'S' end),
                               max(case when suspend_type = 'R' then 'R' end)), '') as suspend_type,
         count(*) filter (where suspend_type = 'S') > 0 as is_suspended,
         count(*) filter (where suspend_type = 'R') > 0 as is_resumed
  from suspend_d group by all)"""
CONSTRAINTS = ROLLUP + """, keys as (
  select ts_code, trade_date from stk_limit union select ts_code, trade_date from rollup_day),
joined as (
  select k.ts_code, k.trade_date, l.pre_close, l.up_limit, l.down_limit, r.suspend_timing,
         r.suspend_type, coalesce(r.is_suspended, false) as is_suspended,
         coalesce(r.is_resumed, false) as is_resumed, b.open, b.high, b.low, b.close
  from keys k
  left join stk_limit l on l.ts_code = k.ts_code and l.trade_date = k.trade_date
  left join rollup_day r on r.ts_code = k.ts_code and r.trade_date = k.trade_date
  left join daily b on b.ts_code = k.ts_code and b.trade_date = k.trade_date),
constraints_day as (
  select *, open >= up_limit as open_at_up_limit, open <= down_limit as open_at_down_limit,
         low >= up_limit as locked_up_limit, high <= down_limit as locked_down_limit,
         case when is_suspended then false else open < up_limit end as can_buy_at_open,
         case when is_suspended then false else open > down_limit end as can_sell_at_open
  from joined)"""
STOCKS = CONSTRAINTS + HISTORY + """, stock_days as (
  select c.ts_code, c.trade_date, s.symbol, h.name as historical_name,
         h.start_date as name_start_date, h.end_date as name_end_date,
         h.ann_date as name_ann_date, h.change_reason, h.name is not null as has_name_history,
         h.is_st, h.is_delisting, s.list_date, s.delist_date,
         c.* exclude (ts_code, trade_date)
  from constraints_day c
  join stock_basic s on s.ts_code = c.ts_code and s.list_date <= c.trade_date
       and (s.delist_date is null or c.trade_date < s.delist_date)
  left join history h on h.ts_code = c.ts_code and h.start_date <= c.trade_date
       and (h.end_date is null or h.end_date >= c.trade_date)
  qualify row_number() over (partition by c.ts_code, c.trade_date
    order by h.start_date desc nulls last, h.ann_date desc nulls last) = 1)"""
LIMITS = "daily stk_limit suspend_d"
ALL_STOCK = f"{LIMITS} stock_basic namechange"

oracle("suspension_rollup", "suspend_d", f"{ROLLUP} select * from rollup_day")
oracle("trade_constraints", LIMITS, f"{CONSTRAINTS} select * from constraints_day")
oracle("stock_trade_constraints", ALL_STOCK, f"{STOCKS} select * from stock_days")
for _key in ("tradeability_asof", "sql_constraints_asof"):
    oracle(_key, ALL_STOCK, f"{STOCKS} select * from stock_days where trade_date = date '2024-01-15'")
oracle(
    "tradeability_symbols", ALL_STOCK,
    f"{STOCKS} select * from stock_days where trade_date = date '2024-01-10' and ts_code in ({CODES})",
)
oracle(
    "sql_adhoc", f"{LIMITS} adj_factor",
    f"""{CONSTRAINTS} select b.trade_date, count(*) as bar_count,
      count(f.adj_factor) as factor_count, max(b.close) as top_close,
      count(*) filter (where c.can_buy_at_open) as buyable
    from daily b
    left join adj_factor f on f.ts_code = b.ts_code and f.trade_date = b.trade_date
    left join constraints_day c on c.ts_code = b.ts_code and c.trade_date = b.trade_date
    group by b.trade_date""",
)

# Audit

LATEST = """, latest as (
  select * from commits qualify row_number() over (
    partition by dataset_id, partition_id order by committed_at desc, run_id desc) = 1)"""


def _health(end: str, some: bool = False) -> str:
    """``some``: only trade_cal and daily hold rows, and nothing was ever committed."""
    span = f"between date '2024-01-01' and date '{end}'"
    days = f"date_diff('day', date '2024-01-01', date '{end}') + 1"
    none = "cast(null as bigint)"
    nothing = "where false" if some else ""

    def whole(rank: int, name: str, low: str, high: str) -> str:
        return (
            f"select {rank} as rank, '{name}' as name, {none} as expected_days, "
            f"{none} as available_days, count(*) as row_count, min({low}) as first_date, "
            f"max({high}) as last_date, {none} as unmatched_daily_rows from {name} {nothing}"
        )

    def dated(rank: int, name: str, unmatched: bool = False, natural: bool = False,
              committed: bool = False) -> str:
        rows = f"(select * from {name} {'' if name == 'daily' else nothing})"
        wanted = f"select d from natural_days" if natural else "select cal_date as d from open_days"
        have = f"select trade_date from {rows}"
        if committed:
            have += f""" union select cast(json_extract_string(partition_values, '$.trade_date')
                as date) from latest where dataset_id = 'tushare.{name}'"""
        missing = none
        if unmatched:
            missing = f"""(select count(*) from daily x where x.trade_date {span} and
                (x.ts_code, x.trade_date) not in (select (ts_code, trade_date) from {rows}))"""
        return f"""select {rank}, '{name}', (select count(*) from ({wanted})),
            (select count(*) from ({wanted}) where d in ({have})), count(*), min(trade_date),
            max(trade_date), {missing} from {rows} where trade_date {span}"""

    nodate = "cast(null as date)"
    parts = [
        whole(1, "stock_basic", nodate, nodate),
        whole(2, "namechange", "start_date", "coalesce(end_date, start_date)"),
        whole(3, "index_basic", "list_date", "coalesce(exp_date, list_date)"),
        whole(4, "index_classify", nodate, nodate),
        whole(5, "index_member_all", "in_date", "coalesce(out_date, in_date)"),
        f"""select 6, 'trade_cal', {days}, count(distinct cal_date), count(*), min(cal_date),
            max(cal_date), {none} from trade_cal where exchange = 'SSE' and cal_date {span}""",
        dated(7, "daily"),
        dated(8, "adj_factor", unmatched=True),
        dated(9, "daily_basic", unmatched=True),
        dated(10, "index_daily", natural=True, committed=True),
        dated(11, "index_dailybasic"),
        dated(12, "suspend_d", committed=True),
        dated(13, "stk_limit"),
        whole(14, "index_weight", "trade_date", "trade_date"),
    ]
    return f"""{LATEST.replace(") = 1)", f") = 1 {'and false' if some else ''})")},
open_days as (select cal_date from trade_cal
              where exchange = 'SSE' and is_open = 1 and cal_date {span}),
natural_days as (select cast(unnest(generate_series(date '2024-01-01', date '{end}',
                 interval 1 day)) as date) as d),
coverage as ({' union all '.join(parts)}),
gap as (select count(distinct cal_date) < {days} as is_gap from trade_cal
        where exchange = 'SSE' and cal_date {span}),
commit_times as (select dataset_id, max(committed_at) as last_committed_at from latest group by 1)
select 'tushare.' || name as dataset_id,
       case when rank in (1, 2, 3, 4, 5, 14) then if(row_count = 0, 'EMPTY', 'HEALTHY')
            when is_gap and rank in (7, 8, 9, 11, 12, 13) then 'CALENDAR_INCOMPLETE'
            when available_days < expected_days or (rank = 8 and unmatched_daily_rows > 0)
              then 'INCOMPLETE'
            else 'HEALTHY' end as status,
       cast(expected_days as bigint) as expected_days,
       cast(available_days as bigint) as available_days,
       cast(greatest(coalesce(expected_days, 0) - coalesce(available_days, 0), 0) as bigint)
         as missing_days,
       cast(unmatched_daily_rows as bigint) as unmatched_daily_rows,
       cast(row_count as bigint) as row_count, first_date, last_date, last_committed_at
from coverage cross join gap left join commit_times t on t.dataset_id = 'tushare.' || name"""


EVERY = " ".join([*DATASETS, "commits"])
oracle("health", EVERY, _health("2024-01-30"))
oracle("health_calendar_gap", EVERY, _health("2024-02-02"))
oracle("health_empty_tables", EVERY, _health("2024-01-30", some=True))

# Partition plans

oracle(
    "open_dates", "trade_cal",
    """ select cal_date from trade_cal where exchange = 'SSE' and is_open = 1
    and cal_date >= date '2024-01-01' and cal_date <= date '2024-01-30'""",
)
ORDER_SPAN = "(select min(cast(o_orderdate as date)) as a, max(cast(o_orderdate as date)) as b from orders)"
NO_TEXT = "cast(null as varchar)"
oracle(
    "plan_calendar_year", "",
    f"""select 'tushare.trade_cal' as dataset_id, 'exchange=SSE/year=' || y as partition_id,
      '{{"exchange":"SSE","year":' || y || '}}' as partition_values,
      '{{"exchange":"SSE","start_date":"' || y || '0101","end_date":"' || y || '1231"}}'
        as request_params,
      'SSE' as scope_key, y || '0101' as scope_from, y || '1231' as scope_to
    from (select cast(unnest(generate_series(year(a), year(b))) as varchar) as y from {ORDER_SPAN})""",
)


def _day_plan(dataset: str, days: str) -> str:
    return f"""select 'tushare.{dataset}' as dataset_id,
      'trade_date=' || strftime(d, '%Y-%m-%d') as partition_id,
      '{{"trade_date":"' || strftime(d, '%Y-%m-%d') || '"}}' as partition_values,
      '{{"trade_date":"' || strftime(d, '%Y%m%d') || '"}}' as request_params,
      {NO_TEXT} as scope_key, strftime(d, '%Y%m%d') as scope_from, strftime(d, '%Y%m%d') as scope_to
    from ({days})"""


oracle(
    "plan_calendar_day", "",
    _day_plan("index_daily",
              f"select unnest(generate_series(a, b, interval 1 day)) as d from {ORDER_SPAN}"),
)
oracle(
    "plan_trading_day", "trade_cal",
    " " + _day_plan("daily", "select cal_date as d from trade_cal where is_open = 1"),
)
oracle(
    "plan_index_month", "",
    f"""select 'tushare.index_weight' as dataset_id,
      'index_code=' || c || '/month=' || strftime(m, '%Y-%m') as partition_id,
      '{{"index_code":"' || c || '","month":"' || strftime(m, '%Y-%m') || '"}}' as partition_values,
      '{{"index_code":"' || c || '","start_date":"' || strftime(m, '%Y%m01') || '","end_date":"'
        || strftime(last_day(m), '%Y%m%d') || '"}}' as request_params,
      c as scope_key, strftime(m, '%Y%m01') as scope_from,
      strftime(last_day(m), '%Y%m%d') as scope_to
    from (select unnest(generate_series(date_trunc('month', a), b, interval 1 month)) as m, b
          from {ORDER_SPAN}),
         (values ('000300.SH'), ('000905.SH'), ('000985.CSI')) codes(c)
    where last_day(m) <= b""",
)
EVENT_DAYS = """select unnest(generate_series(
    (select min(cast(ts as date)) from events), (select max(cast(ts as date)) from events),
    interval 1 day)) as d"""
oracle(
    "plan_pending", "commits",
    f""" select dataset_id, partition_id from ({_day_plan("index_daily", EVENT_DAYS)})
    where partition_id not in (select partition_id from commits
                               where dataset_id = 'tushare.index_daily')""",
)


def _update_plan(keep: str, step: str) -> str:
    return f""", days as (select 'trade_date=' || strftime(d, '%Y-%m-%d') as p from ({EVENT_DAYS})),
open_days as (select 'trade_date=' || strftime(cal_date, '%Y-%m-%d') as p from trade_cal
              where is_open = 1),
months as (select 'index_code=' || c || '/month=' || strftime(m, '%Y-%m') as p from
  (select unnest(generate_series(date_trunc('month', min(ts)), max(cast(ts as date)),
                 interval 1 month)) as m, max(cast(ts as date)) as b from events),
  (values ('000300.SH'), ('000905.SH'), ('000985.CSI')) codes(c) where last_day(m) <= b),
plan as (
  select i as step, n as name, 'full' as p, true as refreshed from (values (1, 'stock_basic'),
    (2, 'namechange'), (3, 'index_basic'), (4, 'index_classify'), (5, 'index_member_all')) v(i, n)
  union all select 6, 'trade_cal', 'exchange=SSE/year=' || y, false
    from (select distinct year(ts) as y from events)
  union all select i, n, p, false from open_days, (values (7, 'daily'), (8, 'adj_factor'),
    (9, 'daily_basic'), (11, 'index_dailybasic'), (12, 'suspend_d'), (13, 'stk_limit')) v(i, n)
  union all select 10, 'index_daily', p, false from days
  union all select 14, 'index_weight', p, false from months)
select cast({step} as integer) as step, 'tushare.' || name as dataset_id, count(*) as planned,
       count(*) filter (where refreshed or (('tushare.' || name, p) not in
         (select (dataset_id, partition_id) from commits))) as pending,
       min(p) as first_partition, max(p) as last_partition
from plan where {keep} group by 1, 2"""


oracle("update_plan", "trade_cal commits", _update_plan("true", "step"))
oracle(
    "update_indices_plan", "trade_cal commits",
    _update_plan(
        "name in ('index_basic', 'index_classify', 'index_member_all', 'index_daily', "
        "'index_dailybasic', 'index_weight')",
        "case when step < 6 then step - 2 when step = 10 then 4 when step = 11 then 5 else 6 end",
    ),
)

# Ledger and run log

oracle("ledger_latest", "commits", f"{LATEST} select * from latest")
STATUS = "select dataset_id, partition_id, row_count, committed_at, run_id from latest"
oracle("status", "commits", f"{LATEST} {STATUS}")
oracle(
    "status_dataset", "commits", f"{LATEST} {STATUS} where dataset_id = 'tushare.suspend_d'"
)
oracle(
    "committed_rows", "commits",
    f"""{LATEST} select e.event_id, e.user_id,
      l.partition_id || '/' || l.run_id as run_id
    from events e join latest l
      on l.run_id = e.event_type || '-' || hour(e.ts)
     and l.partition_id = 'trade_date=' || strftime(e.ts, '%Y-%m-%d')""",
)
oracle(
    "run_status", "",
    """with log as (
  select cast(user_id as varchar) || '/' || strftime(ts, '%Y-%m-%d') as run_id, *,
         case event_id % 3 when 0 then 'InterruptException' when 1 then 'RuntimeError'
              else 'ValueError' end as kind,
         case when event_id % 2 = 0 then ' Query Interrupted ' else repeat('x', 5000) end as msg
  from events),
runs as (
  select run_id, min(ts) as started_at,
         min(ts) filter (where event_type = 'purchase') as success_at,
         max(event_id) filter (where event_type = 'purchase') as rows_received,
         min(ts) filter (where event_type in ('error', 'view')) as bad_at,
         min({'ts': ts, 'event': event_type, 'kind': kind, 'msg': msg})
           filter (where event_type in ('error', 'view')) as bad
  from log group by 1),
opened as (select *, bad.event as bad_event, bad.kind as bad_kind, bad.msg as bad_msg from runs),
judged as (
  select *, case when success_at is not null then 'SUCCESS'
                 when bad_event = 'view' then 'INTERRUPTED'
                 when bad_event = 'error' and (bad_kind = 'InterruptException' or
                   (bad_kind = 'RuntimeError' and bad_msg like '%Interrupted%')) then 'INTERRUPTED'
                 when bad_event = 'error' then 'FAILED'
                 when started_at < timestamp '2024-01-20' then 'INTERRUPTED'
                 else 'RUNNING' end as status
  from opened)
select run_id, 'tushare.daily' as dataset_id, split_part(run_id, '/', 2) as partition_id, status,
       '{}' as request_params, rows_received, started_at, coalesce(success_at, bad_at)
         as finished_at,
       case when status = 'SUCCESS' then null when bad_at is not null then bad_kind
            when status = 'INTERRUPTED' then 'ProcessInterrupted' end as error_type,
       case when status = 'SUCCESS' then null when bad_at is not null then bad_msg
            when status = 'INTERRUPTED' then 'the process ended before this run did' end
         as error_message
from judged""",
)

# Landing and checks

_text_date = "strftime({0}, '%Y%m%d') as {0}"
oracle(
    "variant_union", "stock_basic",
    f""" select list_status as variant, ts_code, symbol, {_text_date.format('list_date')},
      {_text_date.format('delist_date')} from stock_basic""",
)
oracle(
    "exact_dedupe", "suspend_d",
    """ select distinct strftime(trade_date, '%Y%m%d') as partition_id, ts_code,
      strftime(trade_date, '%Y%m%d') as trade_date, suspend_timing, suspend_type from suspend_d""",
)
oracle(
    "validate_nulls", "landed",
    """ select partition_id, count(*) filter (where ts_code is null or trade_date is null)
      as null_rows from landed group by 1""",
)
oracle(
    "validate_pk", "landed",
    """ select partition_id, cast(sum(if(n > 1, n, 0)) as bigint) as duplicate_rows from (
      select partition_id, ts_code, trade_date, count(*) as n from landed group by all) group by 1""",
)
FOREIGN = "trim(trade_date) <> replace(partition_id[12:], '-', '')"
oracle(
    "validate_scope_day", "landed",
    f""" select partition_id, count(*) filter (where {FOREIGN}) as foreign_rows from landed
    where cast(partition_id[12:] as date) <= (select max(cast(ts as date)) from events)
    group by 1""",
)
oracle(
    "validate_scope_calendar", "",
    """select 'exchange=SSE/year=' || year(o_orderdate) as partition_id,
      count(*) filter (where o_orderkey % 2 = 1) as foreign_rows from orders group by 1""",
)
oracle(
    "validate_scope_month", "",
    """with landed as (
      select if(o_orderkey % 2 = 0, 'A', 'B') as asked,
             if(o_orderkey % 7 = 0, 'C', asked) as got, strftime(o_orderdate, '%Y-%m') as month,
             strftime(if(o_orderkey % 5 = 0, o_orderdate + interval 1 month, o_orderdate), '%Y-%m')
               as row_month,
             last_day(o_orderdate) <= max(o_orderdate) over () as whole
      from orders)
    select 'index_code=' || asked || '/month=' || month as partition_id,
      count(*) filter (where got <> asked or row_month <> month) as foreign_rows
    from landed where whole group by 1""",
)
oracle(
    "validate_columns", "daily namechange index_classify",
    """ select 'tushare.daily' as dataset_id, 'amount' as missing_columns, count(*) as row_count
      from daily
    union all select 'tushare.namechange', 'change_reason', count(*) from namechange
    union all select 'tushare.index_classify', '', count(*) from index_classify""",
)
VERDICTS = f""", plan as (select 'trade_date=' || strftime(d, '%Y-%m-%d') as partition_id
                from ({EVENT_DAYS})),
copies as (select *, count(*) over (partition by partition_id, ts_code, trade_date) as n from landed),
counted as (
  select partition_id, count(*) as row_count,
         count(*) filter (where ts_code is null) as null_rows,
         count(*) filter (where {FOREIGN}) as foreign_rows,
         count(*) filter (where adj_factor = 'bad') as bad_rows,
         count(*) filter (where n > 1) as repeated_rows
  from copies group by 1)
select plan.partition_id, coalesce(row_count, 0) as row_count,
       case when row_count is null then 'tushare.adj_factor: empty batch'
            when null_rows > 0 then 'tushare.adj_factor: ' || null_rows
              || ' rows with NULL in a required column'
            when repeated_rows > 0 then 'tushare.adj_factor: ' || repeated_rows
              || ' rows with a repeated key'
            when foreign_rows > 0 then 'tushare.adj_factor: ' || foreign_rows
              || ' rows outside the requested partition'
            when bad_rows > 0 then 'tushare.adj_factor: ' || bad_rows
              || ' rows with malformed values' end as error_message
from plan left join counted on counted.partition_id = plan.partition_id"""
oracle(
    "validate_batches", "landed",
    VERDICTS,
)
oracle(
    "land_typed", "landed",
    f"""{VERDICTS.split("select plan.partition_id")[0].rstrip()}, verdicts as (select plan.partition_id{VERDICTS.split("select plan.partition_id")[1]})
select partition_id, ts_code, cast(strptime(trim(trade_date), '%Y%m%d') as date) as trade_date,
       cast(adj_factor as double) as adj_factor
from landed where partition_id in (select partition_id from verdicts where error_message is null)""",
)
oracle(
    "validate_batches_no_key", "suspend_d",
    f""" select p.partition_id, count(s.ts_code) as row_count,
      {NO_TEXT} as error_message
    from (select 'trade_date=' || strftime(d, '%Y-%m-%d') as partition_id from ({EVENT_DAYS})) p
    left join (select distinct * from suspend_d) s
      on 'trade_date=' || strftime(s.trade_date, '%Y-%m-%d') = p.partition_id
    group by 1""",
)
oracle(
    "sync_report", "index_daily commits",
    f""", plan as (select 'trade_date=' || strftime(d, '%Y-%m-%d') as p from ({EVENT_DAYS})),
done as (select distinct partition_id as p from commits where dataset_id = 'tushare.index_daily')
select 'tushare.index_daily' as dataset_id,
       count(*) filter (where p not in (select p from done)) as completed,
       count(*) filter (where p in (select p from done)) as skipped,
       cast(0 as bigint) as failed from plan""",
)
oracle(
    "page_audit", "",
    """with received as (
  select 'trade_date=' || strftime(ts, '%Y-%m-%d') as partition_id, event_type as variant,
         hour(ts) as page, count(*) as n, list_sort(list(event_id % 97)) as content,
         day(any_value(ts)) as d
  from events group by 1, 2, 3),
asked as (
  select q.partition_id, q.variant, h.page, coalesce(r.n, 0) as n, r.content, q.d
  from (select partition_id, variant, any_value(d) as d from received group by 1, 2) q
  cross join (select unnest(generate_series(0, 24)) as page) h
  left join received r on r.partition_id = q.partition_id and r.variant = q.variant
    and r.page = h.page
  where h.page < 24 or q.d % 7 <> 0),
stepped as (
  select *, lag(content) over w = content as stuck,
         (d * 24 + page) % 131 = 0 or (page > 0 and (d * 24 + page - 1) % 131 = 0) as gap,
         not (page = 24 and d % 11 = 0) as has_columns
  from asked window w as (partition by partition_id, variant order by page)),
verdict as (
  select partition_id, variant, count(*) as pages, cast(sum(n) as bigint) as row_count,
         count(*) filter (where stuck) as stuck_pages, count(*) filter (where gap) as offset_errors,
         count(*) filter (where not has_columns) as pages_without_columns,
         arg_max(n, page) = 0 as ended
  from stepped group by 1, 2),
met as (
  select partition_id, variant, count(*) as repeated_keys from (
    select 'trade_date=' || strftime(ts, '%Y-%m-%d') as partition_id, event_type as variant,
           user_id, event_id % 97 as cell
    from events group by all having count(distinct hour(ts)) > 1) group by 1, 2)
select v.*, coalesce(m.repeated_keys, 0) as repeated_keys,
       stuck_pages = 0 and offset_errors = 0 and pages_without_columns = 0 and ended
         and coalesce(m.repeated_keys, 0) = 0 as complete
from verdict v left join met m on m.partition_id = v.partition_id and m.variant = v.variant""",
)
oracle(
    "partition_replace", "index_daily",
    """ select ts_code, trade_date, open,
      if(day(trade_date) between 10 and 20 and day(trade_date) <> 13, close * 2, close) as close, vol
    from index_daily where day(trade_date) <> 12""",
)
oracle(
    "sync_missing_column", "index_daily",
    " select ts_code, trade_date, open, close, vol from index_daily where day(trade_date) % 7 <> 0",
)
oracle("sync_missing_variant", "stock_basic", " select ts_code, symbol, list_date, delist_date from stock_basic")
oracle(
    "sync_bad_pages", "index_daily",
    """ select ts_code, trade_date, open, close, vol from index_daily
    where day(trade_date) % 7 <> 0 and day(trade_date) % 11 <> 0 and day(trade_date) % 13 <> 0""",
)
oracle("sync_csv_by_name", "index_daily", " select ts_code, trade_date, open, close, vol from index_daily")

oracle(
    "sync_page_copies", "suspend_d",
    " select distinct ts_code, trade_date, suspend_timing, suspend_type from suspend_d where day(trade_date) % 7 <> 0",
)
for _name, _where in {
    "stock_basic": "true", "trade_cal": "true", "index_daily": "trade_date <= date '2024-01-31'",
    "adj_factor": "trade_date in (select cal_date from trade_cal where is_open = 1 and cal_date <= date '2024-01-31')",
    "index_weight": "index_code = 'click' and trade_date <= date '2024-01-31'",
}.items():
    _columns = ", ".join(f'"{column}"' for column in DATASETS[_name].columns)
    oracle(f"update_{_name}", f"{_name} trade_cal".replace("trade_cal trade_cal", "trade_cal"), f" select {_columns} from {_name} where {_where}")
oracle("lake_members_asof", "index_weight", f"{_members('click', '2024-01-25')} select * from members")
