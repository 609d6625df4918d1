"""Audit of how completely the datasets cover a date range."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from pitlake.sources.datasets import CALENDAR_EXCHANGE, DATASETS, PREFIX

# Whole-table datasets with the first and last day a row stands for (None: undated).
WHOLE: dict[str, tuple[str, str] | None] = {
    "stock_basic": None,
    "namechange": ("start_date", "end_date"),
    "index_basic": ("list_date", "exp_date"),
    "index_classify": None,
    "index_member_all": ("in_date", "out_date"),
    "index_weight": ("trade_date", "trade_date"),
}
# Datasets expected on every open day, in report order with the others.
ON_OPEN_DAYS = ["daily", "adj_factor", "daily_basic", "index_dailybasic", "suspend_d", "stk_limit"]
DATED = [*ON_OPEN_DAYS, "index_daily"]
# Datasets compared with the bars row by row; a missing factor makes a dataset incomplete, missing
# metrics are only reported.
MATCHED = ["adj_factor", "daily_basic"]
# Each has a bit of the presence mask, in this order.
ROW_BY_ROW = ["daily", *MATCHED]
# Datasets in which a committed empty day counts as covered.
EMPTY_DAY_OK = ["index_daily", "suspend_d"]
# Fixed value: order of the report.
REPORT_ORDER = [
    "stock_basic", "namechange", "index_basic", "index_classify", "index_member_all", "trade_cal",
    "daily", "adj_factor", "daily_basic", "index_daily", "index_dailybasic", "suspend_d",
    "stk_limit", "index_weight",
]
REPORT = [
    "dataset_id", "status", "expected_days", "available_days", "missing_days",
    "unmatched_daily_rows", "row_count", "first_date", "last_date", "last_committed_at",
]


def _whole_sql() -> str:
    """Rows, first and last day of every dataset that is judged as a whole."""
    frames = []
    for name, dates in WHOLE.items():
        low, high = (dates[0], f"coalesce({dates[1]}, {dates[0]})") if dates else ("cast(null as date)",) * 2
        frames.append(f"select '{name}' as dataset, {low} as lo, {high} as hi from {{{name}}}")
    return f"""select dataset, count(*) as row_count, min(lo) as first_date, max(hi) as last_date
        from ({" union all ".join(frames)}) group by dataset"""


def _dated_sql(start: date, end: date) -> str:
    """Figures of every dated dataset and of the calendar, each read once, as one text: it is planned as a whole.

    Every dataset that is compared row by row has a bit. The bits of a security-day come together in one aggregate
    and its rows are counted by the mask they form, so a bar without its factor is known by its mask, without
    any join; an unknown key meets nothing. All sources are then counted per day in one partially aggregated
    union and brought together by day, so a day knows whether it is open when its datasets are judged.
    """
    within_days = f"between date '{start}' and date '{end}'"
    counts = ", ".join(f"sum(if(bit = {1 << i}, 1, 0)) as n{i}" for i in range(len(ROW_BY_ROW)))
    keyed = " union all ".join(
        f"select ts_code, trade_date, {1 << i} as bit from {{{name}}} where trade_date {within_days}"
        for i, name in enumerate(ROW_BY_ROW)
    )
    by_mask = f"""
        select trade_date as day, if(ts_code is null, 1, mask) as mask, {", ".join(f"sum(n{i}) as n{i}" for i in range(len(ROW_BY_ROW)))}
        from (select ts_code, trade_date, bit_or(bit) as mask, {counts} from ({keyed}) group by ts_code, trade_date)
        group by 1, 2"""
    entries = ", ".join(f"named_struct('source', '{name}', 'n', n{i})" for i, name in enumerate(ROW_BY_ROW))
    ids = ", ".join(f"'{DATASETS[name].id}'" for name in EMPTY_DAY_OK)
    sources = [
        *[f"select '{name}' as source, trade_date as day, 0 as mask, 1 as n from {{{name}}} where trade_date {within_days}"
          for name in DATED if name not in ROW_BY_ROW],
        f"""select of.source, day, mask, of.n
            from (select day, mask, explode(array({entries})) as of from ({by_mask}))""",
        f"""select source, day, 0 as mask, 1 as n from (
              select concat('committed_', substring_index(dataset_id, '.', -1)) as source,
                     try_cast(get_json_object(partition_values, '$.trade_date') as date) as day
              from {{commits}} where dataset_id in ({ids})) where day {within_days}""",
        f"""select explode(if(is_open = 1, array('trade_cal', 'open'), array('trade_cal'))) as source, cal_date as day, 0 as mask, 1 as n
            from {{trade_cal}} where exchange = '{CALENDAR_EXCHANGE}' and cal_date {within_days}""",
    ]
    counted = [*DATED, "trade_cal", "open", *[f"committed_{name}" for name in EMPTY_DAY_OK]]
    per_day = [f"coalesce(sum(if(source = '{name}', n, 0)), 0) as `{name}`" for name in counted] + [
        f"coalesce(sum(if(source = 'daily' and mask & {1 << ROW_BY_ROW.index(name)} = 0, n, 0)), 0) as no_{name}" for name in MATCHED
    ]
    figures = []
    for name in [*DATED, "trade_cal"]:
        covered = f"(`{name}` > 0 or committed_{name} > 0)" if name in EMPTY_DAY_OK else f"`{name}` > 0"
        counts_here = covered if name in ("index_daily", "trade_cal") else f"{covered} and open > 0"
        unmatched = f"sum(no_{name})" if name in MATCHED else "cast(null as bigint)"
        figures.append(
            f"named_struct('dataset', '{name}', 'available_days', count_if({counts_here}), 'row_count', sum(`{name}`), "
            f"'first_date', min(if(`{name}` > 0, day, null)), 'last_date', max(if(`{name}` > 0, day, null)), "
            f"'unmatched_daily_rows', {unmatched}, 'calendar_days', count_if(trade_cal > 0), 'open_days', sum(open))"
        )
    union = " union all ".join(sources)
    return f"""select of.* from (select explode(array({", ".join(figures)})) as of
        from (select day, {", ".join(per_day)} from ({union}) group by day))"""


def health(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    ledger: DataFrame,
    start: date,
    end: date,
) -> DataFrame:
    """One row per dataset over a closed date range, in fixed order."""
    span = (end - start).days + 1
    on_open_days = "dataset in (" + ", ".join(f"'{name}'" for name in ON_OPEN_DAYS) + ")"
    whole = "dataset in (" + ", ".join(f"'{name}'" for name in WHOLE) + ")"
    matched = "dataset in (" + ", ".join(f"'{name}'" for name in MATCHED) + ")"
    ranks = ", ".join(f"('{name}', {rank})" for rank, name in enumerate(REPORT_ORDER))
    measures = [
        "available_days", "row_count", "first_date", "last_date", "unmatched_daily_rows", "calendar_days", "open_days",
        "last_committed_at", "rank",
    ]
    nothing = {"row_count": "bigint", "first_date": "date", "last_date": "date", "last_committed_at": "timestamp", "rank": "int"}

    def part(text: str, *given: str) -> str:
        filled = [name if name in given else f"cast(null as {nothing.get(name, 'bigint')}) as {name}" for name in measures]
        return f"select dataset, {', '.join(filled)} from ({text})"

    commits = "select substring_index(dataset_id, '.', -1) as dataset, max(committed_at) as last_committed_at from {commits} group by 1"
    # Each dataset has at most one row with each of these columns, so one small aggregate brings
    # them together; datasets without any row still have their rank.
    parts = [
        part(_dated_sql(start, end), *measures[:7]),
        part(_whole_sql(), "row_count", "first_date", "last_date"),
        part(commits, "last_committed_at"),
        part(f"select * from values {ranks} as named(dataset, rank)", "rank"),
    ]
    together = ", ".join(f"max({name}) as {name}" for name in measures)
    text = f"""
        with merged as (select dataset, {together} from ({" union all ".join(parts)}) group by dataset),
        judged as (
          select dataset, rank, first_date, last_date, last_committed_at,
                 case when {on_open_days} then coalesce(open_days, 0)
                      when dataset in ('trade_cal', 'index_daily') then cast({span} as bigint) end as expected_days,
                 case when not {whole} then coalesce(available_days, 0) end as available_days,
                 case when {matched} then coalesce(unmatched_daily_rows, 0) end as unmatched_daily_rows,
                 coalesce(row_count, 0) as row_count, coalesce(calendar_days, 0) as calendar_days
          from merged where rank is not null),
        counted as (
          select *, greatest(coalesce(expected_days, 0) - coalesce(available_days, 0), 0) as missing_days from judged)
        select concat('{PREFIX}.', dataset) as dataset_id,
               case when {whole} and row_count = 0 then 'EMPTY'
                    when {on_open_days} and calendar_days < {span} then 'CALENDAR_INCOMPLETE'
                    when missing_days > 0 or dataset = 'adj_factor' and unmatched_daily_rows > 0 then 'INCOMPLETE'
                    else 'HEALTHY' end as status,
               {", ".join(REPORT[2:])}
        from counted order by rank"""
    return spark.sql(text, **{name: tables[name] for name in DATASETS}, commits=ledger)
