"""SQL names: every table and view as a temporary view, every as-of query as a table function.

Temporary views have one-part names, so ``market.daily_bar`` is registered as ``market_daily_bar``;
queries may use either spelling. All are live: they hold plans, not data.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame

from pitlake.operators import panels, prices, securities, tradability
from pitlake.sources.datasets import DATASETS, PREFIX

# View name to a function of the table lookup.
VIEWS: dict[str, Callable[[Callable[[str], DataFrame]], DataFrame]] = {
    "market_daily_bar": lambda t: prices.daily_bar(t("daily"), t("adj_factor")),
    "market_latest_adj_factor": lambda t: prices.latest_adj_factor(t("adj_factor")),
    "market_daily_bar_hfq": lambda t: prices.daily_bar_hfq(
        prices.daily_bar(t("daily"), t("adj_factor"))
    ),
    "market_daily_bar_qfq_latest": lambda t: prices.daily_bar_qfq_latest(
        t("daily"), t("adj_factor")
    ),
    "market_daily_metrics": lambda t: panels.daily_metrics(t("daily_basic")),
    "market_daily_panel": lambda t: panels.daily_panel(
        prices.daily_bar(t("daily"), t("adj_factor")), t("daily_basic")
    ),
    "market_security_name_history": lambda t: securities.name_history(t("namechange")),
    "market_trade_constraints_daily": lambda t: tradability.trade_constraints(
        t("stk_limit"), t("suspend_d"), t("daily")
    ),
    "market_stock_trade_constraints_daily": lambda t: tradability.stock_trade_constraints(
        tradability.trade_constraints(t("stk_limit"), t("suspend_d"), t("daily"), bucketed=True),
        t("stock_basic"), t("namechange"),
    ),
    "indices_basic": lambda t: panels.index_basic(t("index_basic")),
    "indices_daily_bar": lambda t: panels.index_bar(t("index_daily")),
    "indices_daily_metrics": lambda t: panels.index_metrics(t("index_dailybasic")),
    "indices_daily_panel": lambda t: panels.index_panel(t("index_daily"), t("index_dailybasic")),
    "indices_industry_classification": lambda t: panels.industry_classification(
        t("index_classify")
    ),
}

_ADJUSTED = ", ".join(
    f"bar.{name} * bar.adj_factor / nullif(anchor.factor, 0) as {name}" for name in prices.PRICES
)
_PLAIN = ", ".join(f"bar.{name}" for name in prices.UNADJUSTED)

# Function signature to its one SELECT. A parameter may not appear in a nested scalar subquery.
FUNCTIONS = {
    "market_daily_bar_qfq_asof(as_of_date date)": f"""
        select bar.ts_code, bar.trade_date, {_ADJUSTED}, {_PLAIN}, bar.adj_factor,
               anchor.factor as anchor_adj_factor
        from market_daily_bar bar left join (
            select ts_code, max_by(adj_factor, trade_date) as factor
            from {PREFIX}_adj_factor
            where adj_factor is not null and trade_date <= as_of_date
            group by ts_code) anchor on anchor.ts_code = bar.ts_code
        where bar.trade_date <= as_of_date""",
    "market_security_status_asof(as_of_date date)": f"""
        select stock.ts_code, stock.symbol, stock.name as current_name,
               named.it.name as historical_name, named.it.start_date as name_start_date,
               named.it.end_date as name_end_date, named.it.ann_date as name_ann_date,
               named.it.change_reason, named.it.name is not null as has_name_history,
               named.it.is_st, named.it.is_delisting, stock.list_date, stock.delist_date,
               stock.list_date <= as_of_date
                 and (stock.delist_date is null or as_of_date < stock.delist_date) as is_listed
        from {PREFIX}_stock_basic stock left join (
            select ts_code, max_by(struct(*), struct(start_date, ann_date)) as it
            from market_security_name_history
            where start_date <= as_of_date and (end_date is null or end_date >= as_of_date)
            group by ts_code) named on named.ts_code = stock.ts_code""",
    "market_stock_trade_constraints_asof(as_of_date date)": """
        select * from market_stock_trade_constraints_daily where trade_date = as_of_date""",
    "indices_members_asof(requested_code string, as_of_date date)": f"""
        select weights.index_code, weights.con_code, weights.trade_date as snapshot_date,
               weights.weight
        from {PREFIX}_index_weight weights join (
            select index_code, max(trade_date) as trade_date
            from {PREFIX}_index_weight
            where index_code = requested_code and trade_date <= as_of_date
            group by index_code) snapshot
          on snapshot.index_code = weights.index_code
         and snapshot.trade_date = weights.trade_date""",
    "indices_stock_industry_asof(as_of_date date)": f"""
        select it.* from (
            select min_by(struct(*), struct(-unix_date(in_date), out_date is not null,
                          -unix_date(out_date), l3_code)) as it
            from {PREFIX}_index_member_all
            where in_date <= as_of_date and (out_date is null or out_date >= as_of_date)
            group by ts_code)""",
}


_NAMES = {
    *[f"{PREFIX}_{name}" for name in DATASETS], "meta_partitions", "meta_sync_runs", *VIEWS,
    *[signature.partition("(")[0] for signature in FUNCTIONS],
}
# A quoted literal, which is left alone, or a two-part name.
_TWO_PART = re.compile(r"""'[^']*'|"[^"]*"|\b([A-Za-z]\w*)\.([A-Za-z]\w*)""")


def flat_names(query: str) -> str:
    """The query with known two-part names in their registered form."""

    def flat(found: re.Match) -> str:
        name = f"{found[1]}_{found[2]}".lower()
        return name if found[1] and name in _NAMES else found[0]

    return _TWO_PART.sub(flat, query)


def register(market, query: str | None = None) -> None:
    """(Re)creates the names a query mentions, or all of them; no job runs.

    Only mentioned tables are looked up, so an ad-hoc query lists no other files.
    """
    functions = {
        signature: body
        for signature, body in FUNCTIONS.items()
        if query is None or signature.partition("(")[0] in query
    }
    text = None if query is None else " ".join([query, *functions.values()])
    tables: dict[str, Callable[[], DataFrame]] = {
        f"{PREFIX}_{name}": partial(market.table, name) for name in DATASETS
    }
    tables["meta_partitions"] = market.ledger
    if market.lake is not None:
        tables["meta_sync_runs"] = market.runs
    for name, build in VIEWS.items():
        tables[name] = partial(build, market.table)
    for name, build in tables.items():
        if text is None or name in text:
            build().createOrReplaceTempView(name)
    for signature, body in functions.items():
        market.spark.sql(
            f"create or replace temporary function {signature} returns table return {body}"
        )
