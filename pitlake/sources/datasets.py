"""The 14 datasets: typed columns, keys and how each is cut into partitions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import types as T

# Fixed value: prefix of every dataset id.
PREFIX = "tushare"

# Index codes whose weights are kept by default, markets an index list is asked for.
DEFAULT_INDEX_CODES = ("000300.SH", "000905.SH", "000985.CSI")
INDEX_MARKETS = ("MSCI", "CSI", "SSE", "SZSE", "CICC", "SW", "OTH")
# Fixed value: the exchange whose calendar decides what a trading day is.
CALENDAR_EXCHANGE = "SSE"

# How a dataset is cut: the folder columns below its root, in order. The folder path of a partition
# is its id, e.g. ``exchange=SSE/year=2024``; filters on these columns prune folders.
FOLDERS = {
    "full": [],
    "calendar_year": ["exchange", "year"],
    "calendar_day": ["trade_date"],
    "trading_day": ["trade_date"],
    "index_month": ["index_code", "month"],
}


_TYPES = {
    "string": T.StringType(), "date": T.DateType(), "double": T.DoubleType(),
    "tinyint": T.ByteType(), "bigint": T.LongType(), "timestamp": T.TimestampType(),
}


def struct(columns: str) -> T.StructType:
    """``"name type, name type"`` as a schema, without a running session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class Dataset:
    name: str
    column_list: str
    key: Sequence[str]
    strategy: str
    required: Sequence[str] = ()
    allow_empty: bool = False
    drop_exact_copies: bool = False
    variant_column: str | None = None
    variants: Sequence[str] = ()

    @property
    def id(self) -> str:
        return f"{PREFIX}.{self.name}"

    @cached_property
    def schema(self) -> T.StructType:
        return struct(self.column_list)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def not_null(self) -> list[str]:
        return list(dict.fromkeys([*self.key, *self.required]))

    @property
    def folders(self) -> list[str]:
        return FOLDERS[self.strategy]


_BAR = (
    "ts_code string, trade_date date, open double, high double, low double, close double, "
    "pre_close double, change double, pct_chg double, vol double, amount double"
)
_DAY_KEY = ("ts_code", "trade_date")

_ALL = (
    Dataset(
        "stock_basic",
        "ts_code string, symbol string, name string, area string, industry string, "
        "fullname string, enname string, cnspell string, market string, exchange string, "
        "curr_type string, list_status string, list_date date, delist_date date, is_hs string, "
        "act_name string, act_ent_type string",
        key=("ts_code",),
        strategy="full",
        variant_column="list_status",
        variants=("L", "D", "P"),
    ),
    Dataset(
        "namechange",
        "ts_code string, name string, start_date date, end_date date, ann_date date, "
        "change_reason string",
        key=("ts_code", "start_date"),
        strategy="full",
        drop_exact_copies=True,
    ),
    Dataset(
        "trade_cal",
        "exchange string, cal_date date, is_open tinyint, pretrade_date date",
        key=("exchange", "cal_date"),
        strategy="calendar_year",
    ),
    Dataset("daily", _BAR, key=_DAY_KEY, strategy="trading_day"),
    Dataset(
        "adj_factor",
        "ts_code string, trade_date date, adj_factor double",
        key=_DAY_KEY,
        strategy="trading_day",
    ),
    Dataset(
        "daily_basic",
        "ts_code string, trade_date date, close double, turnover_rate double, "
        "turnover_rate_f double, volume_ratio double, pe double, pe_ttm double, pb double, "
        "ps double, ps_ttm double, dv_ratio double, dv_ttm double, total_share double, "
        "float_share double, free_share double, total_mv double, circ_mv double",
        key=_DAY_KEY,
        strategy="trading_day",
    ),
    # An event table: one security may be suspended and resumed on one day and the time of day may
    # be unknown, so no set of columns is a key.
    Dataset(
        "suspend_d",
        "ts_code string, trade_date date, suspend_timing string, suspend_type string",
        key=(),
        strategy="trading_day",
        required=("ts_code", "trade_date", "suspend_type"),
        allow_empty=True,
        drop_exact_copies=True,
    ),
    Dataset(
        "stk_limit",
        "trade_date date, ts_code string, pre_close double, up_limit double, down_limit double",
        key=_DAY_KEY,
        strategy="trading_day",
    ),
    Dataset(
        "index_basic",
        "ts_code string, name string, fullname string, market string, publisher string, "
        "index_type string, category string, base_date date, base_point double, list_date date, "
        "weight_rule string, desc string, exp_date date",
        key=("ts_code",),
        strategy="full",
        drop_exact_copies=True,
        variant_column="market",
        variants=INDEX_MARKETS,
    ),
    # Foreign indices trade on local holidays, hence natural days; a day may well be empty.
    Dataset("index_daily", _BAR, key=_DAY_KEY, strategy="calendar_day", allow_empty=True),
    Dataset(
        "index_dailybasic",
        "ts_code string, trade_date date, total_mv double, float_mv double, total_share double, "
        "float_share double, free_share double, turnover_rate double, turnover_rate_f double, "
        "pe double, pe_ttm double, pb double",
        key=_DAY_KEY,
        strategy="trading_day",
    ),
    Dataset(
        "index_weight",
        "index_code string, con_code string, trade_date date, weight double",
        key=("index_code", "con_code", "trade_date"),
        strategy="index_month",
        allow_empty=True,
    ),
    Dataset(
        "index_classify",
        "index_code string, industry_name string, level string, industry_code string, "
        "is_pub string, parent_code string, src string",
        key=("src", "index_code"),
        strategy="full",
        variant_column="src",
        variants=("SW2021",),
    ),
    Dataset(
        "index_member_all",
        "l1_code string, l1_name string, l2_code string, l2_name string, l3_code string, "
        "l3_name string, ts_code string, name string, in_date date, out_date date, is_new string",
        key=("ts_code", "l3_code", "in_date"),
        strategy="full",
        drop_exact_copies=True,
    ),
)

DATASETS = {dataset.name: dataset for dataset in _ALL}


def get_dataset(dataset_id: str) -> Dataset:
    """Look up by full id or, without a dot, by short name."""
    prefix, _, name = dataset_id.rpartition(".")
    if prefix in ("", PREFIX) and name in DATASETS:
        return DATASETS[name]
    known = ", ".join(sorted(d.id for d in _ALL))
    raise KeyError(f"unknown dataset {dataset_id!r}; known: {known}")
