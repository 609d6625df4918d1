"""The user-facing entry point: research queries, audits and maintenance over one lake."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake import catalog
from pitlake.functions import params
from pitlake.functions.params import DateLike
from pitlake.functions.predicates import restrict
from pitlake.operators import coverage, panels, prices, securities, tradability
from pitlake.operators.ordered import ordered
from pitlake.plans import ledger as ledgers
from pitlake.plans.sync import (
    DATED,
    HISTORY_START,
    INDEX_DATED,
    INDEX_MASTERS,
    MASTERS,
    Synchronizer,
    SyncReport,
)
from pitlake.sources.datasets import DATASETS, get_dataset
from pitlake.sources.lake import Lake
from pitlake.sources.landing import LandingZone, Source

Codes = str | Iterable[str] | None


class MarketLake:
    """Every query returns a lazy DataFrame and reads the committed state when it runs.

    ``landing`` is a folder in one of Spark's file formats or any ``Source`` of landed rows.
    ``tables`` (dataset name to DataFrame) and ``ledger`` replace the lake's own, so the same
    queries run over frames from anywhere.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str | None = None,
        landing: str | Source | None = None,
        *,
        landing_format: str = "parquet",
        tables: Mapping[str, DataFrame] | None = None,
        ledger: DataFrame | None = None,
        read_only: bool = False,
    ) -> None:
        if root is None and tables is None:
            raise ValueError("give a lake root or tables")
        self.spark = spark
        self.lake = Lake(spark, root) if root is not None else None
        if isinstance(landing, str):
            landing = LandingZone(spark, landing, landing_format)
        self.landing = landing
        self.read_only = read_only
        self._tables = tables
        self._ledger = ledger
        # Runs begun earlier and never finished belong to a process that is gone.
        self._opened_at = datetime.now(timezone.utc)

    def table(self, name: str) -> DataFrame:
        dataset = get_dataset(name)
        if self._tables is None:
            return self.lake.table(dataset.name)
        if dataset.name in self._tables:
            return self._tables[dataset.name]
        return self.spark.createDataFrame([], dataset.schema)

    def ledger(self) -> DataFrame:
        if self._ledger is not None:
            return self._ledger
        if self.lake is None:
            return self.spark.createDataFrame([], ledgers.LEDGER)
        return self.lake.ledger()

    def bars(
        self, symbols: Codes = None, *, start: DateLike | None = None, end: DateLike | None = None,
        adjust: str = "none", as_of: DateLike | None = None,
    ) -> DataFrame:
        rows, keys = self._bars(symbols, start, end, adjust, as_of)
        return ordered(rows, keys)

    def panel(
        self, symbols: Codes = None, *, start: DateLike | None = None, end: DateLike | None = None,
        adjust: str = "none", as_of: DateLike | None = None,
    ) -> DataFrame:
        metrics = panels.panel_metrics(self.table("daily_basic"))
        bars, keys = self._bars(symbols, start, end, adjust, as_of, metrics)
        return ordered(panels.adjusted_panel(bars), keys)

    def _bars(self, symbols, start, end, adjust, as_of, aligned=None) -> tuple[DataFrame, DataFrame]:
        """Unordered bars, and a narrow frame of their keys."""
        adjust, day = params.adjustment(adjust, as_of)
        codes = params.code_list(symbols)
        first, last = params.date_range(start, end)
        daily = self.table("daily")
        rows = prices.adjusted_bars(
            daily, self.table("adj_factor"), codes, first, last, adjust, day, aligned
        )
        return rows, restrict(daily, codes, first, prices.last_day(last, day))

    def index_bars(
        self, index_codes: Codes = None, *, start: DateLike | None = None,
        end: DateLike | None = None,
    ) -> DataFrame:
        codes = params.code_list(index_codes, "index_codes")
        rows = restrict(self.table("index_daily"), codes, *params.date_range(start, end))
        return ordered(panels.index_bar(rows), rows)

    def index_panel(
        self, index_codes: Codes = None, *, start: DateLike | None = None,
        end: DateLike | None = None,
    ) -> DataFrame:
        codes = params.code_list(index_codes, "index_codes")
        span = params.date_range(start, end)
        bars, metrics = (
            restrict(self.table(name), codes, *span) for name in ("index_daily", "index_dailybasic")
        )
        return ordered(panels.index_panel(bars, metrics), bars)

    def universe(
        self, as_of: DateLike, *, index_code: str | None = None, exclude_st: bool = False,
        exclude_delisting: bool = False,
    ) -> DataFrame:
        day, code = params.as_date(as_of), params.index_code(index_code)
        status = securities.security_status_asof(
            self.table("stock_basic"), self.table("namechange"), day
        )
        members = None
        if code is not None:
            members = self.members(code, day)
        rows = securities.universe(status, members, exclude_st, exclude_delisting)
        return rows.orderBy("ts_code")

    def members(self, index_code: str, as_of: DateLike) -> DataFrame:
        """The newest weights of an index that are not later than the day; over a lake, from the one month that holds them."""
        day = params.as_date(as_of)
        if self._tables is None:
            weights = self.lake.snapshot_month("index_weight", index_code, day)
        else:
            weights = self.table("index_weight")
        return securities.index_members_asof(weights, index_code, day)

    def clean(self) -> int:
        """See ``Lake.clean``: frees what replaced and failed runs have left."""
        if self.read_only:
            raise PermissionError("this lake was opened read-only")
        return self.lake.clean()

    def tradeability(self, as_of: DateLike, *, symbols: Codes = None) -> DataFrame:
        names = ("stk_limit", "suspend_d", "daily", "stock_basic", "namechange")
        return tradability.stock_trade_constraints_asof(
            *[self.table(name) for name in names],
            params.as_date(as_of),
            params.code_list(symbols),
        ).orderBy("ts_code")

    def health(
        self, *, start: DateLike = HISTORY_START, end: DateLike | None = None
    ) -> DataFrame:
        first, last = params.date_range(start, params.yesterday() if end is None else end)
        tables = {name: self.table(name) for name in DATASETS}
        return coverage.health(self.spark, tables, self.ledger(), first, last)

    def status(self, dataset_id: str | None = None) -> DataFrame:
        full_id = None if dataset_id is None else get_dataset(dataset_id).id
        return ledgers.status(self.ledger(), full_id)

    def runs(self) -> DataFrame:
        """The run log, one row per run."""
        if self.lake is None:
            raise ValueError("the run log needs a lake root")
        return self.lake.runs(F.lit(self._opened_at))

    def sql(self, query: str, **args) -> DataFrame:
        """Free SQL over the tables, views and functions of ``catalog``; ``:name`` takes args."""
        text = catalog.flat_names(query)
        catalog.register(self, text)
        return self.spark.sql(text, args=args or None)

    def sync(
        self, dataset_id: str, *, start: DateLike | None = None, end: DateLike | None = None,
        refresh: bool = False, index_codes: Codes = None,
    ) -> SyncReport:
        return self._synchronizer().sync(
            dataset_id, start=start, end=end, refresh=refresh, index_codes=index_codes
        )

    def update(
        self, *, start: DateLike = HISTORY_START, end: DateLike | None = None,
        index_codes: Codes = None,
    ) -> list[SyncReport]:
        return self._synchronizer().update(MASTERS, DATED, start, end, index_codes)

    def update_indices(
        self, *, start: DateLike = HISTORY_START, end: DateLike | None = None,
        index_codes: Codes = None,
    ) -> list[SyncReport]:
        return self._synchronizer().update(INDEX_MASTERS, INDEX_DATED, start, end, index_codes)

    def _synchronizer(self) -> Synchronizer:
        if self.read_only:
            raise PermissionError("this lake was opened read-only")
        if self.lake is None or self.landing is None:
            raise ValueError("syncing needs a lake root and a landing zone")
        return Synchronizer(self.lake, self.landing)
