"""The registered queries: every operator of the library over the derived market tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitlake import MarketLake
from pitlake.functions.typing import LANDED_DATE
from pitlake.operators import checks, pages, panels, prices, securities, tradability
from pitlake.operators.ordered import numbered
from pitlake.plans import ledger, partitions, runs
from pitlake.plans.sync import (
    DATED,
    INDEX_DATED,
    INDEX_MASTERS,
    MASTERS,
    SyncFailed,
    Synchronizer,
    update_plan,
)
from pitlake.sources.datasets import DATASETS, DEFAULT_INDEX_CODES
from pitlake.sources.lake import Lake
from pitlake.sources.landing import (
    LandingZone,
    drop_exact_copies,
    land_typed,
    variant_union,
)
from workload.derived import Derived, opened

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ANCHOR_DAY = date(2024, 1, 20)
NAME_DAY = date(2024, 1, 15)
MEMBER_DAY = date(2024, 1, 25)
INDUSTRY_DAY = date(2024, 1, 10)
AUDIT = {"start": date(2024, 1, 1), "end": date(2024, 1, 30)}
GAP_AUDIT = {"start": date(2024, 1, 1), "end": date(2024, 2, 2)}
INDEX = "click"
# The code list is the feature under test, not a shortcut.
SOME_CODES = ["1", "2", "3", "5", "8", "13", "21", "34", "55", "89", "144"]


def query(build: Callable[[Derived], DataFrame]) -> Callable[[Derived], DataFrame]:
    # A trailing underscore keeps a name apart from the function it runs.
    QUERIES[build.__name__.rstrip("_")] = lambda spark, sf_dir: build(opened(spark, sf_dir))
    return build


def market(t: Derived) -> MarketLake:
    return MarketLake(t.spark, tables=t.tables, ledger=ledger.latest_commits(t["commits"]))


def as_text(t: Derived, name: str) -> DataFrame:
    """A derived table in its landed form."""
    fields = DATASETS[name].schema
    return t.dataset(name).select(
        *[
            (F.date_format(f.name, LANDED_DATE) if f.dataType.typeName() == "date"
             else F.col(f.name).cast("string")).alias(f.name)
            for f in fields
        ]
    )


def scan(name: str) -> Query:
    return lambda spark, sf_dir: land_typed(DATASETS[name], as_text(opened(spark, sf_dir), name))


for _name in DATASETS:
    QUERIES[f"scan_{_name}"] = scan(_name)


# Price bars


@query
def bars_raw(t):
    return market(t).bars()


@query
def bars_hfq(t):
    return market(t).bars(adjust="hfq")


@query
def bars_qfq_latest(t):
    return market(t).bars(adjust="qfq")


@query
def bars_qfq_asof(t):
    return market(t).bars(adjust="qfq", as_of=ANCHOR_DAY)


@query
def bars_symbols_range(t):
    return market(t).bars(SOME_CODES, start="2024-01-05", end="2024-01-25", adjust="qfq")


@query
def bars_qfq_numbered(t):
    """The order of the rows, as numbers: partitions in order, and rows in order within each."""
    return numbered(market(t).bars(adjust="qfq")).select("position", "trade_date", "ts_code", "close")


@query
def panel_numbered(t):
    return numbered(market(t).panel()).select("position", "trade_date", "ts_code", "close", "pe")


@query
def bars_numbered_few_days(t):
    """Two days, each heavier than a range, which are cut by code."""
    bars = market(t).bars(start="2024-01-08", end="2024-01-09", adjust="hfq")
    return numbered(bars).select("position", "trade_date", "ts_code", "close")


@query
def latest_adj_factor(t):
    return prices.latest_adj_factor(t.dataset("adj_factor"))


# Panels


@query
def daily_metrics(t):
    return panels.daily_metrics(t.dataset("daily_basic"))


@query
def daily_panel(t):
    bars = prices.daily_bar(t.dataset("daily"), t.dataset("adj_factor"))
    return panels.daily_panel(bars, t.dataset("daily_basic"))


@query
def panel_none(t):
    return market(t).panel()


@query
def panel_hfq(t):
    return market(t).panel(adjust="hfq")


@query
def panel_qfq(t):
    return market(t).panel(adjust="qfq")


@query
def panel_qfq_asof(t):
    return market(t).panel(adjust="qfq", as_of=ANCHOR_DAY)


@query
def index_basic(t):
    return panels.index_basic(t.dataset("index_basic"))


@query
def index_bars(t):
    return market(t).index_bars()


@query
def index_metrics(t):
    return panels.index_metrics(t.dataset("index_dailybasic"))


@query
def index_panel(t):
    return market(t).index_panel()


@query
def industry_classification(t):
    return panels.industry_classification(t.dataset("index_classify"))


# Securities on a day


@query
def name_history(t):
    return securities.name_history(t.dataset("namechange"))


@query
def security_status_asof(t):
    return securities.security_status_asof(
        t.dataset("stock_basic"), t.dataset("namechange"), NAME_DAY
    )


@query
def index_members_asof(t):
    return securities.index_members_asof(t.dataset("index_weight"), INDEX, MEMBER_DAY)


@query
def stock_industry_asof(t):
    return securities.stock_industry_asof(t.dataset("index_member_all"), INDUSTRY_DAY)


@query
def universe_all(t):
    return market(t).universe(NAME_DAY)


@query
def universe_index(t):
    return market(t).universe(MEMBER_DAY, index_code=f" {INDEX} ")


@query
def universe_exclude_st(t):
    return market(t).universe(NAME_DAY, exclude_st=True, exclude_delisting=True)


# Suspensions, limits, tradability


@query
def suspension_rollup(t):
    return tradability.suspension_daily(t.dataset("suspend_d"))


def _constraints(t: Derived, bucketed: bool = False) -> DataFrame:
    return tradability.trade_constraints(
        t.dataset("stk_limit"), t.dataset("suspend_d"), t.dataset("daily"), bucketed
    )


@query
def trade_constraints(t):
    return _constraints(t)


@query
def stock_trade_constraints(t):
    return tradability.stock_trade_constraints(
        _constraints(t, bucketed=True), t.dataset("stock_basic"), t.dataset("namechange")
    )


@query
def tradeability_asof(t):
    return market(t).tradeability(NAME_DAY)


@query
def tradeability_symbols(t):
    return market(t).tradeability(INDUSTRY_DAY, symbols=SOME_CODES)


# Audit


@query
def health(t):
    return market(t).health(**AUDIT)


@query
def health_calendar_gap(t):
    return market(t).health(**GAP_AUDIT)


@query
def health_empty_tables(t):
    """Bars alone: every other dataset is empty or incomplete."""
    some = {"trade_cal": t.dataset("trade_cal"), "daily": t.dataset("daily")}
    return MarketLake(t.spark, tables=some).health(**AUDIT)


# Partition plans


def _span(t: Derived, table: str, column: str) -> DataFrame:
    day = F.col(column).cast("date")
    return t.base(table).agg(F.min(day).alias("start"), F.max(day).alias("end"))


@query
def open_dates(t):
    return partitions.open_dates(t.dataset("trade_cal"), AUDIT["start"], AUDIT["end"])


@query
def plan_calendar_year(t):
    return partitions.calendar_years(_span(t, "orders", "o_orderdate"), DATASETS["trade_cal"].id)


@query
def plan_calendar_day(t):
    return partitions.calendar_days(_span(t, "orders", "o_orderdate"), DATASETS["index_daily"].id)


@query
def plan_trading_day(t):
    days = partitions.open_dates(t.dataset("trade_cal"), None, None)
    return partitions.trading_days(days, DATASETS["daily"].id)


@query
def plan_index_month(t):
    return partitions.index_months(
        _span(t, "orders", "o_orderdate"), DATASETS["index_weight"].id, DEFAULT_INDEX_CODES
    )


def _event_days(t: Derived, name: str = "index_daily") -> DataFrame:
    return partitions.calendar_days(_span(t, "events", "ts"), DATASETS[name].id)


@query
def plan_pending(t):
    return ledger.pending(_event_days(t), ledger.latest_commits(t["commits"])).select(
        "dataset_id", "partition_id"
    )


def _update_steps(t: Derived, masters: list[str], dated: list[str]) -> DataFrame:
    """Span and open days come from one look at the event days, of which the calendar is made."""
    days = partitions.open_dates(t.dataset("trade_cal"), None, None)
    return update_plan(
        _span(t, "events", "ts"), days, ledger.latest_commits(t["commits"]), [*masters, *dated], masters
    )


@query
def update_plan_(t):
    """What a full update has to do, step by step."""
    return _update_steps(t, MASTERS, DATED)


@query
def update_indices_plan(t):
    return _update_steps(t, INDEX_MASTERS, INDEX_DATED)


# Ledger and run log


@query
def ledger_latest(t):
    return ledger.latest_commits(t["commits"])


@query
def status(t):
    return market(t).status()


@query
def status_dataset(t):
    return market(t).status("suspend_d")


@query
def committed_rows(t):
    """Rows of replaced runs disappear: of all landed rows of a day only the last run's count."""
    stored = t.base("events").select(
        "event_id", "user_id",
        F.concat(
            F.lit("trade_date="), F.col("ts").cast("date").cast("string"), F.lit("/"),
            F.concat_ws("-", "event_type", F.hour("ts").cast("string")),
        ).alias("run_id"),
    )
    last = ledger.latest_commits(t["commits"]).withColumn(
        "run_id", F.concat_ws("/", "partition_id", "run_id")
    )
    return ledger.committed_rows(stored, last)


@query
def run_status(t):
    ts = F.col("ts")
    events = t.base("events").withColumn(
        "run_id", F.concat_ws("/", F.col("user_id").cast("string"), ts.cast("date").cast("string"))
    )
    starts = events.groupBy("run_id").agg(F.min("ts").alias("event_ts")).withColumn(
        "event", F.lit("RUNNING")
    )
    n, outcome = F.col("event_id"), F.col("event_type")
    # Clicks and signups report that the run is still alive.
    ends = events.select(
        "run_id",
        F.when(outcome == "error", "FAILED").when(outcome == "view", "INTERRUPTED")
        .when(outcome == "purchase", "SUCCESS").otherwise("RUNNING").alias("event"),
        ts.alias("event_ts"),
        n.alias("rows_received"),
        F.when(n % 3 == 0, "InterruptException").when(n % 3 == 1, "RuntimeError")
        .otherwise("ValueError").alias("error_type"),
        F.when(n % 2 == 0, " Query Interrupted ").otherwise(F.repeat(F.lit("x"), 5000))
        .alias("error_message"),
    )
    log = ends.unionByName(starts, allowMissingColumns=True).withColumns(
        {"dataset_id": F.lit("tushare.daily"), "partition_id": F.substring_index("run_id", "/", -1),
         "request_params": F.lit("{}")}
    )
    return runs.run_status(log, F.lit("2024-01-20").cast("timestamp_ntz"))


# Landing and checks


@query
def land_typed_(t):
    factors = DATASETS["adj_factor"]
    found = checks.verdicts(factors, t["landed"], _event_days(t, "adj_factor"))
    sound = found.where(F.col("error_message").isNull()).select("partition_id")
    return land_typed(factors, t["landed"].join(sound, "partition_id"), "partition_id")


@query
def variant_union_(t):
    landed, dataset = as_text(t, "stock_basic"), DATASETS["stock_basic"]
    frames = {v: landed.where(F.col("list_status") == v) for v in dataset.variants}
    return variant_union(frames).select("variant", "ts_code", "symbol", "list_date", "delist_date")


@query
def exact_dedupe(t):
    landed = as_text(t, "suspend_d").withColumn("partition_id", F.col("trade_date"))
    return drop_exact_copies(DATASETS["suspend_d"], landed)


@query
def validate_nulls(t):
    return checks.null_counts(DATASETS["adj_factor"], t["landed"])


@query
def validate_pk(t):
    return checks.duplicate_keys(DATASETS["adj_factor"], t["landed"])


@query
def validate_scope_day(t):
    plan = _event_days(t, "adj_factor")
    return checks.scope_counts(DATASETS["adj_factor"], t["landed"], plan)


@query
def validate_scope_calendar(t):
    """Calendar batches by year; orders of odd keys claim another exchange."""
    day = F.col("o_orderdate").cast("date")
    plan = partitions.calendar_years(_span(t, "orders", "o_orderdate"), DATASETS["trade_cal"].id)
    landed = t.base("orders").select(
        F.concat(F.lit("exchange=SSE/year="), F.year(day)).alias("partition_id"),
        F.when(F.col("o_orderkey") % 2 == 1, "SZSE").otherwise(" SSE ").alias("exchange"),
        F.date_format(day, LANDED_DATE).alias("cal_date"),
    )
    return checks.scope_counts(DATASETS["trade_cal"], landed, plan)


@query
def validate_scope_month(t):
    """Weight batches by month; some rows carry another code or a day of another month."""
    day, key = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    plan = partitions.index_months(
        _span(t, "orders", "o_orderdate"), DATASETS["index_weight"].id, ["A", "B"]
    )
    code = F.when(key % 2 == 0, "A").otherwise("B")
    landed = t.base("orders").select(
        F.concat(
            F.lit("index_code="), code, F.lit("/month="), F.date_format(day, "yyyy-MM")
        ).alias("partition_id"),
        F.when(key % 7 == 0, "C").otherwise(code).alias("index_code"),
        F.date_format(
            F.when(key % 5 == 0, F.add_months(day, 1)).otherwise(day), LANDED_DATE
        ).alias("trade_date"),
    )
    return checks.scope_counts(DATASETS["index_weight"], landed, plan)


@query
def validate_columns(t):
    """Datasets whose source lacks declared columns, and how many rows that spoils."""
    frames = []
    for name in ("daily", "namechange", "index_classify"):
        landed = as_text(t, name).drop("amount", "change_reason")
        lacking = checks.missing_columns(DATASETS[name], landed)
        frames.append(
            landed.groupBy().agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(DATASETS[name].id).alias("dataset_id"),
                F.lit(",".join(lacking)).alias("missing_columns"), "row_count",
            )
        )
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query
def validate_batches(t):
    """The verdict on every planned batch, empty ones included."""
    plan = _event_days(t, "adj_factor")
    return checks.verdicts(DATASETS["adj_factor"], t["landed"], plan).select(
        "partition_id", "row_count", "error_message"
    )


@query
def validate_batches_no_key(t):
    """The same for an event table: no key, empty batches allowed, exact copies dropped."""
    dataset = DATASETS["suspend_d"]
    landed = as_text(t, "suspend_d").withColumn(
        "partition_id",
        F.concat(F.lit("trade_date="), F.to_date("trade_date", LANDED_DATE).cast("string")),
    )
    plan = _event_days(t, "suspend_d")
    return checks.verdicts(dataset, drop_exact_copies(dataset, landed), plan).select(
        "partition_id", "row_count", "error_message"
    )


@query
def sync_report(t):
    plan = _event_days(t, "index_daily")
    done = ledger.latest_commits(t["commits"])
    landed = as_text(t, "index_daily").withColumn(
        "partition_id",
        F.concat(F.lit("trade_date="), F.to_date("trade_date", LANDED_DATE).cast("string")),
    )
    todo = ledger.pending(plan, done)
    found = checks.verdicts(DATASETS["index_daily"], landed, todo)
    return ledger.sync_counts(ledger.sync_results(ledger.already_done(plan, done), found))


@query
def page_audit(t):
    """Requests by day and kind, one page per hour and an empty last page, with planted faults."""
    day = F.col("ts").cast("date")
    rows = t.base("events").select(
        F.concat(F.lit("trade_date="), day.cast("string")).alias("partition_id"),
        F.col("event_type").alias("variant"),
        F.hour("ts").alias("page"),
        "event_id",
        F.col("user_id").alias("code"),
        (F.col("event_id") % 97).alias("cell"),
    )
    received = pages.page_rows(rows, ["cell"])
    number = F.dayofmonth(F.to_date(F.substring_index("partition_id", "=", -1)))
    hours = F.explode(F.sequence(F.lit(0), F.lit(24))).alias("page")
    asked = rows.select(*pages.REQUEST).distinct().select(*pages.REQUEST, hours)
    before = Window.partitionBy(*pages.REQUEST).orderBy("page").rowsBetween(
        Window.unboundedPreceding, -1
    )
    manifest = asked.join(received, [*pages.REQUEST, "page"], "left").withColumn(
        "page_offset", F.coalesce(F.sum("n").over(before), F.lit(0))
        + F.when((number * 24 + F.col("page")) % 131 == 0, 1).otherwise(0)
    ).select(
        *pages.REQUEST, "page", "page_offset",
        (~((F.col("page") == 24) & (number % 11 == 0))).alias("has_columns"),
    ).where((F.col("page") < 24) | (number % 7 != 0))
    repeated = pages.keys_on_many_pages(rows, ["code", "cell"])
    return pages.page_audit(manifest, received, repeated)


def _work_dir(spark: SparkSession) -> str:
    """A new folder in the cluster's shared checkpoint folder, or else, on one machine, below the session's warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/pitlake-{uuid.uuid4().hex}"


@query
def partition_replace(t):
    """Landed index bars are synced day by day, then synced again with other prices for some days.

    The second landing lacks day 12 (replaced by an empty day) and has a repeated key on day 13
    (rejected, so the first version stays).
    """
    root, dataset = _work_dir(t.spark), DATASETS["index_daily"]
    day = F.to_date("trade_date", LANDED_DATE)
    folder = F.concat(F.lit("trade_date="), day.cast("string"))
    first = as_text(t, "index_daily").withColumn("partition_id", folder)
    number = F.dayofmonth(day)
    doubled = (F.col("close").cast("double") * 2).cast("string")
    second = first.where(number != 12).withColumn("close", doubled)
    second = second.unionByName(second.where(number == 13))
    for generation, rows in (("first", first), ("second", second)):
        rows.write.partitionBy("partition_id").parquet(f"{root}/{generation}/{dataset.name}")
    lake = Lake(t.spark, f"{root}/lake")
    span = {"start": date(2024, 1, 1), "end": date(2024, 1, 30)}
    Synchronizer(lake, LandingZone(t.spark, f"{root}/first")).sync("index_daily", **span)
    zone = LandingZone(t.spark, f"{root}/second")
    try:
        Synchronizer(lake, zone).sync(
            "index_daily", start=date(2024, 1, 10), end=date(2024, 1, 20), refresh=True
        )
    except RuntimeError as rejected:
        if rejected.report is None or rejected.report.failed != 1:
            raise
    return lake.table("index_daily").select("ts_code", "trade_date", "open", "close", "vol")


def _sync_some(lake: Lake, zone: LandingZone, name: str, **options) -> None:
    """A sync of which exactly some partitions are rejected."""
    try:
        Synchronizer(lake, zone).sync(name, **options)
    except SyncFailed as rejected:
        if rejected.report is None:
            raise
        return
    raise AssertionError(f"{name}: no partition was rejected")


@query
def sync_missing_column(t):
    """Files of every seventh day lack a column: those days are rejected, the others are committed."""
    root, day = _work_dir(t.spark), F.to_date("trade_date", LANDED_DATE)
    rows = as_text(t, "index_daily").withColumn("partition_id", F.concat(F.lit("trade_date="), day.cast("string")))
    faulty = F.dayofmonth(day) % 7 == 0
    for part in (rows.where(~faulty), rows.where(faulty).drop("amount")):
        part.write.mode("append").partitionBy("partition_id").parquet(f"{root}/landing/index_daily")
    lake = Lake(t.spark, f"{root}/lake")
    _sync_some(lake, LandingZone(t.spark, f"{root}/landing"), "index_daily", start=date(2024, 1, 1), end=date(2024, 1, 30))
    return lake.table("index_daily").select("ts_code", "trade_date", "open", "close", "vol")


@query
def sync_missing_variant(t):
    """A list with all its request variants, one of them empty or not, then one without the last variant."""
    root, dataset = _work_dir(t.spark), DATASETS["stock_basic"]
    landed = as_text(t, "stock_basic").withColumn("partition_id", F.lit("full"))
    asked = t.spark.createDataFrame([("full", v) for v in dataset.variants], "partition_id string, variant string")
    whole = landed.withColumn("variant", F.col("list_status")).unionByName(asked, allowMissingColumns=True)
    part = whole.where(F.col("variant") != dataset.variants[-1]).withColumn("symbol", F.lit("replaced"))
    for generation, rows in (("first", whole), ("second", part)):
        rows.write.partitionBy("partition_id", "variant").parquet(f"{root}/{generation}/stock_basic")
    lake = Lake(t.spark, f"{root}/lake")
    Synchronizer(lake, LandingZone(t.spark, f"{root}/first")).sync("stock_basic")
    _sync_some(lake, LandingZone(t.spark, f"{root}/second"), "stock_basic", refresh=True)
    return lake.table("stock_basic").select("ts_code", "symbol", "list_date", "delist_date")


@query
def sync_bad_pages(t):
    """Days in three pages and an empty last one: some stop early, skip an offset or stand still and are rejected."""
    root, day = _work_dir(t.spark), F.to_date("trade_date", LANDED_DATE)
    rows = as_text(t, "index_daily").withColumn("partition_id", F.concat(F.lit("trade_date="), day.cast("string")))
    rows = rows.withColumn("page", F.pmod(F.xxhash64("ts_code"), F.lit(3)).cast("int"))
    number = F.dayofmonth(F.to_date(F.substring_index("partition_id", "=", -1)))
    days = rows.select("partition_id").distinct()
    sizes = rows.groupBy("partition_id", "page").agg(F.count("*").alias("n"))
    before = Window.partitionBy("partition_id").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    asked = days.select("partition_id", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("page"))
    offset = F.coalesce(F.sum("n").over(before), F.lit(0)) + F.when((number % 11 == 0) & (F.col("page") == 2), 1).otherwise(0)
    manifest = asked.join(sizes, ["partition_id", "page"], "left").select(
        "partition_id", "page", offset.alias("page_offset"), F.lit(True).alias("has_columns")
    ).where((F.col("page") < 3) | (number % 7 != 0))
    landed = rows.unionByName(rows.where(number % 13 == 0).withColumn("page", F.col("page") + 1))
    landed.write.partitionBy("partition_id", "page").parquet(f"{root}/landing/index_daily")
    manifest.write.parquet(f"{root}/landing/_pages/index_daily")
    lake = Lake(t.spark, f"{root}/lake")
    _sync_some(lake, LandingZone(t.spark, f"{root}/landing"), "index_daily", start=date(2024, 1, 1), end=date(2024, 1, 30))
    return lake.table("index_daily").select("ts_code", "trade_date", "open", "close", "vol")


@query
def sync_page_copies(t):
    """An event table in pages: exact copies may cross a page's edge, a page that came twice is rejected."""
    root, day = _work_dir(t.spark), F.to_date("trade_date", LANDED_DATE)
    rows = as_text(t, "suspend_d").withColumn("partition_id", F.concat(F.lit("trade_date="), day.cast("string")))
    rows = rows.withColumn("page", F.pmod(F.xxhash64("ts_code", "suspend_timing"), F.lit(2)).cast("int"))
    number = F.dayofmonth(day)
    # Every third day the first page's rows of one kind come on the second page too; every seventh day all of them do.
    across = rows.where((F.col("page") == 0) & (number % 3 == 0) & (F.col("suspend_type") == "S"))
    twice = rows.where((F.col("page") == 0) & (number % 7 == 0))
    landed = rows.where((F.col("page") == 0) | (number % 7 != 0)).unionByName(
        across.where(number % 7 != 0).withColumn("page", F.lit(1))
    ).unionByName(twice.withColumn("page", F.lit(1)))
    sizes = landed.groupBy("partition_id", "page").agg(F.count("*").alias("n"))
    before = Window.partitionBy("partition_id").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    asked = landed.select("partition_id").distinct().select("partition_id", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("page"))
    manifest = asked.join(sizes, ["partition_id", "page"], "left").select(
        "partition_id", "page", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("page_offset"), F.lit(True).alias("has_columns")
    )
    landed.write.partitionBy("partition_id", "page").parquet(f"{root}/landing/suspend_d")
    manifest.write.parquet(f"{root}/landing/_pages/suspend_d")
    calendar = as_text(t, "trade_cal").withColumns({"partition_id": F.lit("exchange=SSE/year=2024"), "is_open": F.lit("1")})
    calendar.write.partitionBy("partition_id").parquet(f"{root}/landing/trade_cal")
    lake = Lake(t.spark, f"{root}/lake")
    _sync_some(lake, LandingZone(t.spark, f"{root}/landing"), "suspend_d", start=date(2024, 1, 1), end=date(2024, 1, 30))
    return lake.table("suspend_d")


#: A dataset of each layout, in the order an update brings them in.
LAYOUTS = ["stock_basic", "trade_cal", "adj_factor", "index_daily", "index_weight"]


def _landed_layouts(t: Derived, root: str) -> None:
    def land(name: str, partition_id, *rows: DataFrame) -> None:
        landed = as_text(t, name) if not rows else rows[0]
        landed.withColumn("partition_id", partition_id).write.partitionBy("partition_id").parquet(f"{root}/landing/{name}")

    def iso(name: str):
        return F.to_date(name, LANDED_DATE)

    of_day = F.concat(F.lit("trade_date="), iso("trade_date").cast("string"))
    land("stock_basic", F.lit("full"))
    land("trade_cal", F.concat(F.lit("exchange=SSE/year="), F.year(iso("cal_date")).cast("string")))
    land("adj_factor", of_day)
    land("index_daily", of_day)
    month = F.date_format(iso("trade_date"), "yyyy-MM")
    land("index_weight", F.concat(F.lit("index_code="), F.col("index_code"), F.lit("/month="), month))


@lru_cache(maxsize=4)
def _updated(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake after one update of all five layouts; its folder stays for the session's other looks at it."""
    t = opened(spark, sf_dir)
    root = _work_dir(spark)
    _landed_layouts(t, root)
    lake = Lake(spark, f"{root}/lake")
    sync = Synchronizer(lake, LandingZone(spark, f"{root}/landing"))
    reports = sync.update(LAYOUTS[:1], LAYOUTS[1:], date(2024, 1, 1), date(2024, 1, 31), [INDEX])
    if any(report.failed for report in reports):
        raise AssertionError("a partition was rejected")
    return lake


def _layout(name: str) -> None:
    """Registers what one dataset holds after the update."""
    QUERIES[f"update_{name}"] = lambda spark, sf_dir: _updated(spark, sf_dir).table(name)


for _name in LAYOUTS:
    _layout(_name)


@query
def lake_members_asof(t):
    """Weights read back from a lake: the month is chosen by the ledger, another month lies behind it."""
    root, weights = _work_dir(t.spark), as_text(t, "index_weight")
    day = F.to_date("trade_date", LANDED_DATE)
    earlier = weights.withColumns({"trade_date": F.date_format(F.add_months(day, -1), LANDED_DATE), "weight": F.lit("0.5")})
    rows, day = weights.unionByName(earlier.distinct()), F.to_date("trade_date", LANDED_DATE)
    folder = F.concat(F.lit("index_code="), F.col("index_code"), F.lit("/month="), F.date_format(day, "yyyy-MM"))
    rows = rows.dropDuplicates(["index_code", "con_code", "trade_date"])
    rows.withColumn("partition_id", folder).write.partitionBy("partition_id").parquet(f"{root}/landing/index_weight")
    market = MarketLake(t.spark, f"{root}/lake", f"{root}/landing")
    market.sync("index_weight", start=date(2023, 12, 1), end=date(2024, 1, 31), index_codes=[INDEX])
    return market.members(INDEX, MEMBER_DAY)


@query
def sync_csv_by_name(t):
    """CSV files whose columns stand in another order than the declared one."""
    root, day = _work_dir(t.spark), F.to_date("trade_date", LANDED_DATE)
    rows = as_text(t, "index_daily").withColumn("partition_id", F.concat(F.lit("trade_date="), day.cast("string")))
    turned = rows.select(*reversed(DATASETS["index_daily"].columns), "partition_id")
    turned.write.option("header", True).partitionBy("partition_id").csv(f"{root}/landing/index_daily")
    lake = Lake(t.spark, f"{root}/lake")
    zone = LandingZone(t.spark, f"{root}/landing", "csv")
    Synchronizer(lake, zone).sync("index_daily", start=date(2024, 1, 1), end=date(2024, 1, 30))
    return lake.table("index_daily").select("ts_code", "trade_date", "open", "close", "vol")


# SQL surface


@query
def sql_adhoc(t):
    return market(t).sql(
        """
        select bar.trade_date, count(*) as bar_count, count(bar.adj_factor) as factor_count,
               max(bar.close) as top_close, count_if(status.can_buy_at_open) as buyable
        from market_daily_bar bar
        left join market_trade_constraints_daily status
          on status.ts_code = bar.ts_code and status.trade_date = bar.trade_date
        where bar.trade_date >= :since
        group by bar.trade_date
        """,
        since=date(2024, 1, 1),
    )


@query
def sql_qfq_asof(t):
    return market(t).sql(
        "select * from market_daily_bar_qfq_asof(:d)", d=ANCHOR_DAY
    )


@query
def sql_status_asof(t):
    return market(t).sql("select * from market_security_status_asof(:d)", d=NAME_DAY)


@query
def sql_constraints_asof(t):
    return market(t).sql("select * from market_stock_trade_constraints_asof(:d)", d=NAME_DAY)


@query
def sql_members_asof(t):
    return market(t).sql("select * from indices_members_asof(:c, :d)", c=INDEX, d=MEMBER_DAY)


@query
def sql_industry_asof(t):
    return market(t).sql("select * from indices_stock_industry_asof(:d)", d=INDUSTRY_DAY)
