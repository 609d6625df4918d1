"""Landing, checking and committing partitions."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pitlake import MarketLake, SyncFailed
from pitlake.functions.typing import LANDED_DATE
from pitlake.operators import checks
from pitlake.plans import partitions
from pitlake.plans.runs import RUN_EVENTS, run_status
from pitlake.sources.datasets import DATASETS, get_dataset
from tests.conftest import values


class Landing:
    """Writes landed text in the folder layout the zone reads."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.generation = 0

    @property
    def path(self):
        return f"{self.root}/landing{self.generation}"

    def put(self, name, partition_id, rows, columns):
        dataset = DATASETS[name]
        full = [
            tuple(dict(zip(columns, row, strict=True)).get(c) for c in dataset.columns)
            + (partition_id,)
            for row in rows
        ]
        text = ", ".join(f"`{c}` string" for c in [*dataset.columns, "partition_id"])
        self.spark.createDataFrame(full, text).write.mode("append").partitionBy(
            "partition_id"
        ).parquet(f"{self.path}/{name}")

    def calendar(self, year=2024):
        rows = [("SSE", f"{year}010{day}", "0" if day == 1 else "1") for day in (1, 2, 3)]
        self.put("trade_cal", f"exchange=SSE/year={year}", rows, ["exchange", "cal_date", "is_open"])

    def day(self, name, day, rows, columns=("ts_code", "close")):
        columns = ["trade_date", *columns]
        full = [(day.strftime("%Y%m%d"), *row) for row in rows]
        self.put(name, f"trade_date={day}", full, columns)


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


def lake(spark, landing, **options):
    return MarketLake(spark, f"{landing.root}/lake", landing.path, **options)


D1, D2, D3 = (date(2024, 1, n) for n in (1, 2, 3))


def test_trading_day_sync_fills_the_calendar_first(spark, landing):
    landing.calendar()
    landing.day("daily", D2, [("A", "10.5"), ("B", "3")])
    landing.day("daily", D3, [("A", "11")])
    market = lake(spark, landing)
    report = market.sync("tushare.daily", start="2024-01-01", end="2024-01-03")
    assert (report.completed, report.skipped) == (2, 0)
    assert values(market.status(), "dataset_id partition_id row_count") == [
        ("tushare.daily", "trade_date=2024-01-02", 2),
        ("tushare.daily", "trade_date=2024-01-03", 1),
        ("tushare.trade_cal", "exchange=SSE/year=2024", 3),
    ]
    assert values(market.bars(), "trade_date ts_code close") == [
        (D2, "A", 10.5), (D2, "B", 3.0), (D3, "A", 11.0),
    ]
    again = market.sync("daily", start="2024-01-01", end="2024-01-03")
    assert (again.completed, again.skipped) == (0, 2)
    assert values(again.results, "partition_id status row_count") == [
        ("trade_date=2024-01-02", "SKIPPED", None), ("trade_date=2024-01-03", "SKIPPED", None),
    ]
    assert set(values(market.runs(), "status")) == {("SUCCESS",)}


def test_empty_days_are_committed_where_allowed(spark, landing):
    landing.calendar()
    landing.day("index_daily", D2, [("I", "1")])
    landing.day("suspend_d", D3, [("A", "S"), ("A", "S"), ("A", "R")], ("ts_code", "suspend_type"))
    market = lake(spark, landing)
    assert market.sync("index_daily", start=D1, end=D3).completed == 3
    assert values(market.status("index_daily"), "partition_id row_count") == [
        ("trade_date=2024-01-01", 0), ("trade_date=2024-01-02", 1), ("trade_date=2024-01-03", 0),
    ]
    assert market.sync("suspend_d", start=D1, end=D3).completed == 2
    assert values(market.status("suspend_d"), "row_count") == [(0,), (2,)]
    health = market.health(start=D1, end=D3).where(
        "dataset_id in ('tushare.index_daily', 'tushare.suspend_d')"
    )
    assert values(health, "status expected_days available_days") == [
        ("HEALTHY", 3, 3), ("HEALTHY", 2, 2),
    ]
    assert values(
        market.sql("select suspend_type from market_trade_constraints_daily where ts_code = 'A'")
    ) == [("S,R",)]


def test_good_partitions_are_committed_and_bad_ones_keep_their_data(spark, landing):
    landing.calendar()
    for day in (D2, D3):
        landing.day("daily", day, [("A", "10.5")])
    market = lake(spark, landing)
    market.sync("daily", start=D1, end=D3)
    before = dict(values(market.status("daily"), "partition_id run_id"))

    landing.generation += 1
    landing.day("daily", D2, [("A", "not a number")])
    landing.day("daily", D3, [("A", "12"), ("B", "13")])
    market = lake(spark, landing)
    with pytest.raises(SyncFailed, match="malformed") as caught:
        market.sync("daily", start=D1, end=D3, refresh=True)
    assert (caught.value.report.completed, caught.value.report.failed) == (1, 1)
    assert values(market.bars(), "trade_date ts_code close") == [
        (D2, "A", 10.5), (D3, "A", 12.0), (D3, "B", 13.0),
    ]
    after = dict(values(market.status("daily"), "partition_id run_id"))
    assert after["trade_date=2024-01-02"] == before["trade_date=2024-01-02"]
    assert after["trade_date=2024-01-03"] != before["trade_date=2024-01-03"]
    outcomes = market.runs().where("dataset_id = 'tushare.daily'").orderBy("started_at", "partition_id")
    assert values(outcomes, "partition_id status error_type") == [
        ("trade_date=2024-01-02", "SUCCESS", None),
        ("trade_date=2024-01-03", "SUCCESS", None),
        ("trade_date=2024-01-02", "FAILED", "DatasetValidationError"),
        ("trade_date=2024-01-03", "SUCCESS", None),
    ]


def test_refresh_with_an_empty_batch_empties_the_partition(spark, landing):
    landing.day("index_daily", D2, [("I", "1")])
    market = lake(spark, landing)
    market.sync("index_daily", start=D2)
    assert market.table("index_daily").count() == 1
    landing.generation += 1
    landing.day("index_daily", D3, [("I", "1")])
    market = lake(spark, landing)
    market.sync("index_daily", start=D2, refresh=True)
    assert market.table("index_daily").count() == 0


@pytest.mark.parametrize(
    ("rows", "message"),
    [
        ([], "empty batch"),
        ([(None, "20240102", "1")], "NULL in a required"),
        ([("A", "20240102", "1"), ("A", "20240102", "2"), ("B", "20240102", "2")], "2 rows with a repeated"),
        ([("A", "20240103", "1")], "outside the requested"),
        ([("A", "20240102", "x")], "malformed"),
        ([("A", " ", "1")], "outside the requested"),
        ([("A", " 20240102 ", "1"), ("A", "20240102", "2")], "2 rows with a repeated"),
    ],
)
def test_rejected_batches(spark, rows, message):
    dataset = DATASETS["adj_factor"]
    landed = spark.createDataFrame(
        [("trade_date=2024-01-02", *row) for row in rows],
        "partition_id string, ts_code string, trade_date string, adj_factor string",
    )
    plan = partitions.calendar_days(partitions.bounds(spark, D2, D2), dataset.id)
    [verdict] = checks.verdicts(dataset, landed, plan).collect()
    assert message in verdict.error_message


def test_calendar_and_month_scopes(spark):
    span = partitions.bounds(spark, date(2024, 1, 15), date(2024, 2, 28))
    calendar = DATASETS["trade_cal"]
    landed = spark.createDataFrame(
        [("exchange=SSE/year=2024", " SSE ", "20230101"), ("exchange=SSE/year=2024", "SZSE", "20240101")],
        "partition_id string, exchange string, cal_date string",
    )
    plan = partitions.calendar_years(span, calendar.id)
    assert values(checks.scope_counts(calendar, landed, plan)) == [("exchange=SSE/year=2024", 1)]

    weights = DATASETS["index_weight"]
    month = "index_code=I/month=2024-01"
    landed = spark.createDataFrame(
        [(month, "I", "20240101"), (month, "I", "20240201"), (month, "J", "20240102")],
        "partition_id string, index_code string, trade_date string",
    )
    plan = partitions.index_months(span, weights.id, ["I", "J"])
    assert [row.partition_id for row in plan.collect()] == [
        "index_code=I/month=2024-01", "index_code=J/month=2024-01",
    ]
    assert values(checks.scope_counts(weights, landed, plan)) == [(month, 2)]


def test_index_weight_syncs_whole_months_of_each_code(spark, landing):
    for code in ("300", "852"):
        landing.put(
            "index_weight", f"index_code={code}/month=2024-01", [(code, "A", "20240131", "1.5")],
            ["index_code", "con_code", "trade_date", "weight"],
        )
    market = lake(spark, landing)
    codes = [" 300 ", "852", "300"]
    partial = market.sync("index_weight", start=D1, end="2024-01-30", index_codes=codes)
    assert values(partial.results) == []
    whole = market.sync("index_weight", start=D1, end="2024-01-31", index_codes=codes)
    assert whole.completed == 2
    assert values(market.table("index_weight").orderBy("index_code")) == [
        ("300", "A", date(2024, 1, 31), 1.5), ("852", "A", date(2024, 1, 31), 1.5),
    ]
    with pytest.raises(ValueError, match="index_codes"):
        market.sync("index_weight", start=D1, index_codes=[])
    with pytest.raises(ValueError, match="index_codes"):
        market.sync("daily", start=D1, index_codes=["300"])
    with pytest.raises(ValueError, match="start"):
        market.sync("daily")


def test_missing_source_column_fails_the_runs(spark, landing):
    class Narrow:
        def read(self, dataset):
            return spark.createDataFrame([], "partition_id string, ts_code string")

    market = MarketLake(spark, f"{landing.root}/lake", Narrow())
    with pytest.raises(SyncFailed, match="trade_date"):
        market.sync("index_daily", start=D2)
    assert values(market.runs(), "status error_type") == [("FAILED", "ValueError")]
    assert market.ledger().count() == 0


def test_interrupted_sync_commits_nothing(spark, landing):
    class Interrupting:
        def read(self, dataset):
            raise KeyboardInterrupt

    market = MarketLake(spark, f"{landing.root}/lake", Interrupting())
    with pytest.raises(KeyboardInterrupt):
        market.sync("index_daily", start=D2)
    assert values(market.runs(), "status error_type") == [("INTERRUPTED", "KeyboardInterrupt")]
    assert market.table("index_daily").count() == 0


@pytest.mark.parametrize(
    ("error", "status"), [(RuntimeError("disk full"), "FAILED"), (KeyboardInterrupt(), "INTERRUPTED")]
)
def test_files_written_before_an_error_are_never_read(spark, landing, monkeypatch, error, status):
    from pitlake.plans.sync import Synchronizer

    landing.day("index_daily", D2, [("I", "1")])
    market = lake(spark, landing)
    market.sync("index_daily", start=D2)
    committed = values(market.status())
    landing.generation += 1
    landing.day("index_daily", D2, [("I", "2"), ("J", "3")])
    market = lake(spark, landing)
    write = Synchronizer._write

    def write_and_stop(self, *args):
        write(self, *args)
        raise error

    with monkeypatch.context() as patched:
        patched.setattr(Synchronizer, "_write", write_and_stop)
        with pytest.raises(SyncFailed if status == "FAILED" else KeyboardInterrupt):
            market.sync("index_daily", start=D2, refresh=True)
    assert values(market.status()) == committed
    assert values(market.index_bars(), "ts_code close") == [("I", 1.0)]
    assert sorted(values(market.runs(), "status")) == sorted([("SUCCESS",), (status,)])
    market.sync("index_daily", start=D2, refresh=True)
    assert values(market.index_bars(), "ts_code close") == [("I", 2.0), ("J", 3.0)]


def test_a_run_without_an_end_is_recovered_on_reopening(spark, landing):
    from pitlake.plans.sync import Synchronizer

    market = lake(spark, landing)
    started = partitions.calendar_days(
        partitions.bounds(spark, D2, D2), DATASETS["index_daily"].id
    ).withColumn("run_id", F.lit("r"))
    Synchronizer(market.lake, market.landing)._log(started, "b", "RUNNING")
    assert values(market.runs(), "status") == [("RUNNING",)]
    assert values(lake(spark, landing).runs(), "status error_type") == [
        ("INTERRUPTED", "ProcessInterrupted")
    ]


def test_read_only_lake_answers_and_refuses_to_sync(spark, landing):
    market = lake(spark, landing, read_only=True)
    assert market.panel("A", adjust="hfq").count() == 0
    assert market.universe(D1).count() == 0
    assert market.tradeability(D1).count() == 0
    with pytest.raises(PermissionError):
        market.sync("stock_basic")
    with pytest.raises(PermissionError):
        market.update(start=D1, end=D2)


def test_update_order_and_increment(spark, landing):
    landing.calendar()
    landing.put("stock_basic", "full", [("A", "20100101")], ["ts_code", "list_date"])
    landing.put("namechange", "full", [("A", "n", "20100101")] * 2, ["ts_code", "name", "start_date"])
    landing.put("index_basic", "full", [("I",)], ["ts_code"])
    landing.put("index_classify", "full", [("S", "1")], ["src", "index_code"])
    landing.put("index_member_all", "full", [("A", "1", "20100101")], ["ts_code", "l3_code", "in_date"])
    for day in (D2, D3):
        for name in ("daily", "adj_factor", "daily_basic", "index_dailybasic", "stk_limit"):
            landing.day(name, day, [("A",)], ("ts_code",))
        landing.day("suspend_d", day, [("B", "S")], ("ts_code", "suspend_type"))
    landing.day("index_daily", D1, [("I", "1")])
    landing.put(
        "index_weight", "index_code=none/month=2024-01", [("none", "A", "20240131")],
        ["index_code", "con_code", "trade_date"],
    )
    market = lake(spark, landing)
    first = market.update(start=D1, end=D3)
    assert [r.dataset_id.removeprefix("tushare.") for r in first] == [
        "stock_basic", "namechange", "index_basic", "index_classify", "index_member_all",
        "trade_cal", "daily", "adj_factor", "daily_basic", "index_daily", "index_dailybasic",
        "suspend_d", "stk_limit", "index_weight",
    ]
    assert [r.completed for r in first] == [1, 1, 1, 1, 1, 1, 2, 2, 2, 3, 2, 2, 2, 0]
    statuses = [row[0] for row in values(market.health(start=D1, end=D3), "status")]
    assert statuses == ["HEALTHY"] * 13 + ["EMPTY"]
    second = market.update(start=D1, end=D3)
    assert [r.completed for r in second] == [1] * 5 + [0] * 9
    assert [r.skipped for r in second] == [0] * 5 + [1, 2, 2, 2, 3, 2, 2, 2, 0]
    assert market.table("namechange").count() == 1
    reports = market.update_indices(start=D1, end=D2)
    assert [r.dataset_id.removeprefix("tushare.") for r in reports] == [
        "index_basic", "index_classify", "index_member_all", "index_daily", "index_dailybasic",
        "index_weight",
    ]


def test_default_end_is_yesterday():
    from pitlake.functions.params import yesterday

    assert yesterday() == date.today() - timedelta(days=1)


def test_landing_formats_and_variants(spark, landing):
    from pitlake.sources.landing import LandingZone, variant_union

    dataset = DATASETS["stock_basic"]
    schema = ", ".join(f"`{c}` string" for c in dataset.columns)
    def one(code):
        return spark.createDataFrame([(code, *[None] * (len(dataset.columns) - 1))], schema)

    rows = variant_union({"L": one("A"), "D": one("B")}).withColumn("partition_id", F.lit("full"))
    for kind in ("csv", "json", "orc", "parquet"):
        root = f"{landing.root}/{kind}"
        rows.write.partitionBy("partition_id", "variant").format(kind).option("header", True).save(
            f"{root}/stock_basic"
        )
        found = LandingZone(spark, root, kind).read(dataset).orderBy("ts_code")
        assert values(found, "ts_code partition_id variant") == [("A", "full", "L"), ("B", "full", "D")]


def test_run_status_rules(spark):
    at = datetime(2024, 1, 1)
    rows = []

    def run(name, *events):
        rows.append((name, "RUNNING", at, None, None))
        rows.extend(
            (name, event, at + timedelta(hours=i), kind, text)
            for i, (event, kind, text) in enumerate(events, start=1)
        )

    run("late error", ("SUCCESS", None, None), ("FAILED", "RuntimeError", "late"))
    run("late success", ("FAILED", "E", "x"), ("SUCCESS", None, None))
    run("first error stands", ("FAILED", "E", "y" * 5000), ("INTERRUPTED", "K", "k"))
    run("cancelled", ("FAILED", "RuntimeError", " Query interrupted "))
    run("cancelled by engine", ("FAILED", "InterruptException", "z"))
    run("other failure", ("FAILED", "RuntimeError", None))
    run("died")
    rows.append(("alive", "RUNNING", datetime(2024, 2, 1), None, None))
    events = spark.createDataFrame(
        rows, "run_id string, event string, event_ts timestamp, error_type string, error_message string"
    )
    for field in RUN_EVENTS:
        if field.name not in events.columns:
            events = events.withColumn(field.name, F.lit(None).cast(field.dataType))
    resolved = run_status(events, F.lit("2024-01-15").cast("timestamp"))
    found = {r.run_id: (r.status, r.error_type, r.error_message) for r in resolved.collect()}
    assert found["late error"] == ("SUCCESS", None, None)
    assert found["late success"] == ("SUCCESS", None, None)
    assert found["first error stands"] == ("FAILED", "E", "y" * 5000)
    assert found["cancelled"][0] == found["cancelled by engine"][0] == "INTERRUPTED"
    assert found["other failure"][0] == "FAILED"
    assert found["died"][:2] == ("INTERRUPTED", "ProcessInterrupted")
    assert found["alive"][0] == "RUNNING"


def run_log(spark, rows):
    events = spark.createDataFrame(
        rows, "run_id string, event string, event_ts timestamp, error_type string, error_message string, rows_received long"
    )
    for field in RUN_EVENTS:
        if field.name not in events.columns:
            events = events.withColumn(field.name, F.lit(None).cast(field.dataType))
    return events


def test_run_status_of_reports_at_one_time(spark):
    at, later = datetime(2024, 1, 1), datetime(2024, 1, 2)
    rows = [
        ("text", "FAILED", at, "E", "b" * 5000, 1), ("text", "FAILED", at, "E", "a" * 5000, 2), ("text", "FAILED", at, "F", "0", 3),
        ("null text", "FAILED", at, "E", "a", 1), ("null text", "FAILED", at, "E", None, 2),
        ("null type", "FAILED", at, "E", "a", 1), ("null type", "FAILED", at, None, "c", 2), ("null type", "FAILED", at, None, "b", 2),
        ("same", "FAILED", at, "E", "a", 1), ("same", "FAILED", at, "E", "a", 1), ("same", "FAILED", later, "A", "0", 1),
        ("good", "FAILED", at, "E", "a", 1), ("good", "FAILED", at, "E", "b", 1), ("good", "SUCCESS", later, None, None, 7),
        (None, "FAILED", at, "E", "b", 1), (None, "INTERRUPTED", at, "E", "a", 1), (None, None, at, "E", "0", 1),
        ("no time", "FAILED", None, "E", "a", 1),
    ]
    found = run_status(run_log(spark, rows), F.lit("2024-01-15").cast("timestamp")).collect()
    assert len(found) == len({r[0] for r in rows})
    assert {r.run_id: (r.status, r.error_type, r.error_message, r.rows_received) for r in found} == {
        "text": ("FAILED", "E", "a" * 5000, None),
        "null text": ("FAILED", "E", None, None),
        "null type": ("FAILED", None, "b", None),
        "same": ("FAILED", "E", "a", None),
        "good": ("SUCCESS", None, None, 7),
        None: ("FAILED", "E", "b", None),
        "no time": ("RUNNING", None, None, None),
    }


def test_run_status_sorts_no_messages_but_of_ties(spark):
    at = datetime(2024, 1, 1)
    log = run_log(spark, [(str(i), "FAILED", at + timedelta(hours=i), "E", "x" * 5000, i) for i in range(20)])
    plan = run_status(log, F.lit("2024-01-15").cast("timestamp"))._jdf.queryExecution().executedPlan().toString()
    with_texts = [line for line in plan.splitlines() if "Aggregate" in line and "error_message" in line]
    assert with_texts and all("min(struct(error_message" in line for line in with_texts), with_texts
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" in plan


def test_pages(spark):
    from pitlake.operators import pages

    def audit(sizes, offsets, first_rows=None, has_columns=True, keys=None):
        n = len(sizes)
        first_rows = first_rows or list(range(n))
        rows = [
            ("p", "v", page, i, first_rows[page] if i == 0 else 1000 + 10 * page + i)
            for page, size in enumerate(sizes) for i in range(size)
        ]
        if keys:
            rows = [row[:4] + (keys[k],) for k, row in enumerate(rows)]
        landed = spark.createDataFrame(
            rows, "partition_id string, variant string, page int, row int, id int"
        )
        manifest = spark.createDataFrame(
            [("p", "v", page, offset, has_columns) for page, offset in enumerate(offsets)],
            "partition_id string, variant string, page int, page_offset long, has_columns boolean",
        )
        repeated = pages.keys_on_many_pages(landed, ["id"])
        [row] = pages.page_audit(manifest, pages.page_rows(landed, ["id"]), repeated).collect()
        return row

    # A server that caps pages below the requested size: short pages do not end the request.
    capped = audit([3, 2, 0], [0, 3, 5])
    assert capped.complete and capped.row_count == 5
    assert not audit([3, 2], [0, 3]).complete
    # A page that came twice, in whatever order; pages that begin alike are different pages.
    assert audit([2, 2, 0], [0, 2, 4], keys=[7, 8, 8, 7]).stuck_pages == 1
    assert audit([2, 2, 0], [0, 2, 4], first_rows=[7, 7, 0]).stuck_pages == 0
    assert audit([2, 2, 0], [0, 2, 4], keys=[7, 7, 8, 8]).stuck_pages == 0
    assert audit([2, 2, 0], [0, 1, 3]).offset_errors == 1
    assert audit([2, 2, 0], [1, 3, 5]).offset_errors == 1
    assert audit([2, 0], [0, 2], has_columns=False).pages_without_columns == 2
    repeated = audit([2, 2, 0], [0, 2, 4], keys=[1, 2, 3, 2])
    assert repeated.repeated_keys == 1 and not repeated.complete


def test_malformed_text_fails_typing(spark):
    from pitlake.sources.landing import land_typed

    dataset = DATASETS["trade_cal"]
    schema = ", ".join(f"`{c}` string" for c in dataset.columns)
    good = spark.createDataFrame([("SSE", " 20240102 ", "1", "")], schema)
    assert values(land_typed(dataset, good)) == [("SSE", D2, 1, None)]
    for bad in (("SSE", "2024-01-02", "1", None), ("SSE", "20240102", "x", None)):
        with pytest.raises(Exception, match="CAST_INVALID|CANNOT_PARSE|PARSE"):
            land_typed(dataset, spark.createDataFrame([bad], schema)).collect()


def test_plans(spark):
    span = partitions.bounds(spark, date(2023, 12, 30), D2)
    assert [r.partition_id for r in partitions.calendar_years(span, "x").collect()] == [
        "exchange=SSE/year=2023", "exchange=SSE/year=2024",
    ]
    days = partitions.calendar_days(span, "x").collect()
    assert [r.partition_id for r in days] == [
        f"trade_date={d}" for d in ("2023-12-30", "2023-12-31", "2024-01-01", "2024-01-02")
    ]
    assert days[0].scope_from == date(2023, 12, 30).strftime("%Y%m%d")
    [whole] = partitions.full(spark.range(1), "x").collect()
    assert (whole.partition_id, whole.partition_values) == ("full", '{"scope":"full"}')
    assert LANDED_DATE == "yyyyMMdd"


def test_registry():
    assert len(DATASETS) == 14
    assert sum(len(d.columns) for d in DATASETS.values()) == 126
    assert get_dataset("daily") is get_dataset("tushare.daily")
    with pytest.raises(KeyError):
        get_dataset("other.daily")


def test_stray_calendar_days_give_way_to_their_own_year(spark, landing):
    columns = ["exchange", "cal_date", "is_open"]
    landing.put(
        "trade_cal", "exchange=SSE/year=2023",
        [("SSE", "20231229", "1"), ("SSE", "20240102", "0")], columns,
    )
    market = lake(spark, landing)
    market.sync("trade_cal", start="2023-01-01")
    assert values(market.table("trade_cal").orderBy("cal_date"), "cal_date is_open") == [
        (date(2023, 12, 29), 1), (D2, 0),
    ]
    landing.calendar(2024)
    market.sync("trade_cal", start="2024-01-01")
    assert values(market.table("trade_cal").orderBy("cal_date"), "cal_date is_open") == [
        (date(2023, 12, 29), 1), (D1, 0), (D2, 1), (D3, 1),
    ]


def test_variants_of_one_request_are_one_partition(spark, landing):
    dataset = DATASETS["stock_basic"]
    text = ", ".join(f"`{c}` string" for c in [*dataset.columns, "partition_id", "variant"])
    rows = [
        tuple({"ts_code": code, "list_status": kind}.get(c) for c in dataset.columns) + ("full", kind)
        for code, kind in (("A", "L"), ("B", "D"), ("C", "P"))
    ]
    spark.createDataFrame(rows, text).write.partitionBy("partition_id", "variant").parquet(
        f"{landing.path}/stock_basic"
    )
    market = lake(spark, landing)
    report = market.sync("stock_basic")
    assert values(report.results, "partition_id status row_count") == [("full", "SUCCESS", 3)]
    assert values(market.table("stock_basic").orderBy("ts_code"), "ts_code list_status") == [
        ("A", "L"), ("B", "D"), ("C", "P"),
    ]


def test_a_missing_variant_keeps_the_whole_list(spark, landing):
    dataset = DATASETS["stock_basic"]
    text = ", ".join(f"`{c}` string" for c in [*dataset.columns, "partition_id", "variant"])

    def put(*codes):
        rows = [
            tuple({"ts_code": code, "list_status": code and kind}.get(c) for c in dataset.columns) + ("full", kind)
            for code, kind in codes
        ]
        spark.createDataFrame(rows, text).write.partitionBy("partition_id", "variant").parquet(f"{landing.path}/stock_basic")
        return lake(spark, landing)

    # No paused stock: a row of NULLs tells that the question was asked.
    market = put(("north", "L"), ("south", "D"), (None, "P"))
    assert market.sync("stock_basic").completed == 1
    before = values(market.table("stock_basic").orderBy("ts_code"), "ts_code list_status")
    assert before == [("north", "L"), ("south", "D")]
    landing.generation += 1
    market = put(("north", "L"), ("east", "L"))
    with pytest.raises(SyncFailed, match="2 request variants missing"):
        market.sync("stock_basic", refresh=True)
    assert values(market.table("stock_basic").orderBy("ts_code"), "ts_code list_status") == before


@pytest.mark.parametrize("kind", ["parquet", "orc"])
def test_files_without_a_column_fail_their_partition_alone(spark, landing, kind):
    from pitlake.sources.landing import LandingZone

    columns = DATASETS["index_daily"].columns
    for day, names in ((D1, columns), (D2, [c for c in columns if c != "amount"]), (D3, columns[::-1])):
        row = {"ts_code": "I", "trade_date": day.strftime("%Y%m%d"), "close": "7", "open": "6"}
        text = ", ".join(f"`{c}` string" for c in names)
        spark.createDataFrame([tuple(row.get(c) for c in names)], text).write.format(kind).save(
            f"{landing.path}/index_daily/partition_id=trade_date%3D{day}"
        )
    market = MarketLake(spark, f"{landing.root}/lake", LandingZone(spark, landing.path, kind))
    with pytest.raises(SyncFailed, match="1 rows from files without a declared column") as failed:
        market.sync("index_daily", start=D1, end=D3)
    assert values(failed.value.report.results, "partition_id status") == [
        (f"trade_date={D1}", "SUCCESS"), (f"trade_date={D2}", "FAILED"), (f"trade_date={D3}", "SUCCESS"),
    ]
    rows = market.table("index_daily").orderBy("trade_date")
    assert values(rows, "trade_date open close amount") == [(D1, 6.0, 7.0, None), (D3, 6.0, 7.0, None)]


def test_partitions_with_faulty_pages_are_rejected_alone(spark, landing):
    days = [date(2024, 1, n) for n in range(1, 8)]
    good = [("A", 0), ("B", 0), ("C", 1)]
    # Whole; stopped early; an offset skipped; stood still; a page not listed; nothing listed, one page; neither.
    landed = [good, good, good, [("A", 0), ("B", 0), ("A", 1), ("B", 1)], [*good, ("D", 7)], good, [("A", None)]]
    offsets = [[0, 2, 3], [0, 2], [0, 3, 4], [0, 2, 4], [0, 2, 3], [], []]
    columns = DATASETS["index_daily"].columns
    text = ", ".join(f"`{c}` string" for c in columns)
    listed = []
    for day, rows, found in zip(days, landed, offsets, strict=True):
        listed += [(f"trade_date={day}", page, offset, True) for page, offset in enumerate(found)]
        for page in {page for _, page in rows}:
            full = [tuple({"ts_code": code, "trade_date": day.strftime("%Y%m%d")}.get(c) for c in columns) for code, p in rows if p == page]
            number = "__HIVE_DEFAULT_PARTITION__" if page is None else page
            spark.createDataFrame(full, text).write.parquet(f"{landing.path}/index_daily/partition_id=trade_date%3D{day}/page={number}")
    spark.createDataFrame(listed, "partition_id string, page int, page_offset long, has_columns boolean").write.parquet(
        f"{landing.path}/_pages/index_daily"
    )
    market = lake(spark, landing)
    with pytest.raises(SyncFailed, match="pages") as failed:
        market.sync("index_daily", start=days[0], end=days[-1])
    found = [status for _, status in values(failed.value.report.results, "partition_id status")]
    assert found == ["SUCCESS", "FAILED", "FAILED", "FAILED", "FAILED", "FAILED", "SUCCESS"]
    assert market.table("index_daily").count() == 4


def test_csv_columns_go_by_their_header(spark, landing):
    from pitlake.sources.landing import LandingZone

    columns = DATASETS["index_daily"].columns

    def put(day, names):
        row = {"ts_code": "I", "trade_date": day.strftime("%Y%m%d"), "close": "7", "open": "6"}
        text = ", ".join(f"`{c}` string" for c in names)
        spark.createDataFrame([tuple(row.get(c) for c in names)], text).write.option("header", True).csv(
            f"{landing.path}/index_daily/partition_id=trade_date%3D{day}"
        )
        return MarketLake(spark, f"{landing.root}/lake", LandingZone(spark, landing.path, "csv"))

    market = put(D1, columns[::-1])
    market.sync("index_daily", start=D1)
    assert values(market.table("index_daily"), "trade_date open close") == [(D1, 6.0, 7.0)]
    put(D2, columns)
    with pytest.raises(SyncFailed):
        market.sync("index_daily", start=D1, end=D2, refresh=True)
    landing.generation += 1
    market = put(D2, [c for c in columns if c != "amount"])
    with pytest.raises(SyncFailed, match="lacks columns: amount"):
        market.sync("index_daily", start=D2)
    assert values(market.table("index_daily"), "trade_date open close") == [(D1, 6.0, 7.0)]


def test_only_the_folders_of_the_planned_days_are_read(spark, landing, monkeypatch):
    from pitlake.plans import sync

    for day in (D1, D2, D3):
        landing.day("index_daily", day, [("I", "1")])
    seen, original = [], sync.staged

    def spy(dataset, received, *rest):
        seen.append(received)
        return original(dataset, received, *rest)

    monkeypatch.setattr(sync, "staged", spy)
    lake(spark, landing).sync("index_daily", start=D2)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert f"trade_date={D2}" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_dates():
    from pitlake.functions.params import as_date, date_range, distinct_index_codes, index_code

    assert as_date(datetime(2024, 1, 2, 3)) == as_date("2024-01-02") == as_date(D2) == D2
    assert date_range(None, "2024-01-02") == (None, D2)
    assert distinct_index_codes(None, ("x",)) == ["x"]
    assert distinct_index_codes(" a ", ()) == ["a"]
    assert index_code(" a ") == "a"
    for bad in (["a", " "], [1], [None]):
        with pytest.raises(ValueError):
            distinct_index_codes(bad, ())
    with pytest.raises(ValueError):
        as_date("20240132")
