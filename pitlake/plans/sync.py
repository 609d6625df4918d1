"""Bringing landed partitions into a lake.

All pending partitions of a dataset are one unit of work: checked together, written together and
committed together, each on its own merits. A bad partition keeps its previous data and is reported;
the good ones are committed.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlake.functions.params import (
    DateLike,
    as_date,
    date_range,
    distinct_index_codes,
    required_range,
    yesterday,
)
from pitlake.functions.typing import LANDED_DATE
from pitlake.operators.checks import BATCH, missing_columns, scope_columns, staged, staged_verdicts
from pitlake.plans import partitions
from pitlake.plans.ledger import already_done, pending, sync_counts, sync_results
from pitlake.sources.datasets import DATASETS, DEFAULT_INDEX_CODES, Dataset, get_dataset
from pitlake.sources.lake import ASIDE, MARKS, Lake
from pitlake.sources.landing import Source

# What a full and an index-only update bring in, in this order. Masters are always
# refreshed; dated datasets only fill what is missing.
MASTERS = ["stock_basic", "namechange", "index_basic", "index_classify", "index_member_all"]
DATED = [
    "trade_cal", "daily", "adj_factor", "daily_basic", "index_daily", "index_dailybasic",
    "suspend_d", "stk_limit", "index_weight",
]
INDEX_MASTERS = ["index_basic", "index_classify", "index_member_all"]
INDEX_DATED = ["index_daily", "index_dailybasic", "index_weight"]
# Fixed value: first day of a default update or audit.
HISTORY_START = "2010-01-01"


@dataclass(frozen=True)
class SyncReport:
    """``results`` has one row per planned partition: status, row_count, error_message."""

    dataset_id: str
    results: DataFrame
    completed: int = 0
    skipped: int = 0
    failed: int = 0


class SyncFailed(RuntimeError):
    """Some partitions were rejected; ``report`` tells which and why."""

    def __init__(self, message: str, report: SyncReport | None = None) -> None:
        super().__init__(message)
        self.report = report


def run_id(batch: str, dataset_id: Column) -> Column:
    """A function of batch and partition, so a retried task writes the same one."""
    return F.md5(F.concat_ws("|", F.lit(batch), dataset_id, BATCH))


class Synchronizer:
    def __init__(self, lake: Lake, landing: Source) -> None:
        self.lake = lake
        self.landing = landing
        self.spark = lake.spark

    def plan(self, dataset: Dataset, start=None, end=None, index_codes=None) -> DataFrame:
        """The partitions of a date range; fills missing calendar years where open days matter."""
        if index_codes is not None and dataset.strategy != "index_month":
            raise ValueError("index_codes only applies to index_weight")
        if dataset.strategy == "full":
            return partitions.full(self.spark.range(1), dataset.id)
        if dataset.strategy == "calendar_year":
            return self._calendar_plan(start, end)
        first, last = required_range(dataset.id, start, end)
        span = partitions.bounds(self.spark, first, last)
        if dataset.strategy == "calendar_day":
            return partitions.calendar_days(span, dataset.id)
        if dataset.strategy == "index_month":
            codes = distinct_index_codes(index_codes, DEFAULT_INDEX_CODES)
            return partitions.index_months(span, dataset.id, codes)
        self.sync("trade_cal", start=first, end=last)
        return partitions.trading_days(
            partitions.open_dates(self.lake.table("trade_cal"), first, last), dataset.id
        )

    def _calendar_plan(self, start, end) -> DataFrame:
        first = as_date(start) if start is not None else date.today().replace(month=1, day=1)
        last = as_date(end) if end is not None else first.replace(month=12, day=31)
        date_range(first, last)
        span = partitions.bounds(self.spark, first, last)
        return partitions.calendar_years(span, DATASETS["trade_cal"].id)

    def sync(
        self,
        dataset_id: str,
        *,
        start: DateLike | None = None,
        end: DateLike | None = None,
        refresh: bool = False,
        index_codes=None,
    ) -> SyncReport:
        dataset = get_dataset(dataset_id)
        plan = self.plan(dataset, start, end, index_codes)
        ledger = self.lake.ledger()
        done_before = ledger.limit(0) if refresh else ledger
        batch = uuid.uuid4().hex
        skipped = already_done(plan, done_before)
        started = pending(plan, done_before).withColumn("run_id", run_id(batch, F.col("dataset_id")))
        started_path = self.lake.path("meta", "started", f"batch={batch}")
        started.write.parquet(started_path)
        skipped_path = self.lake.path("meta", "skipped", f"batch={batch}")
        skipped.write.parquet(skipped_path)
        started = self.spark.read.schema(started.schema).parquet(started_path)
        skipped = self.spark.read.schema(skipped.schema).parquet(skipped_path)
        checked = self._run(dataset, started, batch)
        results = sync_results(skipped, checked).orderBy("partition_id")
        counts = sync_counts(results).first()
        totals = counts.asDict() if counts else {"dataset_id": dataset.id}
        report = SyncReport(results=results, **totals)
        if report.failed:
            worst = results.where(F.col("status") == "FAILED").first()
            raise SyncFailed(
                f"{report.failed} partitions of {dataset.id} were rejected, first "
                f"{worst['partition_id']}: {worst['error_message']}",
                report,
            )
        return report

    def _run(self, dataset: Dataset, started: DataFrame, batch: str) -> DataFrame:
        """Commit the started partitions and log the outcome of their runs; returns the verdicts."""
        if started.isEmpty():
            nothing = {"row_count": F.lit(0).cast("long"), "error_message": F.lit("")}
            return started.withColumns(nothing)
        self._log(started, batch, "RUNNING")
        try:
            return self._commit(dataset, started, batch)
        except BaseException as error:
            interrupted = not isinstance(error, Exception)
            self._log(
                started, batch, "INTERRUPTED" if interrupted else "FAILED",
                error_type=F.lit(type(error).__name__),
                error_message=F.lit(str(error) or "the sync was interrupted"),
            )
            if interrupted:
                raise
            raise SyncFailed(f"sync of {dataset.id} failed: {error}") from error

    def _commit(self, dataset: Dataset, started: DataFrame, batch: str) -> DataFrame:
        """Check, write, then make visible; returns the verdicts."""
        landed = self.landing.read(dataset)
        lacking = missing_columns(dataset, landed)
        if lacking:
            raise ValueError(f"{dataset.id} lacks columns: {', '.join(lacking)}")
        # Ids are folder names, so just the planned folders are read. They are planned partitions, never data.
        ids = [row[BATCH] for row in started.select(BATCH).collect()]
        asked = landed.where(F.col(BATCH).isin(ids))
        # A source without a manifest came undivided.
        manifest = self.landing.manifest(dataset) if hasattr(self.landing, "manifest") else None
        if manifest is not None:
            manifest = manifest.where(F.col(BATCH).isin(ids))
            if "page" not in asked.columns:
                asked = asked.withColumn("page", F.lit(None).cast("int"))

        # The landed rows are read once: written where readers will look for them, judged there, and seen by readers
        # only if the ledger names their run. The verdicts decide that, so they are kept as a table.
        self._write(dataset, staged(dataset, asked, manifest is not None), batch)
        path = self.lake.path("meta", "verdicts", f"batch={batch}")
        computed = staged_verdicts(dataset, self.lake.staged(dataset, started), started, manifest)
        computed.write.parquet(path)
        checked = self.spark.read.schema(computed.schema).parquet(path)
        good = checked.where(F.col("error_message").isNull())

        commits = good.select(
            "dataset_id", "partition_id", "partition_values", "row_count", "run_id",
            F.current_timestamp().alias("committed_at"),
        )
        # One file, hence one rename, makes all commits of the batch visible at once. The rows are
        # partitions of the plan, a few thousand at most, never data.
        commits.repartition(1).write.mode("append").parquet(self.lake.path("meta", "ledger"))
        self._log(
            checked, batch,
            F.when(F.col("error_message").isNull(), "SUCCESS").otherwise("FAILED"),
            rows_received=F.when(F.col("error_message").isNull(), F.col("row_count")),
            error_type=F.when(F.col("error_message").isNotNull(), "DatasetValidationError"),
            error_message=F.col("error_message"),
        )
        return checked

    def _write(self, dataset: Dataset, rows: DataFrame, batch: str) -> None:
        """Every partition's rows into a folder of its run, named by its id and not by what its rows say."""
        scope = scope_columns(dataset)
        first = scope["scope_from"]
        if dataset.strategy in ("calendar_day", "trading_day"):
            places = {"trade_date": F.to_date(first, LANDED_DATE)}
        elif dataset.strategy == "calendar_year":
            places = {"exchange": scope["scope_key"], "year": F.substring(first, 1, 4)}
        elif dataset.strategy == "index_month":
            month = F.concat_ws("-", F.substring(first, 1, 4), F.substring(first, 5, 2))
            places = {"index_code": scope["scope_key"], "month": month}
        else:
            places = {}
        run = run_id(batch, F.lit(dataset.id))
        places["run_id"] = F.when(F.col("_aside"), F.concat(run, F.lit(ASIDE))).otherwise(run)
        folders = [*dataset.folders, "run_id"]
        marks = [F.col(name).cast(MARKS[name].dataType).alias(name) for name in MARKS.names]
        kept = [name for name in dataset.columns if name not in places]
        placed = rows.select(*kept, *marks, *[place.alias(name) for name, place in places.items()])
        # Rebalancing brings a partition's rows together into files of the advisory size; adaptive
        # execution merges small partitions and splits a hot one over several tasks. Rows are
        # sorted by key inside a file, so that row groups can be skipped by security.
        inner = [name for name in dataset.not_null if name not in folders]
        placed.hint("rebalance", *folders).sortWithinPartitions(*folders, *inner).write.mode("append").partitionBy(
            *folders
        ).parquet(self.lake.path("tables", dataset.name))

    def _log(self, rows: DataFrame, batch: str, event, **columns) -> None:
        empty = {
            "rows_received": F.lit(None).cast("long"),
            "error_type": F.lit(None).cast("string"),
            "error_message": F.lit(None).cast("string"),
        }
        event = F.lit(event) if isinstance(event, str) else event
        values = {**empty, **columns}
        phase = "start" if "error_type" not in columns else "end"
        rows.select(
            "run_id", "dataset_id", "partition_id", "request_params",
            event.alias("event"), F.current_timestamp().alias("event_ts"),
            *[values[name].alias(name) for name in empty],
        ).write.mode("append").parquet(
            self.lake.path("meta", "run_events", f"batch={batch}", f"phase={phase}")
        )

    def update(self, masters, dated, start=HISTORY_START, end=None, index_codes=None):
        """A maintenance round in its fixed order; yields a report per dataset."""
        first, last = date_range(start, yesterday() if end is None else end)
        reports = [self.sync(name, refresh=True) for name in masters]
        for name in dated:
            codes = index_codes if name == "index_weight" else None
            reports.append(self.sync(name, start=first, end=last, index_codes=codes))
        return reports


def update_plan(
    span: DataFrame, open_days: DataFrame, ledger: DataFrame, steps: Sequence[str], refreshed: Collection[str],
    index_codes: Sequence[str] = DEFAULT_INDEX_CODES,
) -> DataFrame:
    """How many partitions each step of an update has and how many are still to be brought in.

    ``span`` has one row of ``start`` and ``end``, ``open_days`` the column ``cal_date``. The ids of a strategy are generated
    once, each tagged with the steps it stands for; all are met with the ledger by one join.
    """
    strategies: dict[str, list[int]] = {}
    for number, name in enumerate(steps, start=1):
        strategies.setdefault(DATASETS[name].strategy, []).append(number)
    ids = partitions.ids_of(span, open_days, list(strategies), index_codes)
    numbers = F.array(*[F.array(*[F.lit(n) for n in found]) for found in strategies.values()])
    names = F.array(*[F.lit(DATASETS[name].id) for name in steps])
    planned = ids.select("partition_id", F.explode(F.element_at(numbers, F.col("strategy") + 1)).alias("step"))
    planned = planned.withColumn("dataset_id", F.element_at(names, F.col("step")))
    done = ledger.select("dataset_id", "partition_id", F.lit(True).alias("done"))
    met = planned.join(done, ["dataset_id", "partition_id"], "left")
    anew = F.col("dataset_id").isin([DATASETS[name].id for name in refreshed])
    return met.groupBy("step", "dataset_id").agg(
        F.count(F.lit(1)).alias("planned"),
        F.count_if(anew | F.col("done").isNull()).alias("pending"),
        F.min("partition_id").alias("first_partition"),
        F.max("partition_id").alias("last_partition"),
    )
