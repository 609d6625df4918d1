"""Storage layout of a lake and reads of its committed state.

::

    <root>/tables/<dataset>/<folder column>=…/run_id=…/*.parquet
    <root>/meta/ledger/*.parquet                 one row per committed partition and run
    <root>/meta/run_events/batch=…/phase=…/      run log
    <root>/meta/verdicts/batch=…/                check results of one sync

Data files become visible only through the ledger, which is appended last, so readers see a
partition before or after a replacement and never in between, an empty partition is a ledger row
without files, and files of failed runs are never read. One writer at a time is assumed.
"""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlake.functions.newest import newest
from pitlake.plans.ledger import LEDGER, committed_rows, latest_commits
from pitlake.plans.runs import RUN_EVENTS, run_status
from pitlake.sources.datasets import DATASETS, Dataset, struct


# What a sync adds to the rows it writes, for its own verdicts; readers leave these columns alone. Rows in a folder
# with the ending were received but are no rows of the table, and no commit names it.
MARKS = struct("_faults bigint, _copies bigint, _variant string, _page bigint, _hash bigint")
ASIDE = ".aside"


class Lake:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def read(self, path: str, schema: T.StructType) -> DataFrame:
        """A parquet table that may not exist yet."""
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def stored(self, dataset: Dataset, marks: T.StructType | None = None) -> DataFrame:
        """Rows of every run, with the folder columns and, if asked for, the columns ``checks.staged`` adds."""
        extra = [name for name in [*dataset.folders, "run_id"] if name not in dataset.columns]
        folders = [T.StructField(name, T.StringType()) for name in extra]
        schema = T.StructType(dataset.schema.fields + (marks.fields if marks else []) + folders)
        return self.read(self.path("tables", dataset.name), schema)

    def staged(self, dataset: Dataset, runs: DataFrame) -> DataFrame:
        """Rows that runs (``run_id``, ``partition_id``) have written, committed or not, as ``checks.staged`` gave them."""
        names = [row["run_id"] for row in runs.select("run_id").collect()]  # planned partitions, never data
        rows = self.stored(dataset, MARKS).where(F.col("run_id").isin([*names, *[f"{name}{ASIDE}" for name in names]]))
        marked = rows.withColumns({"_aside": F.endswith("run_id", F.lit(ASIDE)), "run_id": F.substring_index("run_id", ".", 1)})
        known = F.map_from_entries(F.collect_list(F.struct("run_id", "partition_id")))
        return marked.withColumn("partition_id", F.element_at(runs.agg(known).scalar(), F.col("run_id")))

    def commits(self) -> DataFrame:
        return self.read(self.path("meta", "ledger"), LEDGER)

    def ledger(self) -> DataFrame:
        return latest_commits(self.commits())

    def table(self, name: str, **folders: str) -> DataFrame:
        """Committed rows; ``folders`` names values of folder columns, to read only what lies below them."""
        dataset = DATASETS[name]
        # Filtered before the latest commit is resolved, so that the folder pruning sees a
        # selective side.
        commits = self.commits().where(F.col("dataset_id") == dataset.id)
        stored = self.stored(dataset)
        for folder, value in folders.items():
            stored = stored.where(F.col(folder) == F.lit(value))
        rows = committed_rows(stored, latest_commits(commits))
        if dataset.strategy == "calendar_year":
            # A year's batch may hold days of another year; that year's own batch has the say.
            own = F.year("cal_date") == F.col("year").cast("int")
            rows = newest(rows.withColumn("own", own), dataset.key, ["own"])
        return rows.select(*dataset.columns)

    def snapshot_month(self, name: str, code: str, day: date) -> DataFrame:
        """An index's rows of the newest committed month that has a day not after ``day``.

        The month is chosen by the ledger's ids. Only the day's own month may hold later days alone, so only
        then the month itself is asked, and the one before it taken if it holds no such day.
        """
        begin = f"index_code={code}/month="
        known = self.ledger().where(
            (F.col("dataset_id") == DATASETS[name].id) & (F.col("row_count") > 0)
            & F.startswith("partition_id", F.lit(begin)) & (F.col("partition_id") <= F.lit(f"{begin}{day:%Y-%m}"))
        )
        newest_two = known.orderBy(F.desc("partition_id")).limit(2).collect()
        months = [row["partition_id"].removeprefix(begin) for row in newest_two]
        if months and months[0] == f"{day:%Y-%m}":
            own = self.table(name, index_code=code, month=months[0])
            if own.where(F.col("trade_date") <= F.lit(day)).isEmpty():
                months = months[1:]
        return self.table(name, index_code=code, month=months[0] if months else "")

    def clean(self) -> int:
        """Deletes folders of runs that no commit in force names, and what finished syncs kept; how many went.

        For times without a sync: one that is running has written rows which no commit names yet. Reports of
        earlier syncs can't be read afterwards.
        """
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        files = hadoop.Path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())
        named = {row["run_id"] for row in self.ledger().select("run_id").collect()}  # partitions, never data
        patterns = [
            self.path("tables", dataset.name, *["*"] * len(dataset.folders), "run_id=*") for dataset in DATASETS.values()
        ] + [self.path("meta", kind, "batch=*") for kind in ("started", "skipped", "verdicts")]
        gone = 0
        for pattern in patterns:
            for found in files.globStatus(hadoop.Path(pattern)) or []:
                if found.getPath().getName().removeprefix("run_id=") not in named:
                    gone += files.delete(found.getPath(), True)
        return gone

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in DATASETS}

    def run_events(self) -> DataFrame:
        return self.read(self.path("meta", "run_events"), RUN_EVENTS)

    def runs(self, reopened_at) -> DataFrame:
        """The run log; a ledger row is a success even if its event was never written."""
        commits = self.commits().select(
            "run_id", "dataset_id", "partition_id",
            F.lit("SUCCESS").alias("event"), F.col("committed_at").alias("event_ts"),
            F.col("row_count").alias("rows_received"),
        )
        events = self.run_events().unionByName(commits, allowMissingColumns=True)
        return run_status(events, reopened_at)
