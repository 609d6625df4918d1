"""Landed raw text: reading, joining request variants, dropping exact copies, typing."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlake.functions.typing import typed
from pitlake.sources.datasets import Dataset

# What a declared column reads as in the rows of a file without it; NULL is a value that was landed.
ABSENT = "<the file has no such column>"


class Source(Protocol):
    """Where landed rows come from: all source columns as text, plus ``partition_id``."""

    def read(self, dataset: Dataset) -> DataFrame: ...


class LandingZone:
    """Text files under ``<root>/<dataset>/partition_id=<id>/[variant=<v>/][page=<n>/]``.

    All columns are text; Spark finds ``partition_id`` (and ``variant``) from the folders. A planned
    partition with no folder is an empty batch. Requests that came in pages are listed, page by page, in Parquet
    files under ``<root>/_pages/<dataset>``.
    """

    def __init__(self, spark: SparkSession, root: str, file_format: str = "parquet") -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.file_format = file_format

    def manifest(self, dataset: Dataset) -> DataFrame | None:
        """The pages that were asked for, see ``operators.pages.page_audit``; None where no list was landed."""
        try:
            return self.spark.read.parquet(f"{self.root}/_pages/{dataset.name}")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def read(self, dataset: Dataset) -> DataFrame:
        """Declared columns by name. In Parquet and ORC a column that a file lacks reads as ``ABSENT``.

        A JSON record may leave out what is NULL. CSV files take their columns from the header, which
        has to be the same in all files of a dataset: otherwise the read fails.
        """
        path = f"{self.root}/{dataset.name}"
        paged = self.manifest(dataset) is not None
        folders = ["partition_id"] + (["variant"] if dataset.variants else []) + (["page"] if paged else [])
        if self.file_format == "csv":
            found = self.spark.read.options(header="true", enforceSchema="false").csv(path)
            names = [name for name in [*dataset.columns, *folders] if name in found.columns]
        else:
            default = {key: f"'{ABSENT}'" for key in ("CURRENT_DEFAULT", "EXISTS_DEFAULT")}
            declared = default if self.file_format in ("parquet", "orc") else {}
            names = [*dataset.columns, *folders]
            fields = [T.StructField(n, T.StringType(), True, {} if n in folders else declared) for n in names]
            found = self.spark.read.format(self.file_format).schema(T.StructType(fields)).load(path)
        return found.select(*[F.col(f"`{name}`").cast("string").alias(name) for name in names])


def variant_union(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Landed frames of a dataset's request variants as one, tagged with the variant."""
    tagged = [rows.withColumn("variant", F.lit(name)) for name, rows in frames.items()]
    merged = tagged[0]
    for rows in tagged[1:]:
        merged = merged.unionByName(rows)
    return merged


def drop_exact_copies(dataset: Dataset, landed: DataFrame) -> DataFrame:
    """Rows equal in every source column, NULLs included, become one, where that is declared."""
    columns = ["partition_id", *dataset.columns]
    if not dataset.drop_exact_copies:
        return landed.select(*columns)
    return landed.select(*columns).dropDuplicates()


def land_typed(dataset: Dataset, landed: DataFrame, *keep: str) -> DataFrame:
    """Typed columns; any malformed value fails the job."""
    return landed.select(*keep, *[typed(field) for field in dataset.schema])
