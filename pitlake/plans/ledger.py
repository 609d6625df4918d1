"""The commit ledger: an append-only table with one row per committed partition and run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.sources.datasets import struct

PARTITION = ["dataset_id", "partition_id"]
LEDGER = struct(
    "dataset_id string, partition_id string, partition_values string, row_count bigint, "
    "run_id string, committed_at timestamp"
)


def latest_commits(commits: DataFrame) -> DataFrame:
    """The last commit of each partition; it replaces all earlier ones."""
    payload = [name for name in LEDGER.fieldNames() if name not in PARTITION]
    last = F.max_by(F.struct(*payload), F.struct("committed_at", "run_id"))
    resolved = commits.groupBy(*PARTITION).agg(last.alias("last"))
    return resolved.select(*PARTITION, "last.*")


def committed_rows(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows written by the last commit of their partition.

    ``run_id`` is a folder column, so the folders of replaced or failed runs are pruned at run time.
    """
    return rows.join(ledger.select("run_id"), "run_id", "left_semi")


def pending(plan: DataFrame, ledger: DataFrame) -> DataFrame:
    return plan.join(ledger, PARTITION, "left_anti")


def already_done(plan: DataFrame, ledger: DataFrame) -> DataFrame:
    return plan.join(ledger, PARTITION, "left_semi")


def sync_results(skipped: DataFrame, verdicts: DataFrame) -> DataFrame:
    """What became of each planned partition: SKIPPED, SUCCESS or FAILED."""
    good = F.col("error_message").isNull()
    return skipped.select(
        *PARTITION, F.lit("SKIPPED").alias("status"), F.lit(None).cast("long").alias("row_count"),
        F.lit(None).cast("string").alias("error_message"),
    ).unionByName(
        verdicts.select(
            *PARTITION,
            F.when(good, "SUCCESS").otherwise("FAILED").alias("status"),
            F.when(good, F.col("row_count")).alias("row_count"),
            "error_message",
        )
    )


def sync_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("dataset_id").agg(
        *[F.count_if(F.col("status") == status).alias(name) for status, name in (
            ("SUCCESS", "completed"), ("SKIPPED", "skipped"), ("FAILED", "failed"))]
    )


def status(ledger: DataFrame, dataset_id: str | None = None) -> DataFrame:
    rows = ledger if dataset_id is None else ledger.where(F.col("dataset_id") == dataset_id)
    return rows.select(*PARTITION, "row_count", "committed_at", "run_id").orderBy(*PARTITION)
