"""The run log: an append-only table of run events, resolved to one status per run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlake.sources.datasets import struct

RUN_EVENTS = struct(
    "run_id string, dataset_id string, partition_id string, request_params string, "
    "event string, event_ts timestamp, rows_received bigint, error_type string, "
    "error_message string"
)


def run_status(events: DataFrame, reopened_at: Column) -> DataFrame:
    """One row per run.

    A success stands whatever else was reported. Otherwise the first terminal event decides. A run
    begun before ``reopened_at`` without any terminal event died with its process. A failure caused
    by a cancelled query is an interruption. Of terminal events at one time, the first by name, error type
    and message stands, whatever their order in the log.
    """
    ts = F.col("event_ts")
    is_bad = F.col("event").isin("FAILED", "INTERRUPTED") & ts.isNotNull()
    # Aggregates of texts sort their rows, so messages, which may be long, stay out until one report stands for each run.
    kinds = events.groupBy("run_id", "event", "event_ts", "error_type").agg(
        *(F.max(name).alias(name) for name in ("dataset_id", "partition_id", "request_params", "rows_received")),
        F.count(F.lit(1)).alias("reports"),
    )
    bad_row = F.struct("event_ts", "event", "error_type", "reports")
    runs = kinds.groupBy("run_id").agg(
        F.max("dataset_id").alias("dataset_id"),
        F.max("partition_id").alias("partition_id"),
        F.max("request_params").alias("request_params"),
        F.min(F.when(F.col("event") == "RUNNING", ts)).alias("started_at"),
        F.min(F.when(F.col("event") == "SUCCESS", ts)).alias("success_at"),
        F.max(F.when(F.col("event") == "SUCCESS", F.col("rows_received"))).alias("rows_received"),
        F.min(F.when(is_bad, bad_row)).alias("bad"),
    )
    done = F.col("success_at").isNotNull()
    failed = ~done & F.col("bad").isNotNull()
    died = ~done & F.col("bad").isNull() & (F.col("started_at") < reopened_at)
    runs = with_messages(runs, events.where(is_bad), failed)
    message = F.lower(F.trim("error_message"))
    cancelled = (F.col("bad.error_type") == "InterruptException") | (
        (F.col("bad.error_type") == "RuntimeError") & (message == "query interrupted")
    )
    return runs.select(
        "run_id", "dataset_id", "partition_id",
        F.when(done, "SUCCESS")
        .when(failed & F.coalesce(cancelled, F.lit(False)), "INTERRUPTED")
        .when(failed, F.col("bad.event"))
        .when(died, "INTERRUPTED")
        .otherwise("RUNNING")
        .alias("status"),
        "request_params", "rows_received", "started_at",
        F.when(done, F.col("success_at")).when(failed, F.col("bad.event_ts")).alias("finished_at"),
        F.when(failed, F.col("bad.error_type"))
        .when(died, "ProcessInterrupted")
        .alias("error_type"),
        F.when(failed, F.col("error_message"))
        .when(died, "the process ended before this run did")
        .alias("error_message"),
    )


def with_messages(runs: DataFrame, reports: DataFrame, failed: Column) -> DataFrame:
    """Runs with the error_message of the report that ``bad`` names, if the run failed.

    The runs are hashed and the messages pass by them, unsorted. Only where several reports of a run
    agree in all but the message is the least taken, NULL first.
    """
    names = ("run_id", "event_ts", "event", "error_type")
    told = reports.select(*(F.col(name).alias(f"_{name}") for name in names), "error_message")
    same = F.col("run_id").eqNullSafe(F.col("_run_id")) & failed
    for name in names[1:]:
        same &= F.col(f"bad.{name}").eqNullSafe(F.col(f"_{name}"))
    found = runs.hint("shuffle_hash").join(told, same, "left").select(*runs.columns, "error_message")
    several = F.coalesce(failed & (F.col("bad.reports") > 1), F.lit(False))
    least = found.where(several).groupBy(*runs.columns).agg(F.min(F.struct("error_message")).alias("least"))
    return found.where(~several).unionByName(least.select(*runs.columns, F.col("least.error_message").alias("error_message")))
