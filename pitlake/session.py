"""Session settings the queries are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a hot join key at run time; no join in this package needs a hand-made salt.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A side is broadcast only below this bound on its size: estimated from its files before the
    # run, measured during it. Columnar files of repeated codes and factors are far smaller than
    # their rows, hence the factor; without it ten million rows can pass for a small table.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.sources.fileCompressionFactor": "10",
    # Joins of facts on (security, day) hash the smaller side when every shuffle partition of it was
    # measured to fit, and sort both sides otherwise.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Rows dealt by security and year meet others on (security, year, day) without being dealt again.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}


def build_session(app_name: str = "pitlake", **overrides: str) -> SparkSession:
    """A session with SETTINGS; keyword arguments replace or add settings (dots as ``__``)."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in overrides.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
