"""Results stay whole when one group holds a third of all rows."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from pitlake.operators import checks, prices, securities, tradability
from pitlake.plans import ledger, partitions
from pitlake.sources.datasets import DATASETS

DAY = date(2024, 1, 2)
N = 30_000


@pytest.fixture(scope="module")
def skewed_codes(spark):
    """``code`` is "hot" for a third of the rows and one of 500 others for the rest."""
    other = F.concat(F.lit("c"), (F.col("id") % 500).cast("string"))
    return spark.range(N).withColumn(
        "code", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(other)
    )


def test_suspension_events_of_one_security_day(skewed_codes):
    minute = F.lpad((F.col("id") % 1440).cast("string"), 4, "0")
    events = skewed_codes.select(
        F.col("code").alias("ts_code"), F.lit(DAY).alias("trade_date"),
        minute.alias("suspend_timing"), F.lit("S").alias("suspend_type"),
    )
    [hot] = tradability.suspension_daily(events).where("ts_code = 'hot'").collect()
    assert hot.suspend_timing == ";".join(f"{m:04d}" for m in range(0, 1440, 3))
    assert hot.suspend_type == "S"


def test_factors_of_one_security(skewed_codes):
    factors = skewed_codes.select(
        F.col("code").alias("ts_code"),
        F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("trade_date"),
        F.when(F.col("id") < N - 30, F.col("id").cast("double")).alias("adj_factor"),
    )
    [hot] = prices.latest_adj_factor(factors).where("ts_code = 'hot'").collect()
    last = max(i for i in range(0, N - 30, 3))
    assert (hot.trade_date, hot.adj_factor) == (DAY + timedelta(days=last), float(last))


def test_members_of_one_index(skewed_codes):
    weights = skewed_codes.select(
        F.col("code").alias("index_code"), F.col("id").cast("string").alias("con_code"),
        F.date_add(F.lit(DAY), (F.col("id") % 2).cast("int")).alias("trade_date"),
        F.lit(1.0).alias("weight"),
    )
    assert securities.index_members_asof(weights, "hot", DAY).count() == N // 6
    assert securities.index_members_asof(weights, "hot", DAY + timedelta(days=9)).count() == N // 6


def test_memberships_of_one_stock(skewed_codes):
    columns = DATASETS["index_member_all"].columns
    rows = skewed_codes.select(
        F.col("code").alias("ts_code"),
        F.lpad(F.col("id").cast("string"), 6, "0").alias("l3_code"),
        F.date_sub(F.lit(DAY), (F.col("id") % 7).cast("int")).alias("in_date"),
        F.when(F.col("id") % 5 != 0, F.date_add(F.lit(DAY), (F.col("id") % 11).cast("int")))
        .alias("out_date"),
    )
    for name in columns:
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit("x"))
    [hot] = securities.stock_industry_asof(rows, DAY).where("ts_code = 'hot'").collect()
    best = min(i for i in range(0, N, 3) if i % 7 == 0 and i % 5 == 0)
    assert hot.l3_code == f"{best:06d}"


def test_commits_of_one_partition(skewed_codes):
    commits = skewed_codes.select(
        F.lit("d").alias("dataset_id"), F.col("code").alias("partition_id"),
        F.lit("{}").alias("partition_values"), F.col("id").alias("row_count"),
        F.col("id").cast("string").alias("run_id"),
        F.timestamp_seconds(F.col("id")).alias("committed_at"),
    )
    [hot] = ledger.latest_commits(commits).where("partition_id = 'hot'").collect()
    assert hot.row_count == N - 3


def test_landed_rows_of_one_partition(spark):
    dataset = DATASETS["adj_factor"]
    landed = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, "trade_date=2024-01-02").otherwise("trade_date=2024-01-03")
        .alias("partition_id"),
        F.when(F.col("id") < 6, "same").otherwise(F.col("id").cast("string")).alias("ts_code"),
        F.when(F.col("id") % 3 == 0, "20240102").otherwise("20240103").alias("trade_date"),
        F.lit("1").alias("adj_factor"),
    )
    plan = partitions.calendar_days(
        partitions.bounds(spark, DAY, DAY + timedelta(days=1)), dataset.id
    )
    found = {
        row.partition_id: (row.row_count, row.error_message)
        for row in checks.verdicts(dataset, landed, plan).collect()
    }
    assert found["trade_date=2024-01-02"] == (
        N // 3, "tushare.adj_factor: 2 rows with a repeated key"
    )
    assert found["trade_date=2024-01-03"] == (
        2 * N // 3, "tushare.adj_factor: 4 rows with a repeated key"
    )
