"""Bars joined with valuation metrics, for stocks and for indices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.operators.prices import KEY, PRICES, RAW, UNADJUSTED
from pitlake.sources.datasets import DATASETS

# The metrics table repeats the close; the bar's close is the one that counts.
METRICS = [name for name in DATASETS["daily_basic"].columns if name not in (*KEY, "close")]
INDEX_METRICS = [name for name in DATASETS["index_dailybasic"].columns if name not in KEY]


def daily_metrics(daily_basic: DataFrame) -> DataFrame:
    return daily_basic.select(*KEY, "close", *METRICS)


def panel_metrics(daily_basic: DataFrame) -> DataFrame:
    return daily_basic.select(*KEY, *METRICS)


def daily_panel(bars: DataFrame, daily_basic: DataFrame) -> DataFrame:
    panel = bars.join(panel_metrics(daily_basic), KEY, "left")
    return panel.select(*RAW, "adj_factor", *METRICS)


def adjusted_panel(bars: DataFrame) -> DataFrame:
    """Bars aligned with metrics: always 28 columns, the anchor NULL unless forward adjusted."""
    if "anchor_adj_factor" not in bars.columns:
        bars = bars.withColumn("anchor_adj_factor", F.lit(None).cast("double"))
    return bars.select(*KEY, *PRICES, *UNADJUSTED, "adj_factor", "anchor_adj_factor", *METRICS)


def index_basic(index_basic: DataFrame) -> DataFrame:
    names = DATASETS["index_basic"].columns
    return index_basic.select(*names).withColumnRenamed("desc", "description")


def index_bar(index_daily: DataFrame) -> DataFrame:
    return index_daily.select(*RAW)


def index_metrics(index_dailybasic: DataFrame) -> DataFrame:
    return index_dailybasic.select(*KEY, *INDEX_METRICS)


def index_panel(index_daily: DataFrame, index_dailybasic: DataFrame) -> DataFrame:
    metrics = index_metrics(index_dailybasic)
    return index_bar(index_daily).join(metrics, KEY, "left")


def industry_classification(index_classify: DataFrame) -> DataFrame:
    return index_classify.select(*DATASETS["index_classify"].columns)
