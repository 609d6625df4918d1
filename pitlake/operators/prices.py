"""Price bars: raw, backward adjusted (hfq) and forward adjusted (qfq)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlake.functions.predicates import restrict

KEY = ["ts_code", "trade_date"]
PRICES = ["open", "high", "low", "close", "pre_close", "change"]
UNADJUSTED = ["pct_chg", "vol", "amount"]
RAW = [*KEY, *PRICES, *UNADJUSTED]


def daily_bar(daily: DataFrame, adj_factor: DataFrame) -> DataFrame:
    """Bars with their day's factor; a missing factor stays NULL."""
    factors = adj_factor.select(*KEY, "adj_factor")
    return daily.select(*RAW).join(factors, KEY, "left")


def latest_adj_factor(adj_factor: DataFrame, as_of: date | None = None) -> DataFrame:
    """The last known factor of each security, optionally as known on a day."""
    known = adj_factor.where(F.col("adj_factor").isNotNull())
    if as_of is not None:
        known = known.where(F.col("trade_date") <= F.lit(as_of))
    return known.groupBy("ts_code").agg(
        F.max_by("adj_factor", "trade_date").alias("adj_factor"),
        F.max("trade_date").alias("trade_date"),
    ).select(*KEY, "adj_factor")


def _scaled(bars: DataFrame, factor) -> DataFrame:
    """Prices through ``factor``; other columns, such as joined metrics, are kept as they are."""
    known = [*RAW, "adj_factor", "anchor_adj_factor"]
    prices = [factor(F.col(name)).alias(name) for name in PRICES]
    anchor = [name for name in bars.columns if name == "anchor_adj_factor"]
    others = [name for name in bars.columns if name not in known]
    return bars.select(*KEY, *prices, *UNADJUSTED, "adj_factor", *anchor, *others)


def daily_bar_hfq(bars: DataFrame) -> DataFrame:
    return _scaled(bars, lambda price: price * F.col("adj_factor"))


def daily_bar_qfq(bars: DataFrame, anchors: DataFrame) -> DataFrame:
    """Forward adjustment against one anchor factor per security.

    The anchors stand on the left so that adaptive execution runs them first: it then knows how
    small they are before it would shuffle the bars by security, and broadcasts them instead.
    """
    by_security = anchors.select("ts_code", F.col("adj_factor").alias("anchor_adj_factor"))
    anchored = by_security.join(bars, "ts_code", "right")

    def forward(price: Column) -> Column:
        divisor = F.nullif(F.col("anchor_adj_factor"), F.lit(0.0))
        return price * F.col("adj_factor") / divisor

    return _scaled(anchored, forward)


def daily_bar_qfq_latest(daily: DataFrame, adj_factor: DataFrame) -> DataFrame:
    return daily_bar_qfq(daily_bar(daily, adj_factor), latest_adj_factor(adj_factor))


def daily_bar_qfq_asof(daily: DataFrame, adj_factor: DataFrame, as_of: date) -> DataFrame:
    """As seen on a day: later bars are gone and later factors are unknown."""
    bars = daily_bar(restrict(daily, end=as_of), restrict(adj_factor, end=as_of))
    return daily_bar_qfq(bars, latest_adj_factor(adj_factor, as_of))


def last_day(end: date | None, as_of: date | None) -> date | None:
    """Bars after either are not seen."""
    return min((day for day in (end, as_of) if day is not None), default=None)


def adjusted_bars(
    daily: DataFrame,
    adj_factor: DataFrame,
    codes: list[str] | None = None,
    start: date | None = None,
    end: date | None = None,
    adjust: str = "none",
    as_of: date | None = None,
    aligned: DataFrame | None = None,
) -> DataFrame:
    """Bars of some codes and days in one adjustment mode, unordered.

    ``aligned`` is joined on security and day before the anchor, so that all joins on that key
    share one partitioning of the bars.

    Codes and days are applied to both inputs before their join. The anchor is the exception: it is
    the last factor of a security's whole history, so only the codes may narrow it.
    """
    last = last_day(end, as_of)
    bars = daily_bar(restrict(daily, codes, start, last), restrict(adj_factor, codes, start, last))
    if aligned is not None:
        bars = bars.join(restrict(aligned, codes, start, last), KEY, "left")
    if adjust == "hfq":
        return daily_bar_hfq(bars)
    if adjust == "qfq":
        anchors = latest_adj_factor(restrict(adj_factor, codes), as_of)
        return daily_bar_qfq(bars, anchors)
    return bars
