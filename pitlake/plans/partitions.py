"""Partition plans: which partitions a date range is cut into.

A plan is a DataFrame, one row per partition, generated from a frame of bounds with the date columns
``start`` and ``end``. ``scope_key``, ``scope_from`` and ``scope_to`` are the landed-text form of
what the partition may contain.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.functions.predicates import within
from pitlake.functions.typing import LANDED_DATE
from pitlake.sources.datasets import CALENDAR_EXCHANGE

PLAN = [
    "dataset_id", "partition_id", "partition_values", "request_params",
    "scope_key", "scope_from", "scope_to",
]


def bounds(spark: SparkSession, start: date, end: date) -> DataFrame:
    return spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))


def _landed(day: Column) -> Column:
    return F.date_format(day, LANDED_DATE)


def _json(**values: Column) -> Column:
    return F.to_json(F.struct(*[value.alias(name) for name, value in values.items()]))


def _plan(rows: DataFrame, dataset_id: str, **columns: Column) -> DataFrame:
    none = F.lit(None).cast("string")
    columns["dataset_id"] = F.lit(dataset_id)
    return rows.select(*[columns.get(name, none).alias(name) for name in PLAN])


def full(rows: DataFrame, dataset_id: str) -> DataFrame:
    """One partition per row of ``rows``: the whole dataset."""
    return _plan(
        rows, dataset_id,
        partition_id=F.lit("full"), partition_values=_json(scope=F.lit("full")),
        request_params=F.lit("{}"),
    )


def calendar_years(
    bounds: DataFrame, dataset_id: str, exchange: str = CALENDAR_EXCHANGE
) -> DataFrame:
    """Every year touched by the bounds, whole."""
    years = bounds.select(F.explode(F.sequence(F.year("start"), F.year("end"))).alias("year"))
    code = F.lit(exchange)
    first = _landed(F.make_date(F.col("year"), F.lit(1), F.lit(1)))
    last = _landed(F.make_date(F.col("year"), F.lit(12), F.lit(31)))
    return _plan(
        years, dataset_id,
        partition_id=F.concat(F.lit("exchange="), code, F.lit("/year="), F.col("year")),
        partition_values=_json(exchange=code, year=F.col("year")),
        request_params=_json(exchange=code, start_date=first, end_date=last),
        scope_key=code, scope_from=first, scope_to=last,
    )


def _days(days: DataFrame, dataset_id: str) -> DataFrame:
    """One partition per row of the date column ``day``."""
    iso, text = F.col("day").cast("string"), _landed(F.col("day"))
    return _plan(
        days, dataset_id,
        partition_id=F.concat(F.lit("trade_date="), iso),
        partition_values=_json(trade_date=iso), request_params=_json(trade_date=text),
        scope_from=text, scope_to=text,
    )


def calendar_days(bounds: DataFrame, dataset_id: str) -> DataFrame:
    """Every natural day of the bounds."""
    return _days(bounds.select(F.explode(F.sequence("start", "end")).alias("day")), dataset_id)


def open_dates(
    trade_cal: DataFrame, start: date | None, end: date | None, exchange: str = CALENDAR_EXCHANGE
) -> DataFrame:
    """Open days of an exchange in a closed range, in order."""
    return trade_cal.where(
        (F.col("exchange") == exchange)
        & within(F.col("cal_date"), start, end)
        & (F.col("is_open") == 1)
    ).select("cal_date").orderBy("cal_date")


def trading_days(open_dates: DataFrame, dataset_id: str) -> DataFrame:
    return _days(open_dates.withColumnRenamed("cal_date", "day"), dataset_id)


def index_months(bounds: DataFrame, dataset_id: str, codes: Sequence[str] | Column) -> DataFrame:
    """Each code in each whole month: a month ending after the bounds is left out, as an empty
    answer for a month in progress would stand forever."""
    listed = codes if isinstance(codes, Column) else F.array(*[F.lit(code) for code in codes])
    months = bounds.select(
        F.explode(F.sequence(F.trunc("start", "MM"), F.col("end"), F.expr("interval 1 month")))
        .alias("first"),
        "end",
        listed.alias("codes"),
    ).where(F.last_day("first") <= F.col("end"))
    each = months.select("first", F.explode("codes").alias("code"))
    code, month = F.col("code"), F.date_format("first", "yyyy-MM")
    first, last = _landed(F.col("first")), _landed(F.last_day("first"))
    return _plan(
        each, dataset_id,
        partition_id=F.concat(F.lit("index_code="), code, F.lit("/month="), month),
        partition_values=_json(index_code=code, month=month),
        request_params=_json(index_code=code, start_date=first, end_date=last),
        scope_key=code, scope_from=first, scope_to=last,
    )


def ids_of(
    span: DataFrame, open_days: DataFrame, strategies: Sequence[str], codes: Sequence[str]
) -> DataFrame:
    """``strategy`` (its place in the list) and ``partition_id`` of all strategies' partitions from one row of bounds.

    Open days are gathered into that row, a calendar's worth of them, so the bounds are looked up once.
    """
    listed = F.array(*[F.lit(code) for code in codes])
    first, last = F.col("start"), F.col("end")
    months = F.filter(
        F.sequence(F.trunc("start", "MM"), last, F.expr("interval 1 month")), lambda m: F.last_day(m) <= last
    )

    def of_day(day: Column) -> Column:
        return F.concat(F.lit("trade_date="), day.cast("string"))

    made = {
        "full": lambda: F.array(F.lit("full")),
        "calendar_year": lambda: F.transform(
            F.sequence(F.year(first), F.year(last)),
            lambda year: F.concat(F.lit(f"exchange={CALENDAR_EXCHANGE}/year="), year.cast("string")),
        ),
        "calendar_day": lambda: F.transform(F.sequence(first, last), of_day),
        "trading_day": lambda: F.transform("open_days", of_day),
        "index_month": lambda: F.flatten(F.transform(
            months,
            lambda month: F.transform(
                listed,
                lambda code: F.concat(F.lit("index_code="), code, F.lit("/month="), F.date_format(month, "yyyy-MM")),
            ),
        )),
    }
    days = open_days.agg(F.collect_list("cal_date").alias("open_days"))
    known = span.withColumn("open_days", days.scalar()) if "trading_day" in strategies else span
    each = F.array(*[
        F.struct(F.lit(place).alias("strategy"), made[name]().alias("ids")) for place, name in enumerate(strategies)
    ])
    found = known.select(F.explode(each).alias("of")).select("of.strategy", F.explode("of.ids").alias("partition_id"))
    return found
