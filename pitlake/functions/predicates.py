"""Column predicates shared by the operators.

They rely on SQL's three-valued logic: a comparison with NULL is NULL, so an unknown limit or
listing date yields an unknown flag without any guard.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Day = date | Column


def day(value: Day) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def valid_on(start: Column, end: Column, on: Day) -> Column:
    """Both ends inclusive; a missing end is open."""
    return (start <= day(on)) & (end.isNull() | (end >= day(on)))


def listed_on(list_date: Column, delist_date: Column, on: Day) -> Column:
    """The listing day counts, the delisting day does not."""
    return (list_date <= day(on)) & (delist_date.isNull() | (day(on) < delist_date))


def within(column: Column, start: date | None, end: date | None) -> Column:
    condition = F.lit(True)
    if start is not None:
        condition = condition & (column >= F.lit(start))
    if end is not None:
        condition = condition & (column <= F.lit(end))
    return condition


def restrict(
    rows: DataFrame,
    codes: Iterable[str] | None = None,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """Security codes (None: all, empty: none) and an inclusive trade-date range."""
    if codes is not None:
        rows = rows.where(F.col("ts_code").isin(list(codes)))
    if start is not None or end is not None:
        rows = rows.where(within(F.col("trade_date"), start, end))
    return rows


def any_null(columns: Sequence[str]) -> Column:
    condition = F.lit(False)
    for name in columns:
        condition = condition | F.col(name).isNull()
    return condition
