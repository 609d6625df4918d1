"""Top-1 per group as an aggregate.

``max_by``/``min_by`` over a struct keep one row per group on the map side before the shuffle, so
a hot group never reaches one task whole, and NULL is the smallest member of a struct, which is
exactly "descending, nulls last" for ``max_by``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newest(rows: DataFrame, by: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row with the greatest ``order`` of each ``by`` group, NULLs counting as smallest."""
    return _pick(rows, by, F.max_by, order)


def first(rows: DataFrame, by: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row with the least ``order`` of each ``by`` group, NULLs counting as smallest."""
    return _pick(rows, by, F.min_by, order)


def _pick(rows, by, picker, order) -> DataFrame:
    payload = [name for name in rows.columns if name not in by]
    best = picker(F.struct(*payload), F.struct(*order)).alias("_best")
    picked = rows.groupBy(*by).agg(best)
    return picked.select(
        *[F.col(name) if name in by else F.col("_best")[name].alias(name) for name in rows.columns]
    )
