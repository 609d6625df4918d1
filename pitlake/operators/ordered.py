"""Rows in the order of day and security without sampling what is to be ordered.

A global sort samples its input to find ranges, and so runs the last join of a query twice. Here the ranges come
from one narrow aggregate over the keys: rows per day, cut into ranges of equal weight; a day heavier than a range is
cut further, at quantiles of its codes. The range of a row is then an expression of its own key, ascending with
it for any rows, so rows that come after the count are in order too; only the ranges' weights are then less even.
"""

from __future__ import annotations

import json
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ["trade_date", "ts_code"]
# Rows that Spark estimates below this are ordered in one partition, without a count.
SMALL_BYTES = 32 << 20
# A range has at least so many rows, so that small results don't become many partitions.
LEAST_ROWS = 10_000
# Quantiles of a heavy day's codes, and the bytes of a code that tell them apart.
QUANTILES, CODE_BYTES = 256, 7


def code_rank(code: Column) -> Column:
    """A number that orders codes as their first bytes do."""
    head = F.rpad(F.substring(code.cast("binary"), 1, CODE_BYTES), CODE_BYTES, F.lit(b"\x00"))
    return F.conv(F.hex(head), 16, 10).cast("long")


def range_id(counted: DataFrame, partitions: int) -> tuple[Column, int]:
    """The range of a row's key, and the number of ranges. Counts the rows of `counted` now.

    What comes to the driver are a number per day, and of days heavier than a range, fewer than ranges,
    the quantiles of their codes.
    """
    dated = counted.where(F.col("trade_date").isNotNull())
    sizes = dict(dated.groupBy("trade_date").count().collect())
    total = sum(sizes.values())
    ranges = max(1, min(partitions, total // LEAST_ROWS))
    if ranges == 1:
        return F.lit(0), 1
    heavy = [day for day, n in sizes.items() if n * ranges > total]
    quantiles = {}
    if heavy:
        grid = F.array(*[F.lit(k / QUANTILES) for k in range(1, QUANTILES)])
        ranked = F.percentile_approx(code_rank(F.col("ts_code")), grid, F.lit(4 * QUANTILES))
        quantiles = dict(dated.where(F.col("trade_date").isin(heavy)).groupBy("trade_date").agg(ranked).collect())

    first, last = min(sizes), max(sizes)
    starts, cuts, before, day = [], [], 0, first
    while day <= last:
        n, start = sizes.get(day, 0), before * ranges // total
        starts.append(min(start, ranges - 1))
        passed = [(before + n * k // QUANTILES) * ranges // total - start for k in range(1, QUANTILES)]
        # A quantile stands once for every range that begins at it.
        marks = [
            [rank] * (passed[k] - (passed[k - 1] if k else 0)) for k, rank in enumerate(quantiles.get(day) or [])
        ]
        cuts.append(sum(marks, []) or None)
        before, day = before + n, day + timedelta(days=1)
    offset = F.datediff("trade_date", F.lit(first))
    number = F.get(F.from_json(F.lit(json.dumps(starts)), "array<int>"), offset)
    if any(cuts):
        marks = F.get(F.from_json(F.lit(json.dumps(cuts)), "array<array<bigint>>"), offset)
        rank = code_rank(F.col("ts_code"))
        number = number + F.coalesce(F.size(F.filter(marks, lambda mark: mark <= rank)), F.lit(0))
    later = F.when(F.col("trade_date") > F.lit(last), F.lit(ranges - 1)).otherwise(F.lit(0))
    return F.least(F.coalesce(number, later), F.lit(ranges - 1)), ranges


def estimated_bytes(rows: DataFrame) -> int:
    """Spark's own estimate, by which it also chooses joins."""
    return int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def ordered(rows: DataFrame, counted: DataFrame, partitions: int | None = None) -> DataFrame:
    """`rows` by day, then security. `counted` has the keys of the same rows, or of what they are made from."""
    if partitions is None:
        partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if estimated_bytes(counted) < SMALL_BYTES:
        return rows.repartition(1).sortWithinPartitions(*KEY)
    number, ranges = range_id(counted.select(*KEY), partitions)
    return rows.repartitionById(ranges, number).sortWithinPartitions(*KEY)


def numbered(rows: DataFrame, name: str = "position") -> DataFrame:
    """Ordered rows with their number from 1 on: the rows of earlier partitions, and the place in the own one."""
    place = rows.withColumn("_id", F.monotonically_increasing_id())
    part, at = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    sizes = place.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    placed = place.withColumns({"_part": part, "_at": at}).join(offsets, "_part")
    return placed.select(*rows.columns, (F.col("_before") + F.col("_at") + 1).alias(name))
