"""Audit of landed pages: were all pages of a paged request received?

A short page proves nothing, since a server may cap pages below the requested size; only an empty
page that still carries every column ends a request.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REQUEST = ["partition_id", "variant"]
PRINT = ["n", "low", "high", "parity"]


def row_hash(columns: Sequence[str]) -> Column:
    """A NULL isn't an absent column."""
    return F.xxhash64(*[cell for name in columns for cell in (F.col(name), F.col(name).isNull())])


def fingerprint(row: Column, copies: Column) -> list[Column]:
    """Size and content of a group of rows, in whatever order they come: three numbers that add up on the map side.

    Two parts of the row hashes are summed, and all of them are combined by exclusive or.
    """
    part = (1 << 24) - 1
    return [
        F.sum(copies).alias("n"),
        F.sum(copies * row.bitwiseAND(part)).alias("low"),
        F.sum(copies * F.shiftrightunsigned(row, 24).bitwiseAND(part)).alias("high"),
        F.bit_xor(F.when(copies % 2 == 1, row).otherwise(F.lit(0).cast("long"))).alias("parity"),
    ]


def page_rows(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Size and fingerprint of each received page, from its landed rows."""
    return rows.groupBy(*REQUEST, "page").agg(*fingerprint(row_hash(columns), F.lit(1).cast("long")))


def page_audit(manifest: DataFrame, pages: DataFrame, repeated_keys: DataFrame) -> DataFrame:
    """One verdict per request. A page stands still if it holds just the rows of the page before it.

    ``manifest`` has one row per page asked for (``page`` from 0, ``page_offset``, ``has_columns``),
    ``pages`` is ``page_rows`` and ``repeated_keys`` the keys met on more than one page. Each page is
    compared with the one before it by a join on the page number: offsets that follow from page to
    page follow from the start, and no request is ever gathered in one place.
    """
    seen = manifest.join(pages, [*REQUEST, "page"], "left").withColumn(
        "n", F.coalesce("n", F.lit(0).cast("long"))
    )
    before = seen.select(
        *REQUEST, (F.col("page") + 1).alias("page"),
        (F.col("page_offset") + F.col("n")).alias("due"), F.struct(*PRINT).alias("print_before"),
    )
    stepped = seen.join(before, [*REQUEST, "page"], "left").select(
        *REQUEST, "page", "n", "has_columns",
        ((F.col("n") > 0) & (F.col("print_before") == F.struct(*PRINT))).alias("stuck"),
        (F.col("page_offset") != F.coalesce("due", F.lit(0).cast("long"))).alias("gap"),
    )
    verdict = stepped.groupBy(*REQUEST).agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("n").alias("row_count"),
        F.count_if(F.col("stuck")).alias("stuck_pages"),
        F.count_if(F.col("gap")).alias("offset_errors"),
        F.count_if(~F.col("has_columns")).alias("pages_without_columns"),
        (F.max_by("n", "page") == 0).alias("ended"),
    )
    keys = repeated_keys.groupBy(*REQUEST).agg(F.count(F.lit(1)).alias("repeated_keys"))
    checked = verdict.join(keys, REQUEST, "left").withColumn(
        "repeated_keys", F.coalesce("repeated_keys", F.lit(0).cast("long"))
    )
    problems = [
        F.col("stuck_pages") > 0,
        F.col("offset_errors") > 0,
        F.col("pages_without_columns") > 0,
        ~F.col("ended"),
        F.col("repeated_keys") > 0,
    ]
    bad = F.lit(False)
    for problem in problems:
        bad = bad | problem
    return checked.withColumn("complete", ~bad)


def keys_on_many_pages(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys of a request that came on more than one page."""
    return (
        rows.groupBy(*REQUEST, *key)
        .agg(F.min("page").alias("lo"), F.max("page").alias("hi"))
        .where(F.col("lo") < F.col("hi"))
        .select(*REQUEST, *key)
    )
