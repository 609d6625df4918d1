"""Checks of landed batches; a batch is the landed rows of one partition.

Every check is an aggregate over all pending partitions at once, grouped by partition id, so one bad
partition never hides or blocks another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitlake.functions.predicates import any_null
from pitlake.functions.typing import LANDED_DATE, malformed, tried
from pitlake.operators.pages import REQUEST, fingerprint, keys_on_many_pages, page_audit, row_hash
from pitlake.sources.datasets import Dataset
from pitlake.sources.landing import ABSENT

BATCH = "partition_id"
# What may be wrong with a row, in the order of its bits; a bit more marks an answer without rows.
FAULTS = ["absent_rows", "null_rows", "foreign_rows", "malformed_rows", "blank_rows"]
EMPTY_ANSWER = 1 << len(FAULTS)


def missing_columns(dataset: Dataset, landed: DataFrame) -> list[str]:
    return sorted(set(dataset.columns) - set(landed.columns))


def empty_answer(dataset: Dataset) -> Column:
    """A row without any value: the variant was asked for and has no rows."""
    return F.coalesce(*dataset.columns).isNull()


def request_of(rows: DataFrame) -> list[Column]:
    variant = F.col("variant").cast("string") if "variant" in rows.columns else F.lit(None).cast("string")
    return [F.col(BATCH).cast("string").alias(BATCH), F.coalesce(variant, F.lit("")).alias("variant"), F.col("page").cast("int").alias("page")]


def page_faults(manifest: DataFrame, pages: DataFrame, repeated: DataFrame | None) -> DataFrame:
    """Per batch, requests whose pages are not all there and rows on pages that the manifest doesn't list.

    ``pages`` has the received pages with their fingerprints, ``repeated`` the keys that came on more than one of them. A
    batch that has neither listed nor numbered pages came undivided and has no faults.
    """
    listed = manifest.select(
        *request_of(manifest),
        F.coalesce(F.col("page_offset").cast("long"), F.lit(-1)).alias("page_offset"),
        F.coalesce("has_columns", F.lit(False)).alias("has_columns"),
    ).distinct()
    if repeated is None:
        repeated = pages.select(*REQUEST).limit(0)
    requests = page_audit(listed, pages, repeated).groupBy(BATCH).agg(F.count_if(~F.col("complete")).alias("bad_requests"))
    asked = listed.select(BATCH).distinct().withColumn("listed", F.lit(True))
    stray = pages.join(asked, BATCH, "left").where("listed or page is not null")
    stray = stray.join(listed, [*REQUEST, "page"], "left_anti").groupBy(BATCH).agg(F.sum("n").alias("unlisted_rows"))
    return requests.join(stray, BATCH, "full")


def null_counts(dataset: Dataset, landed: DataFrame) -> DataFrame:
    """Rows with a NULL in a required column, per batch."""
    return landed.groupBy(BATCH).agg(
        F.count_if(any_null(dataset.not_null)).alias("null_rows")
    )


def duplicate_keys(dataset: Dataset, landed: DataFrame) -> DataFrame:
    """Number of rows involved in repeated keys, all copies counted, per batch."""
    copies = landed.groupBy(BATCH, *dataset.key).agg(F.count(F.lit(1)).alias("copies"))
    return copies.groupBy(BATCH).agg(
        F.coalesce(F.sum(F.when(F.col("copies") > 1, F.col("copies"))), F.lit(0).cast("long"))
        .alias("duplicate_rows")
    )


def out_of_scope(dataset: Dataset) -> Column:
    """Rows that do not belong to the partition that was asked for.

    Compares trimmed landed text with the plan's ``scope_key``, ``scope_from`` and ``scope_to``. A
    calendar year only has its exchange checked, as its dates are free.
    """
    def text(name: str) -> Column:
        return F.trim(F.col(name).cast("string"))

    if dataset.strategy in ("calendar_day", "trading_day"):
        return text("trade_date") != F.col("scope_from")
    if dataset.strategy == "calendar_year":
        return text("exchange") != F.col("scope_key")
    if dataset.strategy == "index_month":
        outside = (text("trade_date") < F.col("scope_from")) | (
            text("trade_date") > F.col("scope_to")
        )
        return (text("index_code") != F.col("scope_key")) | outside
    return F.lit(False)


def scope_columns(dataset: Dataset) -> dict[str, Column]:
    """The plan's ``scope_key``, ``scope_from`` and ``scope_to`` from the id alone, so that no row has to meet the plan."""
    last = F.substring_index(BATCH, "=", -1)
    none = F.lit(None).cast("string")
    key, first, end = none, none, none
    if dataset.strategy in ("calendar_day", "trading_day"):
        first = end = F.replace(last, F.lit("-"), F.lit(""))
    elif dataset.strategy == "calendar_year":
        key = F.regexp_extract(BATCH, "^exchange=(.*)/year=", 1)
        first, end = F.concat(last, F.lit("0101")), F.concat(last, F.lit("1231"))
    elif dataset.strategy == "index_month":
        key = F.regexp_extract(BATCH, "^index_code=(.*)/month=", 1)
        day = F.try_to_timestamp(F.concat(last, F.lit("-01")), F.lit("yyyy-MM-dd")).cast("date")
        first, end = F.date_format(day, LANDED_DATE), F.date_format(F.last_day(day), LANDED_DATE)
    return {"scope_key": key, "scope_from": first, "scope_to": end}


def scope_counts(dataset: Dataset, landed: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows outside their partition, per planned batch."""
    counted = landed.withColumns(scope_columns(dataset)).groupBy(BATCH).agg(
        F.count_if(out_of_scope(dataset)).alias("foreign_rows")
    )
    return counted.join(plan.select(BATCH), BATCH, "left_semi")


def row_faults(dataset: Dataset) -> dict[str, Column]:
    """What may be wrong with a landed row by itself; needs the scope columns."""
    malformed_text, absent, blank = F.lit(False), F.lit(False), F.lit(False)
    for field in dataset.schema:
        malformed_text = malformed_text | malformed(field)
    for name in dataset.columns:
        absent = absent | F.col(name).eqNullSafe(ABSENT)
    for name in dataset.not_null:
        blank = blank | tried(dataset.schema[name]).isNull()
    return {
        "absent_rows": absent, "null_rows": any_null(dataset.not_null), "foreign_rows": out_of_scope(dataset),
        "malformed_rows": malformed_text, "blank_rows": blank,
    }


def verdicts(dataset: Dataset, landed: DataFrame, plan: DataFrame) -> DataFrame:
    """Row count and first error of every planned partition; no error means it may be committed.

    One pass over the landed rows: row checks are folded into the first aggregate, which also counts copies of the
    typed key. A typed key is at least as strict as the landed text. Grouping by partition and key
    spreads even a hot partition over all tasks, and only counts per task are grouped by partition.
    """
    typed_key = [tried(dataset.schema[name]) for name in dataset.key]
    keyed = landed.withColumns(scope_columns(dataset)).groupBy(
        BATCH, *[c.alias(f"_key{i}") for i, c in enumerate(typed_key)]
    ).agg(
        F.count(F.lit(1)).alias("copies"),
        *[F.count_if(fault).alias(name) for name, fault in row_faults(dataset).items()],
    )
    repeated = F.when(F.lit(bool(dataset.key)) & (F.col("copies") > 1), F.col("copies"))
    counted = keyed.groupBy(BATCH).agg(
        F.sum("copies").alias("row_count"), F.sum(repeated).alias("duplicate_rows"),
        *[F.sum(name).alias(name) for name in FAULTS],
    )
    return judged(dataset, plan, counted)


def judged(
    dataset: Dataset, plan: DataFrame, counted: DataFrame, variants: DataFrame | None = None,
    paged: DataFrame | None = None,
) -> DataFrame:
    """The planned partitions with their row count and the first of their errors.

    ``variants`` has the missing request variants of a batch, ``paged`` is ``page_faults`` where there is a page manifest.
    """
    rows = plan.join(counted, BATCH, "left").withColumn(
        "row_count", F.coalesce("row_count", F.lit(0).cast("long"))
    )
    if variants is None:
        rows = rows.withColumn("missing_variants", F.lit(0))
    else:
        rows = rows.join(variants, BATCH, "left")
    if paged is None:
        rows = rows.withColumns({"bad_requests": F.lit(0), "unlisted_rows": F.lit(0)})
    else:
        rows = rows.join(paged, BATCH, "left")

    def report(text: str, count: str) -> Column:
        return F.concat(F.lit(f"{dataset.id}: "), F.col(count).cast("string"), F.lit(f" {text}"))

    empty = F.lit(f"{dataset.id}: empty batch")
    error = F.when((F.col("row_count") == 0) & F.lit(not dataset.allow_empty), empty)
    for count, text in (
        ("absent_rows", "rows from files without a declared column"),
        ("missing_variants", "request variants missing"),
        ("bad_requests", "requests with missing or faulty pages"),
        ("unlisted_rows", "rows on pages that the manifest lacks"),
        ("null_rows", "rows with NULL in a required column"),
        ("duplicate_rows", "rows with a repeated key"),
        ("foreign_rows", "rows outside the requested partition"),
        ("malformed_rows", "rows with malformed values"),
        ("blank_rows", "rows with a blank required value"),
    ):
        error = error.when(F.col(count) > 0, report(text, count))
    return rows.select(*plan.columns, "row_count", error.alias("error_message"))


# Staged rows: written once, typed and marked, where readers will find them; judged there before they are committed.


def staged(dataset: Dataset, landed: DataFrame, paged: bool) -> DataFrame:
    """Typed rows with what the verdicts need to know of them, from one pass over the landed rows.

    Added are ``_faults`` (a bit for each of FAULTS, one for an empty answer), ``_copies`` (exact copies a row stands for),
    ``_variant``, ``_page``, ``_hash`` (of the landed row, where pages are listed) and ``_aside``: the row only says that
    something was received (an empty answer, an exact copy from another variant or page) and is no row of the table.
    """
    request = [name for name in ("variant", "page") if name in landed.columns]
    rows = landed.withColumn("_copies", F.lit(1).cast("long"))
    again = F.lit(False)
    if dataset.drop_exact_copies:
        rows = landed.groupBy(BATCH, *request, *dataset.columns).agg(F.count(F.lit(1)).alias("_copies"))
        if request:
            same = Window.partitionBy(BATCH, *dataset.columns).orderBy(*request)
            rows = rows.withColumn("_again", F.row_number().over(same) > 1)
            again = F.col("_again")
    silent = empty_answer(dataset) & F.lit(bool(dataset.variants) and "variant" in request)
    rows = rows.withColumns(scope_columns(dataset))
    faults = F.when(silent, F.lit(EMPTY_ANSWER)).otherwise(F.lit(0))
    for bit, fault in enumerate(row_faults(dataset).values()):
        faults = faults + F.when(fault, F.lit(1 << bit)).otherwise(F.lit(0))
    return rows.select(
        BATCH, *[tried(field) for field in dataset.schema], faults.alias("_faults"), "_copies",
        (F.col("variant") if "variant" in request else F.lit(None)).cast("string").alias("_variant"),
        (F.col("page") if "page" in request else F.lit(None)).cast("int").alias("_page"),
        (row_hash(dataset.columns) if paged else F.lit(None)).cast("long").alias("_hash"),
        (silent | again).alias("_aside"),
    )


def staged_verdicts(dataset: Dataset, rows: DataFrame, plan: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """``verdicts`` of staged rows, and whether all variants and listed pages are among them."""
    fault = {name: F.col("_faults").bitwiseAND(1 << bit) != 0 for bit, name in enumerate(FAULTS)}
    # A folder gives all its rows the asked-for day or code, so rows outside the partition are counted apart.
    keyed = rows.where(~F.col("_aside")).groupBy(BATCH, fault["foreign_rows"].alias("_foreign"), *dataset.key).agg(
        F.count(F.lit(1)).alias("copies"), *[F.count_if(each).alias(name) for name, each in fault.items()]
    )
    repeated = F.when(F.lit(bool(dataset.key)) & (F.col("copies") > 1), F.col("copies"))
    counted = keyed.groupBy(BATCH).agg(
        F.sum("copies").alias("row_count"), F.sum(repeated).alias("duplicate_rows"),
        *[F.sum(name).alias(name) for name in FAULTS],
    )
    variants = paged = None
    if dataset.variants:
        bits = F.lit(0)
        for i, name in enumerate(dataset.variants):
            bits = F.when(F.col("_variant") == name, 1 << i).otherwise(bits)
        lacking = F.lit(len(dataset.variants)) - F.bit_count(F.bit_or(bits))
        variants = rows.groupBy(BATCH).agg(
            F.when(F.count("_variant") > 0, lacking).otherwise(0).alias("missing_variants")
        )
    if manifest is not None:
        told = rows.where(F.col("_faults").bitwiseAND(EMPTY_ANSWER) == 0).withColumnsRenamed({"_variant": "variant", "_page": "page"})
        told = told.select(*request_of(told), "_hash", "_copies", *dataset.key)
        pages = told.groupBy(*REQUEST, "page").agg(*fingerprint(F.col("_hash"), F.col("_copies")))
        unique = dataset.key and not dataset.drop_exact_copies
        paged = page_faults(manifest, pages, keys_on_many_pages(told, dataset.key) if unique else None)
    return judged(dataset, plan, counted, variants, paged)
