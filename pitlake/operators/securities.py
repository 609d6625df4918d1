"""What was known about securities on a day: names, listing, index and industry membership."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.functions.newest import first, newest
from pitlake.functions.predicates import listed_on, valid_on
from pitlake.sources.datasets import DATASETS

# Marks inside a security's name.
ST_MARK = "ST"
DELISTING_MARK = "退"

# A name in force, as the point-in-time tables show it.
NAME_FIELDS = {
    "historical_name": "name",
    "name_start_date": "start_date",
    "name_end_date": "end_date",
    "name_ann_date": "ann_date",
    "change_reason": "change_reason",
    "is_st": "is_st",
    "is_delisting": "is_delisting",
}
NAME_COLUMNS = [
    "historical_name", "name_start_date", "name_end_date", "name_ann_date", "change_reason",
    "has_name_history", "is_st", "is_delisting",
]


def name_history(namechange: DataFrame) -> DataFrame:
    return namechange.select(
        *DATASETS["namechange"].columns,
        F.contains(F.upper("name"), F.lit(ST_MARK)).alias("is_st"),
        F.contains(F.col("name"), F.lit(DELISTING_MARK)).alias("is_delisting"),
    )


def _named(history: DataFrame) -> DataFrame:
    renamed = [F.col(source).alias(shown) for shown, source in NAME_FIELDS.items()]
    return history.select("ts_code", *renamed)


def names_asof(namechange: DataFrame, as_of: date) -> DataFrame:
    """One name per security: of those valid on the day, the one that began last."""
    history = name_history(namechange)
    valid = history.where(valid_on(F.col("start_date"), F.col("end_date"), as_of))
    return _named(newest(valid, ["ts_code"], ["start_date", "ann_date"]))


def with_names(rows: DataFrame) -> DataFrame:
    """Adds the flag that tells an unknown name from a known one."""
    return rows.withColumn("has_name_history", F.col("historical_name").isNotNull())


def security_status_asof(
    stock_basic: DataFrame, namechange: DataFrame, as_of: date
) -> DataFrame:
    listed = listed_on(F.col("list_date"), F.col("delist_date"), as_of)
    return with_names(
        stock_basic.select(
            "ts_code", "symbol", F.col("name").alias("current_name"), "list_date", "delist_date"
        ).join(names_asof(namechange, as_of), "ts_code", "left")
    ).select(
        "ts_code", "symbol", "current_name", *NAME_COLUMNS, "list_date", "delist_date",
        listed.alias("is_listed"),
    )


def name_spans(namechange: DataFrame) -> DataFrame:
    """Each security's history as disjoint spans [span_start, span_stop) with the name in force.

    A fact row meets at most one span, so a whole fact table is looked up by one join that neither
    multiplies rows nor ranks and sorts them afterwards. A security's names are held in one row:
    they are keyed by start day, so there are never more of them than days. Without a join in its
    derivation, Spark estimates the result by the size of the table and broadcasts it only if that
    is small; otherwise the facts are shuffled by security.
    """
    history = _named(name_history(namechange))
    order = ["name_start_date", "name_ann_date"]
    rest = [name for name in history.columns if name not in ("ts_code", *order)]
    names = history.groupBy("ts_code").agg(
        F.sort_array(F.collect_list(F.struct(*order, *rest))).alias("names")
    )
    begins = F.transform("names", lambda name: name["name_start_date"])
    lapses = F.transform("names", lambda name: F.date_add(name["name_end_date"], 1))
    turns = F.array_sort(F.array_distinct(F.array_compact(F.concat(begins, lapses))))
    spans = names.withColumn("turns", turns).select(
        "ts_code", "names", "turns", F.posexplode("turns").alias("turn", "span_start")
    )
    in_force = F.filter(
        "names",
        lambda name: valid_on(name["name_start_date"], name["name_end_date"], F.col("span_start")),
    )
    return spans.select(
        "ts_code",
        "span_start",
        F.get("turns", F.col("turn") + 1).alias("span_stop"),
        F.try_element_at(in_force, F.lit(-1)).alias("name"),
    ).where(F.col("name").isNotNull()).select("ts_code", "span_start", "span_stop", "name.*")


def index_members_asof(index_weight: DataFrame, index_code: str, as_of: date) -> DataFrame:
    """The newest weight snapshot of an index that is not later than the day."""
    weights = index_weight.where(F.col("index_code") == F.lit(index_code))
    snapshot = weights.where(F.col("trade_date") <= F.lit(as_of)).agg(F.max("trade_date"))
    return weights.where(F.col("trade_date") == snapshot.scalar()).select(
        "index_code", "con_code", F.col("trade_date").alias("snapshot_date"), "weight"
    )


def stock_industry_asof(index_member_all: DataFrame, as_of: date) -> DataFrame:
    """One industry per stock: entered last; then still open or left last; then lowest code."""
    columns = DATASETS["index_member_all"].columns
    valid = index_member_all.select(*columns).where(
        valid_on(F.col("in_date"), F.col("out_date"), as_of)
    )
    order = [
        -F.unix_date("in_date"),
        F.col("out_date").isNotNull(),
        -F.unix_date("out_date"),
        F.col("l3_code"),
    ]
    return first(valid, ["ts_code"], order)


def universe(
    status: DataFrame,
    members: DataFrame | None = None,
    exclude_st: bool = False,
    exclude_delisting: bool = False,
) -> DataFrame:
    """Listed stocks, optionally only members of an index; unknown names fail the exclusions."""
    rows = status.where("is_listed")
    if exclude_st:
        rows = rows.where(F.col("is_st") == F.lit(False))
    if exclude_delisting:
        rows = rows.where(F.col("is_delisting") == F.lit(False))
    if members is None:
        rows = rows.select(
            "*",
            F.lit(None).cast("string").alias("index_code"),
            F.lit(None).cast("date").alias("snapshot_date"),
            F.lit(None).cast("double").alias("weight"),
        )
    else:
        rows = rows.join(members.withColumnRenamed("con_code", "ts_code"), "ts_code")
    return rows.select(
        "ts_code", "symbol", *NAME_COLUMNS, "list_date", "delist_date",
        "index_code", "snapshot_date", "weight",
    )
