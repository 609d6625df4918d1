"""Ordered against unordered results and constraints over a market of full size, made below a folder.

``python -m workload.market_size FOLDER [CODES] [DAYS]`` writes the tables it needs once and prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake import MarketLake, build_session
from pitlake.operators.tradability import stock_trade_constraints, trade_constraints
from pitlake.sources.datasets import DATASETS


def made(spark: SparkSession, name: str, codes: int, days: int) -> DataFrame:
    """A row per security and trading day, values by rule; a tenth of the days fall out of the weekly pattern."""
    rows = spark.range(codes * days).select(
        F.format_string("%06d.SZ", F.col("id") % codes).alias("ts_code"),
        F.date_add(F.lit("2010-01-04").cast("date"), (F.col("id") / codes * 7 / 5).cast("int")).alias("trade_date"),
        ((F.col("id") * 7919) % 10_007 / 100 + 1).alias("x"),
    ).dropDuplicates(["ts_code", "trade_date"])
    x = F.col("x")
    rules = {"high": x + 1, "low": x - 1, "up_limit": x * 1.1, "down_limit": x * 0.9, "adj_factor": 1 + F.floor(x / 10)}
    return rows.select(*[
        F.col(f.name) if f.name in ("ts_code", "trade_date") else rules.get(f.name, x).cast("double").alias(f.name)
        for f in DATASETS[name].schema
    ])


def masters(spark: SparkSession, codes: int) -> dict[str, DataFrame]:
    code = spark.range(codes).select(F.format_string("%06d.SZ", "id").alias("ts_code"))
    stocks = code.select("ts_code", F.lit("2010-01-01").cast("date").alias("list_date"))
    names = code.select("ts_code", F.lit("name").alias("name"), F.lit("2010-01-01").cast("date").alias("start_date"))
    events = code.where("hash(ts_code) % 50 = 0").select(
        "ts_code", F.lit("2010-02-01").cast("date").alias("trade_date"), F.lit("S").alias("suspend_type"))
    found = {"stock_basic": stocks, "namechange": names, "suspend_d": events}
    return {
        name: rows.select(*[
            (F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in DATASETS[name].schema
        ]) for name, rows in found.items()
    }


def main(folder: str, codes: int = 4000, days: int = 1200) -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "market_size", spark__master=f"local[{cpus}]", spark__sql__shuffle__partitions="32", spark__driver__memory="8g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__local__dir=f"{folder}/spark",
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = {}
    for name in ("daily", "adj_factor", "stk_limit"):
        path = f"{folder}/{name}"
        if not os.path.exists(f"{path}/_SUCCESS"):
            made(spark, name, codes, days).repartition(64, "trade_date").sortWithinPartitions("trade_date", "ts_code").write.parquet(path)
        tables[name] = spark.read.parquet(path)
    tables |= masters(spark, codes)
    market = MarketLake(spark, tables=tables)

    def constraints() -> DataFrame:
        facts = trade_constraints(tables["stk_limit"], tables["suspend_d"], tables["daily"], bucketed=True)
        return stock_trade_constraints(facts, tables["stock_basic"], tables["namechange"])

    queries = {
        "unordered_qfq": lambda: market._bars(None, None, None, "qfq", None)[0],
        "ordered_qfq": lambda: market.bars(adjust="qfq"),
        "sorted_qfq": lambda: market._bars(None, None, None, "qfq", None)[0].orderBy("trade_date", "ts_code"),
        "stock_trade_constraints": constraints,
    }
    seconds: dict[str, list[float]] = {}
    for _ in range(3):
        for name, build in queries.items():
            begin = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            seconds.setdefault(name, []).append(round(time.perf_counter() - begin, 2))
    print(json.dumps({"rows": tables["daily"].count(), "cpus": int(cpus), "seconds": {n: sorted(s)[1] for n, s in seconds.items()}}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], *map(int, sys.argv[2:]))
