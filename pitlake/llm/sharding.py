"""Shards of near equal size by longest-processing-time scheduling.

Groups of equal texts stay together. Scheduling every group through one heap would bring all groups to
the driver, so only the large ones go there one by one: those over a `fineness`-th of a shard's fair
share, of which there are at most shards * fineness. The others are dealt by their digest into
shards * fineness bundles of about that size. Groups and bundles, a number that the data cannot
raise, are sorted by size and each goes to the least-loaded shard.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import kept, text_frame

ROW_BYTES = 8  # counted for each row beside its text


def longest_first(units: Iterable[tuple[str, int]], shards: int) -> dict[str, int]:
    """Shard of each unit: by falling size (ties by name), each to the least-loaded shard (ties: the lowest)."""
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for name, size in sorted(units, key=lambda unit: (-unit[1], unit[0])):
        load, shard = heapq.heappop(heap)
        placed[name] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def shard_documents(documents: DataFrame, shards: int = 24, fineness: int = 400, slot_buckets: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every document; slots count from 0 without gaps.

    Null text counts as empty, and all empty texts are one group. Repeated rows each get a slot. Rows
    without a doc_id are left out; other columns are ignored; an empty table gives an empty one. A group
    larger than a shard's fair share fills a shard of its own: then sizes are as near as the group allows.
    """
    if shards < 1 or fineness < 1:
        raise ValueError("shards and fineness are 1 or more")
    spark = documents.sparkSession
    rows = text_frame(documents).select(
        "doc_id",
        (F.octet_length("text") + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
    )
    groups = kept(rows.groupBy("digest").agg(F.sum("size").alias("size")))
    total = groups.agg(F.sum("size")).first()[0] or 0
    bound = max(1, -(-total // (shards * fineness)))
    # 16 hex digits of SHA-256 deal small groups evenly.
    bundle = F.pmod(F.xxhash64("digest"), F.lit(shards * fineness))
    unit = F.when(F.col("size") >= bound, F.concat(F.lit("g"), F.hex("digest"))).otherwise(F.concat(F.lit("b"), bundle))
    units = groups.select(unit.alias("unit"), "size").groupBy("unit").agg(F.sum("size").alias("size"))
    # At most shards * fineness groups reach the bound, and as many bundles exist.
    placed = longest_first(((r["unit"], r["size"]) for r in units.toLocalIterator()), shards)
    large = [(name[1:], shard) for name, shard in placed.items() if name[0] == "g"]
    bundles = [(int(name[1:]), shard) for name, shard in placed.items() if name[0] == "b"]
    large_df = F.broadcast(spark.createDataFrame(large, "hexed string, large_shard int").select(F.unhex("hexed").alias("digest"), "large_shard"))
    bundle_df = F.broadcast(spark.createDataFrame(bundles, "bundle long, bundle_shard int"))
    sharded = kept(
        rows.withColumn("bundle", F.pmod(F.xxhash64("digest"), F.lit(shards * fineness)))
        .join(large_df, "digest", "left")
        .join(bundle_df, "bundle", "left")
        .select("doc_id", "size", "text_crc32", F.coalesce("large_shard", "bundle_shard").alias("shard"))
    )
    # Slots: rows are numbered within (shard, bucket), and buckets start where those before them end.
    buckets = slot_buckets or max(1, -(-sharded.count() // (shards * 20_000)))
    bucketed = sharded.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)).cast("int"))
    counts = bucketed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return (
        bucketed.withColumn("place", F.row_number().over(within))
        .join(starts, ["shard", "bucket"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("place") - 1).cast("long").alias("slot"))
    )
