"""The registered queries of the operators, over whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import abuse_terms, byte_bpe, centroid_tree, content_sort, kneser_ney, ngram_join, page_text, pair_bitmaps, perspectives, quality, sharding, suffix_dedup, suffix_search
from .common import table

RANKS = "byte_bpe_multi_50k.tiktoken"
SHARDS = 24
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table(sf_dir, name))


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_groups(read(spark, sf_dir, "documents"))


def op1_ngram_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1_ngram_join, whose SQL has no such column, with the number of links of every document."""
    return ngram_join.jaccard_join(read(spark, sf_dir, "documents"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = kneser_ney.score_held_out(read(spark, sf_dir, "documents"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents")).drop("spans")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encoding_digests(read(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(read(spark, sf_dir, "pages"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score_held_out(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shard_documents(read(spark, sf_dir, "documents"), SHARDS)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.exact_duplicates(read(spark, sf_dir, "documents"), keep="largest")


def op9_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rotated = perspectives.rotate(read(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda span: F.concat_ws(":", span["start"], span["length"]))
    return rotated.withColumn("mask", F.array_join(spans, ","))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_search.find_benchmark(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    n_items, digest = suffix_search.digest_of_items()
    return found.select(
        "doc_id", "n_words", "n_hit", n_items.alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_tree.with_inertia(*centroid_tree.cluster(read(spark, sf_dir, "embeddings")))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = abuse_terms.score_held_out(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    figures, _ = pair_bitmaps.align(read(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_LEVEL), public_tokenizers.path(PIECES))
    return figures


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op1_ngram_links": op1_ngram_links,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_html_extraction": op5_html_extraction,
    "op6_quality": op6_quality,
    "op7_sharding": op7_sharding,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_perspectives": op9_perspectives,
    "op10_decontamination": op10_decontamination,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_toxicity": op12_toxicity,
    "op13_token_alignment": op13_token_alignment,
}
