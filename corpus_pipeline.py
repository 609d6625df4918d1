"""A corpus made ready for training: documents rejected, copies removed, benchmarks taken out, texts encoded.

Each stage is (name, function) with function(spark, docs, sf_dir); its rows are written and read again as the next one's
documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.llm import byte_bpe, content_sort, ngram_join, quality, suffix_search
from pitlake.llm.common import kept, table


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on all labels, doesn't reject. Rows without a doc_id can't be named and go."""
    network = quality.train(docs, spark.read.parquet(table(sf_dir, "labels")))
    rejected = quality.score(docs, network).where("predicted = 0").select(F.col("doc_id").alias("_out")).distinct()
    named = docs.where(F.col("doc_id").isNotNull())
    return named.join(rejected, F.col("doc_id") == F.col("_out"), "left_anti")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of equal texts."""
    dropped = content_sort.exact_duplicates(docs).where("not kept").select(F.col("doc_id").alias("_out")).distinct()
    return docs.join(dropped, F.col("doc_id") == F.col("_out"), "left_anti")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group that n-gram links join."""
    dropped = ngram_join.jaccard_groups(docs).where("component_id <> doc_id").select(F.col("doc_id").alias("_out")).distinct()
    return docs.join(dropped, F.col("doc_id") == F.col("_out"), "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage of the benchmark stands."""
    return suffix_search.decontaminate(docs, spark.read.parquet(table(sf_dir, "benchmark")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text decoded from them."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encode_documents(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("quality_classifier", drop_low_quality),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("byte_level_bpe", encode),
]

#: The classifier is fitted, which SQL can't express; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table(sf_dir, "documents"))
    for _, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir))
    return docs
