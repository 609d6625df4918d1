"""The registered queries against SQL, and the pipeline against plain steps, on the smallest test data."""

import os
import re

import duckdb
import pytest

import corpus_pipeline
from pitlake.llm import quality
from pitlake.llm.oracle import ORACLE
from pitlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
from .test_operators import brute_components, brute_hits, fold  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"create view {table} as select * from read_parquet('{SF}/{table}.parquet')")
    expected = con.execute(ORACLE[name]).to_arrow_table().to_pylist()
    found = [r.asDict() for r in QUERIES[name](spark, SF).collect()]
    key = lambda row: sorted((k, str(v)) for k, v in row.items())
    assert sorted(map(key, found)) == sorted(map(key, expected))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_other_queries_give_a_row_each(spark, name):
    table, column = ("pages", "page_id") if name.startswith("op5") else ("documents", "doc_id")
    ids = {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(column).collect()}
    rows = QUERIES[name](spark, SF).select(column).collect()
    assert len(rows) == len(ids) and {r[0] for r in rows} == ids


def test_classifier_on_held_out_labels(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    found = [r for r in QUERIES["op6_quality"](spark, SF).collect() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in found) >= 0.85 * len(found)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    network = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {r.doc_id for r in quality.score(docs, network).collect() if r.predicted}
    first = {}
    for i in sorted(kept):
        first.setdefault(fold(texts[i]), i)
    kept = sorted(first.values())
    kept = [i for i, _, label in brute_components([(i, texts[i]) for i in kept]) if i == label]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = set()
    for _, body in items:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(body))
        n = min(10, len(words))
        windows |= {tuple(words[a : a + n]) for a in range(len(words) - n + 1)}

    def hit(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(text))
        return any(tuple(words[p : p + n]) in windows for n in {len(w) for w in windows} for p in range(len(words) - n + 1))

    expected = {i: texts[i] for i in kept if not hit(texts[i])}
    out = corpus_pipeline.run(spark, SF)
    assert {r.doc_id: r.decoded for r in out.collect()} == expected
    assert brute_hits([(1, "")], items)[0][2] == 0
