"""Every operator, and the pipeline's stages, on tables with one text of 4 MB in 40,000 lines and one of 1 MB in a single word."""

import os
import shutil
import time

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from countflow.llm.queries import QUERIES

LINES, WORD = 900_001, 900_002


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("long")
    for t in ("labels", "benchmark", "embeddings"):
        shutil.copy(f"/root/testdata/sf0.001/{t}.parquet", at / f"{t}.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rng = np.random.default_rng(1)
    words = np.array([f"w{i}" for i in range(5000)])
    lines = "\n".join(" ".join(words[row]) for row in rng.integers(0, 5000, (40_000, 18)))
    long = spark.createDataFrame([(LINES, lines, "en", "long", len(lines)), (WORD, "ab" * 500_000, "en", "long", 1_000_000)], docs.schema)
    docs.unionByName(long).repartition(2).write.parquet(os.path.join(at, "documents.parquet"))
    return str(at)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ("op11_lexical_search", "op12_centroids")])
def test_every_query_takes_them_whole(spark, tables, name):
    begin = time.monotonic()
    rows = QUERIES[name](spark, tables).filter(F.col("doc_id").isin(LINES, WORD)).collect()
    assert {r["doc_id"] for r in rows} == {LINES, WORD} and time.monotonic() - begin < 240
    first = next(r for r in rows if r["doc_id"] == LINES)
    if name == "op1_lm_scoring":
        assert first["n_tokens"] == 720_001 and first["score"] < first["n_tokens"] * -1
    if name == "op3_line_dedup":
        assert first["removed_lines"] == 0
    if name == "op6_quality":
        assert first["n_words"] == 720_000
    if name == "op8_best_fit_packing":
        own = [r for r in rows if r["doc_id"] == LINES]
        assert sorted(r["piece"] for r in own) == list(range(len(own))) and sum(r["length"] for r in own) > 720_000


def test_a_search_finds_them(spark, tables):
    from countflow.llm.lexical_search import search

    docs = spark.read.parquet(f"{tables}/documents.parquet")
    asked = spark.createDataFrame([(1, "ab" * 500_000), (2, "w17 w4999")], "item long, text string")
    found = {(r["item"], r["doc_id"]) for r in search(docs, "doc_id", "text", asked, "item", "text").collect()}
    assert found == {(1, WORD), (2, LINES)}


def test_the_stages_take_them(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").filter(F.col("doc_id") >= LINES)
    for _, stage in corpus_pipeline.STAGES[2:]:
        out = stage(spark, docs, tables)
        assert {r["doc_id"] for r in out.select("doc_id").distinct().collect()} == {LINES, WORD}
