"""The corpus pipeline: documents to packed token sequences, in five stages.

Each stage takes what the stage before kept and its decisions take effect; all but the last return the columns of
``documents``. Models are fitted on the labelled documents among those a stage is given.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countflow.llm import line_dedup, near_copies, packing, quality, simhash, toxicity
from countflow.llm.text import id_remainder
from countflow.session import shared_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the classifier go, null and empty texts among them; repeated rows share their fate, an empty table stays empty."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.drop_bad(docs, model)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.3 or more go; labels are learned from the same fold as in the query op4_toxicity. Null and empty texts are scored too,
    repeated rows share their fate, an empty table stays empty."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels, where=id_remainder("doc_id", 4) != 2))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go, but for their first place; every document stays, null and empty texts as they are. Rows that share id and text are one document.
    ``n_chars`` follows the text. An empty table stays empty."""
    out = line_dedup.drop_repeated_chunks(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays: first of those whose fingerprints nearly agree, then, among
    the documents left, of those whose sets of 5-word shingles have a similarity of 0.8 or more. Null and empty texts are copies of each other; rows without an id stay;
    rows that share id and text are one document. An empty table stays empty."""
    return near_copies.drop_similar(simhash.drop_near_copies(docs)).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 ids. A null text counts as empty (the end id alone), repeated rows are packed one by one, an empty table gives an empty result."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("line dedup", line_dedup_stage),
    ("simhash near-dedup", near_dedup),
    ("best-fit packing", pack),
]

#: Hashes, models and tokenizers are beyond SQL; tests/llm/test_pipeline.py compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    at = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{k}")
        docs = spark.read.parquet(f"{at}/{k}")
    return docs
