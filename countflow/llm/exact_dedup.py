"""Exact deduplication by two-pass Bloom filtering: only rows whose hash may repeat are shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countflow.llm.bloom import may_repeat, without
from countflow.llm.text import lower_ascii, text_or_empty
from countflow.session import checkpoint, shuffle_partitions


def exact_groups(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: its id, the id that stays of its group, the group's size, whether it
    stays, and the SHA-256 of the text with A-Z lower-cased. Groups are equal such texts; the largest id stays.

    Null texts count as empty, and empty texts are equal. Of rows that share both text and id, all are marked
    as kept if that id stays: they are the same document. A null id stays only where its group has no
    other (``keep_id`` null). Repeated rows are counted one by one. An empty table gives an empty result.

    Pass one counts how many rows set each cell of a Bloom filter; pass two tests every row against the cells set twice. Rows
    that fail are single and go straight to the result. Only the rest shuffle, as ids and digests: groups are
    summed up before the shuffle, and in the join back a group larger than a task's fair share is dealt out by a salt.
    """
    spark = documents.sparkSession
    body = lower_ascii(text_or_empty(text))
    digests = checkpoint(documents.select(F.col(doc_id).alias("doc_id"), F.xxhash64(body).alias("_hash"), F.unhex(F.sha2(body, 256)).alias("_sha")))
    rows, parts = digests.count(), shuffle_partitions(spark)
    marked = may_repeat(digests, "_hash", rows, {"_maybe": 2, "_hot": max(2, rows // parts) + 1})
    single = marked.filter(~F.col("_maybe")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), "_sha")
    maybe = marked.filter("_maybe")
    groups = maybe.groupBy("_sha", "_hot").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    salts = F.when(F.col("_hot"), F.lit(parts)).otherwise(F.lit(1))
    members = maybe.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), salts.cast("bigint")))
    groups = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts.cast("bigint") - 1))).drop("_hot")
    joined = members.join(groups, ["_sha", "_salt"])
    checked = joined.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "_sha")
    return single.unionByName(checked).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("_sha")).alias("text_sha256"))


def drop_exact_copies(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` without the rows that ``exact_groups`` doesn't keep. Ids may repeat: a row goes for its own text. Rows that share id and text are
    one document and stay together; of texts that differ in case only and share an id, all stay."""
    groups = exact_groups(documents, doc_id, text).filter(~F.col("kept")).select(F.col("doc_id").alias("id"), "text_sha256")
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    body = F.sha2(lower_ascii(text_or_empty("text")), 256)
    marks = rows.select("doc_id", F.xxhash64("text").alias("mark"), body.alias("text_sha256"))
    gone = marks.join(groups.distinct(), (marks["doc_id"].eqNullSafe(groups["id"])) & (marks["text_sha256"] == groups["text_sha256"]), "left_semi")
    return without(documents, checkpoint(gone.select(F.col("doc_id").alias("id"), "mark").distinct()), doc_id, text)


def op5_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP5_SQL = """
WITH norm AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents
), grp AS (
  SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM norm GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM norm JOIN grp USING (text_sha256)
"""
