"""Jump consistent hashing: stable keys to shards without a ring table (Lamping and Veach, 2014)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countflow.llm.text import text_or_empty
from countflow.session import shuffle_partitions

#: A key makes about ln(n) jumps; the chance of more than these is below 1e-50 for any shard count up to 2**31.
MAX_JUMPS = 160


def _landing(seed: Column, at: Column) -> Column:
    """The bucket that a key in bucket ``at`` jumps to as buckets are appended."""
    draw = F.shiftrightunsigned(F.xxhash64(seed, at), 33) + F.lit(1)  # 1 .. 2**31
    return F.floor((at + F.lit(1)).cast("double") * F.lit(float(1 << 31)) / draw.cast("double")).cast("bigint")


def jump_hash(key: Column, shards: int) -> Column:
    """Shard 0 .. ``shards`` - 1 of ``key``. Each jump's draw is XXH64 of the key's hash and the bucket
    that it leaves, so the chain of jumps is the same for every shard count and one more
    shard takes keys only into itself. A null key is a key like any other."""
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    seed = F.xxhash64(key)

    def step(at: Column, _: Column) -> Column:
        to = _landing(seed, at)
        return F.when(to < shards, to).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, MAX_JUMPS))), F.lit(0).cast("bigint"), step)


def assign_shards(df: DataFrame, key: str, shards: int, shard_col: str = "shard", grown_col: str | None = "grown_shard") -> DataFrame:
    """``df`` with its rows' shard and, in ``grown_col``, the shard with one more. A projection: no shuffle, no table.

    Rows with the same key share a shard; a column that already has one of the new names is replaced.
    """
    out = df.withColumn(shard_col, jump_hash(F.col(key), shards))
    if grown_col:
        out = out.withColumn(grown_col, F.when(_landing(F.xxhash64(F.col(key)), F.col(shard_col)) == shards, F.lit(shards).cast("int")).otherwise(F.col(shard_col)).cast("int"))
    return out.withColumn(shard_col, F.col(shard_col).cast("int"))


def number_slots(df: DataFrame, shard_col: str, order: list[str], slot_col: str = "slot") -> DataFrame:
    """``df`` with a gapless place from 0 in its shard.

    A shard can hold much of the table, so no window spans one: rows fall into blocks by a hash of
    ``order``, equal rows are counted before the shuffle and written out again at the end, and a
    running sum over the small table of block sizes gives each block its first slot. ``order`` together with
    ``shard_col`` must be all columns of ``df``; places among equal rows are interchangeable.
    """
    from pyspark.sql import Window

    blocks = shuffle_partitions(df.sparkSession)
    cols = [shard_col, *order]
    counted = df.select(*cols).withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(blocks))).groupBy("_block", *cols).agg(F.count("*").alias("_n"))
    sizes = counted.groupBy(shard_col, "_block").agg(F.sum("_n").alias("_rows"))
    before = Window.partitionBy(shard_col).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(F.col(shard_col).alias("_s"), F.col("_block").alias("_b"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy(shard_col, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    joined = placed.join(first, placed[shard_col].eqNullSafe(first["_s"]) & (placed["_block"] == first["_b"]))
    start = F.col("_first") + F.col("_before")
    return joined.select(*cols, F.explode(F.sequence(start, start + F.col("_n") - 1)).alias(slot_col))


def shard_manifest(documents: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: size in bytes plus one, CRC-32, shard, slot, and the shard with one more.

    A null text has size 1 and the CRC-32 of nothing (0); a null id is hashed as null. Repeated rows each get a
    slot. An empty table gives an empty result, and other columns of the input aren't read.
    """
    body = text_or_empty(text)
    rows = documents.select(F.col(doc_id).alias("doc_id"), (F.octet_length(body).cast("bigint") + 1).alias("size"), F.crc32(body).alias("text_crc32"))
    placed = number_slots(assign_shards(rows, "doc_id", shards, grown_col=None), "shard", ["doc_id", "size", "text_crc32"])
    return assign_shards(placed, "doc_id", shards).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"), "grown_shard")


def op7_shard(spark, sf_dir: str) -> DataFrame:
    return shard_manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"), 16)
