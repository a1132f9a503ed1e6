"""Sorts, limits and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from countflow.session import checkpoint


def sort_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Sorted within partitions, which follow one another in order of the key."""
    return df.repartitionByRange(*key).sortWithinPartitions(*key)


def number_rows(df: DataFrame, key: Sequence[str], out: str) -> DataFrame:
    """``df`` with 1, 2, ... in order of the key, which no two rows share. Rows are dealt out by ranges of the key and numbered there; the ranges' sizes, a row for each task, tell
    where each begins."""
    parts = checkpoint(sort_key(df, key).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()))
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return parts.join(F.broadcast(before.select("_part", "_first", "_before")), "_part").withColumn(out, F.col("_before") + F.col("_at") - F.col("_first") + 1).drop("_part", "_at", "_first", "_before")


def top_n(df: DataFrame, n: int, by: Sequence[Column]) -> DataFrame:
    return df.orderBy(*by).limit(n)


def best_per_key(df: DataFrame, key: Sequence[str], score: Column, cols: Sequence[str]) -> DataFrame:
    """The row of the largest ``score`` (a struct states the rule for ties) of each key."""
    return df.groupBy(*key).agg(F.max_by(F.struct(*cols), score).alias("_b")).select(*key, *[F.col(f"_b.{c}").alias(c) for c in cols])


def best_rows(df: DataFrame, key: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows of each key by ``order``."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter(F.col("_r") <= n).drop("_r")


def quantile_groups(df: DataFrame, value: str, q: int = 5, out: str = "group") -> DataFrame:
    """1 .. ``q`` by interpolated quantiles, right-closed, so equal values share a group."""
    from countflow.operators.quantiles import exact_quantiles

    edges = exact_quantiles(df, value, [i / q for i in range(1, q)]).select(F.col("quantiles").alias("_e"))
    group = F.size(F.filter("_e", lambda e: e < F.col(value))) + 1
    return df.join(F.broadcast(edges), how="left").withColumn(out, F.when(F.col(value).isNotNull(), group)).drop("_e")  # one row, or none without a value


def sample_keys(df: DataFrame, key: Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """``n`` keys, the same ones in every run: those that hash lowest."""
    return df.select(*key).distinct().orderBy(F.xxhash64(*key, F.lit(seed)), *key).limit(n)


def sample_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """Up to ``n`` rows of each key, by a hash of ``order``."""
    w = Window.partitionBy(*key).orderBy(F.xxhash64(*order, F.lit(seed)), *order)
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def bounded_backlog(df: DataFrame, day: str, expires: Column, n: int) -> DataFrame:
    """A work list: what expires first, oldest first, then the rest, newest first."""
    rank = F.when(expires, F.unix_date(day)).otherwise(-F.unix_date(day))
    return df.orderBy(F.when(expires, 0).otherwise(1), rank).limit(n)
